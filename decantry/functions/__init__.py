from .names import normalize_columns, resolve_column, storage_name
from .rules import Rule, RuleSet, full_rules, simple_rules
from .typed import date_operand, numeric_value, on_or_before

__all__ = [
    "Rule",
    "RuleSet",
    "date_operand",
    "full_rules",
    "normalize_columns",
    "numeric_value",
    "on_or_before",
    "resolve_column",
    "simple_rules",
    "storage_name",
]
