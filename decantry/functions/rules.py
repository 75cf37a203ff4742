"""Declarative row rules and the verdict columns derived from them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels as L
from .typed import column_ref, date_operand, numeric_value, on_or_before


@dataclass(frozen=True)
class Rule:
    """One row test.

    ``check`` may be NULL when ``operand`` is; a test that is never NULL has no
    operand.
    """

    name: str
    check: Column
    reason: str
    code: str | None = None
    operand: Column | None = None

    @property
    def failed(self) -> Column:
        return ~self.check

    @property
    def not_passed(self) -> Column:
        """True where the check is false or NULL, in a form scans can prune on."""
        return self.failed if self.operand is None else self.failed | self.operand.isNull()


@dataclass(frozen=True)
class RuleSet:
    """Rules in the order their reasons are listed.

    ``code_order`` names the rules in priority order of their codes, which is a
    separate order. With ``first_reason_only`` a row gets the reason of the first
    failing rule instead of all of them.
    """

    rules: Sequence[Rule]
    code_order: Sequence[str] = ()
    first_reason_only: bool = False
    undecided_reason: str = L.REASON_UNDECIDED
    undecided_code: str = L.CODE_UNDECIDED
    # Of the rule that days alone change: its name, and the first day on which it passes.
    timed: tuple[str, Column] | None = None

    @property
    def due(self) -> Column:
        """The day from which a row passes that only time is against; NULL for all others."""
        if self.timed is None:
            return F.lit(None).cast("date")
        name, day = self.timed
        others = reduce(and_, (r.check for r in self.rules if r.name != name))
        against = next(r.failed for r in self.rules if r.name == name)
        return F.when(others & against, day.cast("date"))

    @property
    def checks(self) -> Column:
        return F.struct(*(r.check.alias(r.name) for r in self.rules))

    @property
    def passed(self) -> Column:
        """Conjunction of the checks: NULL where none fails but some is NULL."""
        return reduce(and_, (r.check for r in self.rules))

    @property
    def rejected(self) -> Column:
        """Exact complement of ``passed`` being true, so no row is lost to NULL.

        It is spelled as plain comparisons because ``NOT coalesce(passed, false)``
        would push nothing down to the scan.
        """
        return reduce(or_, (r.not_passed for r in self.rules))

    @property
    def reasons(self) -> Column:
        if self.first_reason_only:
            first = reduce(
                lambda chain, r: chain.when(r.failed, F.lit(r.reason)), self.rules, F
            )
            return first.when(~self.rejected, F.lit("")).otherwise(F.lit(self.undecided_reason))
        listed = [F.when(r.failed, F.lit(r.reason)) for r in self.rules]
        listed.append(F.when(self.passed.isNull(), F.lit(self.undecided_reason)))
        return F.concat_ws(", ", *listed)

    @property
    def code(self) -> Column:
        by_name = {r.name: r for r in self.rules}
        ordered = [by_name[n] for n in self.code_order]
        chain = reduce(lambda c, r: c.when(r.failed, F.lit(r.code)), ordered, F)
        return chain.when(self.passed.isNull(), F.lit(self.undecided_code)).otherwise(
            F.lit(None).cast("string")
        )


def as_day(day: dt.date | Column | None) -> Column:
    if day is None:
        return F.current_date()
    return day if isinstance(day, Column) else F.lit(day)


def _price_rules(df: DataFrame, price: str) -> tuple[Rule, Rule]:
    amount = numeric_value(df, price)
    return (
        Rule(
            L.PRICE_PRESENT,
            column_ref(price).isNotNull(),
            L.REASON_PRICE_NULL,
            L.CODE_PRICE_NULL,
        ),
        Rule(
            L.PRICE_POSITIVE,
            amount > 0,
            L.REASON_PRICE_NOT_POSITIVE,
            L.CODE_PRICE_NOT_POSITIVE,
            operand=amount,
        ),
    )


def _date_present(date: str) -> Rule:
    return Rule(
        L.DATE_PRESENT, column_ref(date).isNotNull(), L.REASON_DATE_NULL, L.CODE_DATE_NULL
    )


def full_rules(
    df: DataFrame, price: str, date: str, as_of: dt.date | Column | None = None
) -> RuleSet:
    """Price present and positive, date present and not after ``as_of`` (today)."""
    present, positive = _price_rules(df, price)
    not_future = Rule(
        L.DATE_NOT_FUTURE,
        on_or_before(df, date, as_day(as_of)),
        L.REASON_DATE_FUTURE,
        L.CODE_DATE_FUTURE,
        operand=date_operand(df, date),
    )
    return RuleSet(
        rules=(present, positive, _date_present(date), not_future),
        code_order=(L.DATE_PRESENT, L.DATE_NOT_FUTURE, L.PRICE_PRESENT, L.PRICE_POSITIVE),
        timed=(L.DATE_NOT_FUTURE, date_operand(df, date)),
    )


def simple_rules(df: DataFrame, price: str, date: str) -> RuleSet:
    """Price present and positive, date present; a later date is accepted."""
    present, positive = _price_rules(df, price)
    return RuleSet(rules=(_date_present(date), present, positive), first_reason_only=True)
