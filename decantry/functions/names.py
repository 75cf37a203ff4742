"""Column names: normalisation before storage and lookup of accepted spellings."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

# Characters that vanish before blanks become underscores.
_VANISHING = str.maketrans("", "", ";:{}()\n\t\r")


def storage_name(label: str) -> str:
    """Name under which a header label is stored.

    Accented letters vanish rather than being transliterated, and a tab or a
    line break inside a label vanishes rather than separating words.
    """
    spaced = label.strip().translate(_VANISHING)
    joined = re.sub(r"\s+", "_", spaced)
    return "".join(ch for ch in joined if ch == "_" or (ch.isascii() and ch.isalnum()))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its storage name; a schema-only change.

    Two labels may not collapse onto one name: Spark resolves names without
    regard to case, so such a table could be written but not queried.
    """
    names = [storage_name(c) for c in df.columns]
    seen = Counter(n.lower() for n in names)
    clashes = sorted({n for n in names if not n or seen[n.lower()] > 1})
    if clashes:
        raise ValueError(f"column labels {df.columns} collapse onto {clashes}")
    return df.toDF(*names)


def resolve_column(df: DataFrame, *spellings: str) -> str:
    """First of ``spellings`` that ``df`` has."""
    for name in spellings:
        if name in df.columns:
            return name
    raise ValueError(f"none of {list(spellings)} is among the columns {df.columns}")
