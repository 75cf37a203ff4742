"""Identity of a row by its content.

Two rows are the same when all their source columns are. The digest takes the columns
by name and leaves out those that are NULL, so a column that a table gains later does
not change the identity of rows that lack it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.typed import column_ref


def source_columns(df: DataFrame) -> list[str]:
    """The columns that came with the data, without what a run adds."""
    return sorted((c for c in df.columns if c not in L.ADDED_COLUMNS), key=str.lower)


def content_digest(df: DataFrame) -> Column:
    """SHA-256 of name, length and value of every source column that is not NULL."""
    parts = []
    for name in source_columns(df):
        value = column_ref(name).cast("string")
        length = F.length(value).cast("string")
        # concat is NULL where the value is, and concat_ws leaves it out.
        parts.append(F.concat(F.lit(f"{len(name)}:{name.lower()}="), length, F.lit(":"), value))
    return F.sha2(F.concat_ws("|", *parts), 256)


def with_identity(df: DataFrame) -> DataFrame:
    """``df`` with the digest; one that is stored already stays as it is.

    A row that was corrected in quarantine keeps the identity it was delivered with.
    """
    digest = content_digest(df)
    if L.ROW_DIGEST in df.columns:
        digest = F.coalesce(F.col(L.ROW_DIGEST), digest)
    return df.withColumn(L.ROW_DIGEST, digest)
