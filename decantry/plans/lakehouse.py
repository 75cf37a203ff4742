"""Layout of a lakehouse: one table per layer under one root."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import files
from .. import labels as L
from ..operators.attempts import ATTEMPT_SCHEMA, with_attempts
from ..sources.commits import CommitLog
from ..sources.tables import Split, State, Table, new_write

_INGESTION = [
    T.StructField(L.INGESTED_AT, T.TimestampType()),
    T.StructField(L.SOURCE_FILE, T.StringType()),
    T.StructField(L.INGESTED_ON, T.StringType()),
    T.StructField(L.ROW_DIGEST, T.StringType()),
]
_VERDICT = [
    T.StructField(
        L.CHECKS,
        T.StructType(
            [
                T.StructField(name, T.BooleanType())
                for name in (
                    L.PRICE_PRESENT,
                    L.PRICE_POSITIVE,
                    L.DATE_PRESENT,
                    L.DATE_NOT_FUTURE,
                )
            ]
        ),
    ),
    T.StructField(L.IS_VALID, T.BooleanType()),
    T.StructField(L.REASONS, T.StringType()),
    T.StructField(L.CODE, T.StringType()),
]
_AUDIT = [
    T.StructField(L.REJECT_REASON, T.StringType()),
    T.StructField(L.VALIDATED_AT, T.TimestampType()),
    T.StructField(L.PIPELINE_VERSION, T.StringType()),
    T.StructField(L.QUARANTINE_ID, T.StringType()),
    T.StructField(L.ATTEMPTS, T.IntegerType()),
    T.StructField(L.DUE_ON, T.DateType()),
    T.StructField(L.VALIDATED_ON, T.DateType()),
]


@dataclass(frozen=True)
class Lakehouse:
    """Paths and schemas of the layers.

    With a ``contract`` (the columns of the source) every layer has a declared schema, to
    which deliveries may add columns. Without one schemas follow the data. A ``snapshot``
    lakehouse has no lineage and of the audit columns only the reason. ``measure_bytes``
    records the size of each write's own files as well as its rows; Delta does both by
    itself. ``known`` is what has been read about the tables; see ``opened``.
    """

    root: str
    table: str = "contracts"
    fmt: str = "parquet"
    contract: T.StructType | None = None
    gold_table: str = "top_groups"
    snapshot: bool = False
    measure_bytes: bool = False
    known: dict[str, State | None] | None = field(default=None, compare=False, repr=False)

    def opened(self) -> Lakehouse:
        """This lakehouse as a run sees it: schemas and versions are read once."""
        return self if self.known is not None else replace(self, known={})

    def _table(self, path: str, *extra: list[T.StructField], folders: tuple[str, ...] = ()) -> Table:
        schema = None
        if self.contract is not None and self.fmt != "delta":
            schema = T.StructType([*self.contract.fields, *(f for part in extra for f in part)])
        key = None if self.snapshot else L.ROW_DIGEST
        return Table(f"{self.root}/{path}", self.fmt, schema, key, folders, self.known)

    @property
    def _lineage(self) -> list[T.StructField]:
        return [] if self.snapshot else _INGESTION

    @property
    def bronze(self) -> Table:
        return self._table(f"bronze/{self.table}", self._lineage)

    @property
    def silver(self) -> Table:
        # The code column is there for consumers that select it and is always
        # NULL; the id is set on rows that came out of quarantine.
        origin = [
            T.StructField(L.CODE, T.StringType()),
            T.StructField(L.QUARANTINE_ID, T.StringType()),
        ]
        return self._table(f"silver/{self.table}", self._lineage, [] if self.snapshot else origin)

    @property
    def quarantine(self) -> Table:
        path = f"quarantine/{self.table}_errors"
        if self.snapshot:
            return self._table(path, _AUDIT[:1])
        return self._table(path, self._lineage, _VERDICT, _AUDIT, folders=(L.VALIDATED_ON,))

    @property
    def attempts(self) -> Table:
        path = f"{self.root}/quarantine/{self.table}_attempts"
        return Table(path, self.fmt, ATTEMPT_SCHEMA, known=self.known)

    @property
    def gold(self) -> Table:
        return Table(f"{self.root}/gold/{self.gold_table}", self.fmt, known=self.known)

    def gold_parts(self, group: str, amount: str) -> Table:
        """Totals of the writes of silver, from which those of gold are added up."""
        of = hashlib.sha256(f"{group}\n{amount}".encode()).hexdigest()[:12]
        path = f"{self.root}/gold/{self.gold_table}_parts_{of}"
        return Table(path, self.fmt, known=self.known)

    def _layer_path(self, layer: str) -> str:
        return {
            "bronze": self.bronze,
            "silver": self.silver,
            "quarantine": self.quarantine,
            "gold": self.gold,
        }[layer].path

    def commit_log(self, layer: str) -> CommitLog:
        if self.fmt == "delta":
            path = f"{self._layer_path(layer)}/_delta_log"
        else:
            # Outside the table's folder, which an overwrite empties.
            path = f"{self.root}/commits/{layer}/{self.table}"
        return CommitLog(self.table, layer, path)

    def commit_logs(self) -> list[CommitLog]:
        return [self.commit_log(layer) for layer in ("bronze", "silver", "quarantine")]

    def append(
        self,
        spark: SparkSession,
        layer: str,
        df: DataFrame,
        compact: bool | str = False,
        judged: int | None = None,
        write: str | None = None,
    ) -> int:
        """``judged``: rows the layer stands for, where this write adds only the new ones."""
        table, write = getattr(self, layer), write or new_write()
        rows = table.append(df, compact, write)
        self._record(spark, layer, "append", rows, [table.write_folder(spark, write)], judged)
        return rows

    def overwrite(
        self,
        spark: SparkSession,
        layer: str,
        df: DataFrame,
        compact: bool | str = False,
        taken: Sequence[str] = (),
    ) -> int:
        table: Table = getattr(self, layer)
        rows = table.overwrite(df, compact, taken)
        self._record(spark, layer, "overwrite", rows, [table.folder(spark)])
        return rows

    def adopt(self, spark: SparkSession, layer: str, split: Split, taken: Sequence[str] = ()) -> None:
        """Replace a layer by the kept rows of a split, see ``Table.split``."""
        table: Table = getattr(self, layer)
        table.adopt(spark, split, taken)
        self._record(spark, layer, "overwrite", split.counts["kept"], [table.folder(spark)])

    def replace_writes(
        self,
        spark: SparkSession,
        layer: str,
        df: DataFrame,
        writes: Sequence[str],
        compact: bool | str = False,
    ) -> int:
        table: Table = getattr(self, layer)
        rows = table.replace_writes(df, writes, compact)
        self._record(spark, layer, "append", rows, [table.write_folder(spark, w) for w in writes])
        return rows

    def _record(
        self,
        spark: SparkSession,
        layer: str,
        mode: str,
        rows: int,
        folders: list[str],
        judged: int | None = None,
    ) -> None:
        if self.fmt == "delta":
            return
        size = None
        if self.measure_bytes:
            # What others write meanwhile is in other folders.
            size = sum(files.bytes_below(spark, f) for f in folders)
        self.commit_log(layer).record(spark, mode, rows, size, judged=judged)

    def read_quarantine(self, spark: SparkSession) -> DataFrame | None:
        """Quarantined rows with their attempts folded in; None without a table."""
        rows = self.quarantine.read_or_none(spark)
        if rows is None:
            return None
        attempts = None if self.fmt == "delta" else self.attempts.read_or_none(spark)
        return with_attempts(rows, attempts)

    def register(
        self, spark: SparkSession, replace: bool = False, namespace: str | None = None
    ) -> list[str]:
        """Make the layers queryable by name as ``<layer>.<table>`` in SQL.

        With a ``namespace`` the databases are ``<namespace>_<layer>``, so that several
        lakehouses have room in one catalog. A name stands for the version that counts now;
        after an overwrite it is to be registered again. Returns the names as SQL takes them.
        """
        names = []
        for layer in ("bronze", "silver", "quarantine", "gold"):
            table: Table = getattr(self, layer)
            folder = table.folder(spark)
            if not files.exists(spark, folder):
                continue
            database = f"{namespace}_{layer}" if namespace else layer
            name = ".".join(_quoted(part) for part in (database, table.path.rsplit("/", 1)[1]))
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
            if spark.catalog.tableExists(name):
                external = spark.catalog.getTable(name).tableType == "EXTERNAL"
                if not (replace and external):
                    raise ValueError(f"the catalog already has a table {name}")
                spark.sql(f"DROP TABLE {name}")
            options = {}
            schema = None
            if self.fmt != "delta":
                # The stored layout tells the schema; no file is read for it.
                layout = table.layout(spark) or table.read(spark).schema
                state = table.state(spark)
                apart = state.folders if state else ()  # only in names of folders
                schema = T.StructType([f for f in layout if f.name not in apart])
                options["recursiveFileLookup"] = "true"
            spark.catalog.createTable(name, path=folder, source=self.fmt, schema=schema, **options)
            names.append(name)
        return names


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
