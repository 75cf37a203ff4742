"""Tables addressed by path, behind one format option.

A Parquet table is a folder of versions, and a version a folder of writes:
``<path>/<version>/_write=<id>/part-...``. A small file next to the table names the
version that counts and the schema. An overwrite fills a new version and then writes the
next such file, so readers have the old rows or the new ones at every moment, also after a
writer has died; the version before stays for readers that have begun. Each write being a
partition of its own, it can be read, measured and replaced alone.
"""

from __future__ import annotations

import hashlib
import json
import logging
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.typed import column_ref
from .. import files
from ..labels import WRITE
from ..session import COMPRESSION

LOG = logging.getLogger(__name__)

# A folder without a file of the format in it.
_EMPTY = {"UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND"}

_INTEGRAL = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


class SchemaConflict(ValueError):
    """Incoming data would lose a value in the stored table."""



def _fits(source: T.DataType, target: T.DataType) -> bool:
    """Every value of ``source`` has its own value in ``target``."""
    if source == target or isinstance(source, T.NullType):
        return True
    if isinstance(target, T.StringType):
        return isinstance(source, T.AtomicType) and not isinstance(source, T.BinaryType)
    if type(source) in _INTEGRAL and type(target) in _INTEGRAL:
        return _INTEGRAL.index(type(source)) <= _INTEGRAL.index(type(target))
    if isinstance(target, T.DoubleType):
        return isinstance(source, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType))
    if isinstance(target, T.FloatType):
        return isinstance(source, (T.ByteType, T.ShortType))
    if isinstance(target, T.DecimalType) and isinstance(source, T.DecimalType):
        whole = target.precision - target.scale
        return target.scale >= source.scale and whole >= source.precision - source.scale
    return isinstance(source, T.DateType) and isinstance(
        target, (T.TimestampType, T.TimestampNTZType)
    )


def _merged_type(name: str, source: T.DataType, target: T.DataType) -> T.DataType:
    """``target`` with the members that structs of ``source`` have besides, at any depth."""
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        own = {f.name.lower(): f for f in source}
        fields = []
        for f in target:
            new = own.pop(f.name.lower(), None)
            inner = f"{name}.{f.name}".lstrip(".")
            kind = f.dataType if new is None else _merged_type(inner, new.dataType, f.dataType)
            fields.append(T.StructField(f.name, kind))
        fields += [T.StructField(f.name, _storable(f.dataType)) for f in own.values()]
        return T.StructType(fields)
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return T.ArrayType(_merged_type(f"{name}.element", source.elementType, target.elementType))
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        value = _merged_type(f"{name}.value", source.valueType, target.valueType)
        return T.MapType(_merged_type(f"{name}.key", source.keyType, target.keyType), value)
    same = source.simpleString() == target.simpleString()
    if same or _fits(source, target):
        return target
    raise SchemaConflict(
        f"{name}: {source.simpleString()} cannot be stored as {target.simpleString()} without loss"
    )


def _storable(kind: T.DataType) -> T.DataType:
    """A column of nothing but NULLs is kept as text."""
    return T.StringType() if isinstance(kind, T.NullType) else kind


def _shaped(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """``value`` in the members, order and types of ``target``; what it lacks is NULL."""
    if source.simpleString() == target.simpleString():
        return value
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        own = {f.name.lower(): f for f in source}
        members = []
        for f in target:
            new = own.get(f.name.lower())
            if new is None:
                member = F.lit(None).cast(f.dataType)
            else:
                member = _shaped(value.getField(new.name), new.dataType, f.dataType)
            members.append(member.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*members))
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(value, lambda x: _shaped(x, source.elementType, target.elementType))
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        keyed = F.transform_keys(value, lambda k, _: _shaped(k, source.keyType, target.keyType))
        return F.transform_values(keyed, lambda _, v: _shaped(v, source.valueType, target.valueType))
    return value.cast(target)


def merged_schema(df: DataFrame, schema: T.StructType, keep_extra: bool = True) -> T.StructType:
    """``schema`` with what ``df`` has besides: new columns, and new members of structs.

    A type change that could lose a value raises, at any depth.
    """
    merged = _merged_type("", df.schema, schema) if schema.fields else T.StructType(
        [T.StructField(f.name, _storable(f.dataType)) for f in df.schema]
    )
    if not keep_extra:
        kept = {f.name.lower() for f in schema}
        merged = T.StructType([f for f in merged if f.name.lower() in kept])
    return merged


def align_to(df: DataFrame, schema: T.StructType, keep_extra: bool = True) -> DataFrame:
    """``df`` in the column order and types of ``schema``.

    Columns and struct members that ``df`` lacks become typed NULLs, those that only ``df``
    has follow at the end (columns are left out without ``keep_extra``), and a type change
    that could lose a value raises.
    """
    have = {f.name.lower(): f for f in df.schema}
    columns = []
    for f in merged_schema(df, schema, keep_extra):
        own = have.get(f.name.lower())
        if own is None:
            value = F.lit(None).cast(f.dataType)
        else:
            value = _shaped(column_ref(own.name), own.dataType, f.dataType)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def new_write() -> str:
    """A name for a write. Names are in the order of time, as far as clocks agree."""
    return f"{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class State:
    """What counts of a table: the version to read, its schema, which columns its writes
    are laid out by, whether every row has the table's key, and the writes of another table
    that it has taken in."""

    version: str
    schema: T.StructType
    folders: tuple[str, ...] = ()
    complete: bool = False
    taken: tuple[str, ...] = ()
    # Its place in the order of states, which is the name of its file.
    number: int = field(default=-1, compare=False)

    def to_json(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "schema": self.schema.jsonValue(),
                "folders": list(self.folders),
                "complete": self.complete,
                "taken": list(self.taken),
            }
        ) + _END

    @classmethod
    def from_json(cls, text: str) -> State:
        d = json.loads(text)
        schema = T.StructType.fromJson(d["schema"])
        return cls(d["version"], schema, tuple(d["folders"]), d["complete"], tuple(d["taken"]))


# What a complete file of a state ends with.
_END = "\n"

# The two sides of a split are folders of one version.
_SIDE = "_side"

@dataclass(frozen=True)
class Split:
    """A version that does not count yet, the rows set apart from it, and what was counted."""

    state: State
    apart: DataFrame
    counts: dict[str, int]


# Of the files that name a version, so many stay.
_STATES_KEPT = 5


@dataclass(frozen=True)
class Table:
    """A stored table.

    Writes may add columns, also to a declared ``schema``, whose own columns keep their
    types. ``key`` names a column of which the table remembers whether all rows have it,
    ``partition_by`` columns whose values become folders. A Parquet folder that something
    else has written is read as it is, and appended to; the first overwrite gives it
    versions. With ``known``, a dictionary, what counts is read once and remembered there.
    """

    path: str
    fmt: str = "parquet"
    schema: T.StructType | None = None
    key: str | None = None
    partition_by: tuple[str, ...] = ()
    known: dict[str, State | None] | None = field(default=None, compare=False, repr=False)

    @property
    def _states(self) -> str:
        return f"{self.path}.state"

    def state(self, spark: SparkSession) -> State | None:
        """What counts now; None for a table that is not there or that others have written."""
        if self.fmt != "parquet":
            return None
        if self.known is not None and self.path in self.known:
            return self.known[self.path]
        state = None
        for number in reversed(self._numbers(spark)):
            text = files.read_text(spark, self._state_path(number))
            if text.endswith(_END):
                state = replace(State.from_json(text), number=number)
                break
            # Somebody is writing it, or has died at it.
        if self.known is not None:
            self.known[self.path] = state
        return state

    def _numbers(self, spark: SparkSession) -> list[int]:
        found = files.names(spark, self._states)
        return [int(n.split(".")[0]) for n in found if n.endswith(".json")]

    def _state_path(self, number: int) -> str:
        return f"{self._states}/{number:020d}.json"

    def _put(self, spark: SparkSession, state: State, before: State | None) -> None:
        """Make ``state`` count after ``before``; raises if another one has done so meanwhile."""
        numbers = self._numbers(spark)
        self._check_unchanged(spark, before, numbers)
        # A number without a whole state behind it is of a writer that died.
        state = replace(state, number=numbers[-1] + 1 if numbers else 0)
        files.claim(spark, self._state_path(state.number), state.to_json())
        if self.known is not None:
            self.known[self.path] = state
        for number in numbers[: 1 - _STATES_KEPT]:
            files.delete(spark, self._state_path(number))

    def _check_unchanged(self, spark: SparkSession, before: State | None, numbers: list[int]) -> None:
        """Rows belong to the version that their writer has seen; if there is another one by
        now they would be lost in silence."""
        if not numbers or numbers[-1] == (before.number if before else -1):
            return
        now = replace(self, known=None).state(spark)
        if now is not None and now.number != (before.number if before else -1):
            raise RuntimeError(f"another run has changed {self.path} meanwhile")

    def layout(self, spark: SparkSession) -> T.StructType | None:
        """The columns by declaration and by what was written; None if neither tells."""
        state = self.state(spark)
        if state is None or self.schema is None:
            return self.schema if state is None else state.schema
        kept = {f.name.lower(): f for f in state.schema}
        fields = []
        for f in self.schema:
            stored = kept.pop(f.name.lower(), f)
            # A declared column keeps its type, but a struct may have gained members.
            fields.append(f if isinstance(f.dataType, T.AtomicType) else stored)
        return T.StructType([*fields, *kept.values()])

    def folder(self, spark: SparkSession) -> str:
        """Where the rows that count are."""
        state = self.state(spark)
        return self.path if state is None else f"{self.path}/{state.version}"

    def write_folder(self, spark: SparkSession, write: str) -> str:
        return f"{self.folder(spark)}/{WRITE}={write}"

    def writes(self, spark: SparkSession) -> list[str]:
        """The names of the writes that make up the table, oldest first."""
        mark = f"{WRITE}="
        found = files.names(spark, self.folder(spark)) if self.state(spark) else []
        return [n[len(mark) :] for n in found if n.startswith(mark)]

    def mark(self, spark: SparkSession, write: str) -> str:
        """What tells a write from another of its name: its files, by their unique names."""
        listed = "\n".join(files.names(spark, self.write_folder(spark, write)))
        return hashlib.sha256(listed.encode()).hexdigest()[:12]

    def complete(self, spark: SparkSession) -> bool:
        """Whether every row is known to have the table's key."""
        state = self.state(spark)
        return state is not None and state.complete

    def read(self, spark: SparkSession, writes: bool = False) -> DataFrame:
        """All rows; with ``writes`` also the name of the write each came with, as ``_write``."""
        reader = spark.read.format(self.fmt)
        layout = self.layout(spark) if self.fmt == "parquet" else None
        if self.fmt == "parquet" and self.state(spark) is not None:
            with_write = T.StructType([*layout.fields, T.StructField(WRITE, T.StringType())])
            rows = reader.schema(with_write).load(self.folder(spark))
            return rows.select(*(column_ref(c) for c in (*layout.names, *([WRITE] if writes else []))))
        if layout is not None:
            reader = reader.schema(layout)
        elif self.fmt == "parquet":
            reader = reader.option("mergeSchema", True)
        return reader.load(self.path)

    def read_or_none(self, spark: SparkSession, writes: bool = False) -> DataFrame | None:
        """The table, or None where there is none; other errors surface."""
        if files.exists(spark, self.folder(spark)):
            try:
                return self.read(spark, writes)
            except AnalysisException as e:
                if (e.getCondition() or "").split(".")[0] not in _EMPTY:
                    raise
        LOG.info("no table at %s", self.path)
        return None

    def append(self, df: DataFrame, compact: bool | str = False, write: str | None = None) -> int:
        """Append, aligned to the table's columns; returns the rows written.

        A ``write`` of a given name is replaced where the table has one.
        """
        spark = df.sparkSession
        state = self.state(spark)
        if state is None and (self.fmt != "parquet" or files.exists(spark, self.path)):
            target = self.layout(spark)
            if target is None:
                present = self.read_or_none(spark)
                target = T.StructType() if present is None else present.schema
            return self._write(align_to(df, target), self.path, "append", compact)[0]
        shaped = align_to(df, self.layout(spark) or T.StructType())
        name = write or new_write()
        if state is None:
            version, folders = new_write(), self._folders(shaped)
            folder = f"{self.path}/{version}/{WRITE}={name}"
            rows, complete = self._write(shaped, folder, "overwrite", compact, folders)
            self._put(spark, State(version, _plain(shaped.schema), folders, complete), None)
            return rows
        self._widen(spark, state, shaped)
        folder = self.write_folder(spark, name)
        rows, complete = self._write(shaped, folder, "overwrite", compact, state.folders)
        self._settle(spark, complete)
        if not rows:
            files.delete(spark, folder)
        return rows

    def _widen(self, spark: SparkSession, state: State, shaped: DataFrame) -> None:
        """Make a new schema count. Before the rows: a column without any reads NULL."""
        complete = state.complete and (self.key is None or self.key in shaped.columns)
        after = replace(state, schema=_plain(shaped.schema), complete=complete)
        if after != state:
            self._put(spark, after, state)

    def _settle(self, spark: SparkSession, complete: bool) -> None:
        """After rows have been added: the version they went to must be the one that counts."""
        state = self.state(spark)
        self._check_unchanged(spark, state, self._numbers(spark) if self.known is not None else [])
        if state.complete and not complete:
            self._put(spark, replace(state, complete=False), state)

    def overwrite(
        self, df: DataFrame, compact: bool | str = False, taken: Sequence[str] = (), write: str | None = None
    ) -> int:
        """Replace the table, of whose present rows ``df`` may be derived; returns the rows written.

        ``taken`` are writes of another table that the new rows stand for.
        """
        spark = df.sparkSession
        shaped = align_to(df, self.schema or T.StructType())
        if self.fmt != "parquet":
            return self._write(shaped, self.path, "overwrite", compact)[0]
        version = new_write()
        folder, folders = f"{self.path}/{version}/{WRITE}={write or new_write()}", self._folders(shaped)
        rows, complete = self._write(shaped, folder, "overwrite", compact, folders)
        self._switch(spark, State(version, _plain(shaped.schema), folders, complete, tuple(taken)))
        return rows

    def rewrite(self, spark: SparkSession, df: DataFrame) -> None:
        """Replace the rows but not the writes they came with: ``df`` has them as ``_write``."""
        before = self.state(spark)
        version = new_write()
        schema = merged_schema(df.drop(WRITE), self.layout(spark) or T.StructType())
        shaped = align_to(df, T.StructType([*schema.fields, T.StructField(WRITE, T.StringType())]))
        folders = self._folders(shaped)
        _, complete = self._write(shaped, f"{self.path}/{version}", "overwrite", False, (WRITE, *folders))
        taken = before.taken if before else ()
        self._switch(spark, State(version, _plain(schema), folders, complete, taken))

    def _switch(self, spark: SparkSession, state: State) -> None:
        before = self.state(spark)
        self._put(spark, state, before)
        if before is not None:
            for name in files.names(spark, self.path):
                if name < before.version.split("/")[0]:
                    files.delete(spark, f"{self.path}/{name}")

    def replace_writes(self, df: DataFrame, writes: Sequence[str], compact: bool | str = False) -> int:
        """Store rows as ``writes``, by their ``_write``; what the table has of those goes first.

        A run that died may be repeated so, whatever it had written.
        """
        spark = df.sparkSession
        state = self.state(spark)
        schema = merged_schema(df.drop(WRITE), self.layout(spark) or T.StructType())
        shaped = align_to(df, T.StructType([*schema.fields, T.StructField(WRITE, T.StringType())]))
        version = state.version if state else new_write()
        folders = state.folders if state else self._folders(shaped)
        if state:
            self._widen(spark, state, shaped.drop(WRITE))
            for name in writes:
                files.delete(spark, f"{self.path}/{version}/{WRITE}={name}")
        rows, complete = self._write(shaped, f"{self.path}/{version}", "append", compact, (WRITE, *folders))
        if state:
            self._settle(spark, complete)
        else:
            self._put(spark, State(version, _plain(schema), folders, complete), None)
        return rows

    def split(
        self, df: DataFrame, kept: Column, columns: Sequence[str], counts: Sequence[Column] = ()
    ) -> Split:
        """Write a next version of the rows of ``df`` that are ``kept``, and set the others apart.

        One job deals the rows by that condition as it goes through ``df`` once, and counts
        all ``rows``, the ``kept`` ones and the given ``counts`` on the way. The table gets
        ``columns``, all others are for the rows apart. Nothing counts before ``adopt``.
        """
        spark = df.sparkSession
        own = merged_schema(df.select(*map(column_ref, columns)), self.schema or T.StructType())
        more = [f for f in df.schema if f.name not in columns]
        df = align_to(df, T.StructType([*own.fields, *more]))
        version, name = new_write(), new_write()
        side = F.when(kept, F.lit("kept")).otherwise(F.lit("apart"))
        sided = df.select("*", side.alias(_SIDE), F.lit(name).alias(WRITE))
        written = Observation()
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(kept).alias("kept"), *counts]
        if self.key is not None and self.key in df.columns:
            counts.append(F.count(column_ref(self.key)).alias("keys"))
        folder = f"{self.path}/{version}"
        # With as many open files per task as sides, rows need not be sorted by side.
        _deal(sided.observe(written, *counts), folder, (_SIDE, WRITE), "overwrite")
        got = written.get
        if not got["kept"]:
            none = df.filter(F.lit(False))
            _deal(none, f"{folder}/{_SIDE}=kept/{WRITE}={name}", (), "overwrite")
        state = State(f"{version}/{_SIDE}=kept", _plain(own), (), got.get("keys") == got["rows"])
        apart = df.filter(F.lit(False))
        if got["kept"] < got["rows"]:
            schema = T.StructType([*_plain(df.schema).fields, T.StructField(WRITE, T.StringType())])
            apart = spark.read.schema(schema).parquet(f"{folder}/{_SIDE}=apart").drop(WRITE)
        return Split(state, apart, got)

    def adopt(self, spark: SparkSession, split: Split, taken: Sequence[str] = ()) -> None:
        """Make a split's kept rows the table, and remove those apart."""
        self._switch(spark, replace(split.state, taken=tuple(taken)))
        version = split.state.version.split("/")[0]
        files.delete(spark, f"{self.path}/{version}/{_SIDE}=apart")

    def take(self, spark: SparkSession, writes: Sequence[str]) -> None:
        """Remember that the table has taken in these writes of another one."""
        state = self.state(spark)
        self._put(spark, replace(state, taken=tuple(sorted({*state.taken, *writes}))), state)

    def _folders(self, df: DataFrame) -> tuple[str, ...]:
        return tuple(c for c in self.partition_by if c in df.columns)

    def _write(
        self, df: DataFrame, folder: str, mode: str, compact: bool | str, folders: tuple[str, ...] = ()
    ) -> tuple[int, bool]:
        """Rows written, and whether all of them have the key."""
        # Rows that survive a selective filter leave every task with a sliver.
        # Rebalancing gathers them into files of the advisory size and splits
        # what is larger. By a column of unique values that takes no sort, which
        # it otherwise does to deal rows out the same way when a task is redone.
        # The count is observed after that shuffle, in the writing stage, where
        # the rows of a task that ran twice count once.
        if compact:
            df = df.hint("rebalance", *([compact] if isinstance(compact, str) else []))
        written = Observation()
        counts = [F.count(F.lit(1)).alias("rows")]
        keyed = self.key is not None and self.key in df.columns
        if keyed:
            counts.append(F.count(column_ref(self.key)).alias("keys"))
        writer = df.observe(written, *counts).write.format(self.fmt).mode(mode)
        if self.fmt == "parquet":
            writer = writer.option("compression", COMPRESSION)
        if self.fmt == "delta":
            writer = writer.option("mergeSchema", True)
        if folders:
            writer = writer.partitionBy(*folders)
        writer.save(folder)
        got = written.get
        return got["rows"], keyed and got["keys"] == got["rows"]


def _deal(df: DataFrame, folder: str, by: tuple[str, ...], mode: str) -> None:
    """Write Parquet dealt by columns, without sorting rows by them where they have few values."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    spark = df.sparkSession
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "16")
    try:
        writer = df.write.mode(mode)
        (writer.partitionBy(*by) if by else writer).parquet(folder, compression=COMPRESSION)
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def _plain(schema: T.StructType) -> T.StructType:
    """Without the marks of columns that are never NULL: a table gains rows without them."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])
