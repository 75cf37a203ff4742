"""The layered run: ingest, gate, write both sides, summarise, reprocess."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from .. import labels as L
from ..functions.names import resolve_column
from ..functions.rules import RuleSet, full_rules, simple_rules
from ..operators.attempts import merge_attempts
from ..operators.copies import beyond, still_missing
from ..operators.gate import audit, clean, judged, quarantine
from ..operators.gold import group_totals, top_groups, top_n
from ..operators.identity import with_identity
from ..operators.ingest import with_ingest_metadata
from ..operators.matching import without_matches_in_large
from ..session import Scratch, one_row
from ..sources.contracts import read_contracts
from ..sources.tables import Table, align_to
from .lakehouse import Lakehouse

LOG = logging.getLogger(__name__)

@dataclass(frozen=True)
class Rules:
    """Which columns the gate reads, by accepted spelling."""

    price: Sequence[str] = L.PRICE_SPELLINGS
    signed_on: Sequence[str] = L.SIGNED_ON_SPELLINGS

    def resolve(self, df: DataFrame) -> tuple[str, str]:
        return resolve_column(df, *self.price), resolve_column(df, *self.signed_on)

    def full(self, df: DataFrame, as_of: dt.date) -> RuleSet:
        return full_rules(df, *self.resolve(df), as_of)

    def simple(self, df: DataFrame) -> RuleSet:
        return simple_rules(df, *self.resolve(df))


@dataclass(frozen=True)
class Clock:
    """Day and instant of a run, the same for everything the run writes.

    Left to each query, "today" could change between writing the clean and the
    rejected rows, and a row dated tomorrow would be in neither table or both.
    """

    as_of: dt.date
    run_ts: dt.datetime

    @classmethod
    def now(cls, spark: SparkSession) -> Clock:
        return cls(*spark.sql("SELECT current_date(), current_timestamp()").first())


@dataclass(frozen=True)
class Refinement:
    """A lakehouse and how to run it.

    Without ``once`` a run does what it says and no more: the input is appended to
    bronze, silver becomes the clean rows of bronze, and its rejects are appended to
    quarantine. With it a run may be repeated: what is delivered again enters bronze,
    silver and quarantine no second time, and rows moved out of quarantine stay in silver.
    A row is known by the content of all its source columns, and of equal rows there are as
    many as the delivery with most of them had. Different rows are kept whatever columns
    they share; ``row_key`` names some that the source must have, and implies ``once``.
    """

    lake: Lakehouse
    rules: Rules = field(default_factory=Rules)
    pipeline_version: str = "v1"
    mode: str = "dev"
    alert_above_pct: float = 5.0
    row_key: Sequence[str] | None = None
    once: bool = False
    as_of: dt.date | None = None
    run_ts: dt.datetime | None = None

    @property
    def keeps_once(self) -> bool:
        return self.once or bool(self.row_key)

    def opened(self) -> Refinement:
        """This job as one run: what it reads about its tables it reads once."""
        return replace(self, lake=self.lake.opened())

    def clock(self, spark: SparkSession) -> Clock:
        """Given times, or else now; a run at a given instant judges by its day."""
        now = Clock.now(spark)
        day = self.run_ts.date() if self.run_ts else now.as_of
        return Clock(self.as_of or day, self.run_ts or now.run_ts)


@dataclass(frozen=True)
class Summary:
    """Outcome of a run. ``moved`` is None unless quarantine was reprocessed."""

    total: int
    clean: int
    quarantine: int
    reject_pct: float
    alert: bool
    moved: int | None = None

    @classmethod
    def of(cls, total: int, clean: int, alert_above_pct: float | None = None) -> Summary:
        rejected = total - clean
        reject_pct = 100.0 * rejected / total if total else 0.0
        alert = alert_above_pct is not None and reject_pct > alert_above_pct
        return cls(total, clean, rejected, reject_pct, alert)

    def as_frame(self, spark: SparkSession) -> DataFrame:
        return one_row(
            spark,
            total=F.lit(self.total).cast("bigint"),
            clean=F.lit(self.clean).cast("bigint"),
            quarantine=F.lit(self.quarantine).cast("bigint"),
            reject_pct=F.lit(self.reject_pct).cast("double"),
            alert=F.lit(self.alert),
            moved=F.lit(self.moved).cast("bigint"),
        )


def ingest(
    spark: SparkSession, job: Refinement, input_path: str, clock: Clock | None = None
) -> int:
    """Append a delimited file to bronze with its lineage; returns the rows written."""
    rows = read_contracts(spark, input_path, job.lake.contract)
    return ingest_rows(spark, job, rows, input_path, clock)


def ingest_rows(
    spark: SparkSession,
    job: Refinement,
    rows: DataFrame,
    source: str | Column,
    clock: Clock | None = None,
    write: str | None = None,
) -> int:
    """Append rows to bronze with their lineage; returns the rows written.

    Under the name of a ``write`` that bronze has, the rows take its place.
    """
    job = job.opened()
    clock = clock or job.clock(spark)
    for name in job.row_key or ():
        resolve_column(rows, name)
    rows = with_identity(with_ingest_metadata(rows, source, clock.run_ts))
    stored = _identified(spark, job.lake.bronze, writes=True) if job.keeps_once else None
    if stored is None:
        # There is nothing to match it with: the delivery goes to bronze as it is read.
        written = job.lake.append(spark, "bronze", rows, write=write)
    else:
        with Scratch(spark) as scratch:
            # The delivery is read and digested once.
            rows, n = scratch.keep(rows)
            if write and L.WRITE in stored.columns:
                stored = stored.filter(F.col(L.WRITE) != write)
            written = job.lake.append(spark, "bronze", beyond(scratch, rows, n, stored), write=write)
            if written < n:
                LOG.info("%d rows of %s are in bronze already", n - written, source)
    LOG.info("%d rows of %s appended to bronze", written, source)
    return written


def _identified(spark: SparkSession, table: Table, writes: bool = False) -> DataFrame | None:
    """The table with the digest of every row, which is stored; None without a table.

    Rows that came without one, by other ways than a run, are given theirs for good the
    first time they are met. Afterwards a match scans that column alone.
    """
    rows = table.read_or_none(spark, writes=True)
    if rows is None:
        return None
    if table.fmt != "parquet":
        return with_identity(rows)
    if not table.complete(spark):
        rows = with_identity(rows)
        if L.WRITE in rows.columns:
            table.rewrite(spark, rows)
        else:
            table.overwrite(rows)
        rows = table.read(spark, writes=True)
    return rows if writes else rows.drop(L.WRITE)


def refine(
    spark: SparkSession,
    job: Refinement,
    input_path: str | None = None,
    reprocess_quarantine: bool = False,
    new_only: bool = False,
) -> Summary | None:
    """Gate bronze into silver and quarantine; None if there is no bronze.

    All of bronze, and silver is replaced; or with ``new_only`` the writes of bronze that
    silver has not taken in yet, which are appended, and of quarantine the rows whose day
    has come. Only a date in the future changes its verdict by itself, so the layers hold
    the same rows then. The counts are of what was gated.
    """
    job = job.opened()
    clock = job.clock(spark)
    lake = job.lake
    if input_path:
        ingest(spark, job, input_path, clock)

    if lake.bronze.read_or_none(spark) is None:
        LOG.error("there is no bronze table at %s", lake.bronze.path)
        return None
    if new_only and lake.bronze.state(spark):
        state = lake.silver.state(spark)
        taken = set(state.taken) if state else set()
        todo = [w for w in lake.bronze.writes(spark) if w not in taken]
        summary = gate_writes(spark, job, todo, clock)
    elif job.keeps_once:
        summary = _refine_once(spark, job, clock)
    else:
        summary = _refine_all(spark, job, clock)
    LOG.info("%d rows: %d clean, %d rejected", summary.total, summary.clean, summary.quarantine)
    if summary.alert:
        LOG.warning("rejection rate %.2f%% is above %.2f%%", summary.reject_pct, job.alert_above_pct)
    if reprocess_quarantine:
        moved = reprocess(spark, job, clock, due_only=new_only)
        summary = replace(summary, moved=moved)
    return summary


def _summary(job: Refinement, total: int, clean: int) -> Summary:
    return Summary.of(total, clean, job.alert_above_pct if job.mode == "prod" else None)


def _accepted(bronze: DataFrame, rules: RuleSet) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return clean(bronze, rules).withColumns({L.CODE: nothing, L.QUARANTINE_ID: nothing})


def _rejects(job: Refinement, bronze: DataFrame, rules: RuleSet, clock: Clock) -> DataFrame:
    rejects = quarantine(bronze, rules).withColumn(L.DUE_ON, rules.due)
    return audit(rejects, job.pipeline_version, clock.run_ts)


def gate_writes(
    spark: SparkSession, job: Refinement, writes: Sequence[str], clock: Clock | None = None
) -> Summary:
    """Gate these writes of bronze into writes of the same names in silver and quarantine.

    No other file of any layer is read. Gated again, after a run that died, they replace
    what they had become.
    """
    job = job.opened()
    clock = clock or job.clock(spark)
    lake = job.lake
    if not writes:
        return _summary(job, 0, 0)
    bronze = lake.bronze.read(spark, writes=True).filter(F.col(L.WRITE).isin(list(writes)))
    if not lake.bronze.complete(spark):
        bronze = with_identity(bronze)
    rules = job.rules.full(bronze, clock.as_of)
    rejects = _rejects(job, bronze, rules, clock)
    kept = lake.replace_writes(spark, "silver", _accepted(bronze, rules), writes)
    rejected = lake.replace_writes(spark, "quarantine", rejects, writes, compact=L.QUARANTINE_ID)
    lake.silver.take(spark, writes)
    return _summary(job, kept + rejected, kept)


def _whole(spark: SparkSession, table: Table, rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """All rows of a table and the writes they came with; a write that others add
    meanwhile is in both or in neither."""
    before = table.writes(spark)
    rows = rows if L.WRITE not in rows.columns else table.read(spark, writes=True)
    if table.writes(spark) != before:
        rows = rows.filter(F.col(L.WRITE).isin(before))
    return rows.drop(L.WRITE), before


def _refine_all(spark: SparkSession, job: Refinement, clock: Clock) -> Summary:
    """Both sides of the gate from one scan: a single job deals the rows of bronze into
    silver's new version and next to it, from where the rejects go to quarantine."""
    lake = job.lake
    bronze, taken = _whole(spark, lake.bronze, lake.bronze.read(spark, writes=True))
    if not lake.bronze.complete(spark):
        bronze = with_identity(bronze)
    rules = job.rules.full(bronze, clock.as_of)
    if lake.fmt != "parquet":
        kept = lake.overwrite(spark, "silver", _accepted(bronze, rules))
        rejects = _rejects(job, bronze, rules, clock)
        rejected = lake.append(spark, "quarantine", rejects, compact=L.QUARANTINE_ID)
        return _summary(job, kept + rejected, kept)
    rows = judged(bronze, rules, job.pipeline_version, clock.run_ts)
    codes = sorted([r.code for r in rules.rules] + [rules.undecided_code])
    split = lake.silver.split(
        rows,
        F.coalesce(rules.passed, F.lit(False)),
        [*bronze.columns, L.CODE, L.QUARANTINE_ID],
        [F.count_if(F.col(L.CODE) == c).alias(c) for c in codes],
    )
    # Rejects first: what silver has taken in is not gated again by a run over new writes.
    rejects = split.apart.select(*(F.col(f"`{c}`") for c in rows.columns))
    lake.append(spark, "quarantine", rejects, compact=L.QUARANTINE_ID)
    lake.adopt(spark, "silver", split, taken)
    counts = split.counts
    found = ", ".join(f"{c} {counts[c]}" for c in codes if counts[c])
    LOG.info("rejected by code: %s", found or "none")
    return _summary(job, counts["rows"], counts["kept"])


def _refine_once(spark: SparkSession, job: Refinement, clock: Clock) -> Summary:
    lake = job.lake
    bronze, taken = _whole(spark, lake.bronze, _identified(spark, lake.bronze, writes=True))
    rules = job.rules.full(bronze, clock.as_of)
    _settle_attempts(spark, lake, clock)
    # What is appended differs from what is judged. The two sides of the gate are
    # complementary, so the rows of bronze and those of one side tell.
    rejects = quarantine(bronze, rules)
    total, rejected = bronze.count(), rejects.count()
    with Scratch(spark) as scratch:
        held = _identified(spark, lake.quarantine)
        new = beyond(scratch, rejects.withColumn(L.DUE_ON, rules.due), rejected, held)
        lake.append(
            spark,
            "quarantine",
            audit(new, job.pipeline_version, clock.run_ts),
            compact=L.QUARANTINE_ID,
            judged=rejected,
        )
    # Then silver: what it has taken in is not gated again by a run over new writes.
    accepted = _accepted(bronze, rules)
    moved_earlier = _moved_earlier(spark, job, accepted)
    silver_rows = accepted if moved_earlier is None else accepted.unionByName(moved_earlier)
    lake.overwrite(spark, "silver", silver_rows, taken=taken)
    return _summary(job, total, total - rejected)


def reprocess(
    spark: SparkSession, job: Refinement, clock: Clock | None = None, due_only: bool = False
) -> int:
    """Move quarantined rows that pass the gate by now to silver; returns how many.

    Rows moved before are left alone, and of a row as many copies are moved as bronze has
    and silver lacks, however many runs have rejected it. Moved rows stay in quarantine for audit and count one attempt. Silver keeps the id of
    a moved row, and the attempts are derived from it after the append: if a run dies in
    between, the next one neither moves the row again nor forgets the attempt. With
    ``due_only`` rows are looked at whose day has come, and not those that somebody may
    have corrected.
    """
    job = job.opened()
    clock = clock or job.clock(spark)
    lake = job.lake
    if lake.quarantine.read_or_none(spark) is None:
        LOG.info("nothing in quarantine at %s", lake.quarantine.path)
        return 0
    held = _identified(spark, lake.quarantine, writes=True)
    if lake.fmt == "delta" and L.REPROCESSED_AT in held.columns:
        held = held.filter(F.col(L.REPROCESSED_AT).isNull())
    if due_only and L.DUE_ON in held.columns:
        held = held.filter(F.col(L.DUE_ON) <= F.lit(clock.as_of))
    movable = held.filter(job.rules.full(held, clock.as_of).passed)
    settled = _settled_ids(spark, lake)
    if settled is not None:
        movable = movable.join(settled, L.QUARANTINE_ID, "left_anti")
    with Scratch(spark) as scratch:
        movable, n = scratch.keep(movable)
        moved = 0
        if n:
            silver, bronze = (_identified(spark, t) for t in (lake.silver, lake.bronze))
            run = L.WRITE if L.WRITE in movable.columns else None
            rows = still_missing(scratch, movable, n, silver, bronze, run)
            moved = lake.append(spark, "silver", _as_silver(spark, lake, rows), L.QUARANTINE_ID)
    _settle_attempts(spark, lake, clock)
    LOG.info("%d rows moved from quarantine to silver", moved)
    return moved


def refresh_gold(
    spark: SparkSession,
    job: Refinement,
    group: str = L.DEPARTMENT,
    n: int = 10,
    by_parts: bool = False,
) -> int:
    """Write the groups with the largest totals over silver.

    With ``by_parts`` the totals of each write of silver are kept, and only writes that are
    new since the last refresh are read. What silver no longer has, or has anew under the
    same name, goes out of the totals.
    """
    job = job.opened()
    silver = job.lake.silver.read(spark)
    price = resolve_column(silver, *job.rules.price)
    if by_parts and job.lake.silver.state(spark):
        top = top_n(part_totals(spark, job.lake, group, price), L.TOTAL_CONTRACTED, group, n)
        top = top.withColumn(L.TOTAL_CONTRACTED, F.col(L.TOTAL_CONTRACTED).cast("double"))
    else:
        top = top_groups(silver, group, price, n)
    return job.lake.overwrite(spark, "gold", top)


def part_totals(spark: SparkSession, lake: Lakehouse, group: str, price: str) -> DataFrame:
    """Total per group, added up from those of each write of silver."""
    silver, parts = lake.silver, lake.gold_parts(group, price)
    # A part is named after the write and its files, so one that was replaced is another.
    current = {f"{w}.{silver.mark(spark, w)}": w for w in silver.writes(spark)}
    held = set(parts.writes(spark))
    for name in held - current.keys():
        files.delete(spark, parts.write_folder(spark, name))
    new = {w: name for name, w in current.items() if name not in held}
    if new or parts.state(spark) is None:
        rows = silver.read(spark, writes=True).filter(F.col(L.WRITE).isin(list(new)))
        totals = group_totals(rows, group, price, by=[L.WRITE])
        names = F.create_map(*(F.lit(x) for pair in new.items() for x in pair)) if new else F.lit(None)
        named = names[F.col(L.WRITE)] if new else names.cast("string")
        parts.replace_writes(totals.withColumn(L.WRITE, named), list(new.values()))
    kept = parts.read(spark)
    total = F.sum(L.TOTAL_CONTRACTED).alias(L.TOTAL_CONTRACTED)
    return kept.groupBy(F.col(f"`{group}`").alias(group)).agg(total)


def _as_silver(spark: SparkSession, lake: Lakehouse, rows: DataFrame) -> DataFrame:
    """Quarantined rows in the columns of silver."""
    rows = rows.withColumn(L.CODE, F.lit(None).cast("string"))
    names: list[str] = []
    for table in (lake.silver, lake.bronze):
        # Delta tables have no stored layout; their own schema tells.
        layout = table.layout(spark) or table.read_or_none(spark)
        columns = [] if layout is None else getattr(layout, "names", None) or layout.columns
        names += [c for c in columns if c not in names]
    names += [c for c in (L.CODE, L.QUARANTINE_ID) if c not in names]
    return rows.select(*(F.col(f"`{c}`") for c in names if c in rows.columns))


def _ids_in_silver(spark: SparkSession, lake: Lakehouse) -> DataFrame | None:
    """Ids of moved rows; files that hold none are skipped by their statistics."""
    silver = lake.silver.read_or_none(spark)
    if silver is None or L.QUARANTINE_ID not in silver.columns:
        return None
    return silver.filter(F.col(L.QUARANTINE_ID).isNotNull()).select(L.QUARANTINE_ID)


def _settled_ids(spark: SparkSession, lake: Lakehouse) -> DataFrame | None:
    """Ids that have been moved, by the attempts or by silver itself."""
    logged = None if lake.fmt == "delta" else lake.attempts.read_or_none(spark)
    in_silver = _ids_in_silver(spark, lake)
    known = [d.select(L.QUARANTINE_ID) for d in (logged, in_silver) if d is not None]
    if not known:
        return None
    return known[0] if len(known) == 1 else known[0].union(known[1])


def _settle_attempts(spark: SparkSession, lake: Lakehouse, clock: Clock) -> None:
    """Log one attempt for every moved row that has none yet."""
    moved = _ids_in_silver(spark, lake)
    if moved is None:
        return
    if lake.fmt == "delta":
        held = lake.quarantine.read(spark)
        if L.REPROCESSED_AT in held.columns:
            done = held.filter(F.col(L.REPROCESSED_AT).isNotNull())
            moved = moved.join(done.select(L.QUARANTINE_ID), L.QUARANTINE_ID, "left_anti")
        merge_attempts(lake.quarantine.path, moved, clock.run_ts)
        return
    logged = lake.attempts.read_or_none(spark)
    if logged is not None:
        moved = moved.join(logged.select(L.QUARANTINE_ID), L.QUARANTINE_ID, "left_anti")
    lake.attempts.append(moved.distinct().withColumn(L.REPROCESSED_AT, F.lit(clock.run_ts)))


def _moved_earlier(
    spark: SparkSession, job: Refinement, accepted: DataFrame
) -> DataFrame | None:
    """Moved rows that the clean rows of bronze do not already hold."""
    lake = job.lake
    held = lake.read_quarantine(spark)
    if held is None:
        return None
    moved = held.filter(F.col(L.REPROCESSED_AT).isNotNull())
    moved = without_matches_in_large(with_identity(moved), accepted, [L.ROW_DIGEST])
    moved = moved.withColumn(L.CODE, F.lit(None).cast("string"))
    return align_to(moved, accepted.schema, keep_extra=False)
