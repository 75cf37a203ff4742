"""Writes and whole runs, each into a lakehouse of its own."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.rules import full_rules, simple_rules
from ..operators import audit, clean, quarantine, sample_rejects, with_attempts, with_ingest_metadata
from ..operators import layer_balance as balance
from ..operators import layer_comparison as comparison
from ..plans import Lakehouse, Refinement, Rules, refine, refine_simple, refresh_gold, reprocess
from ..plans.runs import ingest_rows
from ..session import one_row, work_folder
from ..sources import Table
from ..sources import commit_metrics as last_commits
from .frames import (
    AS_OF,
    GATED,
    LATER,
    RUN_TEXT,
    RUN_TS,
    clock_text,
    corrupt_orders,
    instant,
    rules,
    table,
)
from .registry import query

_RULES = Rules(price=("price",), signed_on=("sdate",))


def _job(lake: Lakehouse, as_of: dt.date = AS_OF, **options) -> Refinement:
    return Refinement(lake, _RULES, as_of=as_of, run_ts=RUN_TS, mode="prod", **options)


def _filled_lake(spark: SparkSession, sf_dir: str, table: str = "orders", **options) -> Lakehouse:
    """A lakehouse whose bronze table holds all orders."""
    orders = corrupt_orders(spark, sf_dir)
    contract = orders.drop("o_orderdate").schema
    lake = Lakehouse(work_folder(spark), table, contract=contract, **options)
    ingest_rows(spark, _job(lake), orders.drop("o_orderdate"), "orders")
    return lake


@query(
    GATED
    + f"""
select o_orderkey, price, cast(null as varchar) as _source_file,
       cast(null as varchar) as _ingestion_date from c
union all
select o_orderkey, price, 'orders', '{RUN_TEXT[:10]}' from c
"""
)
def sink_append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second append brings the lineage columns with it."""
    store = Table(work_folder(spark))
    orders = corrupt_orders(spark, sf_dir).select("o_orderkey", "price")
    store.append(orders)
    store.append(with_ingest_metadata(orders, "orders", instant(RUN_TEXT)))
    return store.read(spark).drop(L.INGESTED_AT)


@query(GATED + "select o_orderkey, price, sdate from v where ok")
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Table(work_folder(spark))
    orders = corrupt_orders(spark, sf_dir).select("o_orderkey", "price", "sdate")
    store.overwrite(orders)
    store.overwrite(clean(orders, rules(orders)))
    return store.read(spark)


@query(
    GATED
    + """
select o_orderkey,
       cast(case when code <> 'E002' then 0 when o_orderpriority = '1-URGENT' then 2 else 1 end as integer)
         as _reprocess_attempts,
       case when code <> 'E002' then null when o_orderpriority = '1-URGENT' then '2001-06-02 00:00:00'
            else '2001-06-01 00:00:00' end as reprocessed_at
from v where not coalesce(ok, false)
"""
)
def merge_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attempt for every order dated too late, a second one for the urgent."""
    df = corrupt_orders(spark, sf_dir)
    held = audit(quarantine(df, rules(df)), "v1", instant(RUN_TEXT), key=["o_orderkey"])
    moved = held.filter(F.col(L.CODE) == "E002")
    attempts = Table(work_folder(spark))
    for rows, at in (
        (moved, "2001-06-01 00:00:00"),
        (moved.filter("o_orderpriority = '1-URGENT'"), "2001-06-02 00:00:00"),
    ):
        attempts.append(
            rows.select(L.QUARANTINE_ID, instant(at).alias(L.REPROCESSED_AT)), compact=True
        )
    return with_attempts(held, attempts.read(spark)).select(
        "o_orderkey", L.ATTEMPTS, clock_text(L.REPROCESSED_AT, "reprocessed_at")
    )


@query(
    GATED
    + """
select count(*) as total, count(*) filter (where ok) as clean,
       count(*) filter (where not coalesce(ok, false)) as quarantine,
       100.0 * count(*) filter (where not coalesce(ok, false)) / count(*) as reject_pct,
       100.0 * count(*) filter (where not coalesce(ok, false)) / count(*) > 5 as alert
from v
"""
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _filled_lake(spark, sf_dir)
    return refine(spark, _job(lake)).as_frame(spark).drop("moved")


@query(
    GATED
    + """
select 'orders' as table_set, layer, count(*) as "rows", true as has_bytes
from (select 'bronze' as layer from v union all
      select case when ok then 'silver' else 'quarantine' end from v) as l group by layer
"""
)
def commit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _filled_lake(spark, sf_dir, measure_bytes=True)
    refine(spark, _job(lake))
    metrics = last_commits(spark, lake.commit_logs())
    return metrics.withColumn("has_bytes", F.col("bytes") > 0).drop("bytes", "judged")


@query(
    GATED
    + """
select 'orders' as table_set, count(*) as bronze_rows, count(*) filter (where ok) as silver_rows,
       count(*) filter (where not coalesce(ok, false)) as quarantine_rows,
       count(*) as total_rows,
       round(100.0 * count(*) filter (where ok) / count(*), 1) as valid_pct,
       round(100.0 * count(*) filter (where not coalesce(ok, false)) / count(*), 1) as rejected_pct
from v
"""
)
def layer_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _filled_lake(spark, sf_dir)
    refine(spark, _job(lake))
    shares = balance(last_commits(spark, lake.commit_logs()))
    return shares.drop("silver_bytes", "quarantine_bytes")


@query(
    GATED
    + """
select 'orders' as table_set, count(*) filter (where ok) as silver_rows,
       count(*) filter (where not coalesce(ok, false)) as quarantine_rows from v
union all
select 'orders_simple',
       count(*) filter (where price > 0 and sdate is not null),
       count(*) filter (where not coalesce(price > 0 and sdate is not null, false)) from v
"""
)
def layer_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full and the simple gate over the same orders."""
    full = _filled_lake(spark, sf_dir)
    refine(spark, _job(full))
    simple = Lakehouse(full.root, "orders_simple", contract=full.contract, snapshot=True)
    simple.overwrite(spark, "bronze", corrupt_orders(spark, sf_dir).drop("o_orderdate"))
    refine_simple(spark, simple, _RULES)
    return comparison(last_commits(spark, [*full.commit_logs(), *simple.commit_logs()]))


@query(
    GATED + "select o_orderkey, price, sdate from v"
    f" where code = 'E002' and price > 0 and sdate <= date '{LATER}'"
)
def reprocess_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second look months later moves; a third one moves nothing more."""
    lake = _filled_lake(spark, sf_dir)
    refine(spark, _job(lake))
    reprocess(spark, _job(lake, LATER))
    reprocess(spark, _job(lake, LATER))
    silver = lake.silver.read(spark)
    return silver.filter(F.col(L.QUARANTINE_ID).isNotNull()).select("o_orderkey", "price", "sdate")


@query(
    GATED
    + f"""
select o_orderkey, code as _rejection_code, cast(0 as integer) as _reprocess_attempts from v
where not coalesce(ok, false)
  and not coalesce(code = 'E002' and price > 0 and sdate <= date '{LATER}', false)
"""
)
def reprocess_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _filled_lake(spark, sf_dir)
    refine(spark, _job(lake))
    reprocess(spark, _job(lake, LATER))
    return (
        lake.read_quarantine(spark)
        .filter(F.col(L.REPROCESSED_AT).isNull())
        .select("o_orderkey", L.CODE, L.ATTEMPTS)
    )


@query(
    GATED
    + f"""
select 'silver' as layer, o_orderkey from v where price > 0 and sdate <= date '{LATER}'
union all
select 'quarantine', o_orderkey from v where not coalesce(ok, false)
"""
)
def rerun_with_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs and a reprocessing, keyed on the order: nothing is stored twice."""
    lake = _filled_lake(spark, sf_dir)
    refine(spark, _job(lake, row_key=["o_orderkey"]))
    refine(spark, _job(lake, LATER, row_key=["o_orderkey"]), reprocess_quarantine=True)
    return (
        lake.silver.read(spark)
        .select(F.lit("silver").alias("layer"), "o_orderkey")
        .unionByName(
            lake.quarantine.read(spark).select(F.lit("quarantine").alias("layer"), "o_orderkey")
        )
    )


@query(
    GATED
    + """
select 'first' as delivery, count(*) as bronze_rows from c
union all
select d, sum(greatest(a, b))::bigint from (select unnest(['both', 'again']) as d), (
  select coalesce(x.n, 0) as a, coalesce(y.n, 0) as b
  from (select o_orderpriority as p, sdate as s, price as v, count(*) as n from c group by all) as x
  full join (select o_orderpriority as p, sdate as s, -price as v, count(*) as n from c group by all) as y
  on x.p = y.p and x.s is not distinct from y.s and x.v is not distinct from y.v)
group by d
"""
)
def keyed_ingest_keeps_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries whose key is neither unique nor always there; the last one is a repeat.

    Equal rows of a delivery are all kept, and of a later one those beyond the stored ones.
    """
    rows = corrupt_orders(spark, sf_dir).select("o_orderpriority", "sdate", "price")
    lake = Lakehouse(work_folder(spark), "orders", contract=rows.schema)
    job = _job(lake, row_key=["o_orderpriority", "sdate"])
    corrected = rows.withColumn("price", -F.col("price"))
    counts = []
    for name, delivery in (("first", rows), ("both", corrected), ("again", corrected)):
        ingest_rows(spark, job, delivery, name)
        count = lake.bronze.read(spark).count()
        counts.append(one_row(spark, delivery=F.lit(name), bronze_rows=F.lit(count).cast("bigint")))
    return reduce(DataFrame.unionByName, counts)


@query(
    GATED
    + """
select o_orderkey, price, layer from (
  select o_orderkey, price, case when ok then 'silver' else 'quarantine' end as layer from v
  union all
  select o_orderkey, -price, case when sdate <= date '2001-01-01' then 'silver' else 'quarantine' end
  from v where price < 0)
"""
)
def corrected_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a negative price come again with a positive one, under the same key."""
    orders = corrupt_orders(spark, sf_dir).drop("o_orderdate")
    lake = Lakehouse(work_folder(spark), "orders", contract=orders.schema)
    job = _job(lake, row_key=["o_orderkey"])
    ingest_rows(spark, job, orders, "first")
    refine(spark, job)
    ingest_rows(spark, job, orders.filter("price < 0").withColumn("price", -F.col("price")), "second")
    refine(spark, job)
    return _layers(spark, lake, "o_orderkey", "price")


@query(
    GATED
    + f"select o_orderpriority, sdate, price from v"
    f" where code = 'E002' and price > 0 and sdate <= date '{LATER}'"
)
def reprocess_same_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that share their key are all moved, by priority and day."""
    rows = corrupt_orders(spark, sf_dir).select("o_orderpriority", "sdate", "price")
    lake = Lakehouse(work_folder(spark), "orders", contract=rows.schema)
    key = ["o_orderpriority"]
    ingest_rows(spark, _job(lake, row_key=key), rows, "orders")
    refine(spark, _job(lake, row_key=key))
    for _ in range(2):
        reprocess(spark, _job(lake, LATER, row_key=key))
    silver = lake.silver.read(spark)
    return silver.filter(F.col(L.QUARANTINE_ID).isNotNull()).select(*rows.columns)


@query(GATED + f"select o_orderkey from v where price > 0 and sdate <= date '{LATER}'")
def rerun_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day advances and quarantine is looked at again: no row is in silver twice."""
    lake = _filled_lake(spark, sf_dir)
    refine(spark, _job(lake))
    refine(spark, _job(lake, LATER), reprocess_quarantine=True)
    return lake.silver.read(spark).select("o_orderkey")


@query(
    GATED
    + """
select o_orderkey, price, cast(null as varchar) as o_orderpriority, case when ok then 'silver' else 'quarantine' end as layer from v
union all
select o_orderkey, price, o_orderpriority, case when ok then 'silver' else 'quarantine' end from v
"""
)
def ingest_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery has a column that the contract does not declare."""
    orders = corrupt_orders(spark, sf_dir).drop("o_orderdate")
    narrow = orders.drop("o_orderpriority")
    lake = Lakehouse(work_folder(spark), "orders", contract=narrow.schema)
    for delivery in (narrow, orders):
        ingest_rows(spark, _job(lake, once=True), delivery, "orders")
        refine(spark, _job(lake, once=True))
    return _layers(spark, lake, "o_orderkey", "price", "o_orderpriority")


@query(
    GATED
    + """
select 'orders' as table_set, count(*) filter (where ok) as silver_rows,
       count(*) filter (where not coalesce(ok, false)) as quarantine_rows,
       round(100.0 * count(*) filter (where ok) / count(*), 1) as valid_pct
from v
"""
)
def layer_balance_after_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run adds no rejects to quarantine, and yet there are some."""
    lake = _filled_lake(spark, sf_dir)
    for _ in range(2):
        refine(spark, _job(lake, row_key=["o_orderkey"]))
    shares = balance(last_commits(spark, lake.commit_logs()))
    return shares.select("table_set", "silver_rows", "quarantine_rows", "valid_pct")


@query(
    GATED
    + f"""
select o_orderkey, n from (
  select o_orderkey, price, sdate, case when o_orderkey % 3 = 0 then 2 else 1 end as n from v)
where price > 0 and sdate <= date '{LATER}'
"""
)
def reprocess_equal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the orders is there twice: both copies are moved, and stay when silver is rebuilt."""
    orders = corrupt_orders(spark, sf_dir).drop("o_orderdate")
    lake = Lakehouse(work_folder(spark), "orders", contract=orders.schema)
    ingest_rows(spark, _job(lake), orders.unionByName(orders.filter("o_orderkey % 3 = 0")), "orders")
    refine(spark, _job(lake))
    reprocess(spark, _job(lake, LATER))
    moved = _copies(spark, lake)
    refine(spark, _job(lake, LATER), reprocess_quarantine=True)
    return moved.intersect(_copies(spark, lake))


def _copies(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    return lake.silver.read(spark).groupBy("o_orderkey").agg(F.count("*").cast("int").alias("n"))


@query(
    GATED
    + f"""
select o_orderkey, 'silver' as layer from v where price > 0 and sdate <= date '{LATER}'
union all
select o_orderkey, 'quarantine' from v where not coalesce(ok, false)
"""
)
def refine_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, each gated alone; then the rejects whose day has come."""
    orders = corrupt_orders(spark, sf_dir).drop("o_orderdate")
    lake = Lakehouse(work_folder(spark), "orders", contract=orders.schema)
    for delivery in ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1"):
        ingest_rows(spark, _job(lake), orders.filter(delivery), "orders")
        refine(spark, _job(lake), new_only=True)
    refine(spark, _job(lake, LATER), reprocess_quarantine=True, new_only=True)
    return _layers(spark, lake, "o_orderkey")


@query(
    GATED
    + """
select o_orderkey, precio_positive, cast(null as boolean) as priority_known from v where not coalesce(ok, false)
union all
select o_orderkey, precio_positive, o_orderpriority <> '5-LOW' from v where not coalesce(ok, false)
"""
)
def quarantine_gains_a_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later run has one check more; rows of the earlier one read NULL there."""
    lake = _filled_lake(spark, sf_dir)
    refine(spark, _job(lake))
    orders = corrupt_orders(spark, sf_dir).drop("o_orderdate")
    held = quarantine(orders, rules(orders))
    checks = F.col(L.CHECKS).withField("priority_known", F.col("o_orderpriority") != "5-LOW")
    lake.append(spark, "quarantine", audit(held.withColumn(L.CHECKS, checks), "v2", instant(RUN_TEXT)))
    checked = lake.quarantine.read(spark).select("o_orderkey", f"{L.CHECKS}.*")
    return checked.select("o_orderkey", L.PRICE_POSITIVE, "priority_known")


@query(
    GATED
    + f"""
select o_custkey % 97 as grp, cast(sum(cast(abs(price) as decimal(14, 2))) as double) as total_contratado
from v where price is not null and sdate <= date '{LATER}' group by 1 order by 2 desc, 1 limit 10
"""
)
def gold_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals refreshed after a delivery, another, one of corrected prices, and a reprocessing."""
    orders = corrupt_orders(spark, sf_dir).drop("o_orderdate").withColumns(
        {"grp": F.expr("o_custkey % 97"), "price": F.col("price").cast("decimal(14,2)")}
    )
    lake = Lakehouse(work_folder(spark), "orders", contract=orders.schema)
    corrected = orders.filter("price < 0").withColumn("price", F.abs("price"))
    for delivery in (orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 = 1"), corrected):
        ingest_rows(spark, _job(lake), delivery, "orders")
        refine(spark, _job(lake), new_only=True)
        refresh_gold(spark, _job(lake), "grp", by_parts=True)
    reprocess(spark, _job(lake, LATER), due_only=True)
    refresh_gold(spark, _job(lake, LATER), "grp", by_parts=True)
    return lake.gold.read(spark)


@query(GATED + "select o_orderkey, price from v where ok")
def overwrite_from_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by rows that are derived from it, and appended to by name twice."""
    store = Table(work_folder(spark))
    orders = corrupt_orders(spark, sf_dir)
    for _ in range(2):
        store.append(orders, write="orders")
    store.overwrite(clean(store.read(spark), rules(orders)))
    return store.read(spark).select("o_orderkey", "price")


@query(
    """
select n_name, count(*) as orders, sum(case when o_totalprice > 0 then 1 else 0 end)::bigint as clean
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name
"""
)
def in_memory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as rows that the driver holds, joined with orders that pass or fail the gate."""
    nations = [tuple(r) for r in table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()]
    held = spark.createDataFrame(nations, "n_nationkey int, n_name string")
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    gate = simple_rules(orders, "o_totalprice", "o_orderdate")
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("orders"), F.count_if(gate.passed).alias("clean")
    )
    per_nation = customers.join(per_customer, "c_custkey").groupBy(F.col("c_nationkey").alias("n_nationkey"))
    sums = per_nation.agg(F.sum("orders").alias("orders"), F.sum("clean").alias("clean"))
    return held.join(sums, "n_nationkey").select("n_name", "orders", "clean")


@query("select count(*) as bronze_rows, false as has_silver, cast(0 as bigint) as moved from orders")
def missing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze is filled, the other layers are not there: reading them finds nothing, as does reprocessing."""
    lake = _filled_lake(spark, sf_dir)
    moved = reprocess(spark, _job(lake))
    has_silver = lake.silver.read_or_none(spark) is not None
    return lake.bronze.read(spark).agg(
        F.count("*").alias("bronze_rows"),
        F.lit(has_silver).alias("has_silver"),
        F.lit(moved).cast("bigint").alias("moved"),
    )


@query(GATED + "select count(*) as total, count(*) as clean, cast(0 as bigint) as moved from v where ok")
def empty_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing but clean orders: no rejects, and nothing to look at again."""
    orders = corrupt_orders(spark, sf_dir).drop("o_orderdate")
    lake = Lakehouse(work_folder(spark), "orders", contract=orders.schema)
    ingest_rows(spark, _job(lake), clean(orders, rules(orders)), "orders")
    summary = refine(spark, _job(lake), reprocess_quarantine=True)
    return summary.as_frame(spark).select("total", "clean", "moved")


@query(
    GATED
    + """
select least(count(*), 10) as sampled, least(count(*), 10) as rejected, least(count(*), 10) as with_reason
from v where not coalesce(ok, false)
"""
)
def sample_of_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any ten rejects: each of them one, and with its reason."""
    orders = corrupt_orders(spark, sf_dir)
    held = audit(quarantine(orders, rules(orders)), "v1", instant(RUN_TEXT), key=["o_orderkey"])
    some = sample_rejects(held, "o_orderkey", "price", "sdate")
    known = held.select("o_orderkey", F.lit(1).alias("known"))
    return some.join(known, "o_orderkey", "left").agg(
        F.count("*").alias("sampled"),
        F.count("known").alias("rejected"),
        F.count_if(F.length(L.REJECT_REASON) > 0).alias("with_reason"),
    )


@query(
    """
select cast(code as varchar) as _rejection_code, n, true as ingested_now, n as ids from (
  select case o_orderkey % 3 when 1 then 'E002' else 'E003' end as code, count(*) as n
  from orders where o_orderkey % 3 <> 0 group by 1)
"""
)
def judged_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dated today, tomorrow, or today without a price, by the clock of the session."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "date_add(current_date(), if(o_orderkey % 3 = 1, 1, 0)) as sdate",
        "if(o_orderkey % 3 = 2, null, o_totalprice) as price",
    )
    rows = with_ingest_metadata(orders, "orders")
    held = audit(quarantine(rows, full_rules(rows, "price", "sdate")))
    now = F.current_timestamp()
    recent = (F.col(L.INGESTED_AT) <= now) & (F.col(L.INGESTED_AT) > now - F.expr("interval 1 day"))
    return held.groupBy(L.CODE).agg(
        F.count("*").alias("n"),
        F.bool_and(recent & (F.col(L.VALIDATED_ON) == F.current_date())).alias("ingested_now"),
        F.countDistinct(L.QUARANTINE_ID).alias("ids"),
    )


def _layers(spark: SparkSession, lake: Lakehouse, *columns: str) -> DataFrame:
    return (
        lake.silver.read(spark)
        .select(*columns, F.lit("silver").alias("layer"))
        .unionByName(lake.quarantine.read(spark).select(*columns, F.lit("quarantine").alias("layer")))
    )


@query(
    GATED
    + "select code as _rejection_code, count(*) as n from v where not coalesce(ok, false) group by 1"
)
def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine table by its catalog name in SQL, in databases of its own."""
    lake = _filled_lake(spark, sf_dir)
    refine(spark, _job(lake))
    names = lake.register(spark, namespace=f"lake_{uuid.uuid4().hex}")
    name = next(n for n in names if "quarantine" in n)
    return spark.sql(f"SELECT {L.CODE}, count(*) AS n FROM {name} GROUP BY {L.CODE}")
