"""Reports and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import labels as L
from ..operators import (
    daily_rejects,
    group_totals,
    reason_counts as count_reasons,
    recent_invalid,
    reject_pct_by_day,
    top_groups,
    top_reasons,
)
from .frames import GATED, LATER, accepted, audited_rejects, table
from .registry import query

_REJECTED = GATED + ", q as (select * from v where not coalesce(ok, false))"


@query(_REJECTED + 'select reasons as motivo_rechazo, count(*) as "count" from q group by 1')
def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_reasons(audited_rejects(spark, sf_dir))


@query(
    _REJECTED
    + """
select cast(o_orderdate as date) as day, count(*) as total_quarantined,
       count(*) filter (where code = 'E001') as e001_fecha_nula,
       count(*) filter (where code = 'E002') as e002_fecha_futura,
       count(*) filter (where code = 'E003') as e003_precio_nulo,
       count(*) filter (where code = 'E004') as e004_precio_no_positivo
from q group by 1 order by day desc
"""
)
def report_daily_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_rejects(audited_rejects(spark, sf_dir))


@query(
    GATED
    + """
select cast(o_orderdate as date) as day,
       count(*) filter (where not coalesce(ok, false)) as q_count,
       count(*) filter (where ok) as s_count,
       cast(round(count(*) filter (where not coalesce(ok, false)) * 100.0 / count(*), 2) as double)
         as reject_pct
from v group by 1 having count(*) filter (where not coalesce(ok, false)) > 0
"""
)
def report_reject_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_pct_by_day(audited_rejects(spark, sf_dir), accepted(spark, sf_dir))


@query(
    _REJECTED
    + f"""
select reasons as motivo_rechazo, count(*) as cnt from q
where o_orderdate >= date '{LATER}' - interval 30 day
group by 1 order by cnt desc, motivo_rechazo limit 10
"""
)
def report_top_reasons_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_reasons(audited_rejects(spark, sf_dir), LATER)


@query(
    _REJECTED
    + """
select o_orderpriority, price, sdate, reasons as motivo_rechazo,
       o_orderdate as _validation_timestamp
from q order by o_orderdate desc, o_orderkey limit 50
"""
)
def report_recent_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_invalid(
        audited_rejects(spark, sf_dir), "o_orderpriority", "price", "sdate", "o_orderkey"
    )


@query(
    GATED
    + """
select n_name, cast(sum(cast(price as decimal(18,2))) as double) as total_contratado
from v join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
where ok group by n_name order by sum(cast(price as decimal(18,2))) desc, n_name limit 10
"""
)
def gold_top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with the largest totals.

    Prices are added up per customer first. Hence the join sees each customer
    once, and neither a customer with a large share of the orders nor the width
    of an order matters to it.
    """
    clean = accepted(spark, sf_dir).withColumn("price", F.col("price").cast("decimal(18,2)"))
    per_customer = group_totals(clean, "o_custkey", "price", "price")
    return top_groups(
        per_customer.join(
            table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
        ).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")),
        "n_name",
        "price",
    )


@query(
    GATED
    + """
select o_orderpriority, cast(sum(cast(price as decimal(18,2))) as double) as total_contratado
from v where ok group by 1 order by sum(cast(price as decimal(18,2))) desc, 1 limit 10
"""
)
def gold_top_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = accepted(spark, sf_dir).withColumn("price", F.col("price").cast("decimal(18,2)"))
    return top_groups(clean, "o_orderpriority", "price")
