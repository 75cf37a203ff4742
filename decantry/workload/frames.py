"""Input of the queries: all orders, with defects put in by rule.

The stored tables have no defects. The rules below leave a known share of the
orders without a price or date, with a negative price, or dated after ``AS_OF``;
no order is left out. Each statement reads the same in Spark and elsewhere.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.rules import RuleSet, full_rules
from ..operators.gate import audit, quarantine

AS_OF = dt.date(2001, 1, 1)
LATER = dt.date(2001, 5, 1)
RUN_TS = dt.datetime(2001, 1, 1, 6, 30)
RUN_TEXT = "2001-01-01 06:30:00"

CORRUPT_ORDERS = """
  select o_orderkey, o_custkey, o_orderpriority, o_orderdate,
         case when o_orderkey % 17 = 0 then null
              when o_orderkey % 13 = 0 then -o_totalprice
              else o_totalprice end as price,
         case when o_orderkey % 19 = 0 then null
              else cast(o_orderdate as date) end as sdate
  from {orders}
"""

TEXT_ORDERS = """
  select o_orderkey,
         case when o_orderkey % 17 = 0 then null
              when o_orderkey % 23 = 0 then 'N/D'
              when o_orderkey % 13 = 0 then cast(-o_totalprice as varchar(40))
              else cast(o_totalprice as varchar(40)) end as price,
         case when o_orderkey % 19 = 0 then null
              when o_orderkey % 29 = 0 then 'pendiente'
              else cast(cast(o_orderdate as date) as varchar(40)) end as sdate
  from {orders}
"""


def _gated_sql(source: str, amount: str, day: str) -> str:
    return f"""
with c as ({source.format(orders="orders")}),
g as (
  select *, price is not null as precio_not_null, {amount} > 0 as precio_positive,
         sdate is not null as fecha_not_null, {day} <= date '2001-01-01' as fecha_not_future
  from c
),
t as (
  select *, precio_not_null and precio_positive and fecha_not_null and fecha_not_future as ok
  from g
),
v as (
  select *,
    concat_ws(', ',
      case when not precio_not_null then 'Precio Base nulo' end,
      case when not precio_positive then 'Precio Base <= 0' end,
      case when not fecha_not_null then 'Fecha de Firma nula' end,
      case when not fecha_not_future then 'Fecha de Firma futura' end,
      case when ok is null then 'Incumple reglas de calidad' end) as reasons,
    case when not fecha_not_null then 'E001' when not fecha_not_future then 'E002'
         when not precio_not_null then 'E003' when not precio_positive then 'E004'
         when ok is null then 'E999' end as code
  from t
)
"""


# Common table expression ``v``: every order with its verdict.
GATED = _gated_sql(CORRUPT_ORDERS, "price", "sdate")
GATED_TEXT = _gated_sql(TEXT_ORDERS, "try_cast(price as double)", "try_cast(sdate as date)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corrupt_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CORRUPT_ORDERS, orders=table(spark, sf_dir, "orders"))


def text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TEXT_ORDERS, orders=table(spark, sf_dir, "orders"))


def rules(df: DataFrame) -> RuleSet:
    return full_rules(df, "price", "sdate", AS_OF)


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def clock_text(name: str, alias: str) -> Column:
    """A timestamp as text, which reads the same in every time zone setting."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(alias)


def audited_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected orders with audit columns, validated on the day of the order."""
    df = corrupt_orders(spark, sf_dir)
    return audit(quarantine(df, rules(df)), "v1", F.col("o_orderdate"), key=["o_orderkey"])


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean orders, ingested on the day of the order."""
    df = corrupt_orders(spark, sf_dir)
    return df.filter(rules(df).passed).withColumn(L.INGESTED_AT, F.col("o_orderdate"))
