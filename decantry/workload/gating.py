"""Scans, projections and the gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import labels as L
from ..functions import normalize_columns, resolve_column, simple_rules
from ..operators import audit, clean, quarantine, split, validate, with_ingest_metadata
from ..operators.gate import with_reason
from ..session import work_folder
from ..sources import Table, read_contracts
from ..sources.contracts import MALFORMED
from .frames import (
    GATED,
    GATED_TEXT,
    RUN_TEXT,
    clock_text,
    corrupt_orders,
    instant,
    rules,
    table,
    text_orders,
)
from .registry import query

_ORDER_FILE = (
    T.StructType()
    .add("o_orderkey", "long")
    .add("o_totalprice", "double")
    .add("o_orderdate", "date")
    .add("o_orderpriority", "string")
)


@query(
    "select o_orderkey, o_totalprice, cast(o_orderdate as date) as o_orderdate, o_orderpriority"
    " from orders"
)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark)
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    orders.select(*_ORDER_FILE.names).write.option("header", True).csv(path)
    return read_contracts(spark, path, _ORDER_FILE)


@query(
    """
select o_orderkey,
       case when o_orderkey % 13 = 0 then null else o_totalprice end as o_totalprice,
       case when o_orderkey % 13 = 0 or o_orderkey % 7 = 0 then null
            else cast(o_orderdate as date) end as o_orderdate,
       case when o_orderkey % 13 = 0 then strftime(o_orderdate, '%Y-%m-%d')
            when o_orderkey % 7 = 0 then null
            else o_orderpriority end as o_orderpriority,
       o_orderkey % 13 = 0 or o_orderkey % 7 = 0 or o_orderkey % 11 = 0 as ragged
from orders
"""
)
def csv_ragged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a surplus separator, too few tokens, or a surplus last token."""
    path = work_folder(spark)
    key, price, priority = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    line = (
        F.when(key % 13 == 0, F.concat_ws(",", key, F.lit(""), price, day, priority))
        .when(key % 7 == 0, F.concat_ws(",", key, price))
        .when(key % 11 == 0, F.concat_ws(",", key, price, day, priority, F.lit("surplus")))
        .otherwise(F.concat_ws(",", key, price, day, priority))
    )
    # One column whose name is the header line; its separator occurs nowhere.
    lines = table(spark, sf_dir, "orders").select(line.alias(",".join(_ORDER_FILE.names)))
    lines.write.option("header", True).option("sep", "\u0001").csv(path)
    scan = read_contracts(spark, path, _ORDER_FILE, keep_malformed=True)
    return scan.withColumn("ragged", F.col(MALFORMED).isNotNull()).drop(MALFORMED)


@query("select * from orders")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Table(f"{sf_dir}/orders.parquet").read(spark)


@query(
    "select o_orderkey as Nit_Entidad, o_totalprice as Precio_Base_COP,"
    " o_orderpriority as Justificacin, o_orderstatus as ab from orders",
    name="normalize_columns",
)
def stored_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" Nit  Entidad "),
        F.col("o_totalprice").alias("Precio Base (COP);"),
        F.col("o_orderpriority").alias("Justificación"),
        F.col("o_orderstatus").alias("a\tb"),
    )
    return normalize_columns(raw)


@query(
    f"select o_orderkey, '{RUN_TEXT}' as ingested_at, 'orders.csv' as _source_file,"
    f" '{RUN_TEXT[:10]}' as _ingestion_date from orders"
)
def ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_ingest_metadata(table(spark, sf_dir, "orders"), "orders.csv", instant(RUN_TEXT))
    return rows.select(
        "o_orderkey", clock_text(L.INGESTED_AT, "ingested_at"), L.SOURCE_FILE, L.INGESTED_ON
    )


@query(
    "select o_orderkey, o_totalprice as price, cast(o_orderdate as date) as signed_on from orders"
)
def resolve_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("Precio Base"),
        F.to_date("o_orderdate").alias("Fecha_de_Firma"),
    )
    price = resolve_column(rows, *L.PRICE_SPELLINGS)
    signed_on = resolve_column(rows, *L.SIGNED_ON_SPELLINGS)
    return rows.select(
        "o_orderkey", F.col(price).alias("price"), F.col(signed_on).alias("signed_on")
    )


@query(
    GATED + "select o_orderkey, precio_not_null, precio_positive, fecha_not_null,"
    " fecha_not_future from v"
)
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = corrupt_orders(spark, sf_dir)
    return validate(df, rules(df)).select("o_orderkey", f"{L.CHECKS}.*")


@query(GATED + "select o_orderkey, ok as _is_valid from v")
def quality_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = corrupt_orders(spark, sf_dir)
    return validate(df, rules(df)).select("o_orderkey", L.IS_VALID)


@query(GATED + "select o_orderkey, reasons as _rejection_reasons from v")
def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = corrupt_orders(spark, sf_dir)
    return validate(df, rules(df)).select("o_orderkey", L.REASONS)


@query(GATED + "select o_orderkey, code as _rejection_code from v")
def rejection_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = corrupt_orders(spark, sf_dir)
    return validate(df, rules(df)).select("o_orderkey", L.CODE)


@query(
    GATED_TEXT + "select o_orderkey, ok as _is_valid, coalesce(ok, false) as accepted,"
    " reasons as _rejection_reasons, code as _rejection_code from v"
)
def gate_text_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price and date as text, some of which does not parse; both sides of the split."""
    df = text_orders(spark, sf_dir)
    ok, bad = split(df, rules(df))
    return (
        validate(ok, rules(df))
        .withColumn("accepted", F.lit(True))
        .unionByName(bad.withColumn("accepted", F.lit(False)))
        .select("o_orderkey", L.IS_VALID, "accepted", L.REASONS, L.CODE)
    )


@query(
    GATED + "select o_orderkey, price, sdate from v"
    " where precio_not_null and precio_positive and fecha_not_null"
)
def gate_simple_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = corrupt_orders(spark, sf_dir).select("o_orderkey", "price", "sdate")
    return clean(df, simple_rules(df, "price", "sdate"))


@query(
    GATED
    + """
select o_orderkey,
       case when sdate is null then 'Fecha de Firma nula'
            when price is null then 'Precio Base nulo'
            else 'Precio Base <= 0' end as motivo_rechazo
from v where not coalesce(precio_not_null and precio_positive and fecha_not_null, false)
"""
)
def gate_simple_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = corrupt_orders(spark, sf_dir)
    return with_reason(df, simple_rules(df, "price", "sdate")).select(
        "o_orderkey", L.REJECT_REASON
    )


@query(
    GATED + "select o_orderkey, o_custkey, o_orderpriority, o_orderdate, price, sdate from v"
    " where ok"
)
def split_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = corrupt_orders(spark, sf_dir)
    return clean(df, rules(df))


@query(
    GATED + "select o_orderkey, price, sdate, reasons as _rejection_reasons,"
    " code as _rejection_code from v where not coalesce(ok, false)"
)
def split_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = corrupt_orders(spark, sf_dir)
    return quarantine(df, rules(df)).select("o_orderkey", "price", "sdate", L.REASONS, L.CODE)


@query(
    GATED
    + f"""
select o_orderkey, reasons as motivo_rechazo, '{RUN_TEXT}' as validated_at,
       'v1' as _pipeline_version, cast(0 as integer) as _reprocess_attempts,
       sha256(length(cast(o_orderkey as varchar)) || ':' || o_orderkey || '|{RUN_TEXT}')
         as _quarantine_id
from v where not coalesce(ok, false)
"""
)
def quarantine_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = corrupt_orders(spark, sf_dir)
    rows = audit(quarantine(df, rules(df)), "v1", instant(RUN_TEXT), key=["o_orderkey"])
    return rows.select(
        "o_orderkey",
        L.REJECT_REASON,
        clock_text(L.VALIDATED_AT, "validated_at"),
        L.PIPELINE_VERSION,
        L.ATTEMPTS,
        L.QUARANTINE_ID,
    )
