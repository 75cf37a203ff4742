import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decantry import labels as L
from decantry.operators import with_ingest_metadata
from decantry.sources import CONTRACT_SCHEMA, read_contracts
from decantry.sources.contracts import MALFORMED


def test_contract_scan(spark, contracts_csv):
    df = read_contracts(spark, contracts_csv)
    assert df.schema == CONTRACT_SCHEMA
    rows = {r["Entidad"]: r for r in df.collect()}
    assert len(rows) == 12
    assert rows["library"]["Fecha_de_Firma"] == dt.date(2021, 3, 9)
    assert rows["library"]["Precio_Base"] == 812.5
    assert rows["well"]["Departamento"] == "PEÑA"


def test_inferred_scan_agrees_with_the_contract(spark, contracts_csv):
    inferred = read_contracts(spark, contracts_csv, contract=None)
    assert inferred.columns == CONTRACT_SCHEMA.names
    types = {f.name: f.dataType.simpleString() for f in inferred.schema}
    assert types["Precio_Base"] == "double" and types["Fecha_de_Firma"] == "date"
    # Whole numbers get the type that a later, larger one fits as well.
    assert types["Fecha_de_Fin_del_Contrato"] == "bigint" and types["Ciudad"] == "string"
    declared = read_contracts(spark, contracts_csv)
    columns = ["Entidad", "Precio_Base", "Fecha_de_Firma"]
    assert set(map(tuple, inferred.select(columns).collect())) == set(
        map(tuple, declared.select(columns).collect())
    )


def test_ragged_rows_are_padded_cut_and_visible(spark, contracts_csv):
    df = read_contracts(spark, contracts_csv, keep_malformed=True)
    # Asking for few columns must not hide the rows with too many or few tokens.
    few = df.select("Entidad", MALFORMED).filter(F.col(MALFORMED).isNotNull()).collect()
    assert {r["Entidad"] for r in few} == {"theatre", "stadium", "tower"}
    rows = {r["Entidad"]: r for r in df.collect()}
    assert rows["theatre"]["Fecha_de_Fin_del_Contrato"] == "990"
    assert rows["stadium"]["Valor_Total"] == "410"
    assert rows["tower"]["Valor_Total"] == "3600"
    assert all(rows[e]["Precio_Base"] is None for e in ("theatre", "stadium", "tower"))


def test_file_order_and_extra_columns(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("amount;Note (free);who\n1.5;n1;a\n;n2;b\n")
    contract = T.StructType().add("who", "string").add("amount", "double")
    df = read_contracts(spark, str(path), contract, delimiter=";")
    assert [tuple(r) for r in df.orderBy("who").collect()] == [(1.5, "n1", "a"), (None, "n2", "b")]
    assert df.columns == ["amount", "Note_free", "who"]
    with pytest.raises(ValueError, match="lacks"):
        read_contracts(spark, str(path), contract.add("missing", "string"), delimiter=";")


def test_ingest_metadata(spark, contracts_csv):
    at = dt.datetime(2024, 5, 6, 7, 8, 9)
    df = with_ingest_metadata(read_contracts(spark, contracts_csv), "here.csv", at)
    assert df.columns[-3:] == [L.INGESTED_AT, L.SOURCE_FILE, L.INGESTED_ON]
    assert df.schema[L.INGESTED_ON].dataType == T.StringType()
    assert {tuple(r)[-3:] for r in df.collect()} == {(at, "here.csv", "2024-05-06")}
    each = with_ingest_metadata(
        read_contracts(spark, contracts_csv), F.col("_metadata.file_path"), at
    )
    assert each.first()[L.SOURCE_FILE].endswith("contracts.csv")


def test_a_file_in_another_order_is_not_read_into_the_wrong_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("who,amount\na,1\n")
    contract = T.StructType().add("who", "string").add("amount", "double")
    assert read_contracts(spark, str(tmp_path / "in"), contract).count() == 1
    (tmp_path / "in" / "2.csv").write_text("amount,who\n1,a\n")
    with pytest.raises(Exception, match="header"):
        read_contracts(spark, str(tmp_path / "in"), contract).collect()
