import pytest

from decantry.functions.names import normalize_columns, resolve_column, storage_name


@pytest.mark.parametrize(
    ("label", "name"),
    [
        ("Precio Base", "Precio_Base"),
        ("  Fecha de   Firma ", "Fecha_de_Firma"),
        ("Razón Social", "Razn_Social"),
        ("a\tb", "ab"),
        ("a \n b", "a_b"),
        ("Valor (COP): {x};", "Valor_COP_x"),
        ("a : b", "a_b"),
        ("a ñ b", "a__b"),
        ("( x", "_x"),
        ("a-b.c/d", "abcd"),
        ("_already_ok9", "_already_ok9"),
    ],
)
def test_storage_name(label, name):
    assert storage_name(label) == name


def test_normalize_is_schema_only(spark):
    df = spark.range(3).toDF("Nit Entidad")
    out = normalize_columns(df)
    assert out.columns == ["Nit_Entidad"]
    assert out.count() == 3


def test_collision_raises(spark):
    df = spark.sql("select 1 as `a b`, 2 as `A_b`")
    with pytest.raises(ValueError, match="collapse"):
        normalize_columns(df)
    with pytest.raises(ValueError, match="collapse"):
        normalize_columns(spark.sql("select 1 as `ñ`"))


def test_resolve_prefers_first_spelling(spark):
    df = spark.sql("select 1 as `Precio Base`, 2 as x")
    assert resolve_column(df, "Precio_Base", "Precio Base") == "Precio Base"
    with pytest.raises(ValueError, match="Precio_Base"):
        resolve_column(df, "Precio_Base")
