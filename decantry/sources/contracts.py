"""Delimited contract files as DataFrames with storage-ready column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import labels as L
from ..functions.names import normalize_columns, storage_name
from ..functions.typed import column_ref

# The contract columns in file order. The two columns the rules
# compare are typed so that their tests reach the scan; all others stay text.
CONTRACT_SCHEMA = T.StructType(
    [
        T.StructField(L.ENTITY, T.StringType()),
        T.StructField("Nit_Entidad", T.StringType()),
        T.StructField(L.DEPARTMENT, T.StringType()),
        T.StructField("Ciudad", T.StringType()),
        T.StructField("Estado", T.StringType()),
        T.StructField("Descripcion_del_Proceso", T.StringType()),
        T.StructField("Tipo_de_Contrato", T.StringType()),
        T.StructField("Modalidad_de_Contratacion", T.StringType()),
        T.StructField("Justificacion_Modalidad_de_Contratacion", T.StringType()),
        T.StructField(L.SIGNED_ON, T.DateType()),
        T.StructField("Fecha_de_Inicio_del_Contrato", T.StringType()),
        T.StructField("Fecha_de_Fin_del_Contrato", T.StringType()),
        T.StructField(L.PRICE, T.DoubleType()),
        T.StructField("Valor_Total", T.StringType()),
        T.StructField("Valor_Pagado", T.StringType()),
    ]
)

MALFORMED = "_corrupt_record"


def _file_schema(labels: list[str], contract: T.StructType) -> T.StructType:
    """Read schema under the file's own labels; columns outside the contract are text."""
    known = {f.name: f.dataType for f in contract}
    names = [storage_name(label) for label in labels]
    missing = [n for n in known if n not in names]
    if missing:
        raise ValueError(f"the file lacks the contract columns {missing}")
    return T.StructType(
        [T.StructField(label, known.get(n, T.StringType())) for label, n in zip(labels, names)]
    )


def read_contracts(
    spark: SparkSession,
    path: str | list[str],
    contract: T.StructType | None = CONTRACT_SCHEMA,
    delimiter: str = ",",
    keep_malformed: bool = False,
) -> DataFrame:
    """Scan delimited files that start with a header row.

    Rows shorter than the header are padded with NULL and surplus tokens are
    dropped. ``keep_malformed`` adds a column with the raw line of such rows
    (and of rows with a value that does not parse).

    With a contract only the header line is looked at before the scan. A file
    with other labels, or the same in another order, then fails the scan instead of
    ending up in the wrong columns. ``contract=None`` infers the types, which
    reads the whole input once more and makes the schema depend on the data.
    """
    reader = spark.read.option("header", True).option("sep", delimiter).option("mode", "PERMISSIVE")
    if contract is None:
        if keep_malformed:
            raise ValueError("keep_malformed needs a contract")
        inferred = reader.option("inferSchema", True).csv(path)
        # A later file may have larger numbers, so each kind gets its widest type.
        widest = {T.IntegerType: "bigint", T.FloatType: "double"}
        return normalize_columns(
            inferred.select(
                *(
                    column_ref(f.name).cast(widest.get(type(f.dataType), f.dataType)).alias(f.name)
                    for f in inferred.schema
                )
            )
        )

    schema = _file_schema(reader.csv(path).columns, contract)
    reader = reader.option("enforceSchema", False)
    if keep_malformed:
        # The parser must split whole lines: with only some columns requested it
        # would not notice that a row has too few or too many tokens.
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option(
            "columnPruning", False
        )
    return normalize_columns(reader.schema(schema).csv(path))
