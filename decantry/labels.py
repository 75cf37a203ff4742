"""Names and texts that are part of the stored tables.

Fixed values: downstream queries select these columns and compare these
strings, so they are data rather than wording and must not be translated.
"""

# Contract columns, in file order.
ENTITY = "Entidad"
DEPARTMENT = "Departamento"
PRICE = "Precio_Base"
SIGNED_ON = "Fecha_de_Firma"

# Spellings accepted for the two columns the rules read.
PRICE_SPELLINGS = ("Precio_Base", "Precio Base")
SIGNED_ON_SPELLINGS = ("Fecha_de_Firma", "Fecha de Firma")

# Ingestion lineage.
INGESTED_AT = "_ingestion_time"
SOURCE_FILE = "_source_file"
INGESTED_ON = "_ingestion_date"

# The write of a table that a row came with; the name of a folder.
WRITE = "_write"

# Identity of a row by its content.
ROW_DIGEST = "_row_digest"

# Verdict of the gate.
CHECKS = "_quality_checks"
IS_VALID = "_is_valid"
REASONS = "_rejection_reasons"
CODE = "_rejection_code"

# Quarantine audit.
REJECT_REASON = "motivo_rechazo"
VALIDATED_AT = "_validation_timestamp"
PIPELINE_VERSION = "_pipeline_version"
QUARANTINE_ID = "_quarantine_id"
ATTEMPTS = "_reprocess_attempts"
REPROCESSED_AT = "_reprocessed_at"
# The day of validation, by which quarantine is laid out, and the day from which a row
# passes that has nothing against it but a date to come.
VALIDATED_ON = "_validated_on"
DUE_ON = "_due_on"

# Members of the verdict struct.
PRICE_PRESENT = "precio_not_null"
PRICE_POSITIVE = "precio_positive"
DATE_PRESENT = "fecha_not_null"
DATE_NOT_FUTURE = "fecha_not_future"

# Reasons and codes.
REASON_PRICE_NULL = "Precio Base nulo"
REASON_PRICE_NOT_POSITIVE = "Precio Base <= 0"
REASON_DATE_NULL = "Fecha de Firma nula"
REASON_DATE_FUTURE = "Fecha de Firma futura"
REASON_UNDECIDED = "Incumple reglas de calidad"
CODE_DATE_NULL = "E001"
CODE_DATE_FUTURE = "E002"
CODE_PRICE_NULL = "E003"
CODE_PRICE_NOT_POSITIVE = "E004"
CODE_UNDECIDED = "E999"

# Column of the daily report that counts each code.
REPORT_CODES = {
    "e001_fecha_nula": CODE_DATE_NULL,
    "e002_fecha_futura": CODE_DATE_FUTURE,
    "e003_precio_nulo": CODE_PRICE_NULL,
    "e004_precio_no_positivo": CODE_PRICE_NOT_POSITIVE,
}

# Gold measure.
TOTAL_CONTRACTED = "total_contratado"

# Columns that a run adds to those of the source.
ADDED_COLUMNS = frozenset(
    {
        INGESTED_AT, SOURCE_FILE, INGESTED_ON, ROW_DIGEST, CHECKS, IS_VALID, REASONS, CODE,
        REJECT_REASON, VALIDATED_AT, PIPELINE_VERSION, QUARANTINE_ID, ATTEMPTS, REPROCESSED_AT,
        VALIDATED_ON, DUE_ON, WRITE,
    }
)
