"""Explicit schemas of the raw entities and of the control tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_TRANSACTIONS = _struct(
    ("transaction_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("amount", T.DoubleType()),
    ("date", T.StringType()),
)
RAW_PAYMENTS = _struct(
    ("payment_id", T.StringType()),
    ("transaction_id", T.StringType()),
    ("amount_paid", T.DoubleType()),
    ("date_paid", T.StringType()),
)
RAW = {"transactions": RAW_TRANSACTIONS, "payments": RAW_PAYMENTS}

REQUIRED = {
    "transactions": ("transaction_id", "customer_id", "transaction_date", "amount"),
    "payments": ("payment_id", "transaction_id", "payment_date", "amount_paid"),
}
ENTITY_KEY = {"transactions": "transaction_id", "payments": "payment_id"}

SILVER_TYPES = {
    "transactions": {
        "amount": "double",
        "transaction_date": "timestamp",
        "due_date": "date",
        "year": "int",
        "month": "int",
    },
    "payments": {
        "amount_paid": "double",
        "payment_date": "timestamp",
        "year": "int",
        "month": "int",
    },
}

PHASES = ("file_discovery", "schema_validation", "data_loading", "data_validation",
          "data_transformation", "data_writing")

# One record for all stages: stages that lack a phase leave its columns null.
PROCESS_LOG = _struct(
    ("process_id", T.StringType()),
    ("execution_id", T.StringType()),
    ("entity_name", T.StringType()),
    ("process_name", T.StringType()),
    ("stage_name", T.StringType()),
    ("start_time", T.StringType()),
    ("end_time", T.StringType()),
    ("status", T.StringType()),
    ("error_message", T.StringType()),
    ("input_path", T.StringType()),
    ("output_path", T.StringType()),
    ("total_files_processed", T.LongType()),
    ("total_records_processed", T.LongType()),
    ("total_records_error", T.LongType()),
    *[(f"{phase}_{edge}", T.StringType()) for phase in PHASES for edge in ("start", "end")],
)
ERROR_RECORDS = _struct(
    ("error_id", T.StringType()),
    ("process_id", T.StringType()),
    ("entity_name", T.StringType()),
    ("error_time", T.StringType()),
    ("error_type", T.StringType()),
    ("error_message", T.StringType()),
    ("source_file", T.StringType()),
    ("record_content", T.StringType()),
)

# Partitions of a bronze table that a batch of a run has changed.
CHANGES = _struct(
    ("entity_name", T.StringType()),
    ("process_id", T.StringType()),
    ("batch", T.StringType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
)

# Explicit, since partition columns read back would be guessed and booleans come as text.
STREAM_DETAIL = _struct(
    ("transaction_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("value", T.DoubleType()),
    ("transaction_date", T.TimestampType()),
    ("due_date", T.DateType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
    ("day", T.IntegerType()),
    ("processing_time", T.TimestampType()),
    ("payment_id", T.StringType()),
    ("payment_amount", T.DoubleType()),
    ("payment_date", T.TimestampType()),
    ("payment_method", T.StringType()),
    ("status", T.StringType()),
    ("payment_done", T.BooleanType()),
    ("days_late", T.IntegerType()),
    ("criterio_1", T.BooleanType()),
    ("criterio_2", T.BooleanType()),
    ("inadimplente", T.BooleanType()),
    ("reference_date", T.StringType()),
    ("reference_month", T.StringType()),
    ("reference_quarter", T.StringType()),
)


def raw_schema(entity: str) -> T.StructType:
    if entity not in RAW:
        raise ValueError(f"no schema is defined for entity {entity!r}")
    return RAW[entity]
