"""Rejected and suspicious rows as typed error records, built in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latebook.operators.cleaning import (
    inconsistent_dates, invalid_rows, nonpositive_payments,
)
from latebook.schemas import ERROR_RECORDS

# The published error types and their messages.
MESSAGES = {
    "DATA_VALIDATION_ERROR": "Campos obrigatórios nulos",
    "DATE_CONSISTENCY_WARNING": "Data de vencimento anterior à data da transação",
    "PAYMENT_VALUE_WARNING": "Pagamento com valor zero ou negativo",
    "INVALID_PAYMENT": "Pagamento com valor zero ou negativo",
    "DATA_QUALITY_ERROR": "Falha na validação de qualidade",
    "PROCESS_FAILURE": "Falha do processo",
}


def error_records(rows: DataFrame, *, error_type: str | Column, entity: str, process_id: str,
                  error_time: str, source_file: str | Column = "",
                  message: str | Column | None = None) -> DataFrame:
    """One error record per row, with the row itself as JSON text.

    The id is a hash of type, process and content: a rerun of the same rows gives the same ids.
    """
    kind = error_type if isinstance(error_type, Column) else F.lit(error_type)
    if message is None:
        names = F.create_map(*[F.lit(x) for pair in MESSAGES.items() for x in pair])
        message = F.lit(MESSAGES[error_type]) if isinstance(error_type, str) else names[kind]
    text = message if isinstance(message, Column) else F.lit(message)
    source = source_file if isinstance(source_file, Column) else F.lit(source_file)
    content = F.to_json(F.struct(*rows.columns))
    return rows.select(
        F.sha2(F.concat_ws("||", kind, F.lit(process_id), content), 256).alias("error_id"),
        F.lit(process_id).alias("process_id"), F.lit(entity).alias("entity_name"),
        F.lit(error_time).alias("error_time"), kind.alias("error_type"),
        text.alias("error_message"), source.alias("source_file"),
        content.alias("record_content"),
    ).select(*ERROR_RECORDS.fieldNames())


def issues(bronze: DataFrame, unique: DataFrame, entity: str) -> DataFrame:
    """Rows worth a record, with their ``error_type``; a clean row does not appear.

    ``bronze`` gives the rejected rows, ``unique`` (complete rows, one per key) the kept
    ones that need a remark: due dates to be repaired, payments without a value.
    """
    rejected = invalid_rows(bronze, entity).withColumn(
        "error_type", F.lit("DATA_VALIDATION_ERROR"))
    if entity == "transactions":
        remarks, kind = inconsistent_dates(unique), "DATE_CONSISTENCY_WARNING"
    else:
        remarks, kind = nonpositive_payments(unique), "PAYMENT_VALUE_WARNING"
    return rejected.unionByName(remarks.withColumn("error_type", F.lit(kind)))


def error_type_counts(errors: DataFrame) -> DataFrame:
    return errors.groupBy("entity_name", "error_type").agg(
        F.count(F.lit(1)).alias("n_errors"))
