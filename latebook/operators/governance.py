"""Retention and role-scoped views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latebook.functions import mask_partial, pseudonym

# Sensitivity tags of the published columns.
COLUMN_TAGS = {
    "customer_id": "PII",
    "amount": "Financial",
    "amount_paid": "Financial",
    "total_valor_em_aberto": "Financial",
}
#: Tags of every column that the jobs publish, for ``tagged``.
PUBLIC, PII, FINANCIAL = "Public", "PII", "Financial"
PUBLISHED_TAGS = {
    **dict.fromkeys((
        "customer_id", "customer_id_masked", "record_content", "email", "cpf"), PII),
    **dict.fromkeys((
        "amount", "amount_paid", "value", "payment_amount", "total_valor_em_aberto",
        "valor_em_aberto", "valor_classificacao", "total_em_aberto", "valor_total_inadimplencia"),
        FINANCIAL),
    **dict.fromkeys((
        "transaction_id", "payment_id", "date", "date_paid", "transaction_date", "payment_date",
        "due_date", "year", "month", "day", "payment_method", "payment_status", "status",
        "inadimplente", "regras_aplicadas", "regra_aplicada", "descricao", "total_ocorrencias",
        "max_dias_atraso", "dias_atraso", "days_late", "payment_done", "criterio_1", "criterio_2",
        "severidade", "data_classificacao", "data_alerta", "data_geracao", "alerta_enviado",
        "processo_id", "process_id", "execution_id", "reference_date", "reference_month",
        "reference_quarter", "processing_time", "dt_ingestao", "dt_atualizacao", "dt_processamento",
        "dt_snapshot", "source_file", "hash_chave", "hash_columns", "certificado_qualidade",
        "versao_processo", "total_clientes", "total_inadimplentes", "taxa_inadimplencia",
        "variacao_mes_anterior"), PUBLIC),
}
_TAG = "tag"


def retained(df: DataFrame, column: str, as_of: dt.date, days: int) -> DataFrame:
    """Rows ingested within the retention period; on a partition column this only prunes."""
    return df.filter(F.col(column) >= F.lit(as_of - dt.timedelta(days=days)))


def expire(spark: SparkSession, table: str, column: str, as_of: dt.date, days: int) -> DataFrame:
    """Drop the partitions of a catalog table that are past the retention period.

    ``column`` is a partition column with dates. Returns the audit of what went: one row for each
    partition with its day, its rows and the last day that is kept. Rows without a day stay.
    Counting reads no column, and dropping removes the files of a managed or external table.
    """
    first_kept = as_of - dt.timedelta(days=days)
    day = F.col(column).cast("date")
    expired = spark.table(table).filter(day < F.lit(first_kept)).groupBy(
        F.col(column).cast("string").alias("dropped_day")).agg(F.count("*").alias("n_rows"))
    rows = expired.collect()  # one row per partition
    for row in rows:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION "
                  f"(`{column}` = '{row['dropped_day']}') PURGE")
    audit = [(table, r["dropped_day"], r["n_rows"], str(first_kept)) for r in rows]
    return spark.createDataFrame(
        audit, "table_name string, dropped_day string, n_rows long, first_kept string")


def role_view(df: DataFrame, allowed: Collection[str],
              tags: Mapping[str, str] = COLUMN_TAGS) -> DataFrame:
    """What a role may see: untagged and allowed columns as they are, personal data
    masked, other tagged columns left out. ``policy_view`` is closed by default instead."""
    columns = []
    for name in df.columns:
        tag = tags.get(name)
        if tag is None or tag in allowed:
            columns.append(F.col(name))
        elif tag == "PII":
            columns.append(mask_partial(F.col(name)).alias(name))
    return df.select(*columns)


def tagged(df: DataFrame, tags: Mapping[str, str] = PUBLISHED_TAGS) -> DataFrame:
    """The table with its columns' tags in their schema, where they go along into files and views.

    Columns that ``tags`` does not name keep the tag that they have, if any.
    """
    for field in df.schema.fields:
        if field.name in tags:
            df = df.withMetadata(field.name, {**field.metadata, _TAG: tags[field.name]})
    return df


def untagged(df: DataFrame) -> list[str]:
    """The columns that no role will see for want of a tag."""
    return [f.name for f in df.schema.fields if _TAG not in f.metadata]


def policy_view(df: DataFrame, allowed: Collection[str], salt: str) -> DataFrame:
    """What a role may see, by the tags in the schema.

    Public columns and those of ``allowed`` tags are shown, personal data becomes a salted
    pseudonym, by which rows can still be joined, and anything else is hidden: what carries no tag,
    too.
    """
    columns: list[Column] = []
    for field in df.schema.fields:
        tag = field.metadata.get(_TAG)
        if tag == PUBLIC or (tag is not None and tag in allowed):
            columns.append(F.col(field.name))
        elif tag == PII:
            hidden = pseudonym(F.col(field.name).cast("string"), salt)
            columns.append(hidden.alias(field.name, metadata=field.metadata))
    return df.select(*columns)
