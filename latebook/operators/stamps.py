"""Audit and quality columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latebook.functions import content_hash, discovered_key_columns, key_hash


def audit_stamp(df: DataFrame, *, ingested_on: str, updated_at: str, process_id: str,
                execution_id: str, source_file: str | Column,
                keys: Sequence[str] | None = None) -> DataFrame:
    """Seven lineage columns; without ``keys`` the key columns are found by name.

    A column ``source_file`` of the rows themselves is no content and is not hashed.
    """
    columns = [c for c in df.columns if c != "source_file"]
    source = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return df.withColumns({
        "dt_ingestao": F.lit(ingested_on),
        "dt_atualizacao": F.lit(updated_at),
        "source_file": source,
        "process_id": F.lit(process_id),
        "execution_id": F.lit(execution_id),
        "hash_chave": key_hash(keys or discovered_key_columns(columns)),
        "hash_columns": content_hash(columns),
    })


def quality_stamp(df: DataFrame, *, process_id: str, stamped_at: str, certified: bool = True,
                  version: str = "1.0") -> DataFrame:
    return df.withColumns({
        "dt_processamento": F.lit(stamped_at),
        "processo_id": F.lit(process_id),
        "certificado_qualidade": F.lit(certified),
        "dt_atualizacao": F.lit(stamped_at),
        "versao_processo": F.lit(version),
    })
