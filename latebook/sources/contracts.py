"""Extraction contracts: source column names and the canonical ones."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Contract columns and what the pipeline calls them.
TRANSACTION_CONTRACT = {"transaction_date": "date"}
PAYMENT_CONTRACT = {"payment_date": "date_paid", "payment_amount": "amount_paid",
                    "status": "payment_status"}
CONTRACTS = {"transactions": TRANSACTION_CONTRACT, "payments": PAYMENT_CONTRACT}
# The stream's names for the amounts.
STREAM_NAMES = {"amount": "value", "amount_paid": "payment_amount"}


def to_canonical(df: DataFrame, entity: str) -> DataFrame:
    return df.withColumnsRenamed(CONTRACTS[entity])


def to_stream_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(STREAM_NAMES)
