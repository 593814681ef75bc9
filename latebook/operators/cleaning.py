"""Bronze to silver: validity, deduplication, typing, repair, defaults, counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latebook.functions import amount_band, due_date, mask_partial
from latebook.profiles import DEFAULT_METHOD, DEFAULT_STATUS
from latebook.schemas import ENTITY_KEY, REQUIRED, SILVER_TYPES


def is_invalid(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def valid_rows(df: DataFrame, entity: str) -> DataFrame:
    return df.filter(~is_invalid(REQUIRED[entity]))


def invalid_rows(df: DataFrame, entity: str) -> DataFrame:
    return df.filter(is_invalid(REQUIRED[entity]))


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of each key in a total order.

    Spark limits each key to one row per task before the shuffle (WindowGroupLimit), so a
    key that holds a large share of the rows reaches its reducer as one row per task. The
    remaining columns break ties, hence rows that still tie are equal.
    """
    given = {c for c in order_by if isinstance(c, str)}
    rest = [c for c in df.columns if c not in given and c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order_by, *rest)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def enforce_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit becomes null instead of failing the job."""
    present = {c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns}
    return df.withColumns(present)


def inconsistent_due(due: Column, transaction_date: Column) -> Column:
    """A due date before its transaction; as midnight, so a later time that day counts."""
    return due.cast("timestamp") < transaction_date.cast("timestamp")


def inconsistent_dates(df: DataFrame) -> DataFrame:
    return df.filter(inconsistent_due(F.col("due_date"), F.col("transaction_date")))


def repair_due_date(df: DataFrame) -> DataFrame:
    """Replace an inconsistent due date by the default term."""
    broken = inconsistent_due(F.col("due_date"), F.col("transaction_date"))
    fixed = F.when(broken, due_date(F.col("transaction_date"))).otherwise(F.col("due_date"))
    return df.withColumn("due_date", fixed)


def with_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Fill nulls, and create columns that are missing."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v)
        for c, v in defaults.items()
    })


def payment_defaults(df: DataFrame) -> DataFrame:
    return with_defaults(df, {"payment_method": DEFAULT_METHOD, "payment_status": DEFAULT_STATUS})


def nonpositive_payments(df: DataFrame) -> DataFrame:
    return df.filter(F.col("amount_paid") <= 0)


def unique_valid(df: DataFrame, entity: str, order_by: Sequence[str | Column]) -> DataFrame:
    """Typed rows of a bronze table: complete ones, and one per key."""
    typed = enforce_types(valid_rows(df, entity), SILVER_TYPES[entity])
    return dedupe(typed, [ENTITY_KEY[entity]], order_by)


def finish_transactions(unique: DataFrame, processed_at: str) -> DataFrame:
    """Mask, classify and repair unique transactions, row by row."""
    return repair_due_date(unique.withColumns({
        "customer_id_masked": mask_partial(F.col("customer_id")),
        "valor_classificacao": amount_band(F.col("amount")),
        "dt_processamento": F.lit(processed_at),
    }))


def finish_payments(unique: DataFrame, processed_at: str) -> DataFrame:
    return payment_defaults(unique).withColumn("dt_processamento", F.lit(processed_at))


FINISH = {"transactions": finish_transactions, "payments": finish_payments}


def clean(df: DataFrame, entity: str, order_by: Sequence[str | Column],
          processed_at: str) -> DataFrame:
    """The silver rows of a bronze table."""
    return FINISH[entity](unique_valid(df, entity, order_by), processed_at)


def cleaning_summary(df: DataFrame, entity: str, key: str) -> DataFrame:
    """Rows before, after and removed by validity and deduplication, in one scan.

    Grouping by key first makes the distinct count a plain sum, combined before the shuffle.
    """
    bad = is_invalid(REQUIRED[entity])
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~bad).alias("valid"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("initial_count"),
        F.coalesce(F.sum(F.col("n") - F.col("valid")), F.lit(0)).alias("invalid_count"),
        F.count_if(F.col("valid") > 0).alias("final_count"),
    ).withColumn("removed_count", F.col("initial_count") - F.col("final_count")).select(
        F.lit(entity).alias("entity_name"), "initial_count", "invalid_count", "final_count",
        "removed_count")
