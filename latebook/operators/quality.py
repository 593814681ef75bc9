"""Data-quality suites: every check of a table in one scan, results as a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latebook.functions import banded
from latebook.profiles import QUALITY_BAND_LOW, QUALITY_BANDS

# Type names of the suites and the Spark types they stand for.
TYPE_NAMES = {"str": ("string",), "float": ("double", "float")}
RESULT_COLUMNS = ("check_name", "column_name", "element_count", "unexpected_count",
                  "unexpected_percent", "success")


@dataclass(frozen=True)
class Check:
    """``kind`` is not_null, of_type, unique or between."""

    kind: str
    column: str
    type_name: str = ""
    min_value: float = 0.0
    mostly: float = 1.0

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"


def _checks(key: str, required: Sequence[str], types: Sequence[tuple[str, str]],
            value: str) -> tuple[Check, ...]:
    return (*[Check("not_null", c) for c in required],
            *[Check("of_type", c, type_name=t) for c, t in types],
            Check("unique", key), Check("between", value, min_value=0, mostly=0.99))


TRANSACTION_SUITE = _checks(
    "transaction_id", ("transaction_id", "customer_id", "transaction_date", "amount"),
    (("transaction_id", "str"), ("amount", "float")), "amount")
PAYMENT_SUITE = _checks(
    "payment_id", ("payment_id", "transaction_id", "payment_date", "amount_paid"),
    (("payment_id", "str"), ("transaction_id", "str"), ("amount_paid", "float")), "amount_paid")
SUITES = {"transactions": TRANSACTION_SUITE, "payments": PAYMENT_SUITE}


def _type_ok(df: DataFrame, check: Check) -> bool:
    return dict(df.dtypes).get(check.column) in TYPE_NAMES[check.type_name]


def _unexpected(check: Check) -> Column:
    """Per row: does it break a row check? Nulls only ever break ``not_null``."""
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    return F.coalesce(column < check.min_value, F.lit(False))


def run_suite(df: DataFrame, suite: Sequence[Check]) -> DataFrame:
    """One result row per check.

    Row checks are counted per key of the first uniqueness check, then summed, so that
    uniqueness comes out of the same scan; both steps combine before their shuffle.
    Percentages refer to all rows for ``not_null`` and to non-null values otherwise.
    """
    row_checks = [c for c in suite if c.kind in ("not_null", "between")]
    unique_checks = [c for c in suite if c.kind == "unique"]
    counted = sorted({c.column for c in suite if c.kind != "not_null"})
    counters = [F.count(F.lit(1)).alias("_n"),
                *[F.count(c).alias(f"_present_{c}") for c in counted],
                *[F.count_if(_unexpected(c)).alias(f"_bad_{c.name}") for c in row_checks]]
    if unique_checks:
        first, *others = unique_checks
        per_key = df.groupBy(F.col(first.column).alias("_key")).agg(*counters)
        totals = per_key.agg(
            *[F.coalesce(F.sum(F.col(f"`{c}`")), F.lit(0)).alias(c)
              for c in per_key.columns if c != "_key"],
            F.coalesce(F.sum(F.when(F.col("_key").isNotNull() & (F.col("_n") > 1),
                                    F.col("_n"))), F.lit(0)).alias(f"_bad_{first.name}"))
    else:
        others = []
        totals = df.agg(*counters)
    rows = F.array(*[_result(df, c) for c in suite if c not in others])
    results = totals.select(F.explode(rows).alias("r")).select("r.*")
    for check in others:
        results = results.unionByName(unique_result(df, check))
    return results


def _result(df: DataFrame, check: Check) -> Column:
    total = F.col("_n")
    present = total if check.kind == "not_null" else F.col(f"_present_{check.column}")
    if check.kind == "of_type":
        good = _type_ok(df, check)
        bad = F.lit(0) if good else present
    else:
        bad = F.col(f"`_bad_{check.name}`")
    return _result_struct(check, total, bad, present)


def _result_struct(check: Check, total: Column, bad: Column, present: Column) -> Column:
    share = F.coalesce(F.try_divide(bad * F.lit(100.0), present), F.lit(0.0))
    return F.struct(
        F.lit(check.kind).alias("check_name"), F.lit(check.column).alias("column_name"),
        total.cast("long").alias("element_count"), bad.cast("long").alias("unexpected_count"),
        F.round(share, 2).alias("unexpected_percent"),
        (share <= round(100.0 * (1 - check.mostly), 9)).alias("success"))


def unique_result(df: DataFrame, check: Check) -> DataFrame:
    """Rows whose key occurs more than once; null keys are left out."""
    per_key = df.groupBy(F.col(check.column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"),
        F.coalesce(F.sum(F.when(F.col("_key").isNotNull(), F.col("_n"))), F.lit(0))
        .alias("_present"),
        F.coalesce(F.sum(F.when(F.col("_key").isNotNull() & (F.col("_n") > 1), F.col("_n"))),
                   F.lit(0)).alias("_bad"))
    row = _result_struct(check, F.col("_total"), F.col("_bad"), F.col("_present"))
    return totals.select(row.alias("r")).select("r.*")


def quality_score(results: DataFrame) -> DataFrame:
    """Share of passed checks per table, as score, percentage and traffic-light band.

    ``results`` has a column ``table_name`` next to the suite's columns.
    """
    score = F.avg(F.col("success").cast("int"))
    scored = results.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_checks"), F.count_if("success").alias("n_passed"),
        F.round(score, 4).alias("score"), F.round(score * 100, 2).alias("score_percent"))
    return scored.withColumn("faixa", banded(
        F.col("score_percent"), QUALITY_BANDS, QUALITY_BAND_LOW, inclusive=True))


def failed_checks(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("success"))


def calendar_check(df: DataFrame, columns: Sequence[str], oldest: str = "1900-01-01") -> DataFrame:
    """Whether any timestamp is older than a day, and the rebase mode that follows."""
    old = F.coalesce(F.greatest(*[F.max(F.col(c) < F.lit(oldest).cast("timestamp_ntz"))
                                  for c in columns], F.lit(False)), F.lit(False))
    return df.agg(old.alias("has_old_dates")).withColumn(
        "rebase_mode", F.when(F.col("has_old_dates"), "LEGACY").otherwise("CORRECTED"))
