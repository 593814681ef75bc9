"""Data-quality suites over the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latebook.catalog import views as v
from latebook.catalog.registry import query
from latebook.operators import quality as q


def _check_sql(table: str, kind: str, column: str) -> str:
    """One suite row; ``unexpected`` and the base of its percentage as in the suite."""
    base = "count(*)" if kind == "not_null" else f"count({column})"
    bad = {
        "not_null": f"count(*) FILTER ({column} IS NULL)",
        "of_type": "0",
        "between": f"count(*) FILTER ({column} < 0)",
        "unique": f"""(SELECT coalesce(sum(n), 0) FROM (
            SELECT count(*) AS n FROM {table} WHERE {column} IS NOT NULL
            GROUP BY {column} HAVING count(*) > 1))""",
    }[kind]
    limit = "1.0" if kind == "between" else "0.0"
    return f"""
SELECT '{kind}' AS check_name, '{column}' AS column_name, n AS element_count,
       CAST(bad AS BIGINT) AS unexpected_count,
       round(bad * 100.0 / base, 2) AS unexpected_percent, bad * 100.0 / base <= {limit}
         AS success
FROM (SELECT count(*) AS n, {bad} AS bad, {base} AS base FROM {table})"""


TX = [("not_null", "transaction_id"), ("not_null", "customer_id"),
      ("not_null", "transaction_date"), ("not_null", "amount"), ("of_type", "transaction_id"),
      ("of_type", "amount"), ("unique", "transaction_id"), ("between", "amount")]
PAY = [("not_null", "payment_id"), ("not_null", "transaction_id"), ("not_null", "payment_date"),
       ("not_null", "amount_paid"), ("of_type", "payment_id"), ("of_type", "transaction_id"),
       ("of_type", "amount_paid"), ("unique", "payment_id"), ("between", "amount_paid")]


def _suite_sql(table: str, checks: list[tuple[str, str]], kinds: tuple[str, ...] = ()) -> str:
    wanted = [c for c in checks if not kinds or c[0] in kinds]
    return "\nUNION ALL".join(_check_sql(table, *c) for c in wanted)


def _part(kind: str) -> str:
    return v.sql(f"SELECT * FROM ({_suite_sql('tx_dirty', TX, (kind,))}\nUNION ALL"
                 f"{_suite_sql('pay_dirty', PAY, (kind,))})", "tx_dirty", "pay_dirty")


def _run(spark: SparkSession, sf_dir: str, kind: str | None = None) -> dict[str, DataFrame]:
    tables = {"transactions": v.tx_dirty(spark, sf_dir), "payments": v.pay_dirty(spark, sf_dir)}
    return {name: q.run_suite(df, [c for c in q.SUITES[name] if kind in (None, c.kind)])
            for name, df in tables.items()}


def _both(results: dict[str, DataFrame]) -> DataFrame:
    return results["transactions"].unionByName(results["payments"])


@query("dq_not_null", _part("not_null"))
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(_run(spark, sf_dir, "not_null"))


@query("dq_types", _part("of_type"))
def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(_run(spark, sf_dir, "of_type"))


@query("dq_unique", _part("unique"))
def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(_run(spark, sf_dir, "unique"))


@query("dq_between_mostly", _part("between"))
def between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(_run(spark, sf_dir, "between"))


@query("dq_suite_transactions", v.sql(_suite_sql("tx_dirty", TX), "tx_dirty"))
def suite_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.run_suite(v.tx_dirty(spark, sf_dir), q.TRANSACTION_SUITE)


@query("dq_suite_payments", v.sql(_suite_sql("pay_dirty", PAY), "pay_dirty"))
def suite_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.run_suite(v.pay_dirty(spark, sf_dir), q.PAYMENT_SUITE)


@query("dq_score", v.sql("""
SELECT *, CASE WHEN score_percent >= 95 THEN 'green' WHEN score_percent >= 90 THEN 'yellow'
               WHEN score_percent >= 80 THEN 'orange' ELSE 'red' END AS faixa
FROM (SELECT table_name, count(*) AS n_checks, count(*) FILTER (success) AS n_passed,
             round(avg(CASE WHEN success THEN 1 ELSE 0 END), 4) AS score,
             round(avg(CASE WHEN success THEN 1 ELSE 0 END) * 100, 2) AS score_percent
      FROM results GROUP BY table_name)""", "tx_dirty", "pay_dirty", results=f"""
SELECT 'transactions' AS table_name, * FROM ({_suite_sql('tx_dirty', TX)})
UNION ALL SELECT 'payments', * FROM ({_suite_sql('pay_dirty', PAY)})"""))
def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = [df.withColumn("table_name", F.lit(name))
               for name, df in _run(spark, sf_dir).items()]
    return q.quality_score(results[0].unionByName(results[1]))
