"""Silver to gold: classification, metrics, alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from latebook.operators import gold as g
from latebook.operators.cleaning import nonpositive_payments
from latebook.operators.control import quality_gate
from latebook.operators.quarantine import error_records
from latebook.operators.rules import classify_rows, late_rows, violating_payments
from latebook.plans.run import Run, recorded
from latebook.profiles import AnalysisWindow
from latebook.sinks.tables import replace_slice, write_plain
from latebook.workspace import scratch


@dataclass(frozen=True)
class Published:
    customers: DataFrame
    metrics: DataFrame
    alerts: DataFrame
    violations: DataFrame
    passed: bool


def audited(rows: DataFrame, run: Run, window: AnalysisWindow) -> DataFrame:
    """Rows of a gold table with when they were made and the day that they show."""
    return rows.withColumns({
        "dt_processamento": F.lit(run.started), "dt_atualizacao": F.lit(run.started),
        "dt_snapshot": F.lit(window.reference_date.isoformat())})


def publish(run: Run, transactions: DataFrame, payments: DataFrame) -> Published:
    """Write the gold tables of a reference month and check them.

    The late rows are staged in the shared folder, since both the classification and the
    list of violating payments need them, so transactions and payments are joined once.
    Metrics and alerts read the written customers. A month that is published again
    replaces its own slice of every table.
    """
    window = AnalysisWindow(run.as_of)
    spark, out = run.spark, run.output_path
    with recorded(run):
        run.require("bronze_to_silver")
        with run.phase("data_validation"):
            run.errors(error_records(
                nonpositive_payments(payments), error_type="INVALID_PAYMENT",
                entity="payments", process_id=run.process_id, error_time=run.started), "payments")
        with scratch(spark, "late-rows") as folder:
            with run.phase("data_transformation"):
                late = late_rows(transactions, payments, window)
                late = spark.read.schema(late.schema).parquet(write_plain(late, folder))
                result = audited(classify_rows(late, transactions, window, run.process_id),
                                 run, window)
            with run.phase("data_writing"):
                month = window.reference_month
                clients, metrics_at, alerts_at, violations_at = (
                    f"{out}/inadimplencia_{name}"
                    for name in ("clientes", "metricas", "alertas", "violacoes"))
                replace_slice(result, clients, "reference_month", month, ["inadimplente"])
                customers = spark.read.schema(result.schema).parquet(clients).filter(
                    F.col("reference_month") == month)
                metrics = audited(g.delinquency_metrics(customers).withColumns({
                    "data_geracao": F.lit(run.started), "processo_id": F.lit(run.process_id)}),
                    run, window)
                replace_slice(metrics, metrics_at, "reference_month", month)
                alerts = audited(g.delinquency_alerts(
                    customers, run.started, run.process_id).withColumn(
                    "reference_month", F.lit(month)), run, window)
                replace_slice(alerts, alerts_at, "reference_month", month)
                violations = audited(violating_payments(late, window).withColumn(
                    "reference_month", F.lit(month)), run, window)
                replace_slice(violations, violations_at, "reference_month", month)
        all_metrics = g.month_over_month(spark.read.schema(metrics.schema).parquet(metrics_at))
        passed = quality_gate(customers, all_metrics, month).first()["success"] == 1
        run.count(processed=customers.count())

    def written_month(schema: StructType, path: str) -> DataFrame:
        return spark.read.schema(schema).parquet(path).filter(F.col("reference_month") == month)
    return Published(customers, all_metrics, written_month(alerts.schema, alerts_at),
                     written_month(violations.schema, violations_at), passed)
