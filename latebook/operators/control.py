"""Control tables: process logs, run gates, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from latebook.profiles import GATE_DEFAULT, GATE_THRESHOLDS, STATUS_ERROR, STATUS_OK
from latebook.schemas import PROCESS_LOG


def process_log_row(spark: SparkSession, **values: object) -> DataFrame:
    """One record of a stage run; columns the stage does not know stay null."""
    unknown = set(values) - set(PROCESS_LOG.fieldNames())
    if unknown:
        raise ValueError(f"unknown process log columns: {sorted(unknown)}")
    return spark.createDataFrame(
        [tuple(values.get(c) for c in PROCESS_LOG.fieldNames())], PROCESS_LOG)


def as_process_log(df: DataFrame) -> DataFrame:
    """Bring any stage's log to the common record."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in PROCESS_LOG.fields])


def run_date(df: DataFrame) -> DataFrame:
    return df.withColumn("run_date", F.col("start_time").cast("date"))


def latest_process(logs: DataFrame) -> DataFrame:
    """The last run per stage, entity and day; ties go to the higher process id.

    Logs of one stage may come without ``stage_name``.
    """
    stage = [c for c in ("stage_name",) if c in logs.columns]
    window = Window.partitionBy(*stage, "entity_name", "run_date").orderBy(
        F.col("start_time").desc(), F.col("process_id").desc())
    return (run_date(logs).withColumn("_rank", F.row_number().over(window))
            .filter(F.col("_rank") == 1).drop("_rank"))


def with_duration(logs: DataFrame) -> DataFrame:
    """Whole seconds from start to end."""
    start, end = F.col("start_time").cast("timestamp"), F.col("end_time").cast("timestamp")
    return logs.withColumn("duration_seconds", F.timestamp_diff("SECOND", start, end))


def error_samples(logs: DataFrame, errors: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` errors of the last run per stage, entity and day.

    Filtered to those runs before ranking; they number one per stage, entity and day.
    """
    last = latest_process(logs).select("process_id", "run_date")
    window = Window.partitionBy("process_id").orderBy("error_time", "error_id")
    return (errors.join(last, "process_id")
            .withColumn("_rank", F.row_number().over(window))
            .filter(F.col("_rank") <= n)
            .select("run_date", "process_id", "entity_name", "error_type", "error_message",
                    "error_time"))


def run_gate(logs: DataFrame, thresholds: Mapping[str, float] | None = None,
             expected: DataFrame | None = None, default: float = GATE_DEFAULT,
             trust_status: bool = True) -> DataFrame:
    """May the next stage start? Per stage, entity and day, from the last run.

    Passes on success, or when the error rate is within the threshold of the stage; a run
    without records passes on success only. Without ``trust_status`` a successful run that
    has records must keep to its threshold too. Logs without ``stage_name`` have thresholds
    by entity. ``expected`` (stage_name if the logs have it, entity_name, run_date) adds runs
    that left no log, which pass as NOT_FOUND.
    """
    stage = [c for c in ("stage_name",) if c in logs.columns]
    named = F.col((stage or ["entity_name"])[0])
    limit = F.lit(float(default))
    for name, value in (GATE_THRESHOLDS if thresholds is None else thresholds).items():
        limit = F.when(named == name, F.lit(float(value))).otherwise(limit)
    runs = with_duration(latest_process(logs))
    if expected is not None:
        runs = expected.join(runs, [*stage, "entity_name", "run_date"], "left").withColumn(
            "status", F.coalesce(F.col("status"), F.lit("NOT_FOUND")))
    processed, failed = F.col("total_records_processed"), F.col("total_records_error")
    rate = F.when(processed > 0, failed / processed)
    within = F.coalesce(rate <= limit, F.lit(False))
    excused = F.col("status") == STATUS_OK
    if not trust_status:
        excused = excused & rate.isNull()
    passed = F.coalesce(excused | (F.col("status") == "NOT_FOUND"), F.lit(False)) | within
    return runs.select(
        *stage, "entity_name", "run_date", "status", "total_records_processed", "total_records_error",
        "duration_seconds", F.round(rate, 4).alias("error_rate"), limit.alias("threshold"),
        passed.alias("passed"))


def overall_status(last_runs: DataFrame) -> DataFrame:
    """Per day: success if every stage succeeded, failure if any failed, else partial."""
    status = F.col("status")
    every = F.bool_and(F.coalesce(status == STATUS_OK, F.lit(False)))
    return last_runs.groupBy("run_date").agg(
        F.count(F.lit(1)).alias("n_stages"),
        F.when(every, "Sucesso").when(F.bool_or(status == STATUS_ERROR), "Falha")
        .otherwise("Parcial").alias("overall_status"))


def run_summary(logs: DataFrame, stages: Sequence[str] = tuple(GATE_THRESHOLDS),
                by: str = "stage_name") -> DataFrame:
    """Per day: runs, records and errors of each stage side by side."""
    sums = []
    for stage in stages:
        mine = F.col(by) == stage
        sums += [
            F.count_if(mine).alias(f"{stage}_runs"),
            F.coalesce(F.sum(F.when(mine, F.col("total_records_processed"))), F.lit(0))
            .alias(f"{stage}_records"),
            F.coalesce(F.sum(F.when(mine, F.col("total_records_error"))), F.lit(0))
            .alias(f"{stage}_errors")]
    return run_date(logs).groupBy("run_date").agg(*sums)


def quality_gate(gold: DataFrame, metrics: DataFrame | None,
                 reference_month: str) -> DataFrame:
    """1 if the month has delinquents and there are metrics at all, else 0.

    Both counts are one-row aggregates; they are stacked and folded, not joined. Without
    ``metrics``, those of ``gold`` itself are meant, which are there if it has any row.
    """
    if metrics is None:
        found = F.count_if(F.col("inadimplente") & (F.col("reference_month") == reference_month))
        return gold.agg(F.when(found > 0, 1).otherwise(0).alias("success"))
    delinquents = gold.filter(
        F.col("inadimplente") & (F.col("reference_month") == reference_month)).agg(
        F.count(F.lit(1)).alias("delinquents"), F.lit(0).cast("long").alias("metrics"))
    months = metrics.agg(
        F.lit(0).cast("long").alias("delinquents"), F.count(F.lit(1)).alias("metrics"))
    both = delinquents.unionByName(months).agg(
        F.max("delinquents").alias("delinquents"), F.max("metrics").alias("metrics"))
    passed = (F.col("delinquents") > 0) & (F.col("metrics") > 0)
    return both.select(F.when(passed, 1).otherwise(0).alias("success"))


