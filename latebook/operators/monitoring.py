"""Monitoring rollups over process logs, as aggregates that combine before the shuffle."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latebook.operators.control import with_duration
from latebook.profiles import STATUS_ERROR, STATUS_OK


def duration_percentile(logs: DataFrame, p: float = 0.95) -> DataFrame:
    """Exact duration percentile per entity.

    Runs are counted per whole second first. The percentile then sees one row per distinct
    duration, a number that the length of a run bounds, however many runs there are.
    """
    per_second = with_duration(logs).groupBy("entity_name", "duration_seconds").agg(
        F.count(F.lit(1)).alias("n"))
    return per_second.groupBy("entity_name").agg(
        F.sum("n").alias("n_runs"),
        F.percentile("duration_seconds", p, F.col("n")).alias("p_duration"))


def records_by_component(logs: DataFrame) -> DataFrame:
    return logs.groupBy("process_name", "entity_name").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.sum("total_records_processed").alias("records_processed"),
        F.sum("total_records_error").alias("records_error"))


def job_status(logs: DataFrame) -> DataFrame:
    """1 for a component whose last run succeeded, else 0."""
    last = F.max_by("status", F.struct("start_time", "process_id"))
    return logs.groupBy("process_name").agg(
        F.when(last == STATUS_OK, 1).otherwise(0).alias("job_status"))


def failures_24h(logs: DataFrame) -> DataFrame:
    """Per entity and hour: failed runs of the 24 hours that end with that hour.

    Runs are counted per hour first, so the window orders hours, not runs.
    """
    start = F.col("start_time").cast("timestamp")
    hour = F.datediff(start.cast("date"), F.lit("1970-01-01")) * 24 + F.hour(start)
    hourly = logs.groupBy("entity_name", hour.alias("epoch_hour")).agg(
        F.count_if(F.col("status") == STATUS_ERROR).alias("failures"))
    window = Window.partitionBy("entity_name").orderBy("epoch_hour").rangeBetween(-23, 0)
    return hourly.withColumn("failures_24h", F.sum("failures").over(window))


def change_markers(logs: DataFrame) -> DataFrame:
    """Minutes in which a component's record counter moved."""
    minute = F.date_trunc("minute", F.col("start_time").cast("timestamp"))
    return (logs.groupBy("process_name",
                         F.date_format(minute, "yyyy-MM-dd HH:mm:ss").alias("minute"))
            .agg(F.sum("total_records_processed").alias("records_added"))
            .filter(F.col("records_added") > 0))


#: Relative error of the merged percentiles, and the bucket of durations of nothing.
SKETCH_ERROR = 0.01
NO_TIME = -1_000_000


def duration_sketches(logs: DataFrame, error: float = SKETCH_ERROR) -> DataFrame:
    """Runs per component, hour and bucket of duration: a sketch of each hour, whose sum over any
    span is the sketch of the span.

    Buckets grow by (1 + error) / (1 - error), so a sketch has some hundred rows at most, however
    many runs there are, and the middle of a bucket is within the error of all it holds.
    """
    seconds = F.col("duration_seconds")
    bucket = F.when(seconds <= 0, F.lit(NO_TIME)).otherwise(
        F.ceil(F.log(seconds) / math.log(_growth(error)))).cast("long")
    hour = F.date_trunc("hour", F.col("start_time").cast("timestamp"))
    return (with_duration(logs).filter(seconds.isNotNull())
            .groupBy("entity_name", hour.alias("hour"), bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n_runs")))


def merged_percentile(sketches: DataFrame, p: float = 0.95,
                      error: float = SKETCH_ERROR) -> DataFrame:
    """The percentile per component over all hours given: that of the run of rank ceil(p n), within
    the relative error of the sketches."""
    merged = sketches.groupBy("entity_name", "bucket").agg(F.sum("n_runs").alias("n"))
    whole = Window.partitionBy("entity_name")  # some hundred buckets
    ranked = merged.withColumns({"upto": F.sum("n").over(whole.orderBy("bucket")),
                                 "n_runs": F.sum("n").over(whole)})
    growth = _growth(error)
    found = ranked.filter(F.col("upto") >= F.ceil(F.col("n_runs") * p)).groupBy("entity_name").agg(
        F.first("n_runs").alias("n_runs"), F.min("bucket").alias("bucket"))
    middle = 2 * F.pow(F.lit(growth), F.col("bucket")) / (growth + 1)
    return found.select("entity_name", "n_runs", F.when(
        F.col("bucket") == NO_TIME, F.lit(0.0)).otherwise(middle).alias("p_duration"))


def _growth(error: float) -> float:
    return (1 + error) / (1 - error)
