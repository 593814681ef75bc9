"""Transaction and payment streams in their common shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebook.functions import date_parts, due_date, parse_timestamp
from latebook.operators.cleaning import with_defaults
from latebook.profiles import DEFAULT_METHOD_STREAM, DEFAULT_STATUS
from latebook.sources.contracts import to_stream_names


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "json",
                max_files: int | None = 1, **options: str) -> DataFrame:
    """Files that arrive in a folder, as a stream; by default one file per trigger."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def transaction_events(raw: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """Raw transactions with event time, due date, parts and the stream's column names."""
    when = parse_timestamp(F.col("date"))
    events = raw.withColumns({
        "transaction_date": when, "due_date": due_date(F.col("date")), **date_parts(when),
        "processing_time": F.current_timestamp() if processing_time is None else processing_time,
    })
    return to_stream_names(events.drop("date"))


def payment_events(raw: DataFrame) -> DataFrame:
    """Raw payments with event time, method and status.

    Parts and processing time stay on the transaction's side only, so that the joined
    stream has each of those columns once.
    """
    events = raw.withColumn("payment_date", parse_timestamp(F.col("date_paid"))).drop("date_paid")
    return with_defaults(to_stream_names(events), {
        "payment_method": DEFAULT_METHOD_STREAM, "status": DEFAULT_STATUS})


def unique_within(events: DataFrame, keys: list[str], time: str, delay: str,
                  salts: int = 4) -> DataFrame:
    """Drop repeated deliveries of an event within the watermark delay.

    Copies are first dropped per key and reading task, so that an event delivered very often
    is spread over tasks; at most one copy per salt then meets the others. The task's number
    stays the same when it is repeated.
    """
    marked = events.withWatermark(time, delay)
    if salts > 1:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        marked = (marked.withColumn("_salt", salt)
                  .dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt"))
    return marked.dropDuplicatesWithinWatermark(keys)
