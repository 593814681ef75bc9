"""Per-batch writers for ``foreachBatch``; a repeated batch overwrites what it wrote."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebook.profiles import STREAM_ALERT_PERCENT
from latebook.sinks.folded import EVERY, fold, stored_rows, write_batch
from latebook.sinks.tables import write_partitioned
from latebook.streaming.metrics import (
    ALERT_COLUMNS, WINDOW_KEYS, current_windows, newest_windows, window_alerts,
)
from latebook.streaming.runner import DETAIL_PARTITIONS
from latebook.workspace import delete_folder, scratch, subfolders

log = logging.getLogger(__name__)


def batch_metrics(df: DataFrame, batch_id: int, now: dt.datetime) -> DataFrame:
    """Records, delinquents, others and percentage of one batch, in one row."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("inadimplente").alias("default_count"),
        F.count_if(~F.col("inadimplente")).alias("non_default_count"))
    share = F.try_divide(F.col("default_count") * 100.0, F.col("total_records"))
    return counts.select(
        F.lit(batch_id).cast("long").alias("batch_id"), F.lit(now.isoformat()).alias("timestamp"),
        "total_records", "default_count", "non_default_count",
        F.coalesce(share, F.lit(0.0)).alias("default_percentage"))


def flag_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("inadimplente").agg(F.count(F.lit(1)).alias("n"))


def metrics_writer(path: str, clock: Callable[[], dt.datetime] = dt.datetime.now,
                   ) -> Callable[[DataFrame, int], None]:
    """A batch function that writes one metrics row and the delinquent rows of each batch.

    Each batch has its own folder, so one that runs again after a failure replaces what it
    wrote. The batch is persisted because two writes read it.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        now = clock()
        day = {"year": F.lit(now.year), "month": F.lit(now.month), "day": F.lit(now.day)}

        def put(rows: DataFrame, name: str) -> None:
            (rows.withColumns(day).write.mode("overwrite").partitionBy(*day)
             .parquet(f"{path}/{name}/batch={batch_id}"))

        df.persist()
        try:
            put(batch_metrics(df, batch_id, now).filter("total_records > 0"), "metrics")
            put(df.filter("inadimplente"), "defaulters_details")
        finally:
            df.unpersist()
    return write


def window_writer(path: str, every: int = EVERY) -> Callable[[DataFrame, int], None]:
    """A batch function that stores the windows a batch touched, for ``stored_windows``; every so
    many batches their newest states become one snapshot."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(df, path, batch_id)
        fold(df.sparkSession, path, df.schema, newest_windows, batch_id, every)
    return write


def stored_windows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest state of each window that ``window_writer`` stored."""
    return current_windows(stored_rows(spark, path, schema))


def alert_writer(path: str, notify: Callable[[int, DataFrame], None] | None = None,
                 every: int = EVERY) -> Callable[[DataFrame, int], None]:
    """A batch function for the states of windows that stores an alert for each that is above the
    limit in a batch and was not after the batch before, and calls ``notify`` if there are any.

    Which windows are above it is kept beside the alerts, in the same way as the windows' states.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        spark, target, state = df.sparkSession, f"{path}/batch={batch_id}", f"{path}_state"
        keys = list(WINDOW_KEYS)
        above = F.coalesce(F.col("percentual_inadimplentes") > STREAM_ALERT_PERCENT, F.lit(False))
        now = df.select(*keys, above.alias("above"))
        before = current_windows(stored_rows(spark, state, now.schema, before=batch_id))
        df.persist()
        try:
            write_batch(now, state, batch_id)
            known = before.filter("above").select(*keys)
            window_alerts(df).join(known, keys, "left_anti").select(*ALERT_COLUMNS).write.mode(
                "overwrite").parquet(target)
        finally:
            df.unpersist()
        fold(spark, state, now.schema, newest_windows, batch_id, every)
        stored = spark.read.schema(window_alerts(df).schema).parquet(target)
        if not stored.isEmpty():
            log.warning("batch %s: delinquency above the limit", batch_id)
            if notify is not None:
                notify(batch_id, stored)
    return write


def settlement_writer(path: str, changes: str, waits: str) -> Callable[[DataFrame, int], None]:
    """A batch function that keeps a table of settled streams true to what has been paid so far.

    Each batch's rows are kept under ``changes``, which other streams can read as it only grows.
    Rows of payments are added to the table at ``path``, in a partition of their batch. A row of
    an unpaid transaction is added, too, and leaves once a payment of the transaction comes
    ``waits`` after it or later: only the months of unpaid rows concerned are written again.
    A batch that runs again after a failure leaves the same table.
    """
    parts = ["settled", *DETAIL_PARTITIONS, "batch"]

    def write(df: DataFrame, batch_id: int) -> None:
        spark, mine = df.sparkSession, f"{changes}/batch={batch_id}"
        df.write.mode("overwrite").parquet(mine)
        rows = spark.read.schema(df.schema).parquet(mine)
        paid = rows.filter("payment_id is not null").withColumns(
            {"settled": F.lit(True), "batch": F.lit(batch_id).cast("long")})
        unpaid = rows.filter("payment_id is null").withColumns(
            {"settled": F.lit(False), "batch": F.lit(-1).cast("long")})
        write_partitioned(paid, path, parts, replace_partitions=True)
        late = F.col("payment_date") > F.col("transaction_date") + F.expr(f"interval {waits}")
        _replace_unpaid(spark, path, parts, unpaid, paid.filter(late), late)
    return write


def _is_one_of(rows: list[Row]) -> Column:
    """Whether the columns have the values of one of the rows; a filter on partitions prunes."""
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [
        F.col(c).eqNullSafe(F.lit(v)) for c, v in row.asDict().items()]) for row in rows], F.lit(False))


def _replace_unpaid(spark: SparkSession, path: str, parts: list[str], new: DataFrame,
                    late: DataFrame, is_late: Column) -> None:
    """Add unpaid rows and take out those that payments have come for, by partition.

    A late payment may also have come out before the unpaid row, which waits for the watermark.
    """
    key, months = ["transaction_id", "year", "month"], ["year", "month"]
    # a table without any partition yet has nothing to take out
    stored = (spark.read.schema(new.schema).parquet(path) if subfolders(spark, path)
              else new.limit(0))
    known, settled = stored.filter("not settled"), late.select(*key).distinct()
    homes = known.join(settled, key, "left_semi").select(*parts).unionByName(
        new.select(*parts)).distinct().collect()  # one row per partition concerned
    if not homes:
        return
    arrived = new.select(*months).distinct().collect()
    before = stored.filter("settled").filter(_is_one_of(arrived)).filter(is_late)
    settled = settled.union(before.select(*key)).distinct()
    kept = (known.filter(_is_one_of(homes))
            .join(new.select("transaction_id"), "transaction_id", "left_anti")
            .unionByName(new).join(settled, key, "left_anti"))
    with scratch(spark, "unpaid") as staged:
        kept.select(*new.columns).write.parquet(staged)
        rows = spark.read.schema(new.schema).parquet(staged)
        write_partitioned(rows, path, parts, replace_partitions=True)
        for home in set(homes) - set(rows.select(*parts).distinct().collect()):
            delete_folder(spark, f"{path}/" + "/".join(
                f"{c}={str(v).lower() if isinstance(v, bool) else v}"
                for c, v in home.asDict().items()))
