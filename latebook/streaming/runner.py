"""Starting streaming queries: sinks, checkpoints, triggers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from latebook.settings import shuffle_partitions

# How the detail table is partitioned, and the default trigger.
DETAIL_PARTITIONS = ("reference_month", "year", "month", "inadimplente")
TRIGGER = "1 minute"

# For the session: state on local disk with change logs, and few retained versions.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "10",
}


def keep_state_on_disk(spark: SparkSession) -> None:
    """Apply ``STATE_CONF`` to the queries that the session starts from now on."""
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)


def sized_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session like the given one whose stateful operators have partitions by input size.

    A stream keeps its number of partitions for as long as its checkpoint lives and adaptive
    execution does not merge them, so the default is too many for little state and too few
    for much.
    """
    sized = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            sized.conf.set(key, value)
    # shuffle_partitions gives at least two partitions per core; state wants one.
    cores = -(-spark.sparkContext.defaultParallelism // 2)
    sized.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes, cores)))
    keep_state_on_disk(sized)
    return sized


def start_table(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
                trigger: str | None = TRIGGER, spread: int | None = None) -> StreamingQuery:
    """Append a stream to a Parquet table; without a trigger, process what is there and stop.

    The rows of a partition are brought together, so that a batch writes ``spread`` files
    per partition and not one per task; a partition with most of the rows is shared by as
    many tasks, by default an eighth of the session's shuffle partitions and at least three.
    The split is by row content, the same again if a task is repeated.
    """
    if partition_by:
        if spread is None:
            tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            spread = max(3, tasks // 8)
        rest = [c for c in df.columns if c not in partition_by]
        df = df.repartition(*partition_by, F.pmod(F.xxhash64(*rest), F.lit(spread)))
    writer = (df.writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer, trigger).start()


def start_batches(df: DataFrame, function: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: str | None = TRIGGER, mode: str = "append") -> StreamingQuery:
    writer = (df.writeStream.outputMode(mode).foreachBatch(function)
              .option("checkpointLocation", checkpoint))
    return _triggered(writer, trigger).start()


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def finish(query: StreamingQuery) -> None:
    """Wait for an available-now query; a failed one raises its error."""
    query.awaitTermination()
