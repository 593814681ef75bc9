"""Tables of states that batches write: one folder per batch, folded into one snapshot at times.

Each batch owns a folder, so one that runs again replaces what it wrote. Every ``every`` batches
the newest snapshot and the batches since then become the next snapshot. A reader meets one
snapshot and the batches after it, however many there have been.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebook.workspace import delete_folder, finished, subfolders

Resolve = Callable[[DataFrame], DataFrame]
BATCH = "batch"
EVERY = 20


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches or snapshots in a folder that were written to their end."""
    names = [n for n in subfolders(spark, path) if "=" in n]
    return sorted(int(n.split("=")[1]) for n in names if finished(spark, f"{path}/{n}"))


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batches/batch={batch_id}")


def snapshot_of(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """The last batch that the newest snapshot holds; with ``before``, of those before a batch."""
    return max((n for n in _numbers(spark, f"{path}/snapshots") if before is None or n < before),
               default=None)


def stored_rows(spark: SparkSession, path: str, schema: T.StructType,
                before: int | None = None) -> DataFrame:
    """The rows of the newest snapshot and of the batches after it, with their ``batch``.

    ``before`` leaves out that batch and all after it, for a batch that looks at its predecessors.
    """
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    held = snapshot_of(spark, path, before)
    tail = [n for n in _numbers(spark, f"{path}/batches")
            if (held is None or n > held) and (before is None or n < before)]
    rows = spark.createDataFrame([], whole)
    if held is not None:
        rows = rows.union(spark.read.schema(whole).parquet(f"{path}/snapshots/upto={held}")
                          .select(*whole.names))
    if tail:
        files = [f"{path}/batches/batch={n}" for n in tail]
        rows = rows.union(spark.read.schema(whole).option("basePath", f"{path}/batches")
                          .parquet(*files).select(*whole.names))
    return rows


def fold(spark: SparkSession, path: str, schema: T.StructType, resolve: Resolve,
         batch_id: int, every: int = EVERY) -> bool:
    """Make the next snapshot once ``every`` batches are not in one; batches and snapshots before
    the one that it replaces are deleted, so that readers of that one can finish.

    ``resolve`` leaves of the rows with their ``batch`` those that count, with their batch.
    """
    held = snapshot_of(spark, path)
    if batch_id - (-1 if held is None else held) < every:
        return False
    rows = resolve(stored_rows(spark, path, schema, before=batch_id + 1))
    rows.write.mode("overwrite").parquet(f"{path}/snapshots/upto={batch_id}")
    for kind, name in (("batches", "batch"), ("snapshots", "upto")):
        for n in _numbers(spark, f"{path}/{kind}"):
            if held is not None and (n <= held if kind == "batches" else n < held):
                delete_folder(spark, f"{path}/{kind}/{name}={n}")
    return True


def newest_by(keys: tuple[str, ...]) -> Resolve:
    """Of the rows of each key the one of the latest batch."""
    def resolve(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys]
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(BATCH)).alias("newest"))
        return last.select(*keys, "newest.*")
    return resolve

