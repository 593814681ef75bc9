"""Writing tables. These functions trigger the write, unlike operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 10
BUCKET_COLUMNS = ("customer_id", "transaction_id")


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str],
                      mode: str = "overwrite", replace_partitions: bool = False) -> str:
    """Parquet partitioned by columns; ``replace_partitions`` leaves other partitions alone.

    The rebalance hint brings the rows of a partition together for few files, and lets
    Spark split a partition that holds a large share of all rows.
    """
    writer = df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "snappy").parquet(path)
    return path


def replace_slice(df: DataFrame, path: str, column: str, value: str,
                  partition_by: Sequence[str] = ()) -> str:
    """Replace one partition of a table as a whole, its inner partitions included.

    An inner partition that has no rows any more disappears, which an overwrite by the
    partitions of the new rows would leave behind.
    """
    rows = df.drop(column)
    writer = rows.hint("rebalance", *partition_by).write if partition_by else rows.write
    writer.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{column}={value}")
    return path


def write_plain(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    return path


def write_staged(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Parquet that is read once or twice and deleted; the denser codec halves texts of hashes."""
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return path


def bucket_column(columns: Sequence[str],
                  preferred: Sequence[str] = BUCKET_COLUMNS) -> str | None:
    """The first preferred bucket column that a table has."""
    return next((c for c in preferred if c in columns), None)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int = BUCKETS,
                   preferred: Sequence[str] = BUCKET_COLUMNS) -> str:
    """A catalog table bucketed for joins on its customer or transaction.

    A reader gets one task per bucket: choose the number by the table's size, and bucket
    by a column whose values are about equally frequent.
    """
    column = bucket_column(df.columns, preferred)
    if column is None:
        raise ValueError(f"none of {list(preferred)} is a column of the table")
    (df.write.mode("overwrite").bucketBy(buckets, column).sortBy(column)
       .option("path", path).saveAsTable(table))
    return table


def append_or_create(df: DataFrame, table: str, path: str,
                     partition_by: Sequence[str] = ()) -> str:
    """Append to a catalog table; create it on first use."""
    spark: SparkSession = df.sparkSession
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    if spark.catalog.tableExists(table):
        writer.mode("append").saveAsTable(table)
    else:
        writer.option("path", path).saveAsTable(table)
    return table


def append_process_log(logs: DataFrame, path: str, run: str) -> str:
    """Logs of one run, which owns its part of the table; written again they replace it."""
    logs.write.mode("overwrite").partitionBy("entity_name").parquet(f"{path}/run={run}")
    return path


def append_error_records(errors: DataFrame, path: str, owner: str) -> str:
    """Error records of one step of a run or batch, which owns its part of the table: a retry
    replaces what the failed attempt has left. Rows go to files where they are, so that what is
    observed about them is counted in the writing tasks."""
    (errors.write.mode("overwrite").partitionBy("entity_name", "error_type")
     .parquet(f"{path}/owner={owner}"))
    return path
