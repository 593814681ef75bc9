"""Upsert by key into a partitioned Parquet table of the catalog.

Beside the table lies an index of its keys: the hash of each key and the partitions it has lived
in, itself partitioned by the leading bits of the hash. A merge reads the parts of the index that
its keys fall into, and of the table only the partitions that these name. The index is only added
to, before the table changes, so it always names the right partition; one that a key has left
costs a rewrite and nothing else, until ``rebuild_index``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebook.operators.cleaning import dedupe
from latebook.sinks.tables import write_staged
from latebook.workspace import delete_folder, scratch, subfolders

#: Leading bits of a key's hash that make a partition of the index.
PREFIX_BITS = 8


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source does not have, plus all source rows.

    ``source`` must hold each key once. Spark broadcasts its keys if they are few by
    measured size, and splits skewed target partitions otherwise.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source, allowMissingColumns=True)


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}_keys"


def index_rows(rows: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """What the index holds of rows: ``key_hash``, ``home`` and ``prefix``."""
    of_key = F.xxhash64(*keys)
    return rows.select(of_key.alias("key_hash"), F.struct(*parts).alias("home"),
                       F.shiftrightunsigned(of_key, 64 - PREFIX_BITS).cast("int").alias("prefix"))


def rebuild_index(spark: SparkSession, table: str, keys: Sequence[str], parts: Sequence[str],
                  path: str) -> None:
    """Write the index of a table anew: one row for each key."""
    delete_folder(spark, index_path(path))
    (index_rows(spark.table(table), keys, parts).hint("rebalance", "prefix")
     .write.partitionBy("prefix").parquet(index_path(path)))


def known_homes(spark: SparkSession, mine: DataFrame, path: str) -> DataFrame:
    """The rows of the index that have the key hashes of ``mine``, read by their prefixes."""
    prefixes = [r["prefix"] for r in mine.select("prefix").distinct().collect()]  # few by design
    schema = T.StructType([f for f in mine.schema.fields])
    index = spark.read.schema(schema).parquet(index_path(path))
    return index.filter(F.col("prefix").isin(prefixes)).join(
        mine.select("prefix", "key_hash").distinct(), ["prefix", "key_hash"], "left_semi")


def affected_rows(target: DataFrame, touched: Sequence[Row]) -> DataFrame:
    """The rows of a table in the partitions that are named; a filter on partitions only."""
    return target.filter(reduce(lambda a, b: a | b, [_is_partition(r) for r in touched], F.lit(False)))


def upsert(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str],
           order_by: Sequence[str | Column], partition_by: Sequence[str], path: str,
           before_write: Callable[[list[Row]], None] | None = None) -> list[Row]:
    """Insert new keys, replace known ones, and rewrite only the partitions concerned.

    Those are the partitions the source writes to and the ones its keys lived in before; they
    are returned, and given to ``before_write`` before the table changes. The new partitions are
    staged in the shared folder first, because the table cannot be overwritten while it is read;
    a lost executor or a rerun starts from complete files.
    """
    parts = list(partition_by)
    with scratch(spark, "upsert") as folder:
        write_staged(dedupe(source, keys, order_by), f"{folder}/source")
        source = spark.read.schema(source.schema).parquet(f"{folder}/source")
        mine = index_rows(source, keys, parts)
        exists = spark.catalog.tableExists(table)
        if exists and not subfolders(spark, index_path(path)):
            rebuild_index(spark, table, keys, parts, path)
        known = known_homes(spark, mine, path) if exists else mine.limit(0)
        # One row per partition concerned: a subset of what the catalog itself lists.
        touched = [r["home"] for r in mine.select("home").union(known.select("home"))
                   .distinct().collect()]
        if not touched:
            return []
        (mine.join(known, ["prefix", "key_hash", "home"], "left_anti").select(*mine.columns)
         .hint("rebalance", "prefix").write.mode("append").partitionBy("prefix")
         .parquet(index_path(path)))
        if before_write is not None:
            before_write(touched)
        if not exists:
            (source.hint("rebalance", *parts).write.partitionBy(*parts).option("path", path)
             .saveAsTable(table))
            return touched
        target = spark.table(table)
        write_staged(merged(affected_rows(target, touched), source, keys).hint("rebalance", *parts),
                     f"{folder}/staged", parts)
        result = spark.read.schema(target.schema).parquet(f"{folder}/staged").select(*target.columns)
        filled = {tuple(r) for r in result.select(*parts).distinct().collect()}
        _overwrite_partitions(spark, table, result)
        for row in touched:
            if tuple(row) not in filled:
                spec = ", ".join(f"`{c}` = {_literal(row[c])}" for c in parts)
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    return touched


def _is_partition(row: Row) -> Column:
    return reduce(lambda a, b: a & b, [
        F.col(c).eqNullSafe(F.lit(v)) for c, v in row.asDict().items()])


def _overwrite_partitions(spark: SparkSession, table: str, rows: DataFrame) -> None:
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(name, before)


def _literal(value: object) -> str:
    if value is None:
        return "null"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "\\'") + "'"
