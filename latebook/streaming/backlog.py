"""Settlement of a backlog: large micro-batches joined as tables instead of row by row in a state store.

Both streams go through one query. Each micro-batch appends its events to a table and joins them: new
transactions with all payments so far, earlier transactions with new payments, and transactions whose
time to pay has ended with none. That reads the stored events once a batch, so it suits few large
batches; ``detail.settle_streams`` suits many small ones. Both follow the same watermark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latebook.streaming.detail import Bounds

KEY = "transaction_id"
KIND, TRANSACTION, PAYMENT = "_kind", "transaction", "payment"
TIMES = {TRANSACTION: "transaction_date", PAYMENT: "payment_date"}


def both_events(transactions: DataFrame, payments: DataFrame) -> DataFrame:
    """The events of both streams as one, told apart by ``KIND``."""
    return transactions.withColumn(KIND, F.lit(TRANSACTION)).unionByName(
        payments.withColumn(KIND, F.lit(PAYMENT)), allowMissingColumns=True)


def backlog_writer(spark: SparkSession, transactions: DataFrame, payments: DataFrame, path: str,
                   put: Callable[[DataFrame, int], None], bounds: Bounds,
                   how: str = "left_outer") -> Callable[[DataFrame, int], None]:
    """A batch function for ``both_events`` that keeps the events under ``path`` and hands the rows
    that a batch settles to ``put``, as ``settle_streams`` gives them.

    A batch that runs again replaces its own events and settles the same rows. ``spark`` plans the
    joins, with the caller's settings; a stream's own session has no adaptive execution.
    """
    columns = {TRANSACTION: transactions.columns, PAYMENT: payments.columns}
    schema = both_events(transactions, payments).schema

    def stored(batches: Sequence[int], kind: str) -> DataFrame:
        rows = spark.read.schema(schema).option("basePath", f"{path}/events").parquet(
            *[f"{path}/events/batch={n}" for n in batches]) if batches else spark.createDataFrame([], schema)
        return rows.filter(F.col(KIND) == kind).select(*columns[kind])

    def write(df: DataFrame, batch_id: int) -> None:
        before = _mark(spark, path, range(batch_id), bounds)
        if before is not None:
            df = df.filter(_time() > F.lit(before))
        mine = f"{path}/events/batch={batch_id}"
        df.write.mode("overwrite").partitionBy(KIND).parquet(mine)
        (spark.read.schema(schema).parquet(mine).groupBy(KIND).agg(F.max(_time()).alias("latest"))
         .coalesce(1).write.mode("overwrite").parquet(f"{path}/latest/batch={batch_id}"))
        old, new = range(batch_id), [batch_id]
        every = [*old, batch_id]
        rows = _pairs(stored(new, TRANSACTION), stored(every, PAYMENT), bounds)
        if batch_id:
            rows = rows.unionByName(_pairs(stored(old, TRANSACTION), stored(new, PAYMENT), bounds))
        after = _mark(spark, path, every, bounds)
        if how != "inner":
            rows = rows.filter(f"{TIMES[TRANSACTION]} is not null and {TIMES[PAYMENT]} is not null")
            if after is not None:
                ends = F.col(TIMES[TRANSACTION]) + _span(bounds.waits)
                closed = stored(every, TRANSACTION).filter(ends < F.lit(after))
                if before is not None:
                    closed = closed.filter(ends >= F.lit(before))
                rows = rows.unionByName(_unpaid(closed, stored(every, PAYMENT), bounds),
                                        allowMissingColumns=True)
        put(rows, batch_id)

    return write


def _time() -> Column:
    return F.coalesce(*TIMES.values())


def _span(text: str) -> Column:
    return F.expr(f"interval {text}")


def _mark(spark: SparkSession, path: str, batches: Sequence[int], bounds: Bounds) -> dt.datetime | None:
    """The watermark after the batches: the earlier of both streams' latest times, less the delay."""
    if not batches:
        return None
    files = [f"{path}/latest/batch={n}" for n in batches]
    latest = spark.read.schema(T.StructType([
        T.StructField(KIND, T.StringType()), T.StructField("latest", T.TimestampType())])).parquet(*files)
    ends = latest.groupBy(KIND).agg(F.max("latest").alias("latest")).filter("latest is not null")
    row = ends.agg(F.count("*").alias("n"), (F.min("latest") - _span(bounds.delay)).alias("mark")).first()
    return row["mark"] if row["n"] == len(TIMES) else None


def _allowed(bounds: Bounds, until: str | None) -> Column:
    """Whether the payment ``p`` lies within the bounds around the transaction ``t``."""
    when, paid = F.col(f"t.{TIMES[TRANSACTION]}"), F.col(f"p.{TIMES[PAYMENT]}")
    match = F.col(f"t.{KEY}") == F.col(f"p.{KEY}")
    if bounds.before is not None:
        match = match & (paid >= when - _span(bounds.before))
    return match if until is None else match & (paid <= when + _span(until))


def _pairs(transactions: DataFrame, payments: DataFrame, bounds: Bounds) -> DataFrame:
    """An inner join, whose skewed partitions Spark can split on either side."""
    joined = transactions.alias("t").join(payments.alias("p"), _allowed(bounds, bounds.within))
    return joined.select("t.*", *[F.col(f"p.{c}") for c in payments.columns if c != KEY])


def _unpaid(transactions: DataFrame, payments: DataFrame, bounds: Bounds) -> DataFrame:
    """Transactions without a payment up to the end of their time to pay; payments of one day and
    transaction are combined before the shuffle."""
    days = payments.select(KEY, TIMES[PAYMENT]).distinct()
    return transactions.alias("t").join(days.alias("p"), _allowed(bounds, bounds.waits), "left_anti")
