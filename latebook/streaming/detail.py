"""Settlement of the transaction stream by the payment stream."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bounds:
    """How late events may arrive, and when a payment may come.

    A payment outside of [transaction - ``before``, transaction + ``within``] does not settle.
    None is no bound: payments that came early wait for their transaction, or transactions for
    later payments, for as long as the stream lives, once each. A bound lets the state forget
    them; choose at least the largest lateness threshold plus the payment term, or the stream
    misses delays that the batch rules see.

    A transaction without a payment comes out ``unpaid_after`` its date, ``within`` by default.
    With less, a payment may still follow it: ``batches.settlement_writer`` takes the unpaid row
    out of its table then, and ``current_rows`` leaves it out of the plain rows.

    ``salts`` is the number of tasks that share the payments of one transaction. The
    state keeps each transaction once per salt; 1 keeps it once and leaves a transaction
    with a large share of all payments to one task.
    """

    delay: str = "2 hours"
    within: str | None = "90 days"
    salts: int = 1
    before: str | None = "0 days"
    unpaid_after: str | None = None

    @property
    def waits(self) -> str:
        waits = self.unpaid_after or self.within
        if waits is None:
            raise ValueError("without a bound after the transaction, unpaid_after is needed")
        return waits


def _span(text: str, extra: str = "") -> Column:
    return F.expr(f"interval {text} {extra}")


def settle_streams(transactions: DataFrame, payments: DataFrame, bounds: Bounds = Bounds(),
                   how: str = "left_outer") -> DataFrame:
    """Join the streams on transaction id within the bounds.

    With ``left_outer``, unpaid transactions follow once the watermark has passed the end
    of their time to pay. The function works on batch tables alike.

    Payments up to ``unpaid_after`` settle in an outer join, whose transactions leave the state
    then, and later ones in an inner join, whose payments need not wait for transactions. So each
    event is kept once for long, in one of the two.
    """
    if bounds.salts == 1:
        if how == "inner":
            return _join(transactions, payments, bounds, bounds.within, how)
        prompt = _join(transactions, payments, bounds, bounds.waits, how)
        if bounds.waits == bounds.within:
            return prompt
        return prompt.unionByName(
            _join(transactions, payments, bounds, bounds.within, "inner", after=bounds.waits))
    salt = F.pmod(F.xxhash64("payment_id"), F.lit(bounds.salts)).cast("int")
    copies = F.explode(F.array(*[F.lit(i) for i in range(bounds.salts)]))
    paid = _join(transactions.withColumn("_salt", copies), payments.withColumn("_salt", salt),
                 bounds, bounds.within, "inner", ["_salt"]).drop("_salt")
    if how == "inner":
        return paid
    return paid.unionByName(unpaid_transactions(transactions, payments, bounds),
                            allowMissingColumns=True)


def current_rows(detail: DataFrame) -> DataFrame:
    """The stored rows without those of transactions that were unpaid at first and paid later."""
    paid = detail.filter("payment_id is not null")
    unpaid = detail.filter("payment_id is null").join(
        paid.select("transaction_id").distinct(), "transaction_id", "left_anti")
    return paid.unionByName(unpaid)


def _join(transactions: DataFrame, payments: DataFrame, bounds: Bounds, until: str | None,
          how: str, also_equal: Sequence[str] = (), after: str | None = None) -> DataFrame:
    """Payments from ``before``, or later than ``after``, up to ``until``."""
    left = transactions.withWatermark("transaction_date", bounds.delay).alias("t")
    right = payments.withWatermark("payment_date", bounds.delay).alias("p")
    when, paid = F.col("t.transaction_date"), F.col("p.payment_date")
    keys = ["transaction_id", *also_equal]
    match = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"p.{k}") for k in keys])
    if after is not None:
        match = match & (paid > when + _span(after))
    elif bounds.before is not None:
        match = match & (paid >= when - _span(bounds.before))
    if until is not None:
        match = match & (paid <= when + _span(until))
    return left.join(right, match, how).select(
        "t.*", *[F.col(f"p.{c}") for c in payments.columns if c not in keys])


def unpaid_transactions(transactions: DataFrame, payments: DataFrame,
                        bounds: Bounds) -> DataFrame:
    """Transactions without a payment from ``before`` to ``unpaid_after`` around them.

    They are joined to one marker per transaction and day of payment, which Spark combines
    before the shuffle. Some payment of the day is within the period exactly if the day's
    last one is not before its start and the day's first one is not after its end, since
    the period is longer than a day. A day is complete once the watermark has passed it,
    so the transactions come out a day later than the period ends.
    """
    left = transactions.withWatermark("transaction_date", bounds.delay).alias("t")
    markers = (payments.withWatermark("payment_date", bounds.delay)
               .groupBy(F.window("payment_date", "1 day"), "transaction_id")
               .agg(F.min("payment_date").alias("first"), F.max("payment_date").alias("last"))
               .select("transaction_id", "first", "last",
                       F.window_time("window").alias("marked_at"))).alias("m")
    end = F.col("t.transaction_date") + _span(bounds.waits)
    settled = ((F.col("t.transaction_id") == F.col("m.transaction_id"))
               & (F.col("m.marked_at") <= F.col("t.transaction_date")
                  + _span(bounds.waits, "1 day")) & (F.col("m.first") <= end))
    if bounds.before is not None:
        start = F.col("t.transaction_date") - _span(bounds.before)
        settled = settled & (F.col("m.marked_at") >= start) & (F.col("m.last") >= start)
    return left.join(markers, settled, "left_outer").filter("m.first is null").select("t.*")
