"""Joining transactions to the payments that settle them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latebook.functions import days_late, open_value

KEY = "transaction_id"


def settle(transactions: DataFrame, payments: DataFrame) -> DataFrame:
    """Left join of transactions to payments: one row per payment, unpaid kept.

    Written as an inner join plus the unpaid remainder. Spark can split a skewed payment
    partition in an inner join, but not on the right of a left join; the remainder is an
    anti join against distinct ids, which are combined before their shuffle. So a
    transaction that holds a large share of all payments does not end in one task.
    """
    paid = transactions.join(payments, KEY, "inner")
    paying = payments.select(KEY).distinct()
    unpaid = transactions.join(paying, KEY, "left_anti")
    return paid.unionByName(unpaid, allowMissingColumns=True)


def payments_by_transaction(payments: DataFrame) -> DataFrame:
    """One row per settled transaction: total, number and last day of its payments."""
    return payments.groupBy(KEY).agg(
        F.sum("amount_paid").alias("total_paid"),
        F.count(F.lit(1)).alias("payment_count"),
        F.max(F.col("payment_date").cast("date")).alias("last_payment_date"),
    )


def settlement_rows(transactions: DataFrame, payments: DataFrame,
                    as_of: dt.date | Column) -> DataFrame:
    """Joined rows with days late and open value, payments without a value left out.

    A transaction whose only payments are zero or negative thereby counts as unpaid.
    """
    payments = payments.filter(F.col("amount_paid") > 0).select(
        "payment_id", KEY, "amount_paid", "payment_date")
    transactions = transactions.select(
        KEY, "customer_id", "amount", "transaction_date", "due_date")
    return settle(transactions, payments).withColumns({
        "dias_atraso": days_late(F.col("payment_date"), F.col("due_date"), as_of),
        "valor_em_aberto": open_value(F.col("amount"), F.col("amount_paid")),
    })


def open_balance_rows(transactions: DataFrame, payments: DataFrame,
                      as_of: dt.date | Column) -> DataFrame:
    """One row per transaction: lateness of its last payment and what stays open.

    Payments are summed per transaction first, so split payments do not overstate the
    debt and the join is one to one.
    """
    paid = payments_by_transaction(payments.filter(F.col("amount_paid") > 0))
    transactions = transactions.select(
        KEY, "customer_id", "amount", "transaction_date", "due_date")
    balance = F.greatest(F.col("amount") - F.coalesce(F.col("total_paid"), F.lit(0.0)),
                         F.lit(0.0))
    return transactions.join(paid, KEY, "left").withColumns({
        "dias_atraso": days_late(F.col("last_payment_date"), F.col("due_date"), as_of),
        "valor_em_aberto": balance,
    })
