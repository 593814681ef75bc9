"""Days late, open value, severity."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from latebook.functions.dates import day
from latebook.profiles import DEFAULT_STATUS, SEVERITY_BANDS, SEVERITY_NONE


def banded(value: Column, bands: Iterable[tuple[float, str]], below: str,
           inclusive: bool = False) -> Column:
    """The label of the first band (highest first) that ``value`` exceeds."""
    expr = None
    for limit, label in bands:
        hit = value >= limit if inclusive else value > limit
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr.otherwise(below)


def days_late(payment_date: Column, due: Column, as_of: dt.date | Column) -> Column:
    """Days from due date to payment, or to ``as_of`` while unpaid; early is negative."""
    return F.datediff(F.coalesce(payment_date.cast("date"), day(as_of)), due)


def days_late_clamped(payment_date: Column, status: Column, due: Column,
                      as_of: dt.date | Column) -> Column:
    """As ``days_late``, but only completed payments count, and never below zero."""
    paid_on = F.when(status == DEFAULT_STATUS, payment_date.cast("date"))
    return F.greatest(F.datediff(F.coalesce(paid_on, day(as_of)), due), F.lit(0))


def open_value(amount: Column, amount_paid: Column) -> Column:
    """What one payment row leaves open; all of the amount while unpaid."""
    return F.when(amount_paid.isNull(), amount).otherwise(amount - amount_paid)


def severity(max_days_late: Column) -> Column:
    return banded(max_days_late, SEVERITY_BANDS, SEVERITY_NONE)
