"""Dates: parsing, terms, parts, reference periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from latebook.profiles import PAYMENT_TERM_DAYS


def parse_timestamp(text: Column) -> Column:
    """Text to timestamp; null, not an error, where the text is no date."""
    return F.try_to_timestamp(text)


def due_date(text: Column, term_days: int = PAYMENT_TERM_DAYS) -> Column:
    """The day ``term_days`` after a date, given as text or as a date."""
    return F.date_add(text.try_cast("date"), term_days)


def date_parts(when: Column) -> dict[str, Column]:
    return {"year": F.year(when), "month": F.month(when), "day": F.dayofmonth(when)}


def reference_columns(as_of: Column) -> dict[str, Column]:
    """Date, month and quarter labels of the day an analysis refers to."""
    return {
        "reference_date": F.date_format(as_of, "yyyy-MM-dd"),
        "reference_month": F.date_format(as_of, "yyyy-MM"),
        "reference_quarter": F.concat(F.year(as_of).cast("string"), F.lit("-Q"),
                                      F.quarter(as_of).cast("string")),
    }


def analysis_window_columns(as_of: Column) -> dict[str, Column]:
    """The columns of ``AnalysisWindow`` when the execution day is itself a column."""
    reference = F.date_sub(F.trunc(as_of, "MM"), 1)
    return {
        "reference_date": reference,
        "three_months_ago": F.date_sub(reference, 90),
        "six_months_ago": F.date_sub(reference, 180),
        "execution_id": F.date_format(as_of, "yyyyMMdd_HHmmss"),
    }


def day(value: dt.date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
