"""Amount bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from latebook.profiles import AMOUNT_BAND_TOP, AMOUNT_BANDS


def amount_band(amount: Column) -> Column:
    """The label of the first band whose upper limit the amount stays below."""
    expr = None
    for limit, label in AMOUNT_BANDS:
        expr = (F.when(amount < limit, label) if expr is None
                else expr.when(amount < limit, label))
    return expr.otherwise(AMOUNT_BAND_TOP)
