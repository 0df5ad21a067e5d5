"""Sums that don't depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(value: Column) -> Column:
    """The sum in steps of a millionth. Sums of doubles change with the order of rows, so with each shuffle."""
    return F.sum(value.cast("decimal(24,6)"))


def rounded(total: Column, places: int) -> Column:
    """An exact sum, rounded half away from zero, as a double."""
    return F.round(total, places).cast("double")
