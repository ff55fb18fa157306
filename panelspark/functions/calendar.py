"""Days and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def age(born: Column, at: Column) -> Column:
    """Years between two days, as days over 365.25."""
    return F.datediff(at, born) / F.lit(365.25)


def placeholder_date(day: Column, month: int = 10, day_of_month: int = 15) -> Column:
    """Whether a date is the stand-in that sources give for an unknown one."""
    return (F.month(day) == month) & (F.dayofmonth(day) == day_of_month)


def marked_sunday(year: Column, month: int = 3, first: int = 11) -> Column:
    """The one Sunday among the seven days that begin with ``first``."""
    start = F.make_date(year.cast("int"), F.lit(month), F.lit(first))
    # dayofweek: 1 is Sunday.
    return F.date_add(start, (8 - F.dayofweek(start)) % 7)
