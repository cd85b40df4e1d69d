"""Calendar keys and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(ts: Column) -> Column:
    """yyyyMMdd as INT, by arithmetic instead of text formatting."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def year_month(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


# Last hour of each band of the day, and the band's label.
TIME_BANDS = [(5, "madrugada"), (11, "mañana"), (14, "almuerzo"), (17, "tarde"), (22, "cena"), (23, "noche")]


def time_of_day(hour: Column) -> Column:
    label = F.lit(TIME_BANDS[-1][1])
    for last_hour, name in reversed(TIME_BANDS[:-1]):
        label = F.when(hour <= last_hour, F.lit(name)).otherwise(label)
    return label


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes, truncated toward zero."""
    return ((F.unix_timestamp(end) - F.unix_timestamp(start)) / 60).cast("int")
