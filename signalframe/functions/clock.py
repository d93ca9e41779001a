"""Time expressions: intervals, calendar parts, day periods, seasons."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalframe import config
from signalframe.functions.text import as_column


def interval_start(time: str | Column, width: str = "15 minutes") -> Column:
    """Start of the fixed-width interval a zone-less time falls into."""
    return F.window(as_column(time), width)["start"]


def epoch_seconds(time: str | Column) -> Column:
    """Whole seconds since 1970-01-01 of a zone-less time, whatever the session zone is."""
    time = as_column(time)
    days = F.unix_date(F.to_date(time)).cast("bigint")
    return days * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def calendar_columns(time: str | Column) -> dict[str, Column]:
    """Hour, weekday (Monday = 0), flags, month, day and the two daily/weekly cycles."""
    time = as_column(time)
    hour, weekday = F.hour(time), F.weekday(time)
    weekend = (weekday >= 5).cast("int")
    hour_sin, hour_cos = cycle(hour, 24)
    dow_sin, dow_cos = cycle(weekday, 7)
    return {
        "hour": hour,
        "day_of_week": weekday,
        "is_weekend": weekend,
        "is_business_hours": (hour.between(9, 17) & (weekend == 0)).cast("int"),
        "month": F.month(time),
        "day": F.dayofmonth(time),
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "day_of_week_sin": dow_sin,
        "day_of_week_cos": dow_cos,
    }


def model_time_columns(time: str | Column) -> dict[str, Column]:
    """Time features handed to the boosted-tree model."""
    time = as_column(time)
    hour, weekday, yearday = F.hour(time), F.weekday(time), F.dayofyear(time)
    hour_sin, hour_cos = cycle(hour, 24)
    year_sin, year_cos = cycle(yearday, 365)
    return {
        "hour": hour,
        "dayofweek": weekday,
        "month": F.month(time),
        "dayofyear": yearday,
        "is_weekend": (weekday >= 5).cast("int"),
        "quarter_of_day": F.floor(hour / 6).cast("int"),
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "day_of_year_sin": year_sin,
        "day_of_year_cos": year_cos,
    }


def day_period(
    hour: Column, periods: Mapping[str, tuple[int, int]] = config.DAY_PERIODS
) -> Column:
    """Name of the period an hour belongs to; a period may wrap past midnight."""
    expr = None
    for name, (start, end) in periods.items():
        inside = hour.between(start, end) if start <= end else (hour >= start) | (hour <= end)
        expr = F.when(inside, name) if expr is None else expr.when(inside, name)
    return F.when(hour.isNotNull(), expr.otherwise("Other"))


def season_code(time: str | Column) -> Column:
    """1 for Dec-Feb, 2 for Mar-May, 3 for Jun-Aug, 0 for Sep-Nov."""
    month = F.month(as_column(time))
    return (F.floor((month % 12 + 3) / 3) % 4).cast("int")


def season_name(code: Column) -> Column:
    expr = F.lit(None).cast("string")
    for value, name in config.SEASON_NAMES.items():
        expr = F.when(code == value, name).otherwise(expr)
    return expr


def width_seconds(width: str) -> int:
    number, unit = width.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
