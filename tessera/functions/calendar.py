"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """yyyyMMdd as int, by arithmetic so it stays inside generated code."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def season(day: Column) -> Column:
    """Meteorological season, northern hemisphere. Null dates fall to Autumn."""
    third = F.floor(F.pmod(F.month(day), F.lit(12)) / 3)
    return (
        F.when(third == 0, "Winter").when(third == 1, "Spring").when(third == 2, "Summer").otherwise("Autumn")
    )


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def calendar_columns(day: Column) -> dict[str, Column]:
    """The attributes of the date dimension; day_of_week counts from Sunday = 1."""
    return {
        "date_id": date_key(day),
        "year": F.year(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "day_of_week": F.dayofweek(day),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": is_weekend(day),
        "season": season(day),
    }
