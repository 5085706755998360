"""Look-back joins: each event with the daily rows of the days before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOKBACK_DAYS = 10


def served_days(daily: DataFrame, day: str, event_day: str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Each daily row once per event day that looks back on it, with the offset."""
    offsets = F.sequence(F.lit(1), F.lit(days))
    return daily.select("*", F.explode(offsets).alias("days_before_review")).withColumn(
        event_day, F.date_add(F.col(day), F.col("days_before_review"))
    )


def lookback_bridge(events: DataFrame, daily: DataFrame, event_id: str, event_day: str, day: str) -> DataFrame:
    """One row per event and daily row of the days d-10 .. d-1.

    The daily side is what gets repeated (ten rows per day, a few thousand days), so
    the events are neither exploded nor compared with every day: it is one equi-join
    on the event day. Events of a single busy day are spread by the adaptive skew
    join when the daily table is too large to broadcast.
    """
    measures = [c for c in daily.columns if c != day]
    return (
        events.select(event_id, event_day)
        .join(served_days(daily, day, event_day), event_day)
        .select(event_id, day, "days_before_review", *measures)
    )


def lookback_means(daily: DataFrame, day: str, event_day: str, measures: list[str]) -> DataFrame:
    """Mean of each measure over the look-back window, per event day.

    Every event of one day sees the same window, so averaging per day and joining
    afterwards equals averaging the bridge per event, without building the bridge.
    """
    return served_days(daily, day, event_day).groupBy(event_day).agg(*[F.avg(m).alias(m) for m in measures])


def lookback_range(dates: DataFrame, day: str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """The range of days an external daily source must cover for these events."""
    return dates.agg(
        F.date_sub(F.min(day), days).alias("start_date"),
        F.max(day).alias("end_date"),
    )
