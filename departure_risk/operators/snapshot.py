"""Latest history and typical load per (carrier, origin, destination, hour), for scoring requests."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from departure_risk.config import HISTORY_DAYS, SNAPSHOT_KEYS, SNAPSHOT_LATEST, SNAPSHOT_MEDIANS


def snapshot(features: DataFrame, last_day: dt.date | None = None, days: int = HISTORY_DAYS) -> DataFrame:
    """Medians of distance, duration and load; last known value of every rate and count.

    Both are aggregates with map-side partials: a median's buffer is counts of distinct values. History
    columns depend on key and day only, so the last one is the same on every row of that day.
    """
    if last_day is None:
        last_day = features.agg(F.max("flight_date")).first()[0]
    recent = features.filter(F.col("flight_date") > F.lit(last_day - dt.timedelta(days=days)))
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("flight_date"))).alias(c) for c in SNAPSHOT_LATEST]
    return recent.dropna(subset=SNAPSHOT_KEYS).groupBy(*SNAPSHOT_KEYS).agg(
        *[F.median(c).alias(c) for c in SNAPSHOT_MEDIANS], *latest)
