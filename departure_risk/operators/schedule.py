"""Scheduled load at the origin, cancelled flights included."""

from pyspark.sql import DataFrame, Window, functions as F


def add_load(cells: DataFrame) -> DataFrame:
    """Scheduled flights at the origin that day, and in that hour.

    Sums over cells instead of counting flights in a window: a group holds the destinations, hours and
    carriers of one airport-day, however many flights those are. Both windows share one shuffle.
    """
    day = Window.partitionBy("origin", "flight_date")
    hour = Window.partitionBy("origin", "flight_date", "dep_hour")
    return cells.withColumns({
        "origin_day_flights": F.sum("scheduled").over(day),
        "origin_hour_flights": F.sum("scheduled").over(hour),
    })
