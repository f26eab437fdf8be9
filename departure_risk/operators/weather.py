"""Forecast weather at both ends of a flight."""

from pyspark.sql import DataFrame, functions as F

from departure_risk.config import WEATHER, WEATHER_COLUMNS


def add_weather(rows: DataFrame, weather: DataFrame | None) -> DataFrame:
    """Add origin_* and dest_* weather; typed nulls when there is no weather table.

    `rows` may be flights or, cheaper, one row per day and route. The table grows with airports and days,
    so no broadcast hint: the size threshold decides. Two rows of one airport and day would multiply flights and
    are an error.
    """
    if weather is None:
        return rows.withColumns({c: F.lit(None).cast("double") for c in WEATHER})
    twice = F.raise_error(F.concat(F.lit("more than one weather row for "), F.col("airport"), F.lit(" on "), F.col("date").cast("string")))
    names = list(WEATHER_COLUMNS.values())
    weather = weather.groupBy("airport", "date").agg(F.count("*").alias("rows"), *[F.any_value(c).alias(c) for c in names]).select(
        F.when(F.col("rows") > 1, twice).otherwise(F.col("airport")).alias("airport"), "date", *names)
    for end in ("origin", "dest"):
        there = weather.select(
            F.col("airport").alias(end), F.col("date").alias("flight_date"),
            *[F.col(c).alias(f"{end}_{c}") for c in WEATHER_COLUMNS.values()],
        )
        rows = rows.join(there, [end, "flight_date"], "left")
    return rows
