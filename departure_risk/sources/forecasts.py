"""Weather forecasts: which airports and days to ask for, and reading the answers."""

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from departure_risk.config import WEATHER_AIRPORTS, WEATHER_COLUMNS
from departure_risk.functions.columns import text_to_double

BATCH = 5
PAYLOAD = "array<struct<daily: struct<time: array<string>, {}>>>".format(
    ", ".join(f"{name}: array<string>" for name in WEATHER_COLUMNS))


def airport_coordinates(table: DataFrame) -> DataFrame:
    """Open airports as (airport, lat, lon); the first row of a code in file order wins."""
    rows = table.select("iata_code", "latitude_deg", "longitude_deg", "type", F.monotonically_increasing_id().alias("place"))
    still_open = rows.filter(~F.col("type").eqNullSafe("closed") & F.col("iata_code").isNotNull())
    first = still_open.groupBy(F.col("iata_code").alias("airport")).agg(
        F.min_by(F.struct("latitude_deg", "longitude_deg"), "place").alias("at"))
    return first.select("airport", F.col("at.latitude_deg").cast("double").alias("lat"),
                        F.col("at.longitude_deg").cast("double").alias("lon"))


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    return airport_coordinates(spark.read.option("header", True).option("escape", '"').csv(path))


def top_airports(flights: DataFrame, top: int | None = WEATHER_AIRPORTS) -> DataFrame:
    """The busiest origins, or with `top` None all of them, cancelled flights included, ties by code."""
    counts = flights.groupBy("origin").agg(F.count("*").alias("flights"))
    return counts if top is None else counts.orderBy(F.desc("flights"), "origin").limit(top)


def without_coordinates(codes: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Set difference: wanted airports nobody knows the place of."""
    return codes.select("airport").subtract(coordinates.select("airport"))


def usable_cache(cached: DataFrame | None, start: dt.date, end: dt.date) -> DataFrame | None:
    """The cached rows between start and end, or None unless the table as a whole covers both."""
    if cached is None:
        return None
    span = cached.agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
    if span.first is None or span.first > start or span.last < end:
        return None
    return cached.filter(F.col("date").between(F.lit(start), F.lit(end)))


def airports_to_fetch(flights: DataFrame, coordinates: DataFrame, cached: DataFrame | None,
                      top: int = WEATHER_AIRPORTS) -> DataFrame:
    """Top airports with known coordinates that the cache does not hold yet."""
    wanted = top_airports(flights, top).select(F.col("origin").alias("airport"))
    todo = coordinates.join(F.broadcast(wanted), "airport", "left_semi")
    return todo if cached is None else todo.join(cached.select("airport").distinct(), "airport", "left_anti")


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """Rows (airports array, payload text) to one row per airport and day.

    A payload is one object per airport asked for, or a bare object for a single one. A different number
    of objects is an error, and so is one without the days or a variable. The days count: a variable's values
    beyond them are ignored, and missing ones are null, as is a value that is no number. Entries without a
    readable day are left out.
    """
    text = F.trim("payload")
    as_list = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    items = payloads.select("airports", F.from_json(as_list, PAYLOAD).alias("items"))
    asked, got = F.size("airports"), F.coalesce(F.size("items"), F.lit(0))
    mismatch = F.raise_error(F.concat(
        F.lit("a payload of "), got.cast("string"), F.lit(" objects for "), asked.cast("string"), F.lit(" airports")))
    pairs = F.when(asked == got, F.arrays_zip("airports", "items")).otherwise(mismatch)
    per_airport = items.select(F.explode(pairs).alias("pair")).select(
        F.col("pair.airports").alias("airport"), F.col("pair.items.daily").alias("daily"))
    lacking = F.raise_error(F.concat(F.lit("incomplete weather for "), F.col("airport")))
    complete = F.lit(True)
    for name in ("time", *WEATHER_COLUMNS):
        complete = complete & F.col(f"daily.{name}").isNotNull()
    by_day = F.transform("daily.time", lambda day, i: F.struct(
        day.alias("time"), *[F.get(F.col(f"daily.{name}"), i).alias(name) for name in WEATHER_COLUMNS]))
    checked = F.when(complete, by_day).otherwise(lacking)
    days = per_airport.select("airport", F.explode(checked).alias("day"))
    return days.select(
        "airport", F.col("day.time").try_cast("date").alias("date"),
        *[text_to_double(F.col(f"day.{name}")).alias(column) for name, column in WEATHER_COLUMNS.items()],
    ).where("date is not null")


def add_fetched(cached: DataFrame | None, fetched: DataFrame | None) -> DataFrame | None:
    """The cache and the fetched airports it lacks, one row per airport and day; None when there is none at all.

    A day that the payloads hold twice keeps the row with values where the other has none, else the larger values.
    """
    if fetched is not None:
        values = F.max(F.struct(*WEATHER_COLUMNS.values())).alias("values")
        fetched = fetched.groupBy("airport", "date").agg(values).select("airport", "date", "values.*")
        if cached is not None:
            fetched = fetched.join(cached.select("airport").distinct(), "airport", "left_anti").select(*fetched.columns)
    return combine([cached, fetched])


def combine(parts: list[DataFrame | None]) -> DataFrame | None:
    """Cached and fetched weather by column name; None when there is none at all."""
    present = [p for p in parts if p is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present) if present else None


def airports_covered(weather: DataFrame) -> DataFrame:
    return weather.agg(F.count_distinct("airport").alias("airports"))
