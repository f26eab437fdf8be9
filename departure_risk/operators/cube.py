"""Test-period forecasts counted by day, airport, carrier and part of the day."""

from pyspark.sql import DataFrame, Window, functions as F

from departure_risk.config import CUBE_AIRPORTS, DAY_PARTS, LABEL, OTHER_AIRPORTS
from departure_risk.functions.columns import day_part

DIMENSIONS = ["date", "origin", "carrier", "part"]


def busiest(rows: DataFrame, key: str, top: int | None) -> DataFrame:
    """The `top` most frequent values of `key`, or with None all of them, ties in key order."""
    counts = rows.groupBy(key).agg(F.count("*").alias("flights"))
    return counts if top is None else counts.orderBy(F.desc("flights"), key).limit(top)


def prediction_cube(scored: DataFrame, top: int = CUBE_AIRPORTS, score: str = "p", label: str = LABEL) -> DataFrame:
    """n, late and sum of probabilities per (day, airport or 'Other airports', carrier, part of day).

    Flights without a day, origin, carrier or hour have no place in the cube and are left out of it.
    """
    kept = busiest(scored, "origin", top).select("origin", F.lit(True).alias("kept"))
    named = scored.join(F.broadcast(kept), "origin", "left").select(
        F.date_format("flight_date", "yyyy-MM-dd").alias("date"),
        F.when(F.col("kept"), F.col("origin")).otherwise(OTHER_AIRPORTS).alias("origin"),
        "carrier",
        day_part(F.col("dep_hour")).alias("part"),
        F.col(label).alias("late"),
        F.col(score).alias("p"),
    )
    return named.dropna(subset=DIMENSIONS).groupBy(*DIMENSIONS).agg(
        F.count("*").alias("n"), F.sum("late").alias("late"), F.round(F.sum("p"), 2).alias("p"))


def dimension(cube: DataFrame, name: str) -> DataFrame:
    """The values of one dimension with their position, 'Other airports' last."""
    order = Window.orderBy(F.col("value") == OTHER_AIRPORTS, "value")
    values = cube.select(F.col(name).alias("value")).distinct()
    return values.select((F.row_number().over(order) - 1).alias("ix"), "value")


def encode_cube(cube: DataFrame) -> DataFrame:
    """Cube rows with day, airport and carrier replaced by their positions.

    Dimensions are bounded: test days, at most top+1 airports, carriers.
    """
    coded = cube
    for name in ("date", "origin", "carrier"):
        codes = dimension(cube, name).select(F.col("value").alias(name), F.col("ix").alias(f"{name}_ix"))
        coded = coded.join(F.broadcast(codes), name).drop(name)
    return coded.select("date_ix", "origin_ix", "carrier_ix", "part", "n", "late", "p")


def cube_document(cube: DataFrame) -> DataFrame:
    """The whole cube as one nested row for the results page.

    Its size is bounded by test days x (top + 1) x carriers x 4, not by flights.
    """
    cells = F.array(*[F.col(c).cast("double") for c in ("date_ix", "origin_ix", "carrier_ix", "part", "n", "late", "p")])
    document = encode_cube(cube).agg(F.sort_array(F.collect_list(cells)).alias("rows"))
    for name, plural in (("carrier", "carriers"), ("origin", "origins"), ("date", "dates")):
        values = dimension(cube, name).agg(F.sort_array(F.collect_list(F.struct("ix", "value"))).alias("pairs"))
        document = document.withColumn(plural, values.select(F.transform("pairs", lambda v: v["value"])).scalar())
    return document.select("dates", "origins", "carriers", F.array(*[F.lit(p) for p in DAY_PARTS]).alias("parts"), "rows")
