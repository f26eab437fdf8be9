"""Leakage audits: tamper with one day and see that nothing known the day before moves."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from departure_risk.config import HISTORY_DAYS, LABEL, MODEL_COLUMNS
from departure_risk.operators.compare import surplus
from departure_risk.operators.recalibrate import recalibrate
from departure_risk.plans.features import build_features


def flip_outcomes(rows: DataFrame, day: dt.date, label: str = LABEL) -> DataFrame:
    """Late flights of the day become on time and the other way round."""
    return rows.withColumn(label, F.when(F.col("flight_date") == F.lit(day), 1 - F.col(label)).otherwise(F.col(label)))


def cancel_some(flights: DataFrame, day: dt.date, every: int = 3) -> DataFrame:
    """Cancel the operated flights of the day whose id divides by `every`."""
    hit = cancelled_by(day, every)
    return flights.withColumns({
        "dep_delay": F.when(~hit, F.col("dep_delay")),
        "delayed": F.when(~hit, F.col("delayed")),
        "operated": F.col("operated") & ~hit,
    })


def cancelled_by(day: dt.date, every: int):
    on_day = F.coalesce(F.col("flight_date") == F.lit(day), F.lit(False))
    return on_day & F.col("operated") & (F.pmod(F.col("flight_id"), F.lit(every)) == 0)


def reach(flights: DataFrame, day: dt.date) -> DataFrame:
    """The days a feature of `day` can look at; nothing else needs reading."""
    return flights.filter(F.col("flight_date").between(F.lit(day - dt.timedelta(days=HISTORY_DAYS)), F.lit(day)))


def features_of(flights: DataFrame, weather: DataFrame | None, day: dt.date) -> DataFrame:
    rows = build_features(reach(flights, day), weather)
    return rows.filter(F.col("flight_date") == F.lit(day)).select("flight_id", *MODEL_COLUMNS)


def outcome_leaks(flights: DataFrame, weather: DataFrame | None, day: dt.date, seen: dt.date | None = None) -> DataFrame:
    """Feature rows of the day that change when its outcomes flip. Empty when nothing leaks.

    With a later day `seen`, the rows of that day: some must change, or the audit could not tell.
    """
    seen = seen or day
    return surplus(features_of(flights, weather, seen), features_of(flip_outcomes(flights, day), weather, seen))


def cancellation_leaks(flights: DataFrame, weather: DataFrame | None, day: dt.date, every: int = 3,
                       seen: dt.date | None = None) -> DataFrame:
    """Feature rows of the flights that still operate, changed by cancelling others on the day (`seen`: as above)."""
    seen = seen or day
    cancelled = reach(flights, day).filter(cancelled_by(day, every)).select("flight_id")
    before = features_of(flights, weather, seen).join(cancelled, "flight_id", "left_anti")
    return surplus(before, features_of(cancel_some(flights, day, every), weather, seen))


def recalibration_leaks(forecasts: DataFrame, score_from: dt.date, day: dt.date, key: str = "flight_id") -> DataFrame:
    """Per side of `day`, how many recalibrated forecasts change when the outcomes of the day flip.

    None up to and including the day; some after it.
    """
    columns = [key, "flight_date", F.round("p_recalibrated", 9).alias("p")]
    before = recalibrate(forecasts, score_from).select(*columns)
    after = recalibrate(flip_outcomes(forecasts, day), score_from).select(*columns)
    moved = surplus(before, after).filter("surplus > 0")
    return moved.groupBy((F.col("flight_date") > F.lit(day)).alias("after_the_day")).agg(F.count("*").alias("changed"))
