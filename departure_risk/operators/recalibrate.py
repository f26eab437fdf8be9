"""Shift each day's probabilities so that recent forecasts match recent outcomes."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from departure_risk.config import LABEL, RECALIBRATION_DAYS
from departure_risk.functions.columns import from_log_odds, log_odds
from departure_risk.operators.history import days_before


def daily_outcomes(forecasts: DataFrame, score: str = "p", label: str = LABEL) -> DataFrame:
    return forecasts.groupBy("flight_date").agg(
        F.sum(label).alias("late"), F.sum(score).alias("expected"), F.count("*").alias("flights"))


def daily_shift(forecasts: DataFrame, days: int = RECALIBRATION_DAYS, score: str = "p", label: str = LABEL) -> DataFrame:
    """Per day: log-odds of the observed rate less log-odds of the mean forecast, over the days before.

    Zero when there is no past. The window runs over one row per day.
    """
    past = days_before((), days)
    flights = F.sum("flights").over(past)
    gap = log_odds(F.sum("late").over(past) / flights) - log_odds(F.sum("expected").over(past) / flights)
    return daily_outcomes(forecasts, score, label).select(
        "flight_date", F.coalesce(F.when(flights > 0, gap), F.lit(0.0)).alias("shift"))


def recalibrate(forecasts: DataFrame, score_from: dt.date, days: int = RECALIBRATION_DAYS, score: str = "p",
                label: str = LABEL, into: str = "p_recalibrated") -> DataFrame:
    """Rows from `score_from` on with the shifted probability. Earlier rows only supply the past.

    The order of flights within a day stays; only the level moves. The shift table holds one row per day,
    so its broadcast is bounded by the calendar.
    """
    shifts = daily_shift(forecasts, days, score, label).filter(F.col("flight_date") >= F.lit(score_from))
    rows = forecasts.filter(F.col("flight_date") >= F.lit(score_from))
    return rows.join(F.broadcast(shifts), "flight_date").withColumn(
        into, from_log_odds(log_odds(F.col(score)) + F.col("shift")))
