"""Batch scoring of scheduled flights against the serving snapshot."""

from pyspark.sql import DataFrame, functions as F

from departure_risk.config import ROTATION, WEATHER
from departure_risk.functions.columns import iso_weekday
from departure_risk.operators.nearest import FOUND, match_requests
from departure_risk.plans.models import BoostedModel, probability


def model_rows(requests: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Requests with everything a model reads; rotation and weather are not known and stay null."""
    return match_requests(requests, snapshot).withColumns({
        "day_of_week": iso_weekday(F.col("flight_date")),
        "month": F.month("flight_date"),
        **{c: F.lit(None).cast("double") for c in ROTATION + WEATHER},
    })


def score_requests(requests: DataFrame, snapshot: DataFrame, model: BoostedModel) -> DataFrame:
    """delay_probability, route_history_rate and note per request; status tells why one has none."""
    answered = F.col("status") == FOUND
    scored = probability(model, model_rows(requests, snapshot))
    return scored.select(
        *requests.columns,
        "status",
        F.when(answered, F.round("p", 4)).alias("delay_probability"),
        F.round("route_rate", 4).alias("route_history_rate"),
        "note",
    )
