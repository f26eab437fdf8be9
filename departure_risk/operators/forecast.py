"""The baseline forecast: the route's own recent record."""

from pyspark.sql import DataFrame, functions as F

from departure_risk.config import LABEL
from departure_risk.operators.split import Split, only


def base_rate(rows: DataFrame, split: Split) -> float:
    """Late rate of the training period, one number."""
    return only(rows, split, "train").agg(F.avg(LABEL)).first()[0]


def base_rate_of_cells(cells: DataFrame, split: Split) -> float:
    """The same from daily cells, which are far fewer than flights."""
    return only(cells, split, "train").agg(F.sum("late") / F.sum("labelled")).first()[0]


def route_forecast(features: DataFrame, base: float, name: str = "p") -> DataFrame:
    """Route rate, else origin rate, else the base rate."""
    return features.withColumn(name, F.coalesce("route_rate", "origin_rate", F.lit(float(base))))
