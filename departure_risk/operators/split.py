"""Split by calendar date: the past trains, later weeks validate and test."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from departure_risk.config import HISTORY_DAYS, MONTH

FEWEST_DAYS = 10


@dataclass(frozen=True)
class Split:
    """First day after the warm-up, first validation day, first test day, last day."""

    start: dt.date
    valid_start: dt.date
    test_start: dt.date
    last: dt.date


def find_split(rows: DataFrame, warm_up: int = HISTORY_DAYS, valid: float = 0.1, test: float = 0.2) -> Split:
    """Cut the distinct days present, after the warm-up, at the given shares.

    One aggregate over the date column. The dates come back as literals, so later filters prune
    partitions and reach the scan; a join would not.
    """
    days = rows.agg(F.sort_array(F.collect_set("flight_date")).alias("days"))
    kept = days.withColumn(
        "kept", F.filter("days", lambda d: d >= F.date_add(F.element_at("days", 1), warm_up)))
    n = F.size("kept")

    def day_at(share: float):
        return F.try_element_at("kept", F.floor(n * F.lit(share)).cast("int") + 1)

    row = kept.select(
        n.alias("n"),
        F.try_element_at("kept", F.lit(1)).alias("start"),
        day_at(1 - test - valid).alias("valid_start"),
        day_at(1 - test).alias("test_start"),
        F.try_element_at("kept", F.lit(-1)).alias("last"),
    ).first()
    if row.n < FEWEST_DAYS:
        raise ValueError(f"{max(row.n, 0)} days remain after the warm-up; a split takes {FEWEST_DAYS}")
    return Split(row.start, row.valid_start, row.test_start, row.last)


def label_split(rows: DataFrame, split: Split) -> DataFrame:
    """Drop the warm-up and add `split`: train, valid or test."""
    day = F.col("flight_date")
    name = F.when(day < F.lit(split.valid_start), "train").when(day < F.lit(split.test_start), "valid").otherwise("test")
    return rows.filter(day >= F.lit(split.start)).withColumn("split", name)


def only(rows: DataFrame, split: Split, name: str) -> DataFrame:
    """The rows of one part, as plain date bounds. If the rows have their month, it is bounded too, so files of other months stay closed."""
    first, end = {
        "train": (split.start, split.valid_start),
        "valid": (split.valid_start, split.test_start),
        "test": (split.test_start, None),
    }[name]
    day = F.col("flight_date")
    kept = rows.filter(day >= F.lit(first))
    if MONTH in rows.columns:
        kept = kept.filter(F.col(MONTH) >= f"{first:%Y-%m}")
    if end is None:
        return kept
    return kept.filter(day < F.lit(end)).filter(F.col(MONTH) <= f"{end:%Y-%m}") if MONTH in rows.columns else kept.filter(day < F.lit(end))


def split_summary(rows: DataFrame, split: Split) -> DataFrame:
    return label_split(rows, split).groupBy("split").agg(
        F.count("*").alias("flights"), F.min("flight_date").alias("first_day"), F.max("flight_date").alias("last_day"),
    )
