"""Adding months to the flights and features tables: only the months that can change are computed and written."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from departure_risk.config import HISTORY_DAYS
from departure_risk.plans.features import build_features
from departure_risk.sources.tables import read_by_month, replace_months


def first_day(month: str) -> dt.date:
    return dt.date.fromisoformat(f"{month}-01")


def last_day(month: str) -> dt.date:
    later = first_day(month) + dt.timedelta(days=31)
    return later.replace(day=1) - dt.timedelta(days=1)


def touched_spans(months: list[str], days: int = HISTORY_DAYS) -> list[tuple[dt.date, dt.date]]:
    """First and last days of the runs of whole months whose features change with the flights of `months`.

    A feature of a day looks at that day and the `days` before it, so a month changes itself and the months of the
    `days` days after it.
    """
    touched = set()
    for month in months:
        day = first_day(month)
        while day <= last_day(month) + dt.timedelta(days=days):
            touched.add(f"{day:%Y-%m}")
            day = last_day(f"{day:%Y-%m}") + dt.timedelta(days=1)
    spans: list[tuple[dt.date, dt.date]] = []
    for month in sorted(touched):
        if spans and first_day(month) - spans[-1][1] == dt.timedelta(days=1):
            spans[-1] = (spans[-1][0], last_day(month))
        else:
            spans.append((first_day(month), last_day(month)))
    return spans


def add_months(spark: SparkSession, flights: DataFrame, flights_path: str, weather: DataFrame | None, features_path: str) -> list[str]:
    """Put the months of `flights` (cleaned) in place in the flights table and bring the features table up to date.

    Each run of touched months reads its own flights and those of the days its histories look back on, and replaces its
    months of features. The tables then hold what a build from all files gives; months out of reach are not read or written.
    A step that is repeated, also after it stopped half-way, writes the same months again.
    """
    months, written = replace_months(flights, flights_path), []
    for first, last in touched_spans(months):
        around = read_by_month(spark, flights_path, first - dt.timedelta(days=HISTORY_DAYS), last)
        rows = build_features(around, weather).where(F.col("flight_date") >= F.lit(first))
        written += replace_months(rows, features_path)
    return written
