"""Refreshing the serving snapshot straight from flights, without the whole feature table."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from departure_risk.config import HISTORY_DAYS
from departure_risk.operators.history import add_histories
from departure_risk.operators.schedule import add_load
from departure_risk.operators.snapshot import snapshot
from departure_risk.plans.features import join_cells, stored_cells
from departure_risk.sources.tables import read_by_month


def last_operated_day(flights: DataFrame) -> dt.date:
    return flights.filter("operated").agg(F.max("flight_date")).first()[0]


def snapshot_of_table(spark: SparkSession, flights_path: str) -> DataFrame:
    """The same from the flights table written by month: only the months of those days are read."""
    last_day = last_operated_day(read_by_month(spark, flights_path))
    days = read_by_month(spark, flights_path, last_day - dt.timedelta(days=2 * HISTORY_DAYS), last_day)
    return fresh_snapshot(days, last_day)


def fresh_snapshot(flights: DataFrame, last_day: dt.date | None = None) -> DataFrame:
    """The snapshot of the last four weeks.

    Those flights and the four weeks before them are all it depends on; `snapshot_of_table` reads no other month. A
    snapshot holds neither rotation nor weather, so neither is computed.
    """
    last_day = last_day or last_operated_day(flights)
    days = F.lit(last_day - dt.timedelta(days=2 * HISTORY_DAYS))
    reach = flights.filter((F.col("flight_date") > days) & (F.col("flight_date") <= F.lit(last_day)))
    cells = stored_cells(reach)
    served = F.col("flight_date") > F.lit(last_day - dt.timedelta(days=HISTORY_DAYS))
    rows = join_cells(reach.filter("operated").filter(served), add_histories(cells, add_load(cells)).filter(served),
                      cells)
    return snapshot(rows, last_day)
