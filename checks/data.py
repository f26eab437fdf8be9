"""The test tables seen as flights, weather and requests."""

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from departure_risk.operators.clean import clean
from departure_risk.operators.forecast import base_rate_of_cells, route_forecast
from departure_risk.operators.history import HISTORIES
from departure_risk.operators.split import Split, find_split, label_split
from departure_risk.plans.features import build_features, stored_cells, with_histories
from departure_risk.session import written_once
from departure_risk.sources import adapters


class Data:
    """One folder of test tables. Everything is derived lazily from whole tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return adapters.table(self.spark, self.folder, name)

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def raw(self) -> DataFrame:
        return adapters.raw_from_orders(self.orders)

    @cached_property
    def flights(self) -> DataFrame:
        """Cleaned flights; the natural key is the id."""
        return clean(self.raw, flight_id=self.raw["flight_id"])

    @cached_property
    def weather(self) -> DataFrame:
        return adapters.weather_from_orders(self.orders)

    @cached_property
    def requests(self) -> DataFrame:
        return adapters.requests_from_orders(self.orders)

    @cached_property
    def stored(self) -> DataFrame:
        """Flights for queries that read them more than once: a projection of the orders, read again each time."""
        return self.flights

    @cached_property
    def cells(self) -> DataFrame:
        return stored_cells(self.stored)

    @cached_property
    def operated(self) -> DataFrame:
        return self.stored.filter("operated")

    @cached_property
    def features(self) -> DataFrame:
        return build_features(self.stored, self.weather, cells=self.cells)

    @cached_property
    def split(self) -> Split:
        return find_split(self.cells.filter("labelled > 0"))

    @cached_property
    def last_operated_day(self) -> dt.date:
        return self.cells.filter("labelled > 0").agg(F.max("flight_date")).first()[0]

    @cached_property
    def forecast(self) -> DataFrame:
        """Route-history forecasts of the validation and test period, written once."""
        histories = [h for h in HISTORIES if h.name in ("route", "origin")]
        later = label_split(self.operated, self.split).filter("split <> 'train'")
        rows = with_histories(later, histories, self.cells)
        return written_once(route_forecast(rows, base_rate_of_cells(self.cells, self.split)), "forecast")

    @cached_property
    def test(self) -> DataFrame:
        return self.forecast.filter("split = 'test'")
