"""Trailing delay histories from a daily pre-aggregate.

Flights are counted once into cells (day, carrier, origin, dest, hour). Partial aggregation makes that
shuffle one row per cell and task, so a hot airport or day costs no more than a quiet one. Every history
is rolled up from the cells, so windows see one row per key and day, never flights.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from departure_risk.config import CELL_KEYS, HISTORY_DAYS, LABEL, RECENT_DAYS
from departure_risk.functions.columns import day_number, ratio


@dataclass(frozen=True)
class History:
    """Late rate and labelled count of `keys` over the `days` before each day."""

    name: str
    keys: tuple[str, ...]
    days: int


HISTORIES = [
    History("origin", ("origin",), HISTORY_DAYS),
    History("carrier", ("carrier",), HISTORY_DAYS),
    History("route", ("origin", "dest"), HISTORY_DAYS),
    History("origin_hour", ("origin", "dep_hour"), HISTORY_DAYS),
    History("origin_7d", ("origin",), RECENT_DAYS),
    History("carrier_7d", ("carrier",), RECENT_DAYS),
    History("nation_7d", (), RECENT_DAYS),
]


def daily_cells(flights: DataFrame) -> DataFrame:
    """Finest daily counts: scheduled flights, labelled flights, late flights."""
    return flights.groupBy(*CELL_KEYS).agg(
        F.count("*").alias("scheduled"), F.count(LABEL).alias("labelled"), F.sum(LABEL).alias("late"),
    )


def daily_counts(cells: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Cells rolled up to one row per key and day."""
    return cells.groupBy(*keys, "flight_date").agg(
        F.sum("labelled").alias("labelled"), F.sum("late").alias("late"),
    )


def days_before(keys: tuple[str, ...], days: int) -> Window:
    """The frame of the calendar days D-days .. D-1 for a table with one row per key and day."""
    ordered = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return ordered.orderBy(day_number(F.col("flight_date"))).rangeBetween(-days, -1)


def trailing(daily: DataFrame, keys: tuple[str, ...], frames: dict[str, int]) -> DataFrame:
    """`{name}_rate` and `{name}_n` for each named frame length; all frames share one sort.

    A group holds one row per day, so its size is bounded by the calendar, also for the keyless total.
    """
    columns: list[Column] = []
    for name, days in frames.items():
        past = days_before(keys, days)
        columns += [
            ratio(F.sum("late").over(past), F.sum("labelled").over(past)).alias(f"{name}_rate"),
            F.coalesce(F.sum("labelled").over(past), F.lit(0)).alias(f"{name}_n"),
        ]
    return daily.select(*keys, "flight_date", *columns)


def key_sets(histories: list[History]) -> dict[tuple[str, ...], dict[str, int]]:
    """Histories grouped by key, so that each key is aggregated, sorted and joined once."""
    grouped: dict[tuple[str, ...], dict[str, int]] = {}
    for h in histories:
        grouped.setdefault(h.keys, {})[h.name] = h.days
    return grouped


def history_table(flights: DataFrame, history: History) -> DataFrame:
    """One history on its own: key, day, rate and count."""
    counts = flights.groupBy(*history.keys, "flight_date").agg(
        F.count(LABEL).alias("labelled"), F.sum(LABEL).alias("late"))
    return trailing(counts, history.keys, {history.name: history.days})


def add_histories(cells: DataFrame, rows: DataFrame, histories: list[History] = HISTORIES) -> DataFrame:
    """Left-join every history to `rows` (any frame holding the keys and flight_date).

    Equality joins: a null key finds nothing. The keyless total has one row per day and is broadcast; the
    others grow with airports and days, so the size threshold and adaptive execution choose.
    """
    for keys, frames in key_sets(histories).items():
        table = trailing(daily_counts(cells, keys), keys, frames)
        rows = rows.join(table if keys else F.broadcast(table), [*keys, "flight_date"], "left")
    return rows
