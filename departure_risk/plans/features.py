"""The feature table: one row per operated flight, using only what is known the day before."""

from pyspark.sql import Column, DataFrame, functions as F

from departure_risk.config import CELL_KEYS, LOAD, ROTATION, WEATHER
from departure_risk.functions.columns import iso_weekday
from departure_risk.operators.history import HISTORIES, History, add_histories, daily_cells
from departure_risk.operators.hot_groups import HOT_ROWS, hottest
from departure_risk.operators.rotation import add_rotation
from departure_risk.operators.schedule import add_load
from departure_risk.operators.weather import add_weather
from departure_risk.session import written_once


def stored_cells(flights: DataFrame) -> DataFrame:
    """Daily cells, written once: every history would scan the flights again otherwise."""
    return written_once(daily_cells(flights), "daily-cells")


def cell_features(cells: DataFrame, weather: DataFrame | None, histories: list[History] = HISTORIES) -> DataFrame:
    """Everything a flight shares with the flights of its cell (day, carrier, origin, dest, hour).

    Load, histories and weather are attached to cells, not flights: the joins move counts and keys only.
    """
    return add_weather(add_histories(cells, add_load(cells), histories), weather).drop("scheduled", "labelled", "late")


def same_cell(left: str = "", right: str = "cell_") -> Column:
    """Carrier and day may be null and still find their cell; cleaning leaves no other key null."""
    match = F.lit(True)
    for key in CELL_KEYS:
        a, b = F.col(f"{left}{key}"), F.col(f"{right}{key}")
        match = match & (a.eqNullSafe(b) if key in ("carrier", "flight_date") else a == b)
    return match


def join_cells(flights: DataFrame, attached: DataFrame, cells: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Bring the columns `attached` to cells to the flights: the one join at flight grain.

    `cells` are the stored daily cells; they tell which cells hold more than `hot_rows` flights. Such
    cells, at most rows/hot_rows of them and the largest MOST_HOT, are broadcast, so their flights are not gathered in one task.
    """
    keyed = attached.select(*[F.col(k).alias(f"cell_{k}") for k in CELL_KEYS],
                            *[c for c in attached.columns if c not in CELL_KEYS])
    drop = [f"cell_{k}" for k in CELL_KEYS]
    hot = hottest(cells, "scheduled", hot_rows)
    if hot is None:
        return flights.join(keyed, same_cell(), "left").drop(*drop)
    hot = F.broadcast(hot.select(*[F.col(k).alias(f"hot_{k}") for k in CELL_KEYS]))
    usual = flights.join(hot, same_cell("", "hot_"), "left_anti").join(keyed, same_cell(), "left")
    few = F.broadcast(keyed.join(hot, same_cell("cell_", "hot_"), "left_semi"))
    return usual.unionByName(flights.join(few, same_cell())).drop(*drop)


def with_histories(flights: DataFrame, histories: list[History], cells: DataFrame | None = None) -> DataFrame:
    """Flights with some of the histories only."""
    cells = cells or stored_cells(flights)
    return join_cells(flights, add_histories(cells, cells.select(*CELL_KEYS), histories), cells)


def feature_columns(histories: list[History]) -> list[str]:
    keys = ["flight_id", "flight_date", "carrier", "origin", "dest", "dep_hour", "day_of_week", "month"]
    trend = [f"{h.name}_{m}" for h in histories for m in ("rate", "n")]
    return keys + ["distance", "crs_elapsed"] + LOAD + trend + ROTATION + WEATHER + ["dep_delay", "delayed"]


def build_features(flights: DataFrame, weather: DataFrame | None = None, histories: list[History] = HISTORIES,
                   hot_rows: int = HOT_ROWS, cells: DataFrame | None = None) -> DataFrame:
    """Feature table of the operated flights. `cells` are those of `flights`, when already at hand.

    Load and rotation are taken over the whole schedule first; the filter to operated flights comes after,
    because a cancellation is only known on the day.
    """
    cells = cells or stored_cells(flights)
    operated = add_rotation(flights, hot_rows).filter("operated")
    rows = join_cells(operated, cell_features(cells, weather, histories), cells, hot_rows)
    return rows.withColumns({
        "day_of_week": iso_weekday(F.col("flight_date")),
        "month": F.month("flight_date"),
    }).select(*feature_columns(histories))
