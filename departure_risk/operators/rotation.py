"""Where a flight sits in its aircraft's scheduled day."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from departure_risk.operators.hot_groups import HOT_ROWS, set_apart
from departure_risk.operators.running import in_ranges

AIRCRAFT_DAY = ["tail", "flight_date"]
LONGEST_TURNAROUND = 720


def turnaround(previous_dest: Column, previous_arrival: Column) -> Column:
    """Planned minutes on the ground, when the previous leg ended here and the gap is believable."""
    gap = F.col("dep_min") - previous_arrival
    return F.when((previous_dest == F.col("origin")) & gap.between(0, LONGEST_TURNAROUND), gap)


def add_rotation(flights: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add leg_number, legs_that_day and turnaround_min; null for flights without a tail.

    One shuffle by aircraft and day. Flights without a tail must not meet in one group: each is its own
    group there. An aircraft-day above `hot_rows` flights (a placeholder tail) goes the piecewise way.
    """
    usual, hot = set_apart(flights, AIRCRAFT_DAY, hot_rows)
    placed = _in_one_window(usual)
    return placed if hot is None else placed.unionByName(_in_pieces(hot))


def _in_one_window(flights: DataFrame) -> DataFrame:
    known = F.col("tail").isNotNull()
    alone = F.when(~known, F.col("flight_id"))
    group = Window.partitionBy(*AIRCRAFT_DAY, alone)
    order = group.orderBy("dep_min", "flight_id")
    return flights.withColumns({
        "leg_number": F.when(known, F.row_number().over(order)),
        "legs_that_day": F.when(known, F.count("*").over(group)),
        "turnaround_min": F.when(known, turnaround(F.lag("dest").over(order), F.lag("arr_min").over(order))),
    })


def _in_pieces(flights: DataFrame) -> DataFrame:
    """The same columns when a group is too large for one task.

    Pieces are departure minutes, cut by ranges of the unique flight_id: some 1,440 times the number of
    ranges per aircraft-day at most, however many flights those hold. Positions inside a piece are shifted by the sizes of the pieces before it; the
    first flight of a piece looks back at the last flight of the piece before.
    """
    piece = [*AIRCRAFT_DAY, "dep_min", "id_range"]
    cut = in_ranges(flights, "flight_id", "id_range")
    before = Window.partitionBy(*AIRCRAFT_DAY).orderBy("dep_min", "id_range")
    pieces = (
        cut.groupBy(*piece)
        .agg(F.count("*").alias("size"), F.max_by(F.struct("dest", "arr_min"), "flight_id").alias("last"))
        .select(
            *piece,
            F.coalesce(F.sum("size").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
            F.sum("size").over(Window.partitionBy(*AIRCRAFT_DAY)).alias("legs_that_day"),
            F.lag("last").over(before).alias("piece_before"),
        )
    )
    inside = Window.partitionBy(*piece).orderBy("flight_id")
    placed = cut.withColumns({
        "place": F.row_number().over(inside),
        "previous": F.lag(F.struct("dest", "arr_min")).over(inside),
    }).join(pieces, piece)
    previous = F.coalesce(F.col("previous"), F.col("piece_before"))
    return placed.select(
        *[F.col(c) for c in flights.columns],
        (F.col("earlier") + F.col("place")).cast("int").alias("leg_number"),
        F.col("legs_that_day"),
        turnaround(previous["dest"], previous["arr_min"]).alias("turnaround_min"),
    )
