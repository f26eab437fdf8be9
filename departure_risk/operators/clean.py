"""Raw text rows to typed scheduled flights. Cancelled flights stay, without a label."""

from pyspark.sql import Column, DataFrame, functions as F

from departure_risk.config import LATE_MINUTES
from departure_risk.functions.columns import (
    blank_to_null, hhmm_to_hour, hhmm_to_minutes, text_to_double, text_to_int,
)


def operated_flag(cancelled: Column, diverted: Column, delay: Column) -> Column:
    """True when neither cancelled nor diverted and a delay is known. Never null."""
    zero = F.lit(0.0)
    return (F.coalesce(cancelled, F.lit(1.0)) == zero) & (F.coalesce(diverted, F.lit(1.0)) == zero) & delay.isNotNull()


def clean(raw: DataFrame, flight_id: Column | None = None, late_minutes: float = LATE_MINUTES) -> DataFrame:
    """One row per scheduled flight with a readable departure time, origin and destination.

    A narrow projection: no shuffle. `flight_id` defaults to Spark's increasing id, which follows scan
    order and needs no global sort; `operators.ids.dense_ids` numbers rows 1..n where that matters.
    """
    departure = text_to_int(F.col("CRSDepTime"))
    delay = text_to_double(F.col("DepDelay"))
    operated = operated_flag(text_to_double(F.col("Cancelled")), text_to_double(F.col("Diverted")), delay)
    parsed = (
        raw.withColumns({"departure": departure, "arrival": text_to_int(F.col("CRSArrTime")),
                         "delay": delay, "operated": operated})
        .filter(F.col("departure").isNotNull() & F.col("Origin").isNotNull() & F.col("Dest").isNotNull())
    )
    identity = flight_id if flight_id is not None else F.monotonically_increasing_id() + 1
    label = (F.col("delay") >= late_minutes).cast("int")
    return parsed.select(
        identity.cast("long").alias("flight_id"),
        F.col("FlightDate").cast("date").alias("flight_date"),
        F.col("Reporting_Airline").alias("carrier"),
        F.col("Origin").alias("origin"),
        F.col("Dest").alias("dest"),
        blank_to_null(F.col("Tail_Number")).alias("tail"),
        hhmm_to_minutes(F.col("departure")).alias("dep_min"),
        hhmm_to_minutes(F.col("arrival")).alias("arr_min"),
        hhmm_to_hour(F.col("departure")).alias("dep_hour"),
        text_to_double(F.col("CRSElapsedTime")).alias("crs_elapsed"),
        text_to_double(F.col("Distance")).alias("distance"),
        F.col("operated"),
        F.when(F.col("operated"), F.col("delay")).alias("dep_delay"),
        F.when(F.col("operated"), label).alias("delayed"),
    )
