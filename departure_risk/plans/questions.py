"""Analytic questions over the flights table, and capped ad-hoc SQL."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from departure_risk.config import ANSWER_ROWS
from departure_risk.functions.columns import month_label, percent, weekday_name

VIEW = "flights"


def operated(flights: DataFrame) -> DataFrame:
    return flights.filter("operated")


def scheduled_flights(flights: DataFrame) -> DataFrame:
    return flights.agg(F.count("*").alias("flights"))


def late_percent(flights: DataFrame) -> DataFrame:
    return operated(flights).agg(percent(F.col("delayed")).alias("late_pct"))


def not_operated_percent(flights: DataFrame) -> DataFrame:
    return flights.agg(percent(F.when(F.col("operated"), 0).otherwise(1)).alias("not_operated_pct"))


def worst_carrier(flights: DataFrame) -> DataFrame:
    rates = operated(flights).groupBy("carrier").agg(F.avg("delayed").alias("rate"))
    top = rates.orderBy(F.desc("rate"), "carrier").limit(1)
    return top.select("carrier", F.round(100 * F.col("rate"), 1).alias("late_pct"))


def late_percent_by_carrier(flights: DataFrame) -> DataFrame:
    rates = operated(flights).groupBy("carrier").agg(percent(F.col("delayed")).alias("late_pct"))
    return rates.orderBy(F.desc("late_pct"), "carrier")


def busiest_origins(flights: DataFrame, top: int = 3) -> DataFrame:
    counts = flights.groupBy("origin").agg(F.count("*").alias("flights"))
    return counts.orderBy(F.desc("flights"), "origin").limit(top)


def late_percent_from(flights: DataFrame, origin: str = "BOS") -> DataFrame:
    return operated(flights).filter(F.col("origin") == origin).agg(percent(F.col("delayed")).alias("late_pct"))


def mean_delay_from(flights: DataFrame, origin: str = "ORD") -> DataFrame:
    return operated(flights).filter(F.col("origin") == origin).agg(F.round(F.avg("dep_delay"), 1).alias("mean_delay"))


def late_percent_by_hour(flights: DataFrame) -> DataFrame:
    rates = operated(flights).groupBy("dep_hour").agg(percent(F.col("delayed")).alias("late_pct"))
    return rates.orderBy("dep_hour")


def worst_weekday(flights: DataFrame) -> DataFrame:
    rates = operated(flights).groupBy(weekday_name(F.col("flight_date")).alias("weekday")).agg(F.avg("delayed").alias("rate"))
    top = rates.orderBy(F.desc("rate"), "weekday").limit(1)
    return top.select("weekday", F.round(100 * F.col("rate"), 1).alias("late_pct"))


def late_percent_by_month(flights: DataFrame) -> DataFrame:
    rates = operated(flights).groupBy(month_label(F.col("flight_date")).alias("month")).agg(
        percent(F.col("delayed")).alias("late_pct"))
    return rates.orderBy("month")


def busiest_route(flights: DataFrame) -> DataFrame:
    counts = flights.groupBy("origin", "dest").agg(F.count("*").alias("flights"))
    return counts.orderBy(F.desc("flights"), "origin", "dest").limit(1)


def operated_on_route(flights: DataFrame, origin: str = "BOS", dest: str = "LAX") -> DataFrame:
    on_route = operated(flights).filter((F.col("origin") == origin) & (F.col("dest") == dest))
    return on_route.agg(F.count("*").alias("flights"))


def late_percent_evening(flights: DataFrame, from_hour: int = 17) -> DataFrame:
    evening = (F.col("dep_hour") >= from_hour).alias("evening")
    return operated(flights).groupBy(evening).agg(percent(F.col("delayed")).alias("late_pct"))


def longest_flight(flights: DataFrame) -> DataFrame:
    return flights.agg(F.max("crs_elapsed").alias("minutes"))


# Answers in the order of the question set.
ANSWERS = [
    scheduled_flights, late_percent, not_operated_percent, worst_carrier, late_percent_by_carrier, busiest_origins,
    late_percent_from, mean_delay_from, late_percent_by_hour, worst_weekday, late_percent_by_month, busiest_route,
    operated_on_route, late_percent_evening, longest_flight,
]


def register(flights: DataFrame, name: str = VIEW) -> None:
    """Make the table known to `spark.sql` for this session."""
    flights.createOrReplaceTempView(name)


def capped(result: DataFrame, rows: int = ANSWER_ROWS) -> DataFrame:
    """At most `rows` rows in the order of `result`, with `truncated` telling whether more exist.

    One row more than the cap is enough to know, so the scan stops there.
    """
    head = result.limit(rows + 1).withColumn("place", F.monotonically_increasing_id())
    flagged = head.withColumn("truncated", F.count("*").over(Window.partitionBy()) > rows)
    return flagged.filter(F.col("place") < rows).drop("place")


def ask(spark: SparkSession, sql: str, rows: int = ANSWER_ROWS) -> DataFrame:
    """Run SQL over the registered view and cap the answer."""
    return capped(spark.sql(sql), rows)
