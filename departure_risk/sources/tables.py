"""Parquet tables and JSON documents of the flow."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.errors import AnalysisException

from departure_risk.config import MONTH
from departure_risk.functions.columns import month_label
from departure_risk.session import written_once

#: The partition column of the weather table.
PLACE = "place"


def write_by_month(rows: DataFrame, path: str, rebalance: bool = True) -> int:
    """Write a dated table partitioned by month and return its row count, counted while writing.

    Rebalancing gathers a month into few files and still splits a month too large for one task. A table
    that arrives month by month (cleaned monthly files) can skip that shuffle.
    """
    dated = rows.withColumn(MONTH, month_label(F.col("flight_date")))
    if rebalance:
        dated = dated.hint("rebalance", MONTH)
    # behind the last shuffle, so a row counts once also where a lost executor's work is done again
    written = Observation()
    dated.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").partitionBy(MONTH).parquet(path)
    return written.get["rows"]


def replace_months(rows: DataFrame, path: str) -> list[str]:
    """Write the months that `rows` hold in place of those of the table; returns them. Other months' files stay as they are.

    Rows without a day belong to no month and are left out.
    """
    dated = written_once(rows.where(F.col("flight_date").isNotNull()).withColumn(MONTH, month_label(F.col("flight_date"))), "months")
    dated.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    return sorted(r[0] for r in dated.select(MONTH).distinct().collect())


def read_by_month(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None,
                  keep_month: bool = False) -> DataFrame:
    """A table written by month; with a first or last day, only the months that hold such days are listed and read.

    With the month kept, later date bounds can prune months too (`operators.split.only` does).
    """
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.filter((F.col(MONTH) >= f"{first:%Y-%m}") & (F.col("flight_date") >= F.lit(first)))
    if last is not None:
        rows = rows.filter((F.col(MONTH) <= f"{last:%Y-%m}") & (F.col("flight_date") <= F.lit(last)))
    return rows if keep_month else rows.drop(MONTH)


def read_if_present(spark: SparkSession, path: str | None) -> DataFrame | None:
    """A Parquet table, or None when nothing was written there."""
    if path is None:
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def weather_place(airport: Column) -> Column:
    """The partition of an airport's weather; never read as a number."""
    return F.concat(F.lit("at-"), airport)


def read_weather(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The weather table, or None when nothing was written there."""
    weather = read_if_present(spark, path)
    return None if weather is None else weather.drop(PLACE)


def _by_airport(weather: DataFrame):
    return weather.withColumn(PLACE, weather_place(F.col("airport"))).hint("rebalance", PLACE).write.mode("overwrite").partitionBy(PLACE)


def write_weather(spark: SparkSession, weather: DataFrame | None, path: str) -> int:
    """Write weather by airport and return its row count; without any data, a table that was there before becomes empty.

    Cached rows come from the very table that is replaced, so the new table is written elsewhere first.
    """
    if weather is None or weather.isEmpty():
        if (before := read_weather(spark, path)) is not None:
            spark.createDataFrame([], before.schema).write.mode("overwrite").parquet(path)
        return 0
    stored = written_once(weather, "weather")
    _by_airport(stored).parquet(path)
    return stored.count()


def upsert_weather(spark: SparkSession, rows: DataFrame, path: str) -> list[str]:
    """Put `rows` (one per airport and day) in place of those of the same airport and day; returns the airports rewritten.

    Only the files of these airports are read and written. Rows without an airport are left out. A table that is not kept by
    airport yet is written anew. A step that is repeated, also after it stopped half-way, writes the same files again.
    """
    rows = written_once(rows.where("airport is not null"), "weather")
    airports = sorted(r[0] for r in rows.select("airport").distinct().collect())
    before = read_if_present(spark, path)
    if before is None or PLACE not in before.columns:
        others = None if before is None else before.join(rows, ["airport", "date"], "left_anti")
        write_weather(spark, rows if others is None else rows.unionByName(others, allowMissingColumns=True), path)
    elif airports:
        theirs = before.where(F.col(PLACE).isin([f"at-{a}" for a in airports])).drop(PLACE)
        kept = theirs.join(rows, ["airport", "date"], "left_anti")
        merged = written_once(rows.unionByName(kept, allowMissingColumns=True), "weather")
        _by_airport(merged).option("partitionOverwriteMode", "dynamic").parquet(path)
    return airports


def write_document(one_row: DataFrame, path: str) -> None:
    """A single-row JSON document."""
    one_row.coalesce(1).write.mode("overwrite").json(path)


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """A question set: question, sql, expect."""
    return spark.read.schema("question string, sql string, expect string").option("multiLine", True).json(path)
