"""Queries over real files: the test tables are written out as CSV, archives, Parquet or JSON and read through the library."""

import io
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import functions as F

from checks.catalog import check, rounded
from checks.sql_parts import SNAPSHOT_LAST
from departure_risk.config import RAW_COLUMNS, SNAPSHOT_MEDIANS, WEATHER_COLUMNS
from departure_risk.operators.cube import prediction_cube
from departure_risk.plans import full_run, refresh
from departure_risk.plans.features import build_features
from departure_risk.plans.serving import snapshot_of_table
from departure_risk.session import shared_dir, written_once
from departure_risk.sources import adapters, artifacts, forecasts, landing, tables
from departure_risk.sources.csv_files import headers, list_files, read_raw

# An empty field of a CSV file is null.
_TEXT = ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_COLUMNS)
_WEATHER = ", ".join(f"round({c}, 6) AS {c}" for c in WEATHER_COLUMNS.values())


def _folder(d, name: str) -> str:
    return f"{shared_dir(d.spark).rstrip('/')}/check-{name}-{uuid.uuid4().hex}"


@check("s1_raw_csv", ["raw"], f"SELECT {_TEXT} FROM raw")
def _(d):
    """Two orders of columns, read by name."""
    folder, text = _folder(d, "csv"), d.raw.select("flight_id", *RAW_COLUMNS)
    for part, columns in enumerate((RAW_COLUMNS, RAW_COLUMNS[::-1])):
        text.filter(f"flight_id % 2 = {part}").select(*columns).write.option("header", True).csv(f"{folder}/{part}")
    return read_raw(d.spark, folder)


@check("s2_headers", [], f"""
    WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT strftime(day, '%Y-%m') AS month, count(*) AS files, count(*) FILTER (WHERE day(day) % 7 <> 3) AS complete,
        CAST({len(RAW_COLUMNS)} AS BIGINT) AS most_columns FROM days GROUP BY ALL""")
def _(d):
    """A file a day, some with columns the other way round and some without the last one; verdicts by month."""
    folder = _folder(d, "headers")
    of_day = [*RAW_COLUMNS], RAW_COLUMNS[::-1], RAW_COLUMNS[:-1]
    kind = F.when(F.expr("day(to_date(FlightDate)) % 7 = 3"), 2).otherwise(F.expr("day(to_date(FlightDate)) % 2"))
    text = d.raw.select(*RAW_COLUMNS).withColumns({"day": F.col("FlightDate"), "kind": kind})
    for part, columns in enumerate(of_day):
        text.where(F.col("kind") == part).select(*columns, "day").repartition(8, "day").write.option("header", True).partitionBy("day").csv(f"{folder}/{part}")
    found = headers(d.spark, list_files(d.spark, folder))
    rows = d.spark.createDataFrame([(p, list(c)) for p, c in found.items()], "path string, columns array<string>")
    of_file = rows.select(F.regexp_extract("path", r"day=(\d{4}-\d{2})", 1).alias("month"), F.size("columns").cast("long").alias("columns"),
                          (F.size(F.array_except(F.lit(RAW_COLUMNS), "columns")) == 0).alias("complete"))
    return of_file.groupBy("month").agg(F.count("*").alias("files"), F.count_if("complete").alias("complete"), F.max("columns").alias("most_columns"))


@check("s10_counts_while_writing", ["flights", "raw"], """
    SELECT (SELECT count(*) FROM raw) AS rows_read, (SELECT count(*) FROM raw WHERE flight_id % 11 = 0) AS malformed,
        count(*) AS kept, count(*) FILTER (WHERE operated) AS operated
    FROM flights WHERE flight_id % 11 <> 0""")
def _(d):
    """Every eleventh row has a field too many; all counts come from the pass that writes the table."""
    folder, path = _folder(d, "csv"), _folder(d, "flights")
    broken = F.when(F.col("flight_id") % 11 == 0, F.lit("N1,more")).otherwise(F.col("Tail_Number"))
    d.raw.withColumn("Tail_Number", broken).select(*RAW_COLUMNS).write.option("header", True).option("quote", "\u0000").csv(folder)
    counts = full_run.counted_clean_step(d.spark, folder, path)
    kept = tables.read_by_month(d.spark, path).count()
    if kept != counts["kept"]:
        raise ValueError(f"{counts['kept']} rows were counted and {kept} written")
    return d.spark.createDataFrame([counts], "rows_read long, malformed long, kept long, operated long")


@check("s3_listed_months", [], "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def _(d):
    folder = _folder(d, "listing")
    d.raw.withColumn("month", F.substring("FlightDate", 1, 7)).write.option("header", True).partitionBy("month").csv(folder)
    paths = d.spark.createDataFrame([(p,) for p in list_files(d.spark, folder)], "path string")
    return paths.select(F.regexp_extract("path", r"month=(\d{4}-\d{2})", 1).alias("month")).distinct()


@check("s6_landed_archives", ["raw"], f"SELECT {_TEXT} FROM raw")
def _(d):
    """One zip a month; landing unpacks them once, the second call finds nothing to do."""
    zips, raw = _folder(d, "zips"), _folder(d, "landed")

    def pack(month: pd.DataFrame) -> pd.DataFrame:
        label, data = month["month"].iloc[0], io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("lines.csv", month[RAW_COLUMNS].to_csv(index=False))
        store, path = fs.FileSystem.from_uri(f"{zips}/lines_{int(label[:4])}_{int(label[5:])}.zip")
        store.create_dir(path.rpartition("/")[0], recursive=True)
        with store.open_output_stream(path) as out:
            out.write(data.getvalue())
        return pd.DataFrame({"month": [label]})

    d.raw.withColumn("month", F.substring("FlightDate", 1, 7)).groupBy("month").applyInPandas(pack, "month string").count()
    landing.land(d.spark, zips, raw)
    if landing.land(d.spark, zips, raw):
        raise ValueError("a landed month was landed again")
    return read_raw(d.spark, raw)


@check("s7_flights_table", ["flights"], "SELECT * FROM flights")
def _(d):
    path = _folder(d, "flights")
    tables.write_by_month(d.flights, path)
    return tables.read_by_month(d.spark, path)


@check("s11_some_months", ["flights", "split"], """
    SELECT flights.* FROM flights, split WHERE flight_date BETWEEN valid_start AND test_start""")
def _(d):
    path = _folder(d, "flights")
    tables.write_by_month(d.flights, path)
    return tables.read_by_month(d.spark, path, d.split.valid_start, d.split.test_start)


@check("s9_features_table", ["features"], "SELECT * FROM features")
def _(d):
    path = _folder(d, "features")
    tables.write_by_month(d.features, path)
    return tables.read_by_month(d.spark, path)


@check("s11_added_months", ["features"], "SELECT * FROM features")
def _(d):
    """A table without the year 1996 and the days to be tested, to which both are then added."""
    flights, features = _folder(d, "flights"), _folder(d, "features")
    new = (F.year("flight_date") == 1996) | (F.date_trunc("month", "flight_date") >= F.date_trunc("month", F.lit(d.split.test_start)))
    first = d.flights.where(~new | F.col("flight_date").isNull())
    tables.write_by_month(first, flights)
    tables.write_by_month(build_features(tables.read_by_month(d.spark, flights), d.weather), features)
    refresh.add_months(d.spark, d.flights.where(new), flights, d.weather, features)
    return tables.read_by_month(d.spark, features)


@check("s12_weather_refresh", ["weather"], f"SELECT airport, date, {_WEATHER} FROM weather")
def _(d):
    """A cache of some airports and payloads that hold one of them again; the refresh runs twice."""
    path = _folder(d, "weather")
    payloads = adapters.payloads_from_weather(d.weather.filter("airport >= 'A2'"))
    tables.write_weather(d.spark, d.weather.filter("airport <= 'A2'"), path)
    for _ in range(2):
        cached = tables.read_weather(d.spark, path)
        tables.write_weather(d.spark, forecasts.add_fetched(cached, forecasts.parse_payloads(payloads)), path)
    return rounded(tables.read_weather(d.spark, path), list(WEATHER_COLUMNS.values()))


@check("s12_weather_upsert", ["weather"], f"""
    SELECT airport, date, {_WEATHER.replace("round(gust_kmh, 6)", "round(CASE WHEN airport IN ('A1', 'A4') AND day(date) > 9 THEN gust_kmh + 7 ELSE gust_kmh END, 6)")}
    FROM weather""")
def _(d):
    """Later days of two airports come again with other values, twice; one airport comes for the first time."""
    path = _folder(d, "weather")
    tables.write_weather(d.spark, d.weather.where("airport <> 'A4'"), path)
    again = d.weather.where("airport = 'A4' or airport = 'A1' and day(date) > 9").withColumn(
        "gust_kmh", F.expr("if(day(date) > 9, gust_kmh + 7, gust_kmh)"))
    for _ in range(2):
        tables.upsert_weather(d.spark, again, path)
    return rounded(tables.read_weather(d.spark, path), list(WEATHER_COLUMNS.values()))


@check("s12_weather_unusable", ["weather"], "SELECT count(*) - count(*) AS rows, count(DISTINCT airport) AS before FROM weather")
def _(d):
    """A table that no longer covers the days is empty afterwards."""
    path = _folder(d, "weather")
    tables.write_weather(d.spark, d.weather, path)
    before = tables.read_weather(d.spark, path).agg(F.count_distinct("airport").alias("before")).first()[0]
    tables.write_weather(d.spark, None, path)
    return d.spark.read.parquet(path).agg(F.count("*").alias("rows"), F.lit(before).cast("long").alias("before"))


@check("s13_snapshot_table", ["snapshot"], f"""
    SELECT carrier, origin, dest, dep_hour, {", ".join(f"round({c}, 6) AS {c}" for c in [*SNAPSHOT_MEDIANS, *SNAPSHOT_LAST])}
    FROM snapshot""")
def _(d):
    flights, path = _folder(d, "flights"), _folder(d, "snapshot")
    tables.write_by_month(d.flights, flights)
    snapshot_of_table(d.spark, flights).write.parquet(path)
    return rounded(d.spark.read.parquet(path), [*SNAPSHOT_MEDIANS, *SNAPSHOT_LAST])


@check("s14_published_results", ["cube", "snapshot"], """
    SELECT (SELECT count(*) FROM cube) AS cube_rows, (SELECT CAST(sum(n) AS BIGINT) FROM cube) AS flights,
        (SELECT count(*) FROM snapshot) AS snapshot_rows, CAST(2 AS BIGINT) AS number""")
def _(d):
    """A version without parts of the test period, one with all, and one that stopped half-way."""
    path, cube = _folder(d, "artifacts"), written_once(prediction_cube(d.test, top=4), "cube")
    flights = _folder(d, "flights")
    tables.write_by_month(d.flights, flights)
    for rows, done in ((cube.where("carrier = 'C1'"), True), (cube, True), (cube.limit(0), False)):
        folder = artifacts.new_version(path)
        rows.write.parquet(f"{folder}/cube")
        if done:
            snapshot_of_table(d.spark, flights).write.parquet(f"{folder}/snapshot")
            artifacts.publish(d.spark, path, folder)
    folder = artifacts.current(d.spark, path)
    read = d.spark.read.parquet(f"{folder}/cube").agg(F.count("*").alias("cube_rows"), F.sum("n").alias("flights"))
    return read.crossJoin(d.spark.read.parquet(f"{folder}/snapshot").agg(F.count("*").alias("snapshot_rows"))).crossJoin(
        artifacts.published(d.spark, path).agg(F.max("number").alias("number")))


@check("s20_question_set", [], """
    SELECT concat('What did customer ', CAST(c_custkey AS VARCHAR), ' order?') AS question,
        CASE WHEN c_custkey % 5 > 0 THEN concat('SELECT ', CAST(c_custkey AS VARCHAR)) END AS sql,
        CASE WHEN c_custkey % 5 = 0 THEN 'refuse' END AS expect
    FROM customer""")
def _(d):
    path = _folder(d, "questions")
    asked = d.table("customer").selectExpr(
        "concat('What did customer ', c_custkey, ' order?') AS question",
        "IF(c_custkey % 5 > 0, concat('SELECT ', c_custkey), NULL) AS sql", "IF(c_custkey % 5 = 0, 'refuse', NULL) AS expect")
    document = asked.agg(F.to_json(F.collect_list(F.struct("question", "sql", "expect"))).alias("value"))
    document.write.text(path)
    return tables.read_questions(d.spark, path)
