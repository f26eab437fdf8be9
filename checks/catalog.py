"""Every checked query: a Spark function over the test tables and, where SQL can say it, its SQL."""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from checks.data import Data
from checks.sql_parts import AUDIT_DAY, HISTORY_KEYS, SNAPSHOT_LAST, WEATHER_NAMES, with_parts
from departure_risk.config import CATEGORICAL, MODEL_COLUMNS, ROTATION, SNAPSHOT_MEDIANS, WEATHER, WEATHER_COLUMNS
from departure_risk.functions import columns as C
from departure_risk.operators import compare, cube as cubes, history, metrics, nearest
from departure_risk.operators.clean import clean
from departure_risk.operators.ids import dense_ids
from departure_risk.operators.recalibrate import daily_outcomes, daily_shift, recalibrate
from departure_risk.operators.rotation import add_rotation
from departure_risk.operators.schedule import add_load
from departure_risk.operators.split import label_split, only, split_summary
from departure_risk.operators.weather import add_weather
from departure_risk.plans import audits, models, questions
from departure_risk.plans.features import build_features, join_cells, with_histories
from departure_risk.plans.serving import fresh_snapshot
from departure_risk.session import written_once
from departure_risk.sources import adapters, forecasts, landing

BUILDS: dict[str, Callable[[Data], DataFrame]] = {}
SQL: dict[str, str] = {}

HISTORY = {h.name: h for h in history.HISTORIES}


def queries() -> dict[str, Callable]:
    """name -> function of (session, folder), each over tables of its own."""
    return {name: lambda spark, folder, build=build: build(Data(spark, folder)) for name, build in BUILDS.items()}


def check(name: str, needs: list[str] | None = None, sql: str | None = None):
    """Register a query and the SQL it must equal."""
    def keep(build: Callable[[Data], DataFrame]):
        BUILDS[name] = build
        if sql is not None:
            SQL[name] = with_parts(needs or [], sql)
        return build
    return keep


def rounded(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in names})


# --- Sources -------------------------------------------------------------------------------------------

@check("s1_raw_text", ["raw"], "SELECT * FROM raw")
def _(d):
    return d.raw


@check("s4_month_spine", [], """
    SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
    FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS m
          FROM orders)""")
def _(d):
    bounds = d.orders.agg(F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last"))
    return landing.months_between(bounds, "first", "last")


@check("s5_months_to_land", [], """
    SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
    FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS m
          FROM orders)
    WHERE m NOT IN (SELECT date_trunc('month', o_orderdate) FROM orders WHERE month(o_orderdate) <= 6)""")
def _(d):
    bounds = d.orders.agg(F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last"))
    files = d.orders.filter("month(o_orderdate) <= 6").select(
        F.concat(F.lit("raw/ontime_"), F.date_format("o_orderdate", "yyyy_MM"), F.lit(".csv")).alias("path"))
    landed = files.select(*landing.month_of(F.col("path"))).distinct()
    return landing.months_to_land(landing.months_between(bounds, "first", "last"), landed)


@check("s7_flights", ["flights"], "SELECT * FROM flights")
def _(d):
    return d.flights


@check("s8_no_weather", ["flights"], f"""
    SELECT flight_id, {", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in WEATHER)} FROM flights""")
def _(d):
    return add_weather(d.flights.select("flight_id"), None)


@check("s8_weather", ["weather"], "SELECT airport, date, round(precip_mm, 6) AS precip_mm, round(snow_cm, 6) AS snow_cm, "
       "round(gust_kmh, 6) AS gust_kmh, round(temp_min_c, 6) AS temp_min_c FROM weather")
def _(d):
    return rounded(d.weather, list(WEATHER_COLUMNS.values()))


@check("s9_features", ["features"], "SELECT * FROM features")
def _(d):
    return d.features


@check("s16_airport_coordinates", ["coordinates"], "SELECT * FROM coordinates")
def _(d):
    return forecasts.airport_coordinates(adapters.airports_from_suppliers(d.table("supplier")))


@check("s17_forecast_payloads", ["weather"], "SELECT airport, date, round(precip_mm, 6) AS precip_mm, "
       "round(snow_cm, 6) AS snow_cm, round(gust_kmh, 6) AS gust_kmh, round(temp_min_c, 6) AS temp_min_c FROM weather")
def _(d):
    return rounded(forecasts.parse_payloads(adapters.payloads_from_weather(d.weather)), list(WEATHER_COLUMNS.values()))


CACHE_DAYS = (dt.date(1996, 1, 10), dt.date(1997, 3, 5))


@check("s18_cached_weather", ["weather"], f"""
    SELECT airport, date, precip_mm FROM weather
    WHERE date BETWEEN DATE '{CACHE_DAYS[0]}' AND DATE '{CACHE_DAYS[1]}'
      AND (SELECT min(date) FROM weather) <= DATE '{CACHE_DAYS[0]}'
      AND (SELECT max(date) FROM weather) >= DATE '{CACHE_DAYS[1]}'""")
def _(d):
    return forecasts.usable_cache(d.weather, *CACHE_DAYS).select("airport", "date", "precip_mm")


@check("s19_named_table", ["flights"], """
    SELECT origin, dest, count(*) AS flights FROM flights GROUP BY origin, dest HAVING count(*) > 2""")
def _(d):
    questions.register(d.flights)
    return d.spark.sql(
        "SELECT origin, dest, count(*) AS flights FROM flights GROUP BY origin, dest HAVING count(*) > 2")


# --- Projections, filters, predicates --------------------------------------------------------------------

@check("p1_clean_columns", ["flights"], """
    SELECT flight_id, flight_date, carrier, origin, dest, tail, crs_elapsed, distance, operated FROM flights""")
def _(d):
    return d.flights.select("flight_id", "flight_date", "carrier", "origin", "dest", "tail", "crs_elapsed", "distance",
                            "operated")


@check("p2_blank_tail", ["raw"], """
    SELECT Origin AS origin, count(*) FILTER (WHERE nullif(trim(Tail_Number), '') IS NULL) AS without_tail
    FROM raw GROUP BY Origin""")
def _(d):
    return d.raw.groupBy(F.col("Origin").alias("origin")).agg(
        F.count_if(C.blank_to_null(F.col("Tail_Number")).isNull()).alias("without_tail"))


@check("p3_text_to_int", ["raw"], """
    SELECT flight_id, TRY_CAST(CRSDepTime AS INTEGER) AS plain, TRY_CAST(Distance AS INTEGER) AS with_point,
        TRY_CAST(concat(CRSDepTime, '.5') AS INTEGER) AS half, TRY_CAST(concat(CRSDepTime, 'd') AS INTEGER) AS suffixed,
        TRY_CAST(concat(' ', CRSArrTime, ' ') AS INTEGER) AS padded
    FROM raw WHERE CRSDepTime <> ''""")
def _(d):
    time, arrival = F.col("CRSDepTime"), F.col("CRSArrTime")
    return d.raw.filter(time != "").select(
        "flight_id", C.text_to_int(time).alias("plain"), C.text_to_int(F.col("Distance")).alias("with_point"),
        C.text_to_int(F.concat(time, F.lit(".5"))).alias("half"),
        C.text_to_int(F.concat(time, F.lit("d"))).alias("suffixed"),
        C.text_to_int(F.concat(F.lit(" "), arrival, F.lit(" "))).alias("padded"))


@check("p4_text_to_double", ["raw"], """
    SELECT flight_id, TRY_CAST(DepDelay AS DOUBLE) AS delay, TRY_CAST(CRSDepTime AS DOUBLE) AS departs,
        TRY_CAST(concat(Distance, 'd') AS DOUBLE) AS suffixed, TRY_CAST(Origin AS DOUBLE) AS no_number
    FROM raw""")
def _(d):
    return d.raw.select(
        "flight_id", C.text_to_double(F.col("DepDelay")).alias("delay"),
        C.text_to_double(F.col("CRSDepTime")).alias("departs"),
        C.text_to_double(F.concat("Distance", F.lit("d"))).alias("suffixed"),
        C.text_to_double(F.col("Origin")).alias("no_number"))


@check("p5_minutes", ["flights"], "SELECT flight_id, dep_min, arr_min FROM flights")
def _(d):
    return d.flights.select("flight_id", "dep_min", "arr_min")


@check("p6_departure_hour", ["flights"], "SELECT flight_id, dep_hour FROM flights")
def _(d):
    return d.flights.select("flight_id", "dep_hour")


@check("p7_operated", ["flights"], "SELECT flight_id, operated FROM flights")
def _(d):
    return d.flights.select("flight_id", "operated")


@check("p8_labels", ["flights"], "SELECT flight_id, dep_delay, delayed FROM flights")
def _(d):
    return d.flights.select("flight_id", "dep_delay", "delayed")


@check("p9_kept_rows", ["raw", "flights"], """
    SELECT (SELECT count(*) FROM raw) AS raw_rows, count(*) AS kept FROM flights""")
def _(d):
    kept = clean(d.raw).agg(F.count("*"))
    return d.raw.agg(F.count("*").alias("raw_rows")).withColumn("kept", kept.scalar())


@check("p10_operated_after_load", ["flights", "load"], """
    SELECT flight_id, CAST(origin_day_flights AS BIGINT) AS origin_day_flights
    FROM flights JOIN load USING (flight_id) WHERE operated""")
def _(d):
    return join_cells(d.operated, add_load(d.cells), d.cells).select("flight_id", "origin_day_flights")


@check("p11_flights_with_tail", ["flights"], "SELECT tail, count(*) AS flights FROM flights WHERE tail IS NOT NULL GROUP BY tail")
def _(d):
    return d.flights.filter(F.col("tail").isNotNull()).groupBy("tail").agg(F.count("*").alias("flights"))


@check("p12_national_days", ["h_nation_7d"], "SELECT flight_date, nation_7d_n FROM h_nation_7d")
def _(d):
    daily = history.daily_counts(d.cells, ())
    return history.trailing(daily, (), {"nation_7d": 7}).select("flight_date", "nation_7d_n")


@check("p13_typed_nulls", ["flights"], f"""
    SELECT count(*) AS flights, {", ".join(f"max(CAST(NULL AS DOUBLE)) AS {c}" for c in WEATHER)} FROM flights""")
def _(d):
    return add_weather(d.flights, None).agg(F.count("*").alias("flights"), *[F.max(c).alias(c) for c in WEATHER])


@check("p14_zero_guard", ["flights"], """
    SELECT origin, flight_date, sum(delayed) / nullif(count(delayed), 0) AS rate FROM flights GROUP BY ALL""")
def _(d):
    return d.flights.groupBy("origin", "flight_date").agg(C.ratio(F.sum("delayed"), F.count("delayed")).alias("rate"))


@check("p15_zero_default", ["h_route"], """
    SELECT origin, dest, count(*) AS days_without_past FROM h_route WHERE route_n = 0 AND route_rate IS NULL GROUP BY ALL""")
def _(d):
    return history.history_table(d.flights, HISTORY["route"]).filter("route_n = 0 AND route_rate IS NULL").groupBy(
        "origin", "dest").agg(F.count("*").alias("days_without_past"))


@check("p16_route_forecast", ["test"], "SELECT flight_id, round(p, 6) AS p FROM test")
def _(d):
    return rounded(d.test.select("flight_id", "p"), ["p"])


@check("p17_recent_days", ["flights"], """
    SELECT flight_id, flight_date FROM flights WHERE flight_date > (SELECT max(flight_date) FROM flights WHERE operated) - 28""")
def _(d):
    last = d.split.last
    return d.flights.filter(F.col("flight_date") > F.lit(last - dt.timedelta(days=28))).select("flight_id", "flight_date")


@check("p18_membership", ["flights", "coordinates"], """
    SELECT flight_id, dest FROM flights WHERE dest IN (SELECT airport FROM coordinates WHERE lat > 0)""")
def _(d):
    near = forecasts.airport_coordinates(adapters.airports_from_suppliers(d.table("supplier"))).filter("lat > 0")
    return d.flights.join(near.select(F.col("airport").alias("dest")), "dest", "left_semi").select("flight_id", "dest")


@check("p19_other_airports", ["cube"], "SELECT origin, CAST(sum(n) AS BIGINT) AS n FROM cube GROUP BY origin")
def _(d):
    return cubes.prediction_cube(d.test, top=4).groupBy("origin").agg(F.sum("n").alias("n"))


@check("p20_first_per_code", ["airports"], """
    SELECT iata_code, latitude_deg FROM airports QUALIFY row_number() OVER (PARTITION BY iata_code ORDER BY s_suppkey) = 1""")
def _(d):
    rows = adapters.airports_from_suppliers(d.table("supplier")).withColumn("type", F.lit("large_airport"))
    return forecasts.airport_coordinates(rows).select(F.col("airport").alias("iata_code"), F.col("lat").alias("latitude_deg"))


@check("p21_open_airports", ["airports"], """
    SELECT iata_code AS airport, count(*) AS rows FROM airports WHERE type IS DISTINCT FROM 'closed' GROUP BY iata_code""")
def _(d):
    rows = adapters.airports_from_suppliers(d.table("supplier"))
    return rows.filter(~F.col("type").eqNullSafe("closed")).groupBy(F.col("iata_code").alias("airport")).agg(
        F.count("*").alias("rows"))


@check("p24_log_odds", ["test"], """
    SELECT flight_id, round(ln(q / (1 - q)), 6) AS log_odds, round(1 / (1 + exp(-ln(q / (1 - q)))), 6) AS back
    FROM (SELECT flight_id, greatest(least(p, 1 - 1E-6), 1E-6) AS q FROM test)""")
def _(d):
    x = C.log_odds(F.col("p"))
    return d.test.select("flight_id", F.round(x, 6).alias("log_odds"), F.round(C.from_log_odds(x), 6).alias("back"))


@check("p25_route_lookup", ["requests", "snapshot"], """
    SELECT request_id, count(*) AS hours FROM requests r JOIN snapshot s
        ON s.carrier = r.carrier AND s.origin = r.origin AND s.dest = r.dest GROUP BY request_id""")
def _(d):
    hours = _snapshot(d).groupBy(*nearest.ROUTE).agg(F.count("*").alias("hours"))
    return d.requests.join(hours, nearest.ROUTE).select("request_id", "hours")


@check("p26_turnaround_guard", ["rotation"], """
    SELECT flight_id, turnaround_min FROM rotation WHERE turnaround_min IS NOT NULL""")
def _(d):
    return add_rotation(d.stored).select("flight_id", "turnaround_min").dropna()


@check("p27_request_status", ["matched"], "SELECT status, count(*) AS requests FROM matched GROUP BY status")
def _(d):
    return nearest.match_requests(d.requests, _snapshot(d)).groupBy("status").agg(F.count("*").alias("requests"))


# --- Joins -----------------------------------------------------------------------------------------------

for _i, (_name, (_keys, _days)) in enumerate(HISTORY_KEYS.items(), start=1):
    _on = " AND ".join([f"h.{k} = f.{k}" for k in _keys] + ["h.flight_date = f.flight_date"])

    @check(f"j{_i}_{_name}_on_flights", [f"h_{_name}"],
           f"SELECT f.flight_id, {_name}_rate, {_name}_n FROM flights f LEFT JOIN h_{_name} h ON {_on}")
    def _(d, name=_name):
        return with_histories(d.stored, [HISTORY[name]], d.cells).select("flight_id", f"{name}_rate", f"{name}_n")


@check("j8_rotation_on_flights", ["rotation"], """
    SELECT flight_id, tail, leg_number, legs_that_day, turnaround_min FROM flights LEFT JOIN rotation USING (flight_id)""")
def _(d):
    return add_rotation(d.stored).select("flight_id", "tail", *ROTATION)


@check("j8_rotation_in_pieces", ["rotation"], """
    SELECT flight_id, tail, leg_number, legs_that_day, turnaround_min FROM flights LEFT JOIN rotation USING (flight_id)""")
def _(d):
    """Every aircraft-day of more than one flight counts as too large for one task."""
    return add_rotation(d.flights, hot_rows=1).select("flight_id", "tail", *ROTATION)


@check("s9_features_of_hot_cells", ["features"], "SELECT * FROM features")
def _(d):
    """Every cell and aircraft-day of more than one flight goes the way of the very large ones."""
    return build_features(d.flights, d.weather, hot_rows=1, cells=d.cells)


for _i, _end in ((9, "origin"), (10, "dest")):
    _list = ", ".join(f"round({c}, 6) AS {_end}_{c}" for c in WEATHER_NAMES)

    @check(f"j{_i}_{_end}_weather", ["flights", "weather"],
           f"SELECT flight_id, {_list} FROM flights LEFT JOIN weather ON airport = {_end} AND date = flight_date")
    def _(d, end=_end):
        names = [f"{end}_{c}" for c in WEATHER_NAMES]
        return rounded(add_weather(d.flights, d.weather).select("flight_id", *names), names)


@check("j11_shift_on_flights", ["recalibrated"], "SELECT flight_id, round(shift, 6) AS shift FROM recalibrated")
def _(d):
    return rounded(recalibrate(d.forecast, d.split.test_start).select("flight_id", "shift"), ["shift"])


def _snapshot(d: Data) -> DataFrame:
    return fresh_snapshot(d.stored, d.last_operated_day)


@check("j12_nearest_hour", ["matched"], f"""
    SELECT request_id, matched_hour, {", ".join(f"round({c}, 6) AS {c}" for c in [*SNAPSHOT_MEDIANS, *SNAPSHOT_LAST])}
    FROM matched WHERE status = 'ok'""")
def _(d):
    names = [*SNAPSHOT_MEDIANS, *SNAPSHOT_LAST]
    found = nearest.match_requests(d.requests, _snapshot(d)).filter("status = 'ok'")
    return rounded(found.select("request_id", "matched_hour", *names), names)


@check("j13_without_history", ["matched"], "SELECT request_id, carrier, origin, dest FROM matched WHERE status = 'no_history'")
def _(d):
    found = nearest.match_requests(d.requests, _snapshot(d))
    return found.filter("status = 'no_history'").select("request_id", "carrier", "origin", "dest")


def _coordinates(d: Data) -> DataFrame:
    return forecasts.airport_coordinates(adapters.airports_from_suppliers(d.table("supplier")))


@check("j14_wanted_coordinates", ["coordinates", "flights"], """
    SELECT airport, lat, lon FROM coordinates
    WHERE airport IN (SELECT origin FROM flights GROUP BY origin ORDER BY count(*) DESC, origin LIMIT 4)""")
def _(d):
    return forecasts.airports_to_fetch(d.flights, _coordinates(d), None, top=4)


@check("j15_airports_not_cached", ["coordinates", "flights", "weather"], """
    SELECT airport, lat, lon FROM coordinates
    WHERE airport IN (SELECT origin FROM flights GROUP BY origin ORDER BY count(*) DESC, origin LIMIT 4)
      AND airport NOT IN (SELECT airport FROM weather WHERE airport IN ('A1', 'A4'))""")
def _(d):
    cached = d.weather.filter(F.col("airport").isin("A1", "A4"))
    return forecasts.airports_to_fetch(d.flights, _coordinates(d), cached, top=4)


@check("j16_in_top_origins", ["test", "top_test_origins"], """
    SELECT flight_id, origin IN (SELECT origin FROM top_test_origins) AS in_top FROM test""")
def _(d):
    top = cubes.busiest(d.test, "origin", 4).select("origin", F.lit(True).alias("in_top"))
    joined = d.test.join(F.broadcast(top), "origin", "left")
    return joined.select("flight_id", F.coalesce("in_top", F.lit(False)).alias("in_top"))


@check("j17_encoded_cube", ["cube"], """
    SELECT d.ix AS date_ix, o.ix AS origin_ix, c.ix AS carrier_ix, part, n, late, p
    FROM cube
    JOIN (SELECT date, CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS ix FROM (SELECT DISTINCT date FROM cube)) d USING (date)
    JOIN (SELECT origin, CAST(row_number() OVER (ORDER BY origin = 'Other airports', origin) - 1 AS INTEGER) AS ix
          FROM (SELECT DISTINCT origin FROM cube)) o USING (origin)
    JOIN (SELECT carrier, CAST(row_number() OVER (ORDER BY carrier) - 1 AS INTEGER) AS ix
          FROM (SELECT DISTINCT carrier FROM cube)) c USING (carrier)""")
def _(d):
    return cubes.encode_cube(written_once(cubes.prediction_cube(d.test, top=4), "cube"))


# --- Aggregations ------------------------------------------------------------------------------------------

for _name, _keys in (("origin", ["origin"]), ("carrier", ["carrier"]), ("route", ["origin", "dest"]),
                     ("origin_hour", ["origin", "dep_hour"]), ("nation", [])):
    _list = "".join(f"{k}, " for k in _keys)

    @check(f"a1_daily_{_name}", ["flights"], f"""
        SELECT {_list}flight_date, count(delayed) AS labelled, CAST(sum(delayed) AS BIGINT) AS late
        FROM flights GROUP BY {_list}flight_date""")
    def _(d, keys=tuple(_keys)):
        return history.daily_counts(history.daily_cells(d.flights), keys)


@check("a2_operated_count", ["flights"], "SELECT count(*) FILTER (WHERE operated) AS operated FROM flights")
def _(d):
    return d.flights.agg(F.count_if("operated").alias("operated"))


@check("a3_row_count", ["flights"], "SELECT count(*) AS rows FROM flights WHERE operated")
def _(d):
    return d.operated.agg(F.count("*").alias("rows"))


@check("a4_first_and_last_day", ["flights"], "SELECT min(flight_date) AS first_day, max(flight_date) AS last_day FROM flights")
def _(d):
    return d.flights.agg(F.min("flight_date").alias("first_day"), F.max("flight_date").alias("last_day"))


@check("a5_flights_per_origin", ["flights"], "SELECT origin, count(*) AS flights FROM flights GROUP BY origin")
def _(d):
    return forecasts.top_airports(d.flights, top=None)


@check("a6_prediction_cube", ["cube"], "SELECT * FROM cube")
def _(d):
    return cubes.prediction_cube(d.test, top=4)


@check("a7_test_frequencies", ["test"], "SELECT origin, count(*) AS flights FROM test GROUP BY origin")
def _(d):
    return cubes.busiest(d.test, "origin", None)


@check("a8_cube_dimensions", ["cube"], """
    SELECT 'origin' AS dimension, CAST(row_number() OVER (ORDER BY origin = 'Other airports', origin) - 1 AS INTEGER) AS ix,
        origin AS value FROM (SELECT DISTINCT origin FROM cube)
    UNION ALL
    SELECT 'carrier', CAST(row_number() OVER (ORDER BY carrier) - 1 AS INTEGER), carrier FROM (SELECT DISTINCT carrier FROM cube)""")
def _(d):
    cube = written_once(cubes.prediction_cube(d.test, top=4), "cube")
    parts = [cubes.dimension(cube, n).select(F.lit(n).alias("dimension"), "ix", "value") for n in ("origin", "carrier")]
    return parts[0].unionByName(parts[1])


@check("a9_categories", ["parts"], """
    SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY value) - 1 AS INTEGER) AS ix, value FROM (
        SELECT DISTINCT 'carrier' AS name, carrier AS value FROM parts WHERE split = 'train'
        UNION SELECT 'origin', origin FROM parts WHERE split = 'train'
        UNION SELECT 'dest', dest FROM parts WHERE split = 'train') WHERE value IS NOT NULL""")
def _(d):
    indexer = models.category_indexer(CATEGORICAL).fit(only(d.operated, d.split, "train"))
    labels = [(n, i, v) for n, values in zip(CATEGORICAL, indexer.labelsArray) for i, v in enumerate(values)]
    return d.spark.createDataFrame(labels, "name string, ix int, value string")


@check("a10_daily_outcomes", ["forecast"], """
    SELECT flight_date, CAST(sum(delayed) AS BIGINT) AS late, round(sum(p), 6) AS expected, count(*) AS flights
    FROM forecast GROUP BY flight_date""")
def _(d):
    return rounded(daily_outcomes(d.forecast), ["expected"])


SCORED = """(SELECT 'route_history' AS model, delayed, p FROM test
    UNION ALL SELECT 'route_history_recalibrated', delayed, p_recalibrated FROM recalibrated)"""

RANKED = f"""(SELECT model, p, late, on_time, sum(late) OVER down AS hits, sum(late + on_time) OVER down AS flagged,
        sum(late) OVER (PARTITION BY model) AS all_late, sum(on_time) OVER (PARTITION BY model) AS all_on_time
    FROM (SELECT model, p, sum(delayed) AS late, count(*) - sum(delayed) AS on_time FROM {SCORED} GROUP BY model, p)
    WINDOW down AS (PARTITION BY model ORDER BY p DESC))"""


def _both(d: Data) -> DataFrame:
    """Test forecasts of two models in one table."""
    columns = ["flight_id", "dep_hour", "delayed"]
    raw = d.test.select(*columns, "p", F.lit("route_history").alias("model"))
    again = recalibrate(d.forecast, d.split.test_start).select(
        *columns, F.col("p_recalibrated").alias("p"), F.lit("route_history_recalibrated").alias("model"))
    return raw.unionByName(again)


@check("a11_average_precision", ["test"], """
    SELECT round(sum(late / all_late * hits / flagged), 6) AS pr_auc
    FROM (SELECT late, sum(late) OVER () AS all_late, sum(late) OVER down AS hits, sum(late + on_time) OVER down AS flagged
          FROM (SELECT p, sum(delayed) AS late, count(*) - sum(delayed) AS on_time FROM test GROUP BY p)
          WINDOW down AS (ORDER BY p DESC))""")
def _(d):
    scored = d.test.select("delayed", "p", F.lit("route_history").alias("model"))
    return rounded(metrics.ranking_metrics(scored, ["model"]).select("pr_auc"), ["pr_auc"])


@check("a12_roc_auc", ["test"], """
    SELECT round(sum(on_time * (hits - late + late / 2)) / (CAST(max(all_late) AS DOUBLE) * max(all_on_time)), 6) AS roc_auc
    FROM (SELECT late, on_time, sum(late) OVER () AS all_late, sum(on_time) OVER () AS all_on_time,
              sum(late) OVER (ORDER BY p DESC) AS hits
          FROM (SELECT p, sum(delayed) AS late, count(*) - sum(delayed) AS on_time FROM test GROUP BY p))""")
def _(d):
    scored = d.test.select("delayed", "p", F.lit("route_history").alias("model"))
    return rounded(metrics.ranking_metrics(scored, ["model"]).select("roc_auc"), ["roc_auc"])


@check("a13_brier", ["test"], "SELECT round(avg((delayed - p) * (delayed - p)), 6) AS brier FROM test")
def _(d):
    scored = d.test.select("delayed", "p", F.lit("route_history").alias("model"))
    return rounded(metrics.ranking_metrics(scored, ["model"]).select("brier"), ["brier"])


@check("a14_calibration", ["test"], """
    SELECT CAST(greatest(below, 1) - 1 AS INTEGER) AS bin, round(avg(p), 4) AS predicted, round(avg(delayed), 4) AS observed,
        count(*) AS flights
    FROM (SELECT delayed, p, (SELECT count(DISTINCT edge) FROM (
            SELECT lo.p + (hi.p - lo.p) * (((n - 1) * k) % 10) / 10.0E0 AS edge
            FROM range(0, 11) AS steps(k), (SELECT count(*) AS n FROM test)
            JOIN (SELECT p, row_number() OVER (ORDER BY p) - 1 AS r FROM test) lo ON lo.r = ((n - 1) * k) // 10
            JOIN (SELECT p, row_number() OVER (ORDER BY p) - 1 AS r FROM test) hi
                ON hi.r = ((n - 1) * k) // 10 + CAST(((n - 1) * k) % 10 > 0 AS INTEGER)) WHERE edge < t.p) AS below
          FROM test t)
    GROUP BY ALL""")
def _(d):
    scored = d.test.select("delayed", "p", F.lit("route_history").alias("model"))
    return metrics.calibration_table(scored, ["model"]).drop("model")


@check("a15_by_hour", ["test"], """
    SELECT dep_hour, round(avg(delayed), 4) AS observed, round(avg(p), 4) AS predicted, count(*) AS flights
    FROM test GROUP BY dep_hour""")
def _(d):
    return metrics.by_hour(d.test)


@check("a16_overall_rates", ["parts", "recalibrated"], """
    SELECT (SELECT round(avg(delayed), 4) FROM parts WHERE split = 'train') AS train_rate, round(avg(delayed), 4) AS test_rate,
        round(avg(p), 4) AS mean_raw, round(avg(p_recalibrated), 4) AS mean_recalibrated FROM recalibrated""")
def _(d):
    train_rate = only(d.operated, d.split, "train").agg(F.round(F.avg("delayed"), 4).alias("train_rate"))
    rates = recalibrate(d.forecast, d.split.test_start).agg(
        F.round(F.avg("delayed"), 4).alias("test_rate"), F.round(F.avg("p"), 4).alias("mean_raw"),
        F.round(F.avg("p_recalibrated"), 4).alias("mean_recalibrated"))
    return rates.withColumn("train_rate", train_rate.scalar())


@check("a17_split_summary", ["parts"], """
    SELECT split, count(*) AS flights, min(flight_date) AS first_day, max(flight_date) AS last_day FROM parts GROUP BY split""")
def _(d):
    return split_summary(d.operated, d.split)


@check("a18_snapshot_aggregates", ["snapshot"], f"""
    SELECT carrier, origin, dest, dep_hour, {", ".join(f"round({c}, 6) AS {c}" for c in [*SNAPSHOT_MEDIANS, *SNAPSHOT_LAST])}
    FROM snapshot""")
def _(d):
    return rounded(_snapshot(d), [*SNAPSHOT_MEDIANS, *SNAPSHOT_LAST])


@check("a19_airports_covered", ["weather"], "SELECT count(DISTINCT airport) AS airports FROM weather")
def _(d):
    return forecasts.airports_covered(d.weather)


# --- Windows ------------------------------------------------------------------------------------------------

@check("w1_row_id", [], "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS flight_id FROM orders")
def _(d):
    return dense_ids(d.orders.select("o_orderkey"), ["o_orderkey"])


@check("w2_origin_day_flights", ["load"], "SELECT flight_id, origin_day_flights FROM load")
def _(d):
    return join_cells(d.stored, add_load(d.cells), d.cells).select("flight_id", "origin_day_flights")


@check("w3_origin_hour_flights", ["load"], "SELECT flight_id, origin_hour_flights FROM load")
def _(d):
    return join_cells(d.stored, add_load(d.cells), d.cells).select("flight_id", "origin_hour_flights")


for _i, _name in enumerate(HISTORY_KEYS, start=4):
    @check(f"w{_i}_{_name}_history", [f"h_{_name}"], f"SELECT * FROM h_{_name}")
    def _(d, name=_name):
        return history.history_table(d.flights, HISTORY[name])


@check("w11_leg_number", ["rotation"], "SELECT flight_id, leg_number FROM rotation")
def _(d):
    return add_rotation(d.stored).select("flight_id", "leg_number").dropna()


@check("w12_legs_that_day", ["rotation"], "SELECT flight_id, legs_that_day FROM rotation")
def _(d):
    return add_rotation(d.stored).select("flight_id", "legs_that_day").dropna()


@check("w13_turnaround", ["rotation"], "SELECT flight_id, turnaround_min FROM rotation")
def _(d):
    return add_rotation(d.stored).filter("tail IS NOT NULL").select("flight_id", "turnaround_min")


@check("w14_daily_shift", ["shifts"], "SELECT flight_date, round(shift, 6) AS shift FROM shifts")
def _(d):
    return rounded(daily_shift(d.forecast), ["shift"])


@check("w15_shifted_forecasts", ["recalibrated"], "SELECT flight_id, round(p_recalibrated, 6) AS p FROM recalibrated")
def _(d):
    shifted = recalibrate(d.forecast, d.split.test_start)
    return shifted.select("flight_id", F.round("p_recalibrated", 6).alias("p"))


# --- Sorts, limits, top-k -------------------------------------------------------------------------------------

@check("o1_top_origins", ["flights"], """
    SELECT origin, count(*) AS flights FROM flights GROUP BY origin ORDER BY flights DESC, origin LIMIT 60""")
def _(d):
    return forecasts.top_airports(d.flights)


@check("o2_top_test_origins", ["top_test_origins"], "SELECT * FROM top_test_origins")
def _(d):
    return cubes.busiest(d.test, "origin", 4)


@check("o3_capped_answer", ["flights"], """
    SELECT origin, flight_date, flights, truncated FROM (
        SELECT *, count(*) OVER () > 200 AS truncated, row_number() OVER (ORDER BY flights DESC, origin, flight_date) AS r
        FROM (SELECT origin, flight_date, count(*) AS flights FROM flights GROUP BY origin, flight_date)) WHERE r <= 200""")
def _(d):
    questions.register(d.flights)
    return questions.ask(d.spark, """SELECT origin, flight_date, count(*) AS flights FROM flights
        GROUP BY origin, flight_date ORDER BY flights DESC, origin, flight_date""")


@check("o5_last_known_rate", ["h_route"], """
    SELECT origin, dest, round(arg_max(route_rate, flight_date) FILTER (WHERE route_rate IS NOT NULL), 6) AS last_rate
    FROM h_route GROUP BY ALL""")
def _(d):
    rates = history.history_table(d.flights, HISTORY["route"])
    known = F.when(F.col("route_rate").isNotNull(), F.col("flight_date"))
    return rates.groupBy("origin", "dest").agg(F.round(F.max_by("route_rate", known), 6).alias("last_rate"))


@check("o6_nearest_hour_first", ["matched"], """
    SELECT abs(matched_hour - dep_hour) AS gap, count(*) AS requests FROM matched WHERE status = 'ok' GROUP BY 1""")
def _(d):
    found = nearest.match_requests(d.requests, _snapshot(d)).filter("status = 'ok'")
    return found.groupBy(F.abs(F.col("matched_hour") - F.col("dep_hour")).alias("gap")).agg(F.count("*").alias("requests"))


@check("o9_top_days", ["flights"], """
    SELECT flight_date, count(*) AS flights FROM flights GROUP BY flight_date ORDER BY 2 DESC, 1 LIMIT 10""")
def _(d):
    counts = d.flights.groupBy("flight_date").agg(F.count("*").alias("flights"))
    return counts.orderBy(F.desc("flights"), "flight_date").limit(10)


# --- Set operations --------------------------------------------------------------------------------------------

@check("u1_union_by_name", ["raw"], """
    SELECT flight_id, Origin, Dest, CASE WHEN FlightDate >= '1998-01-01' THEN Diverted END AS Diverted FROM raw""")
def _(d):
    """Older files lack a column and have another order."""
    old = d.raw.filter("FlightDate < '1998-01-01'").select("Dest", "flight_id", "Origin")
    new = d.raw.filter("FlightDate >= '1998-01-01'").select("flight_id", "Origin", "Dest", "Diverted")
    return new.unionByName(old, allowMissingColumns=True)


@check("u2_combined_weather", ["weather"], "SELECT airport, date, round(gust_kmh, 6) AS gust_kmh FROM weather")
def _(d):
    cached, fetched = d.weather.filter("airport < 'A3'"), d.weather.filter("airport >= 'A3'")
    both = forecasts.combine([cached, fetched.select(*reversed(fetched.columns))])
    return rounded(both.select("airport", "date", "gust_kmh"), ["gust_kmh"])


@check("u3_validation_and_test", ["forecast"], "SELECT flight_id, split, round(p, 6) AS p FROM forecast")
def _(d):
    return rounded(d.forecast.select("flight_id", "split", "p"), ["p"])


@check("u4_without_coordinates", ["flights", "coordinates"], """
    SELECT DISTINCT dest AS airport FROM flights EXCEPT SELECT airport FROM coordinates""")
def _(d):
    return forecasts.without_coordinates(d.flights.select(F.col("dest").alias("airport")), _coordinates(d))


# --- Scalar functions --------------------------------------------------------------------------------------------

@check("f1_calendar", ["flights"], """
    SELECT flight_id, CAST(isodow(flight_date) AS INTEGER) AS day_of_week, CAST(month(flight_date) AS INTEGER) AS month,
        dayname(flight_date) AS weekday, strftime(flight_date, '%Y-%m') AS label FROM flights""")
def _(d):
    day = F.col("flight_date")
    return d.flights.select("flight_id", C.iso_weekday(day).alias("day_of_week"), F.month(day).alias("month"),
                            C.weekday_name(day).alias("weekday"), C.month_label(day).alias("label"))


@check("f2_day_parts", ["flights"], """
    SELECT flight_id, CAST(CASE WHEN (dep_hour + 19) % 24 <= 5 THEN 0 WHEN (dep_hour + 19) % 24 <= 10 THEN 1
        WHEN (dep_hour + 19) % 24 <= 15 THEN 2 ELSE 3 END AS INTEGER) AS part FROM flights""")
def _(d):
    return d.flights.select("flight_id", C.day_part(F.col("dep_hour")).alias("part"))


# --- Modelling and evaluation -------------------------------------------------------------------------------------

@check("m1_time_split", ["parts"], "SELECT flight_id, split FROM parts")
def _(d):
    return label_split(d.operated, d.split).select("flight_id", "split")


@check("m2_baseline_scores", ["test"], """
    SELECT round(avg(p), 6) AS mean_forecast, round(avg(delayed), 6) AS late_rate, count(*) AS flights FROM test""")
def _(d):
    return d.test.agg(F.round(F.avg("p"), 6).alias("mean_forecast"), F.round(F.avg("delayed"), 6).alias("late_rate"),
                      F.count("*").alias("flights"))


@check("m7_recalibrated", ["recalibrated"], """
    SELECT flight_id, flight_date, round(p, 6) AS p, round(p_recalibrated, 6) AS p_recalibrated FROM recalibrated""")
def _(d):
    rows = recalibrate(d.forecast, d.split.test_start)
    return rounded(rows.select("flight_id", "flight_date", "p", "p_recalibrated"), ["p", "p_recalibrated"])


@check("m8_scores_by_model", ["recalibrated", "test"], f"""
    SELECT model, round(sum(late / all_late * hits / flagged), 6) AS pr_auc,
        round(sum(on_time * (hits - late + late / 2)) / (CAST(max(all_late) AS DOUBLE) * max(all_on_time)), 6) AS roc_auc,
        round(sum(late * (1 - p) * (1 - p) + on_time * p * p) / sum(late + on_time), 6) AS brier
    FROM {RANKED} GROUP BY model""")
def _(d):
    return rounded(metrics.ranking_metrics(_both(d), ["model"]), ["pr_auc", "roc_auc", "brier"])


@check("m11_serving_snapshot", ["snapshot"], f"""
    SELECT carrier, origin, dest, count(*) AS hours, round(max(route_rate), 6) AS route_rate FROM snapshot GROUP BY ALL""")
def _(d):
    return _snapshot(d).groupBy("carrier", "origin", "dest").agg(
        F.count("*").alias("hours"), F.round(F.max("route_rate"), 6).alias("route_rate"))


@check("m12_cube_totals", ["cube"], """
    SELECT date, CAST(sum(n) AS BIGINT) AS n, CAST(sum(late) AS BIGINT) AS late FROM cube GROUP BY date""")
def _(d):
    return cubes.prediction_cube(d.test, top=4).groupBy("date").agg(F.sum("n").alias("n"), F.sum("late").alias("late"))


@check("m10_request_matches", ["matched"], """
    SELECT request_id, status, round(route_rate, 4) AS route_history_rate, CASE WHEN status = 'ok' THEN
        CASE WHEN matched_hour = dep_hour THEN 'exact scheduled hour'
             ELSE 'nearest scheduled hour on this route used for history' END END AS note FROM matched""")
def _(d):
    found = nearest.match_requests(d.requests, _snapshot(d))
    return found.select("request_id", "status", F.round("route_rate", 4).alias("route_history_rate"), "note")


# --- Questions ------------------------------------------------------------------------------------------------------

def _question(name: str, build: Callable[[DataFrame], DataFrame], sql: str) -> None:
    check(name, ["flights"], sql)(lambda d: build(d.flights))


LATE = "round(100 * avg(delayed), 1) AS late_pct"
_question("q01_scheduled_flights", questions.scheduled_flights, "SELECT count(*) AS flights FROM flights")
_question("q02_late_percent", questions.late_percent, f"SELECT {LATE} FROM flights WHERE operated")
_question("q03_not_operated_percent", questions.not_operated_percent,
          "SELECT round(100 * avg(CASE WHEN operated THEN 0 ELSE 1 END), 1) AS not_operated_pct FROM flights")
_question("q04_worst_carrier", questions.worst_carrier,
          f"SELECT carrier, {LATE} FROM flights WHERE operated GROUP BY carrier ORDER BY avg(delayed) DESC, carrier LIMIT 1")
_question("q05_rate_by_carrier", questions.late_percent_by_carrier,
          f"SELECT carrier, {LATE} FROM flights WHERE operated GROUP BY carrier ORDER BY late_pct DESC, carrier")
_question("q06_busiest_origins", questions.busiest_origins,
          "SELECT origin, count(*) AS flights FROM flights GROUP BY origin ORDER BY flights DESC, origin LIMIT 3")
_question("q07_rate_from_origin", lambda f: questions.late_percent_from(f, "A1"),
          f"SELECT {LATE} FROM flights WHERE operated AND origin = 'A1'")
_question("q08_mean_delay_from_origin", lambda f: questions.mean_delay_from(f, "A4"),
          "SELECT round(avg(dep_delay), 1) AS mean_delay FROM flights WHERE operated AND origin = 'A4'")
_question("q09_rate_by_hour", questions.late_percent_by_hour,
          f"SELECT dep_hour, {LATE} FROM flights WHERE operated GROUP BY dep_hour ORDER BY dep_hour")
_question("q10_worst_weekday", questions.worst_weekday,
          f"SELECT dayname(flight_date) AS weekday, {LATE} FROM flights WHERE operated GROUP BY 1 "
          "ORDER BY avg(delayed) DESC, weekday LIMIT 1")
_question("q11_rate_by_month", questions.late_percent_by_month,
          f"SELECT strftime(flight_date, '%Y-%m') AS month, {LATE} FROM flights WHERE operated GROUP BY 1 ORDER BY 1")
_question("q12_busiest_route", questions.busiest_route,
          "SELECT origin, dest, count(*) AS flights FROM flights GROUP BY origin, dest ORDER BY flights DESC, origin, dest LIMIT 1")
_question("q13_operated_on_route", lambda f: questions.operated_on_route(f, "A1", "A3"),
          "SELECT count(*) AS flights FROM flights WHERE operated AND origin = 'A1' AND dest = 'A3'")
_question("q14_rate_evening", questions.late_percent_evening,
          f"SELECT dep_hour >= 17 AS evening, {LATE} FROM flights WHERE operated GROUP BY 1")
_question("q15_longest_flight", questions.longest_flight, "SELECT max(crs_elapsed) AS minutes FROM flights")


# --- Comparison and audits --------------------------------------------------------------------------------------------

@check("e1_normalised_rows", ["flights"], """
    SELECT list_aggregate(list_sort([carrier_cell, rate_cell]), 'string_agg', '|') AS cells, count(*) AS copies
    FROM (SELECT concat('''', carrier, '''') AS carrier_cell,
              CAST(round(100 * avg(delayed), 1) AS VARCHAR) AS rate_cell
          FROM flights WHERE operated GROUP BY carrier) GROUP BY cells""")
def _(d):
    rows = compare.normalised_rows(questions.late_percent_by_carrier(d.flights))
    return rows.groupBy(F.concat_ws("|", "cells").alias("cells")).agg(F.count("*").alias("copies"))


@check("e2_results_match", ["flights"], """
    SELECT 'same rows, other names and columns' AS "case", true AS match
    UNION ALL SELECT 'other rows', count(DISTINCT carrier) FILTER (WHERE carrier <> 'C1') = count(DISTINCT carrier) FROM flights""")
def _(d):
    expected = questions.late_percent_by_carrier(d.flights)
    wider = d.operated.groupBy(F.col("carrier").alias("airline")).agg(
        F.count("*").alias("flights"), (100 * F.avg("delayed")).alias("pct"))
    return d.spark.createDataFrame([
        ("same rows, other names and columns", compare.results_match(wider, expected)),
        ("other rows", compare.results_match(wider.filter("airline <> 'C1'"), expected)),
    ], "case string, match boolean")


@check("e3_answer_scores", ["flights"], """
    SELECT CAST(4 AS INTEGER) AS correct, CAST(5 AS INTEGER) AS total, 0.8::DOUBLE AS accuracy FROM flights LIMIT 1""")
def _(d):
    """Answers from DataFrames against answers from SQL over the same view, and one that must stay open."""
    questions.register(d.stored)
    late = "round(100 * avg(delayed), 1)"
    asked = [
        ("How many flights were scheduled?", questions.scheduled_flights(d.stored), "SELECT count(*) FROM flights"),
        ("Which share left late, by carrier?", questions.late_percent_by_carrier(d.stored),
         f"SELECT carrier, {late} FROM flights WHERE operated GROUP BY carrier"),
        ("And by hour?", questions.late_percent_by_hour(d.stored),
         f"SELECT dep_hour, {late} FROM flights WHERE operated GROUP BY dep_hour"),
        ("Which is the busiest route?", questions.busiest_origins(d.stored, 1),
         "SELECT origin, dest, count(*) FROM flights GROUP BY origin, dest ORDER BY 3 DESC, 1, 2 LIMIT 1"),
        ("Which pilots were late most often?", None, None),
    ]
    scores = compare.score_answers([(q, got, None if sql is None else d.spark.sql(sql)) for q, got, sql in asked])
    return d.spark.createDataFrame([(scores["correct"], scores["total"], scores["accuracy"])],
                                   "correct int, total int, accuracy double")


def _changed(prefix: str, kept: str = "true") -> str:
    """Feature rows of the audited day that are in one table only, counted over both directions."""
    names = ", ".join(["flight_id", *MODEL_COLUMNS])

    def one(later: int) -> str:
        of_day = kept if later == 0 else "true"
        before = f"SELECT {names} FROM features WHERE flight_date = {AUDIT_DAY} + {later} AND {of_day}"
        after = f"SELECT {names} FROM {prefix}features WHERE flight_date = {AUDIT_DAY} + {later}"
        return f"""SELECT {later} AS days_later, (SELECT count(*) FROM ({before} EXCEPT ALL {after}))
            + (SELECT count(*) FROM ({after} EXCEPT ALL {before})) AS changed"""

    return f"{one(0)} UNION ALL {one(1)}"


def _audited(d, audit) -> DataFrame:
    """Changed rows on the day itself (none may be) and on the day after it (some must be)."""
    day = d.split.valid_start
    parts = [audit(d.stored, d.weather, day, seen=day + dt.timedelta(days=later)).agg(F.count("*").alias("changed")).select(
        F.lit(later).alias("days_later"), "changed") for later in (0, 1)]
    return parts[0].unionByName(parts[1])


@check("l1_outcome_leaks", ["features", "flipped_features"], _changed("flipped_"))
def _(d):
    return _audited(d, audits.outcome_leaks)


@check("l2_cancellation_leaks", ["features", "thinned_features"], _changed("thinned_", "flight_id % 3 <> 0"))
def _(d):
    return _audited(d, audits.cancellation_leaks)


@check("l3_recalibration_leaks", ["recalibrated", "later_recalibrated", "split"], """
    SELECT a.flight_date > (SELECT test_start + 14 FROM split) AS after_the_day, count(*) AS changed
    FROM recalibrated a JOIN later_recalibrated b USING (flight_id)
    WHERE round(a.p_recalibrated, 9) <> round(b.p_recalibrated, 9) GROUP BY 1""")
def _(d):
    forecast = written_once(d.forecast.select("flight_id", "flight_date", "delayed", "p"), "forecast")
    return audits.recalibration_leaks(forecast, d.split.test_start, d.split.test_start + dt.timedelta(days=14))
