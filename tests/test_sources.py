import datetime as dt
import json
import tracemalloc
import zipfile

import pytest
from pyspark.sql import functions as F

from departure_risk.config import RAW_COLUMNS
from departure_risk.operators.clean import clean
from departure_risk.operators.weather import add_weather
from departure_risk.plans import full_run
from departure_risk.plans.serving import fresh_snapshot, snapshot_of_table
from departure_risk.sources import csv_files, forecasts, landing, stores, tables
from departure_risk.sources.csv_files import read_raw


def test_months_cross_the_year(spark):
    months = [tuple(r) for r in landing.month_spine(spark, "2024-11", "2025-02").orderBy("year", "month").collect()]
    assert months == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]
    with pytest.raises(ValueError, match="no months run from 2025-03"):
        landing.month_spine(spark, "2025-03", "2025-01")
    same = spark.sql("SELECT date'2025-03-15' AS a, date'2025-03-02' AS b")
    assert [tuple(r) for r in landing.months_between(same, "a", "b").collect()] == [(2025, 3)]
    bounds = spark.sql("SELECT date'2025-03-02' AS a, date'2025-01-01' AS b")
    with pytest.raises(Exception, match="no months run from 2025-03 to 2025-01"):
        landing.months_between(bounds, "a", "b").collect()


def archive(folder, year, month, *files):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / f"On_Time_1987_present_{year}_{month}.zip", "w") as z:
        for name, text in files:
            z.writestr(name, text)


def month_csv(year, month, rows):
    values = {c: "1" for c in RAW_COLUMNS} | {"FlightDate": f"{year}-{month:02d}-03", "Cancelled": "0", "Diverted": "0"}
    lines = [",".join(RAW_COLUMNS)] + [",".join((values | {"Tail_Number": f"N{i}"})[c] for c in RAW_COLUMNS) for i in range(rows)]
    return "\r\n".join(lines) + "\r\n"


def test_archives_land_once_and_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "LINES_PER_BATCH", 7)
    zips, raw = tmp_path / "zips", tmp_path / "raw"
    archive(zips, 2024, 12, ("a.csv", month_csv(2024, 12, 50)), ("readme.html", "x"))
    archive(zips, 2025, 1, ("b.CSV", month_csv(2025, 1, 30)))
    assert landing.land(spark, str(zips), str(raw)) == 2
    assert landing.land(spark, str(zips), str(raw)) == 0
    archive(zips, 2025, 2, ("c.csv", month_csv(2025, 2, 9)))
    assert landing.land(spark, str(zips), str(raw)) == 1
    assert {tuple(r) for r in landing.landed_months(spark, str(raw)).collect()} == {(2024, 12), (2025, 1), (2025, 2)}
    flights = clean(read_raw(spark, str(raw)))
    per_month = {r["m"]: r["count"] for r in flights.groupBy(F.month("flight_date").alias("m")).count().collect()}
    assert per_month == {12: 50, 1: 30, 2: 9}


def test_each_archive_is_a_partition_read_piece_by_piece(spark, tmp_path, monkeypatch):
    for month in range(1, 13):
        archive(tmp_path / "zips of 2024", 2024, month, ("a.csv", month_csv(2024, month, 40 * month)))
    paths = sorted(f"file:{p}" for p in (tmp_path / "zips of 2024").glob("*.zip"))
    lines = landing.unpack(spark, paths)
    assert [f.name for f in lines.schema] == ["path", "line_no", "value"]
    where = lines.select("path", F.spark_partition_id().alias("part")).distinct().collect()
    assert len(where) == len({r.path for r in where}) == len({r.part for r in where}) == 12
    monkeypatch.setattr(landing, "can_open", lambda path: False)
    assert sorted(lines.collect()) == sorted(landing.unpack(spark, paths).collect())


def test_a_large_archive_takes_little_memory(tmp_path):
    with zipfile.ZipFile(tmp_path / "big_2025_01.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("a.csv", "w") as member:
        for _ in range(30):
            member.write((b"1,2,3,4,5" * 22 + b"\n") * 10_000)  # 60 MB in all
    tracemalloc.start()
    with stores.opened(f"file:{tmp_path}/big_2025_01.zip") as file:
        rows = sum(b.num_rows for b in landing._lines("big", file))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 300_000 and peak < 16 << 20


def test_headers_of_many_files_come_from_one_job(spark, tmp_path, monkeypatch):
    folder = tmp_path / "raw files"
    folder.mkdir()
    texts = ["a,b,c\n1,2,3\n", "\n\n  \nc,b,a\r\n1,2,3\r\n", 'a,"b ""x""",c\n', "a,,a\n1,2,3\n", "\ufeffa,b\n"]
    for i in range(300):
        (folder / f"part {i:03d}.csv").write_bytes(texts[i % len(texts)].encode())
    paths = csv_files.list_files(spark, str(folder))
    read = []
    plain = csv_files.header
    monkeypatch.setattr(csv_files, "header", lambda s, path: (read.append(path), plain(s, path))[1])
    found = csv_files.headers(spark, paths)
    assert list(found) == paths and len(read) == len(texts)
    assert all(found[p] == tuple(plain(spark, p)) for p in paths[:len(texts)])
    assert all(found[p] == found[paths[i % len(texts)]] for i, p in enumerate(paths))
    monkeypatch.setattr(csv_files, "can_open", lambda path: False)
    assert csv_files.headers(spark, paths[:20]) == {p: found[p] for p in paths[:20]}


def test_an_archive_needs_exactly_one_csv(spark, tmp_path):
    archive(tmp_path / "zips", 2025, 1, ("a.csv", "x\n"), ("b.csv", "x\n"))
    with pytest.raises(Exception, match="should hold a single CSV and holds 2"):
        landing.land(spark, str(tmp_path / "zips"), str(tmp_path / "raw"))


def test_archives_without_a_month_of_their_own_are_refused(spark, tmp_path):
    zips, raw = tmp_path / "zips", str(tmp_path / "raw")
    archive(zips, 2024, 5, ("a.csv", month_csv(2024, 5, 2)))
    (zips / "extra.zip").write_bytes((zips / "On_Time_1987_present_2024_5.zip").read_bytes())
    with pytest.raises(ValueError, match="extra.zip"):
        landing.land(spark, str(zips), raw)
    (zips / "extra.zip").rename(zips / "again_2024_05.zip")
    with pytest.raises(ValueError, match="2024_"):
        landing.land(spark, str(zips), raw)
    assert not (tmp_path / "raw").exists()


def answer(days, rain, **more):
    variables = {"precipitation_sum": rain, "snowfall_sum": [0] * len(days), "wind_gusts_10m_max": [40] * len(days),
                 "temperature_2m_min": [-3.5] * len(days)}
    return {"daily": {"time": days, **variables, **more}}


def payloads(spark, airports, payload):
    return spark.createDataFrame([(airports, json.dumps(payload))], "airports array<string>, payload string")


def test_payload_rows_per_airport(spark):
    days = ["2025-09-30", "2025-10-01", "2025-10-02"]
    out = forecasts.parse_payloads(payloads(spark, ["ORD", "LAX"], [answer(days, [3.25, None, "15d"]), answer(days[:1], [8])]))
    rows = {(r.airport, str(r.date)): (r.precip_mm, r.temp_min_c) for r in out.collect()}
    assert rows == {("ORD", days[0]): (3.25, -3.5), ("ORD", days[1]): (None, -3.5), ("ORD", days[2]): (None, -3.5), ("LAX", days[0]): (8.0, -3.5)}
    alone = forecasts.parse_payloads(payloads(spark, ["SEA"], answer(days, [0, 0, 1]))).collect()
    assert [(r.airport, r.precip_mm) for r in alone] == [("SEA", 0.0), ("SEA", 0.0), ("SEA", 1.0)]


def test_the_days_of_a_payload_count(spark):
    uneven = answer(["2025-09-30", None, "soon", "2025-10-03"], [1, 2, 3, 4, 5], snowfall_sum=[7])
    rows = forecasts.parse_payloads(payloads(spark, ["ORD"], uneven)).orderBy("date").collect()
    assert [(str(r.date), r.precip_mm, r.snow_cm) for r in rows] == [("2025-09-30", 1.0, 7.0), ("2025-10-03", 4.0, None)]


@pytest.mark.parametrize("airports, payload, problem", [
    (["ORD"], "<html>", "a payload of 0 objects for 1 airports"),
    (["ORD", "LAX", "SEA"], [answer([], [])], "a payload of 1 objects for 3 airports"),
    (["ORD"], {"daily": {"time": ["2025-09-30"]}}, "incomplete weather for ORD"),
])
def test_broken_payloads_are_errors(spark, airports, payload, problem):
    with pytest.raises(Exception, match=problem):
        forecasts.parse_payloads(payloads(spark, airports, payload)).collect()


def test_cache_counts_only_when_it_covers_the_days(spark, tmp_path, weather):
    march = weather.filter("date between '2025-03-01' and '2025-03-31'")
    whole, week = (dt.date(2025, 3, 1), dt.date(2025, 3, 31)), (dt.date(2025, 3, 10), dt.date(2025, 3, 16))
    assert forecasts.usable_cache(march, *whole).count() == 6 * 31 and forecasts.usable_cache(march, *week).count() == 6 * 7
    for first, last in ((dt.date(2025, 2, 28), week[1]), (week[0], dt.date(2025, 4, 1))):
        assert forecasts.usable_cache(march, first, last) is None
    assert forecasts.usable_cache(march.filter("airport = 'none'"), *week) is None
    assert forecasts.usable_cache(tables.read_if_present(spark, str(tmp_path / "nothing")), *week) is None


def test_fetched_weather_is_added_once(spark, weather):
    cached = weather.filter("airport in ('BOS', 'DEN')")
    fetched = weather.filter("airport in ('DEN', 'SEA')")
    both = forecasts.add_fetched(cached, fetched.unionByName(fetched))
    assert both.count() == both.select("airport", "date").distinct().count() == weather.filter("airport in ('BOS', 'DEN', 'SEA')").count()
    assert forecasts.add_fetched(None, fetched).count() == fetched.count()
    assert forecasts.add_fetched(cached, None).count() == cached.count() and forecasts.add_fetched(None, None) is None


def test_repeated_weather_is_refused(flights, weather):
    with pytest.raises(Exception, match="more than one weather row for BOS"):
        add_weather(flights, weather.unionByName(weather.filter("airport = 'BOS' and date = '2025-02-03'"))).count()


def test_weather_table_can_replace_itself(spark, tmp_path, weather):
    path = str(tmp_path / "weather")
    assert tables.write_weather(spark, None, path) == 0 and tables.read_if_present(spark, path) is None
    assert tables.write_weather(spark, weather, path) == weather.count()
    smaller = tables.read_if_present(spark, path).filter("airport <> 'TPA'")
    assert tables.write_weather(spark, smaller, path) == weather.filter("airport <> 'TPA'").count()
    assert tables.write_weather(spark, weather.limit(0), path) == 0  # what lay there is not used any more
    assert tables.read_if_present(spark, path).isEmpty()


def test_an_upsert_leaves_other_airports_files(spark, tmp_path, weather):
    path = tmp_path / "weather"

    def files():
        return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}

    def of(airport):
        return {p: t for p, t in files().items() if f"place=at-{airport}" in str(p)}

    tables.write_weather(spark, weather, str(path))
    before, boston = files(), of("BOS")
    late = weather.where("airport = 'BOS' and date >= '2025-03-01'").withColumn("snow_cm", F.lit(9.0))
    first = weather.where("airport = 'LAX' and date < '2025-02-01'").withColumn("airport", F.lit("01"))
    for _ in range(2):
        assert tables.upsert_weather(spark, late.unionByName(first), str(path)) == ["01", "BOS"]
    assert {p: t for p, t in files().items() if p in before and p not in boston} == {p: t for p, t in before.items() if p not in boston}
    assert boston and not set(boston) & set(of("BOS")) and of("01")
    columns = weather.columns
    expected = weather.withColumn("snow_cm", F.when(F.expr("airport = 'BOS' and date >= '2025-03-01'"), 9.0).otherwise(F.col("snow_cm"))).unionByName(first)
    assert sorted(tables.read_weather(spark, str(path)).select(columns).collect()) == sorted(expected.select(columns).collect())
    assert tables.upsert_weather(spark, late.limit(0), str(path)) == []
    weather.write.parquet(str(tmp_path / "flat"))  # a table that is not kept by airport
    tables.upsert_weather(spark, late.unionByName(first), str(tmp_path / "flat"))
    assert sorted(tables.read_weather(spark, str(tmp_path / "flat")).select(columns).collect()) == sorted(expected.select(columns).collect())


def test_a_weather_step_writes_only_new_airports(spark, tmp_path, flights, weather):
    where, path = str(tmp_path / "flights"), tmp_path / "weather"
    tables.write_by_month(flights, where)

    dates = [str(r.date) for r in weather.select("date").distinct().orderBy("date").collect()]
    days = len(dates)
    item = {"daily": {"time": dates, "precipitation_sum": [0.5] * days, "snowfall_sum": [0] * days,
                      "wind_gusts_10m_max": [20.0] * days, "temperature_2m_min": [None] * days}}

    def payload(airport):
        return spark.createDataFrame([([airport], json.dumps(item))], "airports array<string>, payload string")

    assert full_run.weather_step(spark, where, payload("BOS"), str(path)) == days
    before = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    assert full_run.weather_step(spark, where, payload("LAX"), str(path)) == 2 * days
    assert full_run.weather_step(spark, where, payload("BOS"), str(path)) == 2 * days  # held already
    assert before and all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert full_run.weather_step(spark, where, None, str(path)) == 2 * days


def test_coordinates_of_open_airports(spark, tmp_path):
    (tmp_path / "airports.csv").write_text(
        'id,type,name,latitude_deg,longitude_deg,iata_code\n1,closed,"Old, field",1,2,BOS\n2,large_airport,Logan,42.3,-71,BOS\n'
        "3,heliport,Roof,42.4,-71.1,BOS\n4,,Null type,33.9,-118.4,LAX\n5,small_airport,No code,1,1,\n")
    places = forecasts.read_coordinates(spark, str(tmp_path / "airports.csv"))
    assert {(r.airport, r.lat, r.lon) for r in places.collect()} == {("BOS", 42.3, -71.0), ("LAX", 33.9, -118.4)}


def test_monthly_table_round_trip(spark, tmp_path, flights):
    path = str(tmp_path / "flights")
    assert tables.write_by_month(flights, path) == flights.count()
    back = tables.read_by_month(spark, path)
    assert back.columns == flights.columns
    january = back.filter("flight_date < '2025-02-01'")
    assert january.count() == flights.filter("flight_date < '2025-02-01'").count()
    assert sorted(p.name for p in (tmp_path / "flights").glob("flight_month=*"))[0] == "flight_month=2025-01"
    february = tables.read_by_month(spark, path, dt.date(2025, 2, 10), dt.date(2025, 2, 20))
    assert february.count() == flights.filter("flight_date between '2025-02-10' and '2025-02-20'").count()
    plan = february._jdf.queryExecution().executedPlan().toString()
    assert "flight_month" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_snapshot_from_the_table(spark, tmp_path, flights):
    path = str(tmp_path / "flights")
    tables.write_by_month(flights, path)
    one, two = (rows.orderBy("carrier", "origin", "dest", "dep_hour").collect() for rows in (snapshot_of_table(spark, path), fresh_snapshot(flights)))
    assert one == two and one
