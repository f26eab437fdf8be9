import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from departure_risk.operators.clean import clean
from departure_risk.operators.split import find_split, only
from departure_risk.plans import full_run, refresh
from departure_risk.plans.features import build_features
from departure_risk.sources import tables


def rows_of(frame):
    return sorted(map(str, frame.drop("flight_id").collect()))


def files_of(path):
    return {f"{folder}/{name}": os.stat(f"{folder}/{name}").st_mtime_ns for folder, _, names in os.walk(path) for name in names if name.endswith("parquet")}


def test_touched_spans():
    day = dt.date
    assert refresh.touched_spans(["2025-01"]) == [(day(2025, 1, 1), day(2025, 2, 28))]
    assert refresh.touched_spans(["2024-12", "2025-01", "2025-06"]) == [(day(2024, 12, 1), day(2025, 2, 28)), (day(2025, 6, 1), day(2025, 7, 31))]
    assert refresh.touched_spans(["2025-01"], 60) == [(day(2025, 1, 1), day(2025, 4, 30))] and refresh.touched_spans([]) == []


def test_an_added_month_equals_a_full_build_and_leaves_the_rest(spark, raw, weather, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("first", "new", "flights", "weather", "features")}
    march = F.col("FlightDate").like("2025-03%")
    raw.where(~march).write.option("header", True).csv(paths["first"])
    raw.where(march).write.option("header", True).csv(paths["new"])
    weather.write.parquet(paths["weather"])
    full_run.clean_step(spark, paths["first"], paths["flights"])
    full_run.features_step(spark, paths["flights"], paths["weather"], paths["features"])
    before = {n: files_of(paths[n]) for n in ("flights", "features")}
    months = full_run.add_months_step(spark, paths["new"], paths["flights"], paths["weather"], paths["features"])
    assert months == ["2025-03", "2025-04"]  # April looks back on March
    flights, features = (tables.read_by_month(spark, paths[n]) for n in ("flights", "features"))
    whole = clean(raw)
    assert rows_of(flights) == rows_of(whole) and rows_of(features) == rows_of(build_features(whole, weather))
    assert flights.count() == flights.select("flight_id").distinct().count()
    for name in before:
        after = files_of(paths[name])
        kept = [f for f in before[name] if "2025-01" in f or "2025-02" in f]
        assert kept and all(after.get(f) == before[name][f] for f in kept)
    # once more, and a correction of one month
    assert full_run.add_months_step(spark, paths["new"], paths["flights"], paths["weather"], paths["features"]) == months
    assert rows_of(tables.read_by_month(spark, paths["features"])) == rows_of(build_features(whole, weather))


def test_a_first_month_without_any_table_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        full_run.add_months_step(spark, str(tmp_path / "none"), str(tmp_path / "flights"), None, str(tmp_path / "features"))


def test_parts_of_the_split_open_only_their_months(spark, features, tmp_path):
    path = str(tmp_path / "features")
    tables.write_by_month(features, path)
    rows = tables.read_by_month(spark, path, keep_month=True)
    split = find_split(rows)
    for part in ("train", "valid", "test"):
        chosen = only(rows, split, part)
        assert chosen.drop("flight_month").count() == only(features, split, part).count()
        plan = chosen._jdf.queryExecution().executedPlan().toString()
        assert "flight_month" in plan.split("PartitionFilters: ")[1].split("]")[0]
