import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from departure_risk.plans import audits
from departure_risk.operators.cube import cube_document, encode_cube, prediction_cube
from departure_risk.operators.metrics import by_hour, calibration_table, ranking_metrics
from departure_risk.operators.recalibrate import daily_shift, recalibrate
from departure_risk.operators.running import add_running_totals
from departure_risk.operators.split import find_split, label_split, only, split_summary


def scored_frame(spark, n=4000, seed=3, digits=2):
    rng = np.random.default_rng(seed)
    p = rng.beta(2, 6, n).round(digits)
    p[: n // 3] = 0.25  # a third of the rows share one score
    y = (rng.random(n) < p).astype(int)
    return pd.DataFrame({"model": "a", "p": p, "delayed": y})


def average_precision(y, p):
    order = sorted(set(p), reverse=True)
    total, area = y.sum(), 0.0
    for s in order:
        chosen = p >= s
        area += y[p == s].sum() / total * y[chosen].sum() / chosen.sum()
    return area


def pairwise_auc(y, p):
    late, on_time = p[y == 1], p[y == 0]
    wins = (late[:, None] > on_time[None, :]).sum() + 0.5 * (late[:, None] == on_time[None, :]).sum()
    return wins / (len(late) * len(on_time))


@pytest.mark.parametrize("pieces", [1, 2, 7, 64])
def test_ranking_metrics_match_their_definitions(spark, pieces):
    frames = [scored_frame(spark), scored_frame(spark, 700, 5, 6).assign(model="b")]
    out = ranking_metrics(spark.createDataFrame(pd.concat(frames)), ["model"], pieces=pieces).toPandas().set_index("model")
    for name, frame in zip("ab", frames):
        y, p = frame.delayed.to_numpy(), frame.p.to_numpy()
        assert np.isclose(out.pr_auc[name], average_precision(y, p))
        assert np.isclose(out.roc_auc[name], pairwise_auc(y, p))
        assert np.isclose(out.brier[name], ((y - p) ** 2).mean())


def test_ranking_metrics_by_hand(spark):
    rows = spark.createDataFrame([("m", 0.9, 1), ("m", 0.8, 0), ("m", 0.7, 1), ("m", 0.1, 0)], "model string, p double, delayed int")
    out = ranking_metrics(rows, ["model"]).first()
    assert np.isclose(out.pr_auc, 0.5 * 1 + 0.5 * 2 / 3) and np.isclose(out.roc_auc, 0.75)


@pytest.mark.parametrize("pieces", [1, 3, 16])
def test_running_totals(spark, pieces):
    rng = np.random.default_rng(0)
    frame = pd.DataFrame({"g": rng.integers(0, 3, 600), "x": rng.permutation(600) / 7.0, "c": rng.integers(0, 9, 600)})
    got = add_running_totals(spark.createDataFrame(frame), ["g"], "x", ["c"], pieces).toPandas().sort_values(["g", "x"])
    frame = frame.sort_values(["g", "x"])
    assert (got.c_before.to_numpy() == (frame.groupby("g").c.cumsum() - frame.c).to_numpy()).all()
    assert (got.c_all.to_numpy() == frame.groupby("g").c.transform("sum").to_numpy()).all()


@pytest.mark.parametrize("digits", [1, 2, 9])
def test_calibration_bins_are_equal_frequency_bins(spark, digits):
    frame = scored_frame(spark, 2500, 11, digits)
    out = calibration_table(spark.createDataFrame(frame), ["model"], pieces=5).orderBy("bin").toPandas()
    bins = pd.qcut(frame.p, 10, labels=False, duplicates="drop")
    expected = frame.groupby(bins).agg(predicted=("p", "mean"), observed=("delayed", "mean"), flights=("p", "size"))
    assert out.flights.tolist() == expected.flights.tolist()
    assert np.allclose(out.predicted, expected.predicted, atol=6e-5) and np.allclose(out.observed, expected.observed, atol=6e-5)


def test_split_follows_the_calendar(features, features_pd):
    split = find_split(features)
    days = sorted(d for d in features_pd.flight_date.unique() if d >= features_pd.flight_date.min() + dt.timedelta(days=28))
    assert split.valid_start == days[int(len(days) * (1 - 0.2 - 0.1))]
    assert split.test_start == days[int(len(days) * (1 - 0.2))]
    parts = {r.split: r for r in split_summary(features, split).collect()}
    assert parts["train"].last_day < parts["valid"].first_day and parts["valid"].last_day < parts["test"].first_day
    assert parts["train"].first_day == split.start == days[0] and parts["test"].last_day == split.last
    for name, part in parts.items():
        assert only(features, split, name).count() == part.flights
    assert label_split(features, split).count() == sum(p.flights for p in parts.values())


def test_too_few_days_is_an_error(features):
    with pytest.raises(ValueError, match="a split takes 10"):
        find_split(features.filter("flight_date < '2025-02-05'"))
    with pytest.raises(ValueError, match="a split takes 10"):
        find_split(features.filter("flight_date < '2024-02-05'"))


def forecasts(spark, days, per_day, bias, seed):
    """Outcomes that come true at a rate of their own each day, and forecasts that run `bias` times as high."""
    rng = np.random.default_rng(seed)
    level = np.repeat(0.25 + 0.1 * np.sin(np.arange(days) / 5), per_day)
    truth = np.clip(level + rng.normal(0, 0.06, days * per_day), 0.02, 0.6)
    day = np.repeat(pd.date_range("2025-03-01", periods=days).date, per_day)
    return spark.createDataFrame(pd.DataFrame({
        "flight_id": np.arange(len(truth)), "flight_date": day, "p": truth * bias,
        "delayed": rng.binomial(1, truth).astype(int)}))


START = dt.date(2025, 3, 18)


def test_an_outcome_moves_later_days_only(spark):
    rows = forecasts(spark, 36, 90, 1.2, 21)
    for day in (START, dt.date(2025, 3, 27)):
        changed = {r.after_the_day: r.changed for r in audits.recalibration_leaks(rows, START, day).collect()}
        assert changed.get(False, 0) == 0 and changed[True] > 0


def test_recalibration_corrects_forecasts_that_run_high(spark):
    scored = recalibrate(forecasts(spark, 80, 260, 1.45, 22), START)
    by_half = scored.groupBy((F.col("flight_date") < "2025-04-15").alias("early")).agg(
        F.avg("p").alias("p"), F.avg("p_recalibrated").alias("fixed"), F.avg("delayed").alias("seen")).collect()
    assert len(by_half) == 2
    for half in by_half:
        assert abs(half.fixed - half.seen) < 0.25 * abs(half.p - half.seen)


def test_shift_matches_a_loop_over_days(spark):
    rows = forecasts(spark, 30, 40, 0.9, 23).filter("flight_date NOT IN ('2025-03-06', '2025-03-07')")
    frame = rows.toPandas()
    got = {r.flight_date: r["shift"] for r in daily_shift(rows).collect()}

    def logit(x):
        x = min(max(x, 1e-6), 1 - 1e-6)
        return np.log(x / (1 - x))

    for day, shift in got.items():
        past = frame[(frame.flight_date < day) & (frame.flight_date >= day - dt.timedelta(days=14))]
        assert np.isclose(shift, logit(past.delayed.mean()) - logit(past.p.mean()) if len(past) else 0.0)


@pytest.fixture(scope="module")
def test_rows(features):
    split = find_split(features)
    return only(features, split, "test").withColumn("p", F.coalesce("route_rate", "origin_rate"))


@pytest.mark.parametrize("top", [2, 6])
def test_cube_adds_up(test_rows, top):
    frame = test_rows.select("flight_date", "origin", "delayed", "p").toPandas()
    cube = prediction_cube(test_rows, top).toPandas()
    assert cube.n.sum() == len(frame) and cube.late.sum() == frame.delayed.sum()
    assert np.isclose(cube.p.sum(), frame.p.sum(), atol=0.005 * len(cube))
    assert ((cube.p >= 0) & (cube.p <= cube.n)).all()
    assert cube.origin.nunique() == (top + 1 if top < 6 else 6)
    assert set(cube.part) == {0, 1, 2, 3}


def test_cube_document_holds_the_coded_rows(test_rows):
    cube = prediction_cube(test_rows, 2)
    page = cube_document(cube).first()
    assert page.dates == sorted(page.dates) and page.origins[-1] == "Other airports" and len(page.parts) == 4
    assert len(page.rows) == cube.count() == encode_cube(cube).count()
    decoded = {(page.dates[int(r[0])], page.origins[int(r[1])], page.carriers[int(r[2])], int(r[3])): r[4] for r in page.rows}
    for row in cube.collect():
        assert decoded[row.date, row.origin, row.carrier, row.part] == row.n


def test_rates_by_hour(test_rows):
    out = by_hour(test_rows).toPandas()
    frame = test_rows.select("dep_hour", "delayed").toPandas().groupby("dep_hour").delayed
    assert out.dep_hour.tolist() == sorted(out.dep_hour) and np.allclose(out.observed, frame.mean(), atol=6e-5)
