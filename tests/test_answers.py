import json
import random
import time
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from departure_risk.operators import compare
from departure_risk.operators.nearest import match_requests
from departure_risk.operators.snapshot import snapshot
from departure_risk.plans import questions
from departure_risk.sources.tables import read_questions


def test_question_set_answers(flights, flights_pd):
    flown = flights_pd[flights_pd.operated]
    first = {f.__name__: f(flights).first() for f in questions.ANSWERS}
    assert first["scheduled_flights"][0] == len(flights_pd)
    assert first["late_percent"][0] == pytest.approx(100 * flown.delayed.mean(), abs=0.051)
    by_carrier = flown.groupby("carrier").delayed.mean()
    assert first["worst_carrier"][0] == by_carrier.idxmax() == "N4"
    assert first["mean_delay_from"][0] == pytest.approx(flown[flown.origin == "ORD"].dep_delay.mean(), abs=0.051)
    assert first["operated_on_route"][0] == ((flown.origin == "BOS") & (flown.dest == "LAX")).sum()
    assert first["longest_flight"][0] == flights_pd.crs_elapsed.max()
    assert first["busiest_route"][2] == flights_pd.groupby(["origin", "dest"]).size().max()
    assert len(questions.busiest_origins(flights).collect()) == 3 and len(questions.ANSWERS) == 15


def test_capped_answers_keep_their_order(spark, flights):
    questions.register(flights)
    sql = "SELECT flight_id FROM flights ORDER BY flight_id DESC"
    out = questions.ask(spark, sql, 50).collect()
    top = [r.flight_id for r in flights.orderBy(F.desc("flight_id")).limit(50).collect()]
    assert [r.flight_id for r in out] == top and all(r.truncated for r in out)
    few = questions.ask(spark, "SELECT carrier, count(*) AS n FROM flights GROUP BY carrier", 4).collect()
    assert len(few) == 4 and not any(r.truncated for r in few)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_names_order_and_extra_columns_do_not_matter(spark):
    key = frame(spark, [("mon", 7, 0.31), ("tue", 4, 0.5), ("wed", 9, 0.07)], "day string, n int, share double")
    reply = frame(spark, [(0.07, "x", "wed", 9), (0.31, "y", "mon", 7), (0.5, "z", "tue", 4)], "s double, note string, d string, cases int")
    assert compare.results_match(reply, key)
    assert compare.results_match(reply.select("cases", "d", "s"), key)
    assert not compare.results_match(reply.filter("cases > 4"), key)
    assert not compare.results_match(reply.drop("s"), key)
    assert not compare.results_match(reply.withColumn("cases", F.lit(9)), key)


def test_copies_nulls_and_kinds_count(spark):
    def match(a, b, schema="x string"):
        return compare.results_match(frame(spark, a, schema), frame(spark, b, schema))

    assert match([("a",), ("a",), ("b",)], [("b",), ("a",), ("a",)])
    assert not match([("a",), ("a",), ("b",)], [("a",), ("b",), ("b",)])
    assert match([(None,), ("a",)], [("a",), (None,)]) and not match([(None,)], [("a",)])
    assert match([(float("nan"),), (-0.01,)], [(None,), (0.0,)], "x double")
    assert not compare.results_match(frame(spark, [("1.0",)], "x string"), frame(spark, [(1.0,)], "x double"))
    assert compare.results_match(frame(spark, [(1,)], "x int"), frame(spark, [(1.04,)], "x double"))


def test_scoring_a_question_set(spark, flights, tmp_path):
    (tmp_path / "q.json").write_text(json.dumps([
        {"question": "How many?", "sql": "SELECT count(*) FROM flights"},
        {"question": "Late by carrier?", "sql": "SELECT carrier, avg(delayed) FROM flights WHERE operated GROUP BY carrier"},
        {"question": "Which pilots?", "expect": "refuse"}]))
    questions.register(flights)
    cases = read_questions(spark, str(tmp_path / "q.json")).collect()

    def scored(answer):
        return compare.score_answers([(c.question, answer(c), None if c.expect else spark.sql(c.sql)) for c in cases])

    assert scored(lambda c: spark.sql(c.sql) if c.sql else None)["accuracy"] == 1.0
    constant = scored(lambda c: spark.sql("SELECT 1 AS x"))
    assert constant["correct"] == 0 and constant["total"] == 3


@pytest.fixture(scope="module")
def latest(features):
    return snapshot(features)


def test_snapshot_of_the_last_four_weeks(latest, features_pd):
    frame = latest.toPandas()
    import datetime as dt
    recent = features_pd[features_pd.flight_date > features_pd.flight_date.max() - dt.timedelta(days=28)]
    groups = recent.sort_values("flight_date").groupby(["carrier", "origin", "dest", "dep_hour"])
    assert len(frame) == groups.ngroups
    expected = groups.agg(distance=("distance", "median"), route_rate=("route_rate", "last"), n=("origin_hour_n", "last"),
                          week=("nation_7d_rate", "last"), load=("origin_day_flights", "median"))
    got = frame.set_index(["carrier", "origin", "dest", "dep_hour"]).loc[expected.index]
    for ours, theirs in (("distance", "distance"), ("route_rate", "route_rate"), ("origin_hour_n", "n"),
                         ("nation_7d_rate", "week"), ("origin_day_flights", "load")):
        assert (got[ours].fillna(-1) - expected[theirs].fillna(-1)).abs().max() < 1e-12


def test_requests_take_the_nearest_hour(spark, latest):
    few = latest.filter("carrier = 'K1' AND origin = 'BOS' AND dest = 'LAX' AND dep_hour IN (6, 10)")
    hours = sorted(r.dep_hour for r in few.collect())
    assert hours == [6, 10]
    asked = [(1, "K1", "LAX", 6), (2, "K1", "LAX", 8), (3, "K1", "LAX", 9), (4, "K1", "LAX", 23), (5, "K1", "LAX", 30),
             (6, "K1", "ZZZ", 8), (7, "L2", "LAX", 8), (8, "K1", "LAX", 0), (9, "K1", "LAX", None)]
    requests = spark.createDataFrame([(i, c, "BOS", d, h) for i, c, d, h in asked],
                                     "request_id int, carrier string, origin string, dest string, dep_hour int")
    out = {r.request_id: r for r in match_requests(requests, few).collect()}
    assert {i: r.matched_hour for i, r in out.items()} == {1: 6, 2: 6, 3: 10, 4: 10, 5: None, 6: None, 7: None, 8: 6, 9: None}
    assert [out[i].status for i in range(1, 10)] == ["ok"] * 4 + ["invalid_hour", "no_history", "no_history", "ok", "invalid_hour"]
    assert out[1].note == "exact scheduled hour" and out[2].note.startswith("nearest") and out[6].note is None


def test_choices_that_add_up_against_all_choices():
    rng = random.Random(3)
    for _ in range(200):
        values = [rng.choice([-2 ** 70, -5, 0, 1, 1, 2, 3, 2 ** 64 + 4]) for _ in range(rng.randrange(9))]
        wanted, target = rng.randrange(len(values) + 2), rng.randrange(-6, 8)
        plain = [list(c) for c in combinations(range(len(values)), wanted) if (sum(values[i] for i in c) - target) % 2 ** 64 == 0]
        assert sorted(compare.choices_that_add_up(values, wanted, target)) == plain


def test_many_columns_are_matched_at_once(spark):
    rng = random.Random(5)
    values = [rng.randrange(2 ** 70) for _ in range(40)]
    picked = sorted(rng.sample(range(40), 20))
    start = time.perf_counter()
    assert list(compare.choices_that_add_up(values, 20, sum(values[i] for i in picked))) == [picked]
    assert time.perf_counter() - start < 5
    wide = spark.range(50).select(*[(F.col("id") * (i + 3) % (i + 11)).alias(f"c{i}") for i in range(40)])
    expected = wide.select(*[F.col(f"c{i}").alias(f"x{39 - i}") for i in picked])
    assert compare.results_match(wide, expected)
    assert not compare.results_match(wide.withColumn(f"c{picked[7]}", F.lit(-1)), expected)
