import numpy as np
import pytest
from pyspark.sql import functions as F

from departure_risk.llm import topk
from llm.conftest import table

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k, every):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole = [int(np.floor(64 * x)) for x in v]
            fine[i] = min(fine.get(i, whole), whole)
    out = []
    for q, a in fine.items():
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine.items() if i != q)[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    return sorted(out)


def search(spark, rows, k, every, **options):
    found = topk.top_k(table(spark, rows, SCHEMA).repartition(3), k, query_every=every, **options)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())


@pytest.mark.parametrize("spread", [0.05, 1.0, 3e5])
@pytest.mark.parametrize("blocks", [dict(block_rows=30, query_rows=7, sampled=20, pivots=3), {}])
def test_against_all_pairs(spark, spread, blocks):
    rng = np.random.default_rng(int(spread))
    centres = rng.normal(0, spread, (6, 12))
    rows = [(i, (centres[i % 6] + rng.normal(0, spread / 5, 12)).tolist()) for i in range(400)]
    assert search(spark, rows, 9, 8, **blocks) == brute(rows, 9, 8)


def test_defined_cases(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 1, 4).tolist()) for i in range(40)]
    rows += [(100 + i, [1.0, 0.5, 0.25, 0.0]) for i in range(60)]  # ties
    rows += [(200, None), (205, [1.0, None, 2.0, 3.0]), (210, [float("nan")] * 4), (215, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4),
             (220, []), (225, [2.0]), (230, [1.0, 1.0, 1.0, 1.0, 9.0]), (235, [0.1] * 4), (235, [-0.1] * 4), (235, [0.1] * 4), (240, [0.0] * 4)]
    assert search(spark, rows, 7, 5, block_rows=16, sampled=10, pivots=4) == brute(rows, 7, 5)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert search(spark, rows, 20, 2) == brute(rows, 20, 2)
    assert search(spark, [(0, [1.0])], 20, 2) == [] and search(spark, [], 20, 2) == []


def test_very_large_components_keep_whole_numbers():
    a = np.array([[2.0 ** 40 + 1, 3.0]])
    assert topk.scores(a, a)[0, 0] == min((2 ** 40 + 1) ** 2 + 9, 2 ** 63 - 1)
    assert topk.scores(np.array([[2.0 ** 30 + 1]]), np.array([[2.0 ** 25 + 1]]))[0, 0] == (2 ** 30 + 1) * (2 ** 25 + 1)


def test_far_candidates_are_never_evaluated(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.round(np.concatenate([rng.normal(0, 1, (4000, 8)) + 60, rng.normal(0, 1, (4000, 8)) - 60]))
    largest = float((x * x).sum(axis=1).max())
    pivots = topk.choose_pivots(topk._lifted(x, largest), 12)
    seen = []
    monkeypatch.setattr(topk, "scores", lambda a, b, f=topk.scores: (seen.append(len(b)), f(a, b))[1])
    q = x[:1]
    near = np.abs(topk._distances(np.column_stack([q, [0.0]]), pivots) - topk._distances(topk._lifted(x, largest), pivots)).max(axis=0)
    whole = float((q * q).sum()) + largest
    ids, got = topk.best(q[0], 0, (whole - near ** 2) / 2 + 1, -np.inf, x, np.arange(len(x)), 5)
    want = np.lexsort((np.arange(1, len(x)), -(x[1:] @ q[0])))[:5] + 1
    assert ids.tolist() == want.tolist() and sum(seen) < 0.6 * len(x)


def test_a_block_whose_bounds_rule_out_nothing_is_done_in_few_steps(monkeypatch):
    rng = np.random.default_rng(5)
    x, ids = rng.integers(-3, 4, (4000, 6)).astype(float), np.arange(4000)
    want = sorted(((-int(s), i) for i, s in enumerate(x @ x[7]) if i != 7))[:20]
    steps, part = [], np.argpartition
    monkeypatch.setattr(topk.np, "argpartition", lambda *a: steps.append(1) or part(*a))
    for exact in ((True,), (False,), ()):
        steps.clear()
        got, value = topk.best(x[7], 7, np.full(4000, np.inf), -np.inf, x, ids, 20, *exact)
        assert [(-s, i) for i, s in zip(got.tolist(), value.tolist())] == want and len(steps) <= 2


def test_the_sample_does_not_grow_with_the_tasks(spark, monkeypatch):
    """every task sent `sampled` whole vectors to the driver, which ran out of memory at 6 GB."""
    rows = spark.range(0, 8000, 1, 40).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    taken, ordered = [], type(rows).orderBy
    monkeypatch.setattr(type(rows), "orderBy", lambda self, *a: taken.append(self.count()) or ordered(self, *a))
    found = topk.sample_of(rows, 8000, 2, 100)
    monkeypatch.undo()
    wanted = [r.id for r in rows.orderBy(F.xxhash64("id"), "id").limit(100).collect()]
    assert [r.id for r in found] == wanted and sum(taken) < 8 * 100


def test_the_sample_holds_the_vectors_that_count(spark):
    """Of 3000 rows of 12 ids the smallest vectors: one that does not count may reach a score that no candidate has."""
    rows = [(i % 12, [float(i % 7), float(-i)]) for i in range(3000)]
    vectors = spark.createDataFrame(rows, "id long, v array<double>")
    least = {i: min(v for j, v in rows if j == i) for i in range(12)}
    assert {r.id: r.v for r in topk.sample_of(vectors, 3000, 2, 12)} == least
    assert {r.id: r.v for r in topk.sample_of(vectors, 3000, 2, 50)} == least
    assert search(spark, rows, 4, 3, sampled=12) == brute(rows, 4, 3)


def test_queries_are_never_broadcast(spark):
    """the exploded queries, 3 GB at 615,384 vectors, were taken for their 7 MB table and broadcast from the driver."""
    rng = np.random.default_rng(4)
    found = topk.top_k(table(spark, [(i, rng.normal(0, 1, 4).tolist()) for i in range(60)], SCHEMA), 5, query_every=4, block_rows=10, query_rows=5)
    assert "SortMergeJoin" in (plan := found._jdf.queryExecution().executedPlan().toString()) and "Broadcast" not in plan
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
