from collections import Counter
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from departure_risk.llm import mixing
from llm.conftest import sentence, table

SCHEMA = "doc_id long, text string, source string, n_chars long"


def water_level(sizes, weights, share, most):
    """Targets by raising all sources together until the whole is shared out."""
    left, targets, open_ = share * sum(sizes), [0.0] * len(sizes), list(range(len(sizes)))
    while open_ and left > 1e-9:
        total = sum(weights[i] for i in open_)
        step = min([left / total, *[(most * sizes[i] - targets[i]) / weights[i] for i in open_]])
        for i in open_:
            targets[i] += step * weights[i]
        left -= step * total
        open_ = [i for i in open_ if most * sizes[i] - targets[i] > 1e-9]
    return targets


def documents(seed=1, n=400):
    rng = np.random.default_rng(seed)
    sources = ["a", "B", "é", "z", "source with a third"]
    rows = [(i, sentence(rng, int(rng.integers(1, 60))), "source with a third" if i % 3 == 0 else sources[int(rng.integers(0, 4))], 5) for i in range(n)]
    return rows + [(n, None, "a", 0), (n + 1, "", "a", 0), (n + 2, " \t one\x0btwo joined ", None, 9), (n + 3, "x " * 5000, None, 9),
                   (n + 4, "nothing but me", "tiny", 3), (n + 5, "  ", "no words", 2)]


def code_points(source):
    return (source is None, [ord(c) for c in source or ""])


@pytest.mark.parametrize("options", [{}, dict(block_words=150, shard_blocks=3)])
def test_targets_and_words_taken(spark, options):
    rows = documents()
    got = {r.doc_id: r for r in mixing.mix_words(table(spark, rows, SCHEMA).repartition(3), **options).collect()}
    sizes = {i: len([w for w in (t or "").replace("\x0b", " ").replace("\t", " ").split(" ") if w]) for i, t, _, _ in rows}
    of_source = Counter()
    for i, _, s, _ in rows:
        of_source[s] += sizes[i]
    names = sorted(of_source, key=code_points)
    targets = dict(zip(names, water_level([of_source[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2.0)))
    taken = Counter()
    for i, _, s, _ in rows:
        r = got[i]
        assert (r["size"], r.source_size) == (sizes[i], of_source[s]) and r.target == pytest.approx(targets[s])
        assert 0 <= r.taken <= 2 * sizes[i]
        taken[s] += r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - targets[s]) <= 0.5 for s in names)


def test_reruns_agree_and_seeds_differ(spark):
    docs = table(spark, documents(), SCHEMA)
    first, again, other = (sorted(map(tuple, mixing.mix_words(d, block_words=100, **o).collect()), key=repr)
                           for d, o in ((docs, {}), (docs.repartition(5), {}), (docs, {"seed": 99})))
    assert first == again != other


def test_shards_hold_their_quotas_and_every_place_once(spark):
    sizes, _, mixed = mixing.mix(table(spark, documents(), SCHEMA), block_words=120, shard_blocks=4)
    rows = mixed.collect()
    shards = Counter(r.shard for r in rows)
    assert len(shards) > 4
    for shard, count in shards.items():
        assert sorted(r.position for r in rows if r.shard == shard) == list(range(count))
    assert max(Counter((r.doc_id, r.copy) for r in rows).values()) == 1 and {r.copy for r in rows} <= {0, 1, 2}
    assert sum(r.words for r in rows) == mixing.mix_words(table(spark, documents(), SCHEMA), block_words=120, shard_blocks=4).agg(F.sum("taken")).first()[0]


def test_hypergeometric_draws(spark):
    got = Counter(r.x for r in spark.range(20_000).selectExpr(
        "9L k", "30L n", "12L m", "pmod(xxhash64(id), 1000003) / 1000003.0D u").select(F.expr(mixing.hypergeometric("k", "n", "m", "u")).alias("x")).collect())
    for x in range(10):
        want = 20_000 * comb(9, x) * comb(21, 12 - x) / comb(30, 12)
        assert abs(got[x] - want) < 5 * want ** 0.5 + 5
    large = [r.x for r in spark.range(3000).selectExpr("300000L k", "1000000L n", "500000L m", "(id + 0.5D) / 3000 u").select(
        F.expr(mixing.hypergeometric("k", "n", "m", "u")).alias("x")).collect()]
    deviation = (500_000 * 0.3 * 0.7 * 0.5) ** 0.5
    assert abs(np.mean(large) - 150_000) < 2 and abs(np.std(large) / deviation - 1) < 0.02
    edges = spark.sql("SELECT * FROM VALUES (0L, 5L, 3L), (5L, 5L, 3L), (2L, 5L, 5L), (2L, 5L, 0L), (1L, 1L, 1L), (4L, 5L, 4L) AS t(k, n, m)")
    rows = edges.select("k", "n", "m", F.expr(mixing.hypergeometric("k", "n", "m", "0.999D")).alias("x")).collect()
    assert all(max(0, r.m - r.n + r.k) <= r.x <= min(r.k, r.m) for r in rows)


def test_splitting_adds_up(spark):
    quotas = spark.createDataFrame([([4, 7, 9], [1000, 37, 0])], "numbers array<long>, quotas array<long>")
    parts = mixing.split_quotas(quotas, 13, 3).collect()
    sums, widths = Counter(), Counter()
    for r in parts:
        sums[r.number] += r.takes
        widths[r.shard] += r.takes
    assert sums == {4: 1000, 7: 37, 9: 0} and set(widths) == set(range(13)) and max(widths.values()) - min(widths.values()) <= 4


def test_empty_tables(spark):
    assert mixing.mix_words(table(spark, [], SCHEMA)).isEmpty()
    rows = [(1, None, "a", 0), (2, "", None, 0)]
    assert sorted(map(tuple, mixing.mix_words(table(spark, rows, SCHEMA)).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.mixed_documents(table(spark, rows, SCHEMA)).isEmpty()


def test_rows_without_an_id_and_repeated_ids(spark):
    rng = np.random.default_rng(12)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, sentence(rng, int(rng.integers(1, 40))), ["a", "b", None][i % 4 % 3], 1) for i in range(240)]
    rows += [(7, "the very same row", "a", 1)] * 30 + [(None, "the very same row", "b", 1)] * 30
    got = mixing.mix_words(table(spark, rows, SCHEMA).repartition(3), block_words=100).collect()
    words = [len(t.split()) for _, t, _, _ in rows]
    of_source = Counter()
    for (_, _, s, _), n in zip(rows, words):
        of_source[s] += n
    names = sorted(of_source, key=code_points)
    targets = water_level([of_source[s] for s in names], [3, 1, 2], 1.5, 2.0)
    assert sorted((r.doc_id or -1, r["size"]) for r in got) == sorted((i or -1, n) for (i, *_), n in zip(rows, words))
    assert all(r.taken <= 2 * r["size"] for r in got)
    for name, target in zip(names, targets):
        assert abs(sum(r.taken for r in got if r.source_size == of_source[name]) - target) <= 0.5
    _, _, mixed = mixing.mix(table(spark, rows, SCHEMA), block_words=20)
    blocks = Counter((r.doc_id, r.shard) for r in mixed.collect() if r.doc_id in (None, 7))
    assert len(blocks) > 4  # no id holds its rows in one block


def test_mixed_documents_are_what_the_mix_takes(spark):
    rows = documents() + [(7000, "same words here", "a", 15), (7000, "same words here", "a", 15), (None, "not lost", "a", 1), (None, "nor this", None, 1)]
    docs = table(spark, rows, SCHEMA)
    out = mixing.mixed_documents(docs, block_words=90)
    assert out.columns == docs.columns
    _, targets, mixed = mixing.mix(docs, block_words=90)
    texts = {(i, s): t for i, t, s, _ in rows}
    got = out.collect()
    assert all((r.doc_id, r.text, r.source, r.n_chars) in rows for r in got)  # whole documents, null ids too
    want = Counter((r.doc_id, r.source, r["size"]) for r in mixed.collect() if 2 * r.words >= r["size"])
    size = {k: len([w for w in (t or "").replace("\x0b", " ").replace("\t", " ").split(" ") if w]) for k, t in texts.items()}
    assert Counter((r.doc_id, r.source, size[r.doc_id, r.source] if r.doc_id is not None else len(r.text.split())) for r in got) == want
    taken = Counter()
    for (_, source, n), count in want.items():
        taken[source] += n * count
    longest = {s: max(n for (_, x), n in size.items() if x == s) for s in taken}
    for r in targets.collect():
        assert abs(taken[r.source] - r.target) <= longest.get(r.source, 0) / 2 + 1
