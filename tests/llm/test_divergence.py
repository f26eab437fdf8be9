import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from departure_risk.llm import divergence
from llm.conftest import table

SCHEMA = "doc_id long, text string, lang string, source string"


def words_of(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(rows, least, top):
    counts, docs, groups = {}, {}, sorted({(r[2] or "", r[3] or "") for r in rows})
    for _, text, lang, source in rows:
        words = Counter(words_of(text))
        counts.setdefault((lang or "", source or ""), Counter()).update(words)
        docs.setdefault(lang or "", Counter()).update(words.keys())
    out = []
    for lang in docs:
        kept = [w for w, n in docs[lang].items() if n >= least]
        sources = [s for x, s in groups if x == lang]

        def shares(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + 10 ** 9 * (count[w] + 5) // (total + 5 * len(kept)) for w in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][w] - p[x][w]) for w in kept), x) for x in sources if x != s]
            terms = [(p[s][w] - q[w], w) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(found, key=lambda r: (-r[0], r[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ordered)]
    return sorted(out)


def audited(docs, **options):
    return sorted(tuple(r) for r in divergence.audit(docs, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def documents(n, seed=5):
    rng = np.random.default_rng(seed)
    vocabulary = [f"{a}{b}" for a in ["Al", "be", "ça", "Dé", "eX", "火", "zz"] for b in ["", "ra", "LO", "ñu", "q"]]
    sources = [f"src{i}" for i in range(9)] + [None, ""]
    out = []
    for i in range(n):
        source = int(min(rng.exponential(3), 10))
        weights = np.roll(1 / np.arange(1, len(vocabulary) + 1), source * 2)
        text = "".join(w + ["_", " ", "\n", "1", "@", "[", "\x7f"][rng.integers(7)] for w in rng.choice(vocabulary, int(rng.integers(0, 30)), p=weights / weights.sum()))
        out.append((i, text, ["en", "de", None, ""][int(rng.integers(4))], sources[source]))
    return out


@pytest.mark.parametrize("blocks", [dict(group_block=2, word_block=5), dict(group_block=3, word_block=1), {}])
def test_against_all_pairs(spark, blocks):
    rows = documents(400)
    assert audited(table(spark, rows, SCHEMA).repartition(3), least_docs=12, top_words=6, **blocks) == brute(rows, 12, 6)


def test_words_by_shuffling_and_counts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BROADCAST_WORDS", 3)
    monkeypatch.setattr(divergence, "HELD", 20)
    rows = documents(150, 6)
    assert audited(table(spark, rows, SCHEMA).repartition(2), least_docs=5, top_words=4, group_block=4, word_block=8) == brute(rows, 5, 4)


def test_defined_cases(spark):
    rows = [(None, None, None, None), (None, "", "", ""), (1, "x y", "en", "a"), (1, "x y", "en", "a"), (2, "X", "en", "b"), (3, "", "en", "c"),
            (4, "é" * 200_000 + " É", "fr", "a"), (5, "é", "fr", "b"), (6, "12 34", "de", "a"), (7, None, "de", None), (8, "x " * 50_000, "en", "d")]
    for least in (1, 2, 30):  # with 30, no language keeps a word
        assert audited(table(spark, rows, SCHEMA), least_docs=least) == brute(rows, least, 50)
    assert audited(table(spark, [], SCHEMA)) == []


def test_shares_beyond_64_bits(spark):
    cases = [(10 ** 13, 10 ** 14, 10 ** 6), (0, 10 ** 14, 10 ** 6), (7, 10, 3), (0, 0, 4), (0, 0, 0), (2 * 10 ** 9, 2 * 10 ** 9, 1)]
    rows = spark.createDataFrame(cases, "count long, total long, kept long")
    got = rows.select(divergence.share(F.col("count"), F.col("total"), F.col("kept"))).collect()
    assert [r[0] for r in got] == [1 + (10 ** 9 * (c + 5) // (n + 5 * v) if v else 0) for c, n, v in cases]
