import zlib

import numpy as np
import pytest

from departure_risk.llm import quality
from llm.conftest import sentence, table


def loss(net, chunks, counts, labels):
    out = 0.0
    at = 0
    for n, y in zip(counts, labels):
        hidden = []
        for chunk in chunks[at:at + n]:
            e = net["bytes"][chunk]
            best = np.full(quality.FILTERS, -np.inf)
            for w in range(quality.WINDOWS):
                window = e[w * quality.STEP:w * quality.STEP + quality.WIDTH].reshape(quality.PARTS, -1)
                value = sum(window[j] @ net["filters"][:, j * quality.FILTERS:(j + 1) * quality.FILTERS] for j in range(quality.PARTS))
                best = np.maximum(best, value)
            active = np.maximum(best + net["filter_bias"], 0)
            hidden.append(np.maximum(active @ net["hidden"] + net["hidden_bias"], 0))
        z = np.mean(hidden, axis=0) @ net["mean"] + np.max(hidden, axis=0) @ net["top"] + net["bias"][0]
        p = 1 / (1 + np.exp(-z))
        out -= np.log(p if y else 1 - p) / len(labels)
        at += n
    return out


@pytest.mark.parametrize("at_once", [1 << 18, 2 * quality.CHUNK])
def test_gradients_against_differences(monkeypatch, at_once):
    monkeypatch.setattr(quality, "AT_ONCE", at_once)
    rng = np.random.default_rng(0)
    counts, labels = np.array([3, 4]), np.array([0.0, 1.0])
    chunks = rng.integers(0, 256, (7, quality.CHUNK + quality.WIDTH)).astype(np.uint8)
    net = {k: v.astype(np.float64) for k, v in quality.new_network(1).items()}
    grads = quality._gradients(chunks, counts, labels, net)
    for k, g in grads.items():
        for place in np.argsort(-np.abs(g), axis=None)[:2]:
            at, e = np.unravel_index(place, g.shape), 1e-6
            up, down = ({**net, k: net[k].copy()} for _ in range(2))
            up[k][at] += e
            down[k][at] -= e
            assert g[at] == pytest.approx((loss(up, chunks, counts, labels) - loss(down, chunks, counts, labels)) / (2 * e), rel=1e-4, abs=1e-9)


def test_scores_against_chunk_by_chunk(monkeypatch):
    monkeypatch.setattr(quality, "AT_ONCE", 4 * quality.CHUNK)
    rng = np.random.default_rng(2)
    net = quality.new_network(3)
    texts = [b"", b"a", bytes(rng.integers(0, 256, quality.CHUNK)), *[bytes(rng.integers(0, 256, n)) for n in rng.integers(1, 9 * quality.CHUNK, 30)],
             bytes(rng.integers(0, 256, 40 * quality.CHUNK + 3))]
    got = quality.score_texts(texts, net)
    for text, p in zip(texts, got):
        chunks = np.frombuffer(quality.all_chunks(text), np.uint8).reshape(-1, quality.CHUNK + quality.WIDTH)
        assert -np.log(p) == pytest.approx(loss(net, chunks, [len(chunks)], [1]), abs=1e-4)


def corpus(n=700):
    rng = np.random.default_rng(8)
    good = [(i, sentence(rng, int(rng.integers(5, 200))) + ".") for i in range(0, n, 2)]
    bad = [(i, " ".join(f"{w.upper()}!!" for w in sentence(rng, int(rng.integers(5, 200))).split())) for i in range(1, n, 2)]
    return good + bad


def test_held_out_documents_are_told_apart(spark):
    docs = corpus()
    rows = table(spark, docs + [(5000, None), (5001, ""), (5002, "x" * 300_000), (None, "no id"), (3, "again")])
    labels = table(spark, [(i, int(i % 2 == 0)) for i, _ in docs] + [(None, 1), (77, None)], "doc_id long, quality int")
    net = quality.train(rows, labels)
    got = quality.scores(rows, net).collect()
    assert len(got) == len(docs) + 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    known = [r for r in got if r.held_out and r.doc_id < 5000]
    assert np.mean([r.predicted == (r.doc_id % 2 == 0) for r in known]) > 0.97
    again = quality.train(rows.repartition(6), labels)
    assert all(np.array_equal(net[k], again[k]) for k in net)
    kept = quality.accepted(rows, net)
    assert kept.columns == rows.columns and kept.count() == sum(r.predicted for r in got)


def test_whole_texts_of_the_sample_are_learned(spark, monkeypatch):
    rng = np.random.default_rng(4)
    docs = [(i, sentence(rng, int(rng.integers(1, 3000)))) for i in range(60)] + [(70, None), (71, ""), (1, "again")]
    given = []
    monkeypatch.setattr(quality, "fit", lambda samples: given.extend(samples))
    quality.train(table(spark, docs), table(spark, [(i, i % 2) for i in range(80)], "doc_id long, quality int"))
    parts = [(np.frombuffer(c, np.uint8).reshape(-1, quality.CHUNK + quality.WIDTH)[:, :quality.CHUNK].tobytes().rstrip(b"\0"), y) for c, y in given]
    assert sorted(parts) == sorted(((t or "").encode(), i % 2) for i, t in docs if zlib.crc32(str(i).encode()) % 5)


def test_held_out_labels_are_never_learned(spark):
    docs = corpus(200)
    flip = {i: int(i % 2 == 0) ^ int(zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in docs}
    one, two = (quality.train(table(spark, docs), table(spark, list(of.items()), "doc_id long, quality int"))
                for of in ({i: int(i % 2 == 0) for i, _ in docs}, flip))
    assert all(np.array_equal(one[k], two[k]) for k in one)


@pytest.mark.parametrize("labels", [[], [(0, 1), (2, 1)]])
def test_without_both_labels_nothing_is_rejected(spark, labels):
    rows = table(spark, corpus(20))
    net = quality.train(rows, table(spark, labels, "doc_id long, quality int"))
    assert quality.accepted(rows, net).count() == 20
    assert quality.scores(table(spark, []), net).isEmpty()
