import tracemalloc
import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from departure_risk.llm import gru, lm
from llm.conftest import sentence, table


def plain_score(net, text, start):
    """One step at a time, written from the definition."""
    h, members = net["state"].shape[0], net["word"].shape[2]
    state, total, before = np.zeros(h), 0.0, start
    for word in text:
        given, own = net["input"][before], state @ net["state"]
        keep, let = (1 / (1 + np.exp(-(given[a:b] + own[a:b] + net["bias"][a:b]))) for a, b in ((0, h), (h, 2 * h)))
        new = np.tanh(given[2 * h:] + net["bias"][2 * h:] + let * own[2 * h:])
        state = (1 - keep) * new + keep * state
        of_class = state @ net["class"] + net["class_bias"]
        of_word = state @ net["word"][word // members] + net["word_bias"][word // members]
        total += of_class[word // members] - np.log(np.exp(of_class).sum()) + of_word[word % members] - np.log(np.exp(of_word).sum())
        before = word
    return total


SHAPE = gru.Shape(5, 4, 3)


@pytest.mark.parametrize("most, window", [(1, 4), (3, 2), (100, 1000)])
def test_scores_against_one_step_at_a_time(most, window):
    rng = np.random.default_rng(1)
    net = {k: v + rng.normal(0, 0.5, v.shape) for k, v in gru.new_net(SHAPE, np.arange(12.0)).items()}
    texts = [rng.integers(0, 12, n) for n in (1, 7, 30, 2, 2, 11, 1)]
    got = gru.score(net, texts, 0, most=most, window=window)
    assert got == pytest.approx([plain_score(net, t, 0) for t in texts], rel=1e-4)


def test_one_very_long_text_beside_short_ones():
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 12, 40) for _ in range(500)] + [rng.integers(0, 12, 1_000_000)]
    tracemalloc.start()
    laid = gru.Lanes(texts, 512, 0)
    read = [sum(int(laid.window(at, 32)[4].sum()) for at in range(0, laid.steps, 32)), tracemalloc.get_traced_memory()[1] / 2**20]
    tracemalloc.stop()
    assert read[0] == 1_020_000 and read[1] < 100


def test_every_word_is_laid_out_once_behind_the_one_before():
    rng = np.random.default_rng(5)
    texts = [rng.integers(1, 12, n) for n in (9, 0, 33, 4, 4, 1, 17)]
    laid, seen = gru.Lanes(texts, 3, 0), {i: [] for i in range(len(texts))}
    for at in range(0, laid.steps, 5):
        inputs, targets, starts, text, active = laid.window(at, 5)
        for t, n in enumerate(active):
            for lane in range(n):
                number = int(text[t, lane])
                assert inputs[t, lane] == (seen[number][-1] if seen[number] else 0) and starts[t, lane] == (not seen[number])
                seen[number].append(int(targets[t, lane]))
    assert all(seen[i] == t.tolist() for i, t in enumerate(texts))


def test_gradients_against_differences():
    rng = np.random.default_rng(2)
    net = {k: v.astype(np.float64) + rng.normal(0, 0.3, v.shape) for k, v in gru.new_net(SHAPE, np.arange(12.0)).items()}
    texts = [rng.integers(0, 12, n) for n in (7, 3, 5, 1)]
    inputs, targets, starts, _, active = gru.Lanes(texts, 3, 0).window(0, 100)

    def of(net):
        return gru.gradients(net, np.zeros((inputs.shape[1], 5)), inputs, targets, starts, active)

    grads, _ = of(net)
    for k, g in grads.items():
        at, e = np.unravel_index(np.abs(g).argmax(), g.shape), 1e-4
        up, down = ({**net, k: net[k].copy()} for _ in range(2))
        up[k][at] += e
        down[k][at] -= e
        assert g[at] == pytest.approx((of(up)[1] - of(down)[1]) / (2 * e) / 16, rel=2e-2, abs=1e-6)


def test_training_learns_an_order_of_words():
    texts = [np.array([1, 2, 3, 4, 5, 6] * 5) for _ in range(40)]
    net = gru.new_net(SHAPE, np.ones(12))
    before = gru.score(net, texts[:1], 0)[0]
    gru.train(net, texts, 0, epochs=30, most=8, window=10, rate=2e-2)
    assert gru.score(net, texts[:1], 0)[0] > before / 3


def words(text):
    return [*(text or "").encode().lower().split(), None]


def check(spark, rows, **options):
    got = lm.scores(table(spark, rows).repartition(3), shape=gru.Shape(6, 4, 4), epochs=1, **options).collect()
    fold = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = collections.Counter(w for i, t in rows if i is not None and not fold[i] for w in words(t))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words(t))
        want.append((i, fold[i], len(words(t)), sum(counts[w] > 0 for w in words(t)), total, round(base, 6)))
    key = lambda x: (repr(x[0]), x[5])
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=key) == sorted(want, key=key)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    return got


def corpus():
    rng = np.random.default_rng(4)
    rows = [(i, sentence(rng, int(n)) + f" Rare{i} RARE{i % 9}") for i, n in enumerate(rng.integers(1, 80, 120))]
    return rows + [(1000, None), (1001, ""), (1002, "\n"), (1003, "never seen words at all " * 40), (1004, sentence(rng, 3000)), (5, rows[5][1]), (None, "no id here"), (None, None)]


@pytest.mark.parametrize("known", [1_000_000, 20, 1])
def test_counts_and_base_scores(spark, known):
    check(spark, corpus(), known=known)


def test_scores_of_all_words_add_up_to_one(spark):
    """A one-word text of each known word and of an unknown one: probabilities of the first token."""
    rows = corpus()
    vocabulary = sorted({w for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for w in words(t)[:-1]})
    counts = lm.written_once(lm.word_counts(table(spark, [(i, t) for i, t in rows if i is not None and t is not None and zlib.crc32(str(i).encode()) % 7 != 2])), "counts")
    found, of_id = lm.vocabulary(counts, 16, 1_000_000)
    net = gru.new_net(gru.Shape(6, 4, 4), of_id)
    import pyarrow as pa

    keys = lm.text_words(pa.array([w.decode() for w in vocabulary]))[0][::2]
    ids = lm.network_ids(np.append(keys, lm.END), found)
    place = found.place(np.append(keys, lm.END))
    chance = np.exp(gru.score(net, [np.array([i]) for i in ids], found.end))
    share = np.where(ids == found.other, 10 ** found.log_base(found.counts[place]) / found.left_over, 1.0)
    unseen = np.exp(gru.score(net, [np.array([found.other])], found.end))[0] * 10 ** found.log_base(np.array([0]))[0] / found.left_over
    unused = sum(np.exp(gru.score(net, [np.array([i])], found.end))[0] for i in range(16) if i not in set(ids))
    assert (chance * share).sum() + unseen + unused == pytest.approx(1.0, abs=1e-5)


def test_the_network_beats_word_counts_on_held_out_texts(spark):
    rng = np.random.default_rng(6)
    cycle = "one two three four five six seven eight nine ten".split()
    rows = [(i, " ".join(cycle[(int(a) + k) % 10] for k in range(60))) for i, a in enumerate(rng.integers(0, 10, 400))]
    got = lm.scores(table(spark, rows), shape=gru.Shape(12, 4, 4), epochs=40).collect()
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > 0.5 * sum(r.base_score for r in held)


@pytest.mark.parametrize("step_words", [1, 100])
def test_the_corpus_pass_learns_from_all_words_with_the_state_carried(spark, step_words):
    rng = np.random.default_rng(8)
    texts = [sentence(rng, n) for n in (150, 71, 5)]  # the longest first: their order in one lane
    rows = table(spark, list(enumerate(texts))).coalesce(1)
    vocab, of_id = lm.vocabulary(lm.word_counts(rows), 12, 1000)
    net = gru.new_net(SHAPE, of_id)
    got = lm.averaged(net, rows, spark.sparkContext.broadcast(vocab), 1e-2, 1, step_words)
    ids = [lm.network_ids(lm.text_words(pa.array([t]))[0], vocab) for t in texts]
    targets = np.concatenate(ids)
    starts = np.zeros(len(targets), bool)
    starts[np.cumsum([0] + [len(t) for t in ids[:-1]])] = True
    inputs = np.where(starts, vocab.end, np.roll(targets, 1))
    want = {k: v.copy() for k, v in net.items()}
    adam, state, waiting, total = gru.Adam(want, 1e-2), np.zeros((1, 5), np.float32), 0, {}
    for at in range(0, len(targets), 32):
        part = slice(at, at + 32)
        n = len(targets[part])
        grads, _ = gru.gradients(want, state, inputs[part, None], targets[part, None], starts[part, None], np.ones(n, int))
        total, waiting = {k: total.get(k, 0) + g * n for k, g in grads.items()}, waiting + n
        if waiting >= step_words or at + 32 >= len(targets):
            adam.apply({k: g / waiting for k, g in total.items()}, 0.0)
            total, waiting = {}, 0
    for k in net:
        assert got[k] == pytest.approx(want[k], abs=1e-5), k
        assert not np.allclose(got[k], net[k], atol=1e-3), k


def test_without_training_texts_and_empty_tables(spark):
    check(spark, [(None, "a b"), (None, None)])
    assert lm.scores(table(spark, [])).isEmpty()


def test_windows_add_to_what_is_gathered(monkeypatch):
    """Gradients of summed losses are added in place, the same in blocks of any size, also where few lanes are left."""
    rng = np.random.default_rng(8)
    net = gru.new_net(gru.Shape(5, 4, 6), rng.integers(1, 90, 24))
    texts = [np.minimum(rng.geometric(0.2, n) - 1, 23).astype(np.int32) for n in (90, 7, 30, 1, 12)]
    words = sum(map(len, texts))
    together, arrays = {}, set()
    for n, _ in gru.windows(net, texts, 0, 3, 8, together):
        arrays |= {id(g) for g in together.values()}
    assert len(arrays) == len(net)
    whole, _ = gru.gradients(net, np.zeros((3, 5), np.float32), *_as_one_window(texts, 3))
    alone = {k: np.zeros_like(v) for k, v in net.items()}
    gru.gradients(net, np.zeros((3, 5), np.float32), *_as_one_window(texts, 3), alone)
    for k in net:
        np.testing.assert_allclose(alone[k], whole[k] * words, rtol=1e-4, atol=1e-5)
    scores = gru.score(net, texts, 0)
    monkeypatch.setattr(gru, "ROWS", 3)
    small: dict = {}
    assert sum(n for n, _ in gru.windows(net, texts, 0, 3, 8, small)) == words
    for k in net:
        np.testing.assert_allclose(small[k], together[k], rtol=1e-4, atol=1e-5)
    np.testing.assert_allclose(gru.score(net, texts, 0), scores, rtol=1e-6)


def _as_one_window(texts, most):
    laid = gru.Lanes(texts, most, 0)
    inputs, targets, starts, _, active = laid.window(0, laid.steps)
    return inputs, targets, starts, active
