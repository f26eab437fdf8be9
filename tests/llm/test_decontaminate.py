import numpy as np
import pytest

from departure_risk.llm import decontaminate
from llm.conftest import sentence, table, values

ITEMS = "item_id long, text string"


def words(text):
    return [w for w in (text or "").lower().replace("\n", " ").replace("\t", " ").split(" ") if w]


def brute(docs, items, least=10):
    """All alignments of every seed hit, by lists."""
    masks = [[i for i, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
    first = {}
    for item, text in items:
        w = tuple(words(text))
        if item is not None and len(w) >= decontaminate.SHORTEST:
            first[w] = min(first.get(w, item), item)
    found = {}
    for doc, text in docs:
        d = words(text)
        for w, item in first.items():
            windows = [(kind, p) for kind in masks for p in range(len(w) - decontaminate.SPAN + 1)]
            if len(w) < 12:
                n = len(w) if len(w) < 8 else len(w) // 2
                windows += [(range(n), 0), (range(n), len(w) - n)]
            for diagonal in range(-len(w), len(d)):
                both = range(max(0, -diagonal), min(len(w), len(d) - diagonal))
                hits = any(all(0 <= p + k + diagonal < len(d) and p + k < len(w) and w[p + k] == d[p + k + diagonal] for k in kind)
                           for kind, p in windows)
                if not hits:
                    continue
                now = best = 0
                for p in both:
                    now = max(0, now + (1 if w[p] == d[p + diagonal] else -1))
                    best = max(best, now)
                if best >= min(least, len(w) if len(w) < 8 else len(w) - 2):
                    found[doc, item] = max(found.get((doc, item), 0), best)
    return sorted(((d, i, n) for (d, i), n in found.items()), key=repr)


def swapped(rng, text, share):
    return " ".join(f"new{rng.integers(1000)}" if rng.random() < share else w for w in text.split(" "))


def fixture():
    rng = np.random.default_rng(17)
    items = [(i, sentence(rng, int(n))) for i, n in enumerate([40, 25, 30, 12, 60, 35])]
    items += [(20, "five words make one item"), (21, "seven words are the whole of this"), (22, "too few words"), (23, items[0][1]), (24, None),
              (25, ""), (26, items[1][1].upper()), (None, sentence(rng, 30))]
    docs = [(i, sentence(rng, 50)) for i in range(20)]
    for i, (_, text) in enumerate(items[:6]):
        docs += [(100 + i, sentence(rng, 8) + " " + text + " " + sentence(rng, 30)), (110 + i, text), (120 + i, swapped(rng, text, 0.15) + "\n" + sentence(rng, 5)),
                 (130 + i, sentence(rng, 3) + "\t" + " ".join(text.split()[:14]).title()), (140 + i, " ".join(text.split()[-11:]))]
    docs += [(200, "before five words make one item after"), (201, "Seven words\nare THE whole of this"), (202, "too few words"), (203, None), (204, ""),
             (205, "seven words are a whole of this"), (None, items[0][1]), (101, items[4][1]), (300, " ".join([items[2][1]] * 30)), (301, "the " * 3000)]
    return docs, items


@pytest.mark.parametrize("seed_rows", [1_000_000, 60])
def test_overlaps_against_all_alignments(spark, seed_rows):
    docs, items = fixture()
    got = values(decontaminate.overlaps(table(spark, docs), table(spark, items, ITEMS), seed_rows=seed_rows), "doc_id", "item_id", "overlap")
    want = [r for r in brute([d for d in docs if d[0] is not None], items)]
    assert got == want
    leaked = {d for d, _, _ in got}
    assert {100 + i for i in range(6)} | {110 + i for i in range(6)} | {120, 124} | {200, 201, 300, 101} <= leaked
    assert not leaked & ({*range(20)} | {202, 203, 204, 205, 301})


def test_replaced_words_are_tolerated(spark):
    rng = np.random.default_rng(4)
    items = [(i, sentence(rng, 40)) for i in range(30)]
    docs = [(i, sentence(rng, 20) + " " + swapped(rng, t, 0.2) + " " + sentence(rng, 20)) for i, t in items]
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(table(spark, docs), table(spark, items, ITEMS)).collect()}

    def stretch(i):
        now = best = 0
        for a, b in zip(items[i][1].split(), docs[i][1].split()[20:60]):
            now = max(0, now + (1 if a == b else -1))
            best = max(best, now)
        return best

    enough = {(i, i) for i in range(30) if stretch(i) >= 10}
    assert len(enough) > 25 and enough <= got


def test_a_very_long_item_and_a_passage_in_most_documents(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 64)
    rng = np.random.default_rng(5)
    long, common = sentence(rng, 700), sentence(rng, 30)
    docs = [(i, sentence(rng, 10) + " " + common) for i in range(200)] + [(500 + at, " ".join(long.split()[at:at + 25])) for at in range(0, 675, 9)]
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(table(spark, docs), table(spark, [(1, long), (2, common)], ITEMS)).collect()}
    assert {(i, 2) for i in range(200)} <= got and {(d, 1) for d, _ in docs[200:]} <= got


def test_the_end_of_a_very_long_item_needs_as_much_as_the_rest(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 64)
    lengths = [64 + 7, 84, 85, 128 + 5, 148, 149]
    items = [(i, " ".join(f"w{i}x{k}" for k in range(n))) for i, n in enumerate(lengths)]
    docs = [(10 * i + 1, "before " + " ".join(t.split()[at:])) for i, t in items for at in [64 * ((lengths[i] - 1) // 64)] if lengths[i] - at < 10]
    assert [d for d, _ in docs] == [1, 31]
    whole = [(1000 + i, t) for i, t in items] + [(2000 + i, " ".join(t.split()[-10:])) for i, t in items]
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(table(spark, docs + whole), table(spark, items, ITEMS)).collect()}
    assert got == {(1000 + i, i) for i, _ in items} | {(2000 + i, i) for i, _ in items}


def test_empty_tables(spark):
    docs, items = fixture()
    assert decontaminate.overlaps(table(spark, []), table(spark, items, ITEMS)).isEmpty()
    assert decontaminate.overlaps(table(spark, docs), table(spark, [], ITEMS)).isEmpty()


def test_the_rest_keeps_its_columns(spark):
    docs, items = fixture()
    docs += [(None, "nothing of a test"), (None, None), (None, "say " + items[3][1])]
    rows = table(spark, docs)
    kept = decontaminate.decontaminated(rows, table(spark, items, ITEMS))
    leaked = {d for d, _, _ in brute([d for d in docs if d[0] is not None], items)}
    leaked_texts = {t for d, t in docs if d is None and brute([(0, t)], items)}  # rows without an id go by their text
    assert len(leaked_texts) == 2
    assert kept.columns == rows.columns
    assert values(kept, "doc_id", "text") == sorted(((d, t) for d, t in docs if d not in leaked and (d is not None or t not in leaked_texts)), key=repr)


def test_one_replaced_word_of_a_short_item(spark):
    rng = np.random.default_rng(21)
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in range(5, 20)]
    docs = []
    for n, text in items:
        own = text.split()
        docs += [(100 * n + at, " ".join([sentence(rng, 6), *own[:at], "other", *own[at + 1:], sentence(rng, 6)])) for at in range(n)]
    found = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(table(spark, docs), table(spark, items, ITEMS)).collect()}
    assert found == {(d, i) for d, i, _ in brute(docs, items)} == {(d, d // 100) for d, _ in docs if d // 100 >= 8}


def test_one_word_over_and_over(spark):
    n = 500
    got = decontaminate.overlaps(table(spark, [(1, "na " * n), (2, "na " * 9)]), table(spark, [(7, "na " * n)], ITEMS))
    assert values(got, "doc_id", "item_id", "overlap") == [(1, 7, n)]
