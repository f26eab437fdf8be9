import numpy as np
import pytest

from departure_risk.llm import linededup
from llm.conftest import sentence, table, values


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute(docs, shortest=6):
    """Removed lines by comparing every line with every line before it."""
    lines = sorted((d, n, linededup.words_of(line)) for d, t in docs if d is not None and t is not None for n, line in enumerate(t.split("\n")))
    gone = {}
    for i, (d, n, w) in enumerate(lines):
        for e, m, v in lines[:i]:
            near = min(len(w), len(v)) >= shortest and abs(len(w) - len(v)) < 2 and distance(w, v) <= 1
            if w and (e, m) < (d, n) and (w == v or near):
                gone.setdefault(d, set()).add(n)
                break
    out = []
    for d in {d for d, _ in docs if d is not None}:
        own = {n for e, n, _ in lines if e == d}
        out.append((d, len(own), len(gone.get(d, ())), ",".join(map(str, sorted(gone.get(d, ()))))))
    return sorted(out, key=repr)


def corpus():
    rng = np.random.default_rng(12)
    lines = [sentence(rng, int(n)) for n in rng.integers(1, 14, 40)]
    docs = []
    for i in range(60):
        text = []
        for line in rng.choice(lines, 5):
            w = line.split()
            kind = rng.integers(6)
            if kind == 1:
                w[int(rng.integers(len(w)))] = "changed"
            elif kind == 2:
                w.insert(int(rng.integers(len(w) + 1)), "added")
            elif kind == 3:
                del w[int(rng.integers(len(w)))]
            elif kind == 4:
                w = [x.upper() for x in w] + ["two", "more"]
            text.append(("  " if kind == 5 else "") + " ".join(w))
        docs.append((i * 7 % 61, "\n".join(text)))
    rows = [(200 + i, f"this page was seen by reader number {i}\nother text {i}") for i in range(30)]
    return docs + rows + [(300, None), (301, ""), (302, "\n\n \t\n"), (303, "short line\nshort line\nSHORT  LINE"), (None, docs[0][1]), (304, "w " * 3000),
                          (305, "w " * 2999), (306, "w " * 2997), (400, docs[1][1]), (401, "a b c d e f\na b c d e\nb a c d e f\na b c d e f g h")]


@pytest.mark.parametrize("partitions", [1, 6])
def test_against_every_pair_of_lines(spark, partitions):
    docs = corpus()
    got = values(linededup.line_report(table(spark, docs).repartition(partitions)), "doc_id", "n_lines", "n_removed", "removed")
    assert got == brute(docs)


def test_rows_that_repeat_an_id_share_their_places(spark):
    docs = [(1, "the first line of this document\nx"), (1, "the first line of this document\nx"), (2, "the first line of this document")]
    got = {r.doc_id: r for r in linededup.line_report(table(spark, docs)).collect()}
    assert (got[1].n_removed, got[2].n_removed) == (0, 1)


def test_a_line_in_most_documents(spark):
    docs = [(i, f"all rights to this page are reserved\nown line {i}") for i in range(2000)]
    got = linededup.line_report(table(spark, docs)).collect()
    assert sorted(r.doc_id for r in got if r.n_removed == 0) == [0] and all(r.removed in ("", "0") for r in got)


def test_texts_lose_their_removed_lines(spark):
    docs = corpus()
    rows = table(spark, docs)
    out = linededup.deduplicated(rows)
    assert out.columns == rows.columns and out.count() == len(docs)
    gone = {d: {int(x) for x in r.split(",") if x} for d, _, _, r in brute(docs)}
    texts = dict(docs)
    for r in out.where("doc_id is not null").collect():
        t = texts[r.doc_id]
        assert r.text == (t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[r.doc_id]))


def test_empty_table(spark):
    assert linededup.line_report(table(spark, [])).isEmpty() and linededup.deduplicated(table(spark, [])).isEmpty()


def test_variant_keys_are_keys_of_the_shorter_line():
    import pyarrow as pa

    lines = linededup.Lines(pa.array(["a b c d", "x", "", "a b c d e"]))
    line, place, key = lines.variants()
    for number, text in enumerate(["a b c d", "x", "", "a b c d e"]):
        w = text.split()
        for i in range(len(w)):
            want = linededup.Lines(pa.array([" ".join(w[:i] + w[i + 1:])])).variants()[2][-1]
            assert key[(line == number) & (place == i)].tolist() == [want]
