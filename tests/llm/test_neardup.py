import numpy as np
import pyarrow as pa
import pytest

from departure_risk.llm import neardup, shingles
from llm.conftest import WORDS, sentence, table, values


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text, size=5):
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows):
    """doc_id, n_shingles, component_id, kept by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            linked = a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= 75 * len(a | b)
            if same_id or linked:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[find(i)] = min(smallest.get(find(i), doc), doc)
    out = [(doc, len(s), smallest[find(i)] if doc is not None else None) for i, ((doc, _), s) in enumerate(zip(rows, sets))]
    return sorted(((d, n, c, d is None or d == c) for d, n, c in out), key=repr)


def edited(rng, text, edits):
    w = text.split()
    for at in rng.integers(0, len(w), edits):
        w[at] = str(rng.choice(WORDS))
    return " ".join(w)


def corpus(seed=3):
    rng = np.random.default_rng(seed)
    bases = [sentence(rng, int(n)) for n in rng.integers(6, 160, 25)]
    rows = [(i, t) for i, t in enumerate(bases)]
    for i in range(25, 220):
        rows.append((i, edited(rng, bases[int(rng.integers(25))], int(rng.integers(0, 7)))))
    chain = sentence(rng, 60)
    for i in range(20):  # every copy is one edit from the one before it
        rows.append((300 + i, chain))
        chain = edited(rng, chain, 1)
    passage = sentence(rng, 60)
    rows += [(400 + i, passage + " " + sentence(rng, 60)) for i in range(40)]
    rows += [(500, None), (501, ""), (502, " \n\t "), (503, "one two"), (504, "ONE\ntwo"), (505, "one"), (506, "one two three four five"),
             (507, "One  two three\x0bfour five"), (508, "é À one two three"), (509, "É à one two three"), (510, sentence(rng, 20_000)),
             (511, "same " * 400), (512, "same " * 900), (513, bases[0]), (513, bases[0]), (513, bases[1]), (None, bases[2]), (None, None), (None, bases[2])]
    return rows


def found(rows, **options):
    return values(neardup.near_duplicates(rows, **options), "doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize("options", [{}, dict(node=6, depth=3), dict(node=8, depth=0)])
def test_against_all_pairs(spark, options):
    rows = corpus()
    assert found(table(spark, rows).repartition(5), **options) == brute(rows)


def test_a_group_around_a_document_that_few_share_with_each_other(spark):
    rng = np.random.default_rng(11)
    base = sentence(rng, 150)
    rows = [(1000, base)] + [(i, edited(rng, base, 5)) for i in range(150)] + [(2000 + i, sentence(rng, 30)) for i in range(50)]
    assert found(table(spark, rows), node=20) == brute(rows)


def test_copies_far_outnumber_the_rest(spark):
    rows = [(i, "a passage that was copied and copied and copied again") for i in range(3000, 0, -1)] + [(5000 + i, f"own text number {i} of some") for i in range(300)]
    got = neardup.near_duplicates(table(spark, rows)).collect()
    assert {r.doc_id for r in got if r.kept} == {1, *range(5000, 5300)} and all(r.component_id == 1 for r in got if r.doc_id <= 3000)


def test_empty_table(spark):
    assert neardup.near_duplicates(table(spark, [])).isEmpty()


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    docs = table(spark, rows)
    kept = neardup.deduplicated(docs)
    assert kept.columns == docs.columns
    stays = {d for d, _, _, k in brute(rows) if k and d is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(d for d in got if d is not None) == sorted(stays) and got.count(None) == 3


def test_components_of_any_graph(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(500 + i, 501 + i) for i in range(40)] + [(700, 700 + i) for i in range(90)]
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = dict(tuple(r) for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: r for x, r in root.items() if x != r}


def test_word_hashes_tell_words_apart():
    texts = ["Alpha beta", "", None, "ALPHA", " alpha\n\x0bx ", "x" * 5000 + " " + "x" * 5001, "ab c", "a bc", "é É", "abcdefgh abcdefghi", "aé"]
    h, bounds = shingles.word_hashes(pa.array(texts))
    assert np.diff(bounds).tolist() == [2, 0, 0, 1, 2, 2, 2, 2, 2, 2, 1]
    key = {}
    flat = [w for t in texts for w in words(t)]
    for w, x in zip(flat, h.tolist()):
        assert key.setdefault(w, x) == x
    assert len(set(key.values())) == len(key)
    part, _ = shingles.word_hashes(pa.array(texts).slice(3, 4))
    assert part.tolist() == h[2:2 + len(part)].tolist()


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = pa.array([" ".join("ab" * (n % 9) + "x" * (n % 700) for n in range(at, at + 40)) for at in range(0, 2000, 40)])
    h, bounds = shingles.word_hashes(texts)
    monkeypatch.setattr(shingles, "BLOCK", 7)
    again, same = shingles.word_hashes(texts)
    assert h.tolist() == again.tolist() and bounds.tolist() == same.tolist()


def test_minhash_estimates_similarity():
    a, b = np.arange(3000, dtype=np.uint64), np.arange(600, 3600, dtype=np.uint64)
    one, two = shingles.signature(shingles.mix(a)), shingles.signature(shingles.mix(b))
    assert abs((one == two).mean() - 2400 / 3600) < 0.2


def test_blocks_copy_a_class_a_few_times_and_let_every_two_labels_meet_once(spark):
    n, node = 600, 20
    # one large node of the last tree; half of its classes met in one node of an earlier tree, the others in many small ones
    last = [(1, 5, i, i // 2, n) for i in range(n)]
    before = [(2, 3, i, i // 2, n // 2) for i in range(n // 2)] + [(10 + i // 6, 3, i, i // 2, 6) for i in range(n // 2, n)]
    large = spark.createDataFrame(last + before, "task long, tree int, id long, label long, size long")
    rows = [r for r in neardup.blocks(large, node).collect() if r.tree == 5]
    assert len(rows) <= n * (n // (neardup.BLOCK_NODES * node) + 2)
    met, tasks = {i: 2 if i < n // 2 else 10 + i // 6 for i in range(n)}, {}
    for r in rows:
        tasks.setdefault(r.task, []).append(r)
    pairs = []
    for own in tasks.values():
        pairs += [tuple(sorted((a.id, b.id))) for i, a in enumerate(own) for b in own[:i]
                  if a.label != b.label and (a.side != b.side or not a.side) and (a.earlier != b.earlier or not a.earlier)]
    assert sorted(pairs) == [(a, b) for a in range(n) for b in range(a + 1, n) if a // 2 != b // 2 and met[a] != met[b]]


def test_texts_stay_where_they_are_while_few_documents_go(spark):
    rows = corpus()
    automatic = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables that are larger than it
    try:
        plan = neardup.deduplicated(table(spark, [r for r in rows if r[0] != 513]))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", automatic)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_nodes_that_branch_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "WHOLE_NODES", 1)
    rows = corpus()
    assert found(table(spark, rows).repartition(5), node=6, depth=3) == brute(rows)


def test_a_group_that_is_little_alike_is_not_copied_level_by_level(spark):
    rng = np.random.default_rng(5)
    # two of five classes share each value: too few to be alike, too many for a branch to part them
    minhash = np.where(rng.random((300, 64)) < 0.4, 7, rng.integers(100, 1 << 30, (300, 64)))
    minhash[:, 0] = 7
    classes = spark.createDataFrame([(i, i, m.tolist()) for i, m in enumerate(minhash)], "id long, label long, minhash array<int>")
    small, large, split = neardup.tree_nodes(classes, range(0, 1), 20, 8, True)
    rows = [r.id for r in small.collect()] + [r.id for r in large.collect()]
    assert sorted(rows) == list(range(300)) and split.isEmpty()
