import numpy as np
import pytest
from pyspark.sql import functions as F

from departure_risk.plans import boosting

COLUMNS, CATEGORIES, MISSING = ["kind", "a", "b", "noise"], {"kind": 12}, -9999.0


def made(n, seed):
    rng = np.random.default_rng(seed)
    kind, a, b, noise = rng.integers(0, 13, n).astype(float), rng.integers(0, 40, n).astype(float), rng.normal(0, 1, n), rng.random(n)
    b[rng.random(n) < 0.25] = MISSING
    odds = -1.5 + 1.6 * np.isin(kind, [1, 4, 7, 11]) + 0.05 * a + np.where(b == MISSING, 1.2, b * (a > 20))
    label = (rng.random(n) < 1 / (1 + np.exp(-odds))).astype(int)
    return np.column_stack([kind, a, b, noise]), label


def prepared(spark, n=3000, partitions=4, bins=20):
    parts = [made(n, 1), made(n // 3, 2)]
    frames = [spark.createDataFrame([(x.tolist(), int(y), i) for i, (x, y) in enumerate(zip(*p))], "inputs array<double>, label long, id long").repartition(
        partitions).select("inputs", "label", F.xxhash64("id").alias("key")) for p in parts]
    named = frames[0].select(*[F.col("inputs")[i].alias(c) for i, c in enumerate(COLUMNS)])
    booster = boosting.find_cuts(named, COLUMNS, COLUMNS, CATEGORIES, MISSING, bins)
    rate = parts[0][1].mean()
    booster.base = float(np.log(rate / (1 - rate)))
    blocks = boosting.blocks_of(frames[0], booster, False).unionByName(boosting.blocks_of(frames[1], booster, True))
    return boosting.written_once(blocks, "test-blocks"), booster, parts


def plain_split(bins, g, h, booster, column, leaf_rows):
    """The best gain of a column by trying every way to part it that is allowed."""
    last = booster.bins_of(column) - 1
    if booster.cuts[column] is None:
        used = [b for b in range(last + 1) if (bins == b).any()]
        used.sort(key=lambda b: (g[bins == b].sum() / (h[bins == b].sum() + 20.0), b))
        ways, penalty = [used[:k] for k in range(1, len(used))], 10.0
    else:
        ways, penalty = [[*range(c + 1), *also] for c in range(last) for also in ([], [last])] + [[last]], 0.0
    best = 0.0
    for way in ways:
        left = np.isin(bins, way)
        if min(left.sum(), (~left).sum()) >= leaf_rows and min(h[left].sum(), h[~left].sum()) >= 1e-3:
            best = max(best, sum(g[s].sum() ** 2 / (h[s].sum() + penalty) for s in (left, ~left)) - g.sum() ** 2 / h.sum())
    return best


def plain_tree(bins, g, h, booster, leaves, leaf_rows):
    """Best leaf first, one split at a time: the gains in order and the leaf of every row."""
    open_leaves, gains = [np.ones(len(g), bool)], []

    def option(rows):
        return max((plain_split(bins[c][rows], g[rows], h[rows], booster, c, leaf_rows), -c) for c in range(len(COLUMNS)))

    options = [option(open_leaves[0])]
    while len(open_leaves) < leaves and max(options)[0] > 1e-12:
        at = options.index(max(options, key=lambda o: o[0]))
        gains.append(options[at])
        rows, (_, column) = open_leaves.pop(at), options.pop(at)
        for half in halves(bins, g, h, booster, rows, -column, leaf_rows):
            open_leaves.append(half)
            options.append(option(half))
    return gains


def halves(bins, g, h, booster, rows, column, leaf_rows):
    own = bins[column][rows]
    size = booster.bins_of(column)
    units = [np.bincount(own, np.rint(x[rows] * boosting.UNIT), size).astype(np.int64) for x in (g, h)]
    split = boosting.best_split(*units, np.bincount(own, minlength=size), booster.cuts[column] is None, leaf_rows)
    left = rows & np.isin(bins[column], split["left_bins"])
    return left, rows & ~left


@pytest.fixture(scope="module")
def data(spark):
    return prepared(spark)


def test_one_tree_is_the_one_that_single_splits_give(data):
    blocks, booster, ((inputs, label), _) = data
    tree, seen = boosting.grown(blocks, booster, [], [0, 1, 2, 3], 0, 12, 1.0, 60, 7)
    bins = booster.binned(inputs)
    p = 1 / (1 + np.exp(-booster.base))
    g, h = np.rint((p - label) * boosting.UNIT) / boosting.UNIT, np.full(len(label), np.rint(p * (1 - p) * boosting.UNIT) / boosting.UNIT)
    wanted = plain_tree(bins, g, h, booster, 12, 60)
    got = sorted(((tree.gain[i], -tree.column[i]) for i in range(len(tree.left)) if tree.left[i] >= 0), reverse=True)
    assert len(got) == len(wanted) == 11
    assert [c for _, c in got] == [c for _, c in sorted(wanted, reverse=True)]
    assert np.allclose([x for x, _ in got], sorted((x for x, _ in wanted), reverse=True), rtol=1e-9)
    ends = tree.leaf_of(bins, booster.most_bins)
    assert all(tree.left[i] < 0 for i in set(ends)) and min(np.bincount(ends)[np.unique(ends)]) >= 60
    for leaf in set(ends):
        assert tree.value[leaf] == pytest.approx(-0.05 * g[ends == leaf].sum() / h[ends == leaf].sum())
    assert seen[2] == len(label)


def test_training_stops_after_the_best_and_does_not_depend_on_partitions(spark, data):
    blocks, booster, (_, (inputs, label)) = data
    options = dict(most=25, leaves=8, patience=4, leaf_rows=60)
    first = boosting.boost(blocks, booster, COLUMNS, **options)
    again = boosting.boost(blocks.repartition(2), booster, COLUMNS, **options)
    assert [vars(t) for t in first.trees] == [vars(t) for t in again.trees] and first.losses == again.losses
    # the losses that were kept up are those of the trees
    raw = first.raw(inputs)
    assert first.losses[len(first.trees)] == pytest.approx(np.mean(np.logaddexp(0, raw) - label * raw), abs=1e-7)
    assert first.losses[len(first.trees)] == min(first.losses) < 0.95 * first.losses[0]
    assert len(first.losses) - 1 - len(first.trees) in (4, 25 - len(first.trees))
    gains = first.gains()
    assert gains["kind"] > gains["noise"] and gains["a"] > gains["noise"]


def test_only_the_asked_columns_and_saved_trees(spark, data, tmp_path):
    blocks, booster, (_, (inputs, _)) = data
    model = boosting.boost(blocks, booster, ["a", "kind"], most=3, leaves=5, leaf_rows=60)
    assert {COLUMNS[c] for t in model.trees for c, left in zip(t.column, t.left) if left >= 0} <= {"a", "kind"}
    model.save(spark, str(tmp_path / "trees"))
    same = boosting.Booster.load(spark, str(tmp_path / "trees"))
    assert same == model
    odd = np.array([[99.0, 5.0, MISSING, 0.5], [3.0, -1e9, 1e9, 0.0], [12.0, MISSING, MISSING, MISSING]])
    rows = spark.createDataFrame([(x.tolist(),) for x in [*inputs[:50], *odd]], "inputs array<double>")
    got = [r[0] for r in rows.select(model.probability(spark, F.col("inputs"))).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-model.raw(np.vstack([inputs[:50], odd])))))


def test_rows_without_a_split_give_the_base_rate(spark):
    blocks, booster, _ = prepared(spark, n=150)
    model = boosting.boost(blocks, booster, COLUMNS, leaf_rows=100)
    assert model.trees == [] and len(model.losses) == 1


@pytest.mark.parametrize("node_rows", [0, 700, 1 << 18])
def test_small_leaves_are_opened_in_one_pass(data, monkeypatch, node_rows):
    """F1 to F5: a tree took a pass over all blocks for every level."""
    blocks, booster, (_, (inputs, _)) = data
    rows = 3000
    monkeypatch.setattr(boosting, "NODE_ROWS", 0)
    wanted = [boosting.grown(blocks, booster, [], [0, 1, 2, 3], i, 20, 0.8, 40, 7, rows) for i in (0, 1)]
    monkeypatch.setattr(boosting, "NODE_ROWS", node_rows)
    passes, whole = [], boosting.splits
    monkeypatch.setattr(boosting, "splits", lambda *a: passes.append(a[4]) or whole(*a))
    bins = booster.binned(inputs)
    for i, (tree, seen) in enumerate(wanted):
        again, seen_again = boosting.grown(blocks, booster, [], [0, 1, 2, 3], i, 20, 0.8, 40, 7, rows)
        assert seen == seen_again
        assert sorted(g for g, x in zip(again.gain, again.left) if x >= 0) == sorted(g for g, x in zip(tree.gain, tree.left) if x >= 0)
        assert np.array_equal(again.values(bins, booster.most_bins), tree.values(bins, booster.most_bins))
    assert len(passes) == 2 if node_rows > rows else len(passes) > 4


def test_fits_in_memory_are_those_of_single_passes(spark, data, monkeypatch):
    """F2 to F6: every level of every tree read all blocks in a job of its own."""
    blocks, booster, (_, (inputs, _)) = data
    sets, options = {"all": COLUMNS, "two": ["a", "kind"]}, dict(most=6, leaves=12, patience=3, leaf_rows=40)
    passes, whole = [], boosting.splits
    monkeypatch.setattr(boosting, "splits", lambda *a: passes.append(a[4]) or whole(*a))
    held = boosting.boost_held(blocks, booster, sets, **options)
    assert not passes
    monkeypatch.setattr(boosting, "holders", lambda *a: 0)
    assert boosting.boost_held(blocks, booster, sets, **options) is None
    for node_rows in (0, boosting.NODE_ROWS):
        monkeypatch.setattr(boosting, "NODE_ROWS", node_rows)
        for name, columns in sets.items():
            plain = boosting.boost(blocks, booster, columns, **options)
            assert plain.losses == held[name].losses and len(plain.trees) == len(held[name].trees)
            assert np.array_equal(plain.raw(inputs), held[name].raw(inputs)) and plain.gains() == pytest.approx(held[name].gains(), rel=1e-12)
    assert passes


def test_blocks_that_do_not_fit_are_read_pass_by_pass(spark, data, monkeypatch):
    blocks, booster, _ = data
    assert boosting.holders(blocks, booster, 1) > 1
    monkeypatch.setattr(boosting, "HELD_BYTES", 10_000)
    assert boosting.holders(blocks, booster, 1) == 0


def test_the_best_column_is_that_of_single_columns():
    rng = np.random.default_rng(11)
    for _ in range(100):
        cuts = [None if rng.random() < 0.3 else [float(x) for x in range(rng.integers(0, 30))] for _ in range(5)]
        booster = boosting.Booster([*"abcde"], cuts, [int(rng.integers(1, 20)) if c is None else 0 for c in cuts], MISSING)
        n, sums = int(rng.integers(0, 300)), []
        weights = np.rint(rng.normal(0, 0.4, n) * boosting.UNIT), np.rint(rng.random(n) * 0.2 * boosting.UNIT), None
        for c in range(5):
            size = booster.bins_of(c)
            of = rng.integers(0, size, n) * (rng.random() < 0.5 or rng.integers(0, 2, n))
            sums.append(np.stack([np.bincount(of, w, size).astype(np.int64) for w in weights]))
        options = [(-s["gain"], c) for c in range(5) if (s := boosting.best_split(*sums[c], cuts[c] is None, 20))]
        assert boosting.best_columns([np.concatenate(sums, axis=1)], booster, [0, 1, 2, 3, 4], 20) == [min(options)[1] if options else None]
