"""Boosted trees for a yes/no label, grown best leaf first from histograms of gradients.

Rows are binned once and kept in blocks: numbers by exact quantiles, categories by their code, with a bin of its own for what is
missing. A pass over the blocks adds up gradients by (leaf, column, bin); one row per leaf and column, its best split, comes back
to the driver, which keeps the queue of leaves. A pass looks at all leaves that the queue would open next. The drawn rows of a
leaf of at most NODE_ROWS go to one task instead, which opens it and what is below by the same sums and a queue of its own. So a
tree takes about as many passes as larger leaves lie above each other, and is the same tree that one split at a time would give.

Where the blocks fit the memory of as many tasks as run at once, one barrier job does all passes of several fits: each task holds its
blocks, the tasks exchange their sums, and each keeps the same queues. Sums are of the smaller side of a split; the other side is what is left.

A missing number goes to the side that gains more. Categories are ordered by gradient per curvature and cut once.
Gradients are whole multiples of 1 / UNIT, so sums are exact and no result depends on how rows are dealt out. The share of
rows of a tree is drawn by a hash of the row's key. The validation loss of a tree is summed in the next tree's first pass;
training stops `patience` trees after the best one and keeps the trees up to it.
"""

import heapq
import json
import math
import time
import uuid
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from departure_risk.operators.quantiles import order_statistics
from departure_risk.session import shared_dir, written_once

# Learning rate, leaves of a tree, rows per leaf, share of rows and of columns per tree, smoothing of categories,
# seed, patience, most trees.
STEP, LEAVES, LEAF_ROWS = 0.05, 63, 100
ROW_SHARE, COLUMN_SHARE = 0.8, 0.8
CATEGORY_SMOOTHING = 20.0
SEED, PATIENCE, MOST_TREES = 7, 50, 2000

#: Least curvature of a side, penalty on a side chosen by categories.
LEAST_CURVATURE, CATEGORY_PENALTY = 1e-3, 10.0
#: Bins of a number, besides the one for missing values.
BINS = 255
UNIT = 1 << 24
BLOCK_ROWS = 65_536
#: Rows of a leaf (some 15 MB) that a task opens by itself, however many rows there are in all.
NODE_ROWS = 4 * BLOCK_ROWS
#: What stands for the column where rows of a leaf, or the leaves that a task opened, are meant.
INNER = -2
#: Trees that tasks add up themselves before the blocks are written with the sums.
PENDING = 5
#: Tasks that count at most: each sends a histogram per leaf and column. Leaves and columns a task then looks at.
MOST_TASKS, KEYS_A_TASK = 4096, 64
#: Tasks that hold blocks in memory at most (each gets the sums of all), and bytes in each; more blocks are read pass by pass.
MOST_HOLDERS, HELD_BYTES = 32, 256 << 20


@dataclass
class Tree:
    """Node 0 is the root; a node with left = -1 is a leaf. `left_bins` are the bins that go left."""

    column: list[int] = field(default_factory=list)
    left_bins: list[list[int]] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self) -> int:
        for of, empty in ((self.column, 0), (self.left_bins, []), (self.left, -1), (self.right, -1), (self.value, 0.0), (self.gain, 0.0)):
            of.append(empty)
        return len(self.left) - 1

    def leaf_of(self, bins: np.ndarray, most_bins: int) -> np.ndarray:
        """The node where each row (column of `bins`) ends."""
        out, open_nodes = np.zeros(bins.shape[1], np.int32), [(0, np.arange(bins.shape[1]))]
        while open_nodes:
            node, rows = open_nodes.pop()
            if self.left[node] < 0:
                out[rows] = node
            elif len(rows):
                goes_left = np.zeros(most_bins, bool)
                goes_left[self.left_bins[node]] = True
                is_left = goes_left[bins[self.column[node]][rows]]
                open_nodes += [(self.left[node], rows[is_left]), (self.right[node], rows[~is_left])]
        return out

    def values(self, bins: np.ndarray, most_bins: int) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(bins, most_bins)]


@dataclass
class Booster:
    """Columns, the cut points of numbers (None for a category), the number of categories, base score and trees."""

    columns: list[str]
    cuts: list[list[float] | None]
    categories: list[int]
    missing: float
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def bins_of(self, column: int) -> int:
        """Bins of a column; the last one is for missing numbers or unknown categories."""
        cuts = self.cuts[column]
        return self.categories[column] + 1 if cuts is None else len(cuts) + 2

    @property
    def most_bins(self) -> int:
        return max(self.bins_of(c) for c in range(len(self.columns)))

    def binned(self, inputs: np.ndarray) -> np.ndarray:
        """Bins of rows x columns, as columns x rows."""
        out = np.empty((len(self.columns), len(inputs)), np.uint16)
        for c, cuts in enumerate(self.cuts):
            values = inputs[:, c]
            if cuts is None:
                out[c] = np.minimum(values, self.categories[c])
            else:
                out[c] = np.where(values == self.missing, len(cuts) + 1, np.searchsorted(np.array(cuts), values))
        return out

    def raw(self, inputs: np.ndarray) -> np.ndarray:
        bins = self.binned(inputs)
        return reduce(np.add, (t.values(bins, self.most_bins) for t in self.trees), np.full(len(inputs), self.base))

    def gains(self) -> dict[str, float]:
        """What the splits on each column gained, over all trees."""
        total = dict.fromkeys(self.columns, 0.0)
        for tree in self.trees:
            for column, left, gain in zip(tree.column, tree.left, tree.gain):
                if left >= 0:
                    total[self.columns[column]] += gain
        return total

    def probability(self, spark: SparkSession, inputs: Column) -> Column:
        """The probability from an array of the columns' values."""
        shared = spark.sparkContext.broadcast(self)  # trees, not rows

        @F.pandas_udf("double")
        def score(rows: pd.Series) -> pd.Series:
            return pd.Series(1 / (1 + np.exp(-shared.value.raw(np.stack(rows.to_numpy()))))) if len(rows) else pd.Series(dtype=float)

        return score(inputs)

    def save(self, spark: SparkSession, path: str) -> None:
        head = {"columns": self.columns, "cuts": self.cuts, "categories": self.categories, "missing": self.missing, "base": self.base, "losses": self.losses}
        rows = [(-1, json.dumps(head)), *[(i, json.dumps(vars(t))) for i, t in enumerate(self.trees)]]
        spark.createDataFrame(rows, "number int, body string").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Booster":
        head, *trees = [json.loads(r.body) for r in spark.read.parquet(path).orderBy("number").collect()]
        return Booster(**head, trees=[Tree(**t) for t in trees])


def find_cuts(rows: DataFrame, inputs: list[str], columns: list[str], categories: dict[str, int], missing: float, bins: int = BINS) -> Booster:
    """A booster without trees: where numbers are cut. `inputs` are the names of the columns' values in `rows`."""
    numbers = [(c, i) for c, i in zip(columns, inputs) if c not in categories]
    present = rows.select(*[F.when(F.col(i) != missing, F.col(i)).alias(i) for _, i in numbers])
    found = order_statistics(present, [i for _, i in numbers], lambda n: [-(-k * n // bins) - 1 for k in range(1, bins)])
    cuts = {c: sorted(set(found[i])) for c, i in numbers}
    return Booster(list(columns), [cuts.get(c) for c in columns], [categories.get(c, 0) for c in columns], missing)


def blocks_of(rows: DataFrame, booster: Booster, held_out: bool) -> DataFrame:
    """Blocks of rows as bytes: bins (columns x rows), label, key and raw score, from inputs (array), label and key."""
    def block(inputs: np.ndarray, label: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        n = len(label)
        parts = [booster.binned(inputs).tobytes(), label.astype(np.uint8).tobytes(), key.tobytes(), np.full(n, booster.base).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([held_out]), pa.array([n], pa.int32()), *[pa.array([p], pa.binary()) for p in parts]],
                                          names=["held_out", "n", "bins", "label", "key", "raw"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1), batch.column(1).to_numpy(), batch.column(2).to_numpy()))
            if sum(len(x[1]) for x in held) >= BLOCK_ROWS:
                yield block(*map(np.concatenate, zip(*held)))
                held = []
        if held:
            yield block(*map(np.concatenate, zip(*held)))

    return rows.mapInArrow(blocks, "held_out boolean, n int, bins binary, label binary, key binary, raw binary")


def _arrays(row: dict, pending: list[Tree], most_bins: int) -> tuple[np.ndarray, ...]:
    n = row["n"]
    bins = np.frombuffer(row["bins"], np.uint16).reshape(-1, n)
    raw = reduce(np.add, (t.values(bins, most_bins) for t in pending), np.frombuffer(row["raw"], np.float64))
    return bins, np.frombuffer(row["label"], np.uint8), np.frombuffer(row["key"], np.int64), raw


def drawn(key: np.ndarray, number: int, seed: int, share: float) -> np.ndarray:
    """Which rows a tree is grown from, by their key."""
    h = (key.view(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03 & (2 ** 64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(40)) < np.uint64(share * (1 << 24))


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, category: bool, leaf_rows: int) -> dict | None:
    """The best way to part a leaf by one column, from its sums per bin (gradient and curvature in units of 1 / UNIT)."""
    total_g, total_h, total_n = int(g.sum()), int(h.sum()), int(n.sum())

    def strength(g, h, penalty):
        return (g / UNIT) ** 2 / np.maximum(h / UNIT + penalty, 1e-300)

    if category:
        used = np.flatnonzero(n)
        used = used[np.argsort(g[used] / (h[used] + CATEGORY_SMOOTHING * UNIT), kind="stable")]
        options = [(used, np.cumsum(g[used]), np.cumsum(h[used]), np.cumsum(n[used]))]
        penalty = CATEGORY_PENALTY
    else:
        shown, penalty = np.arange(len(n) - 1), 0.0
        right = (shown, np.cumsum(g[:-1]), np.cumsum(h[:-1]), np.cumsum(n[:-1]))
        options = [right]
        if n[-1]:  # missing numbers on the right, or on the left
            options.append((np.concatenate([[len(n) - 1], shown]), *[np.concatenate([[x[-1]], x[-1] + of]) for x, of in zip((g, h, n), right[1:])]))
    best = None
    for order, gl, hl, nl in options:
        fits = (nl >= leaf_rows) & (total_n - nl >= leaf_rows) & (hl >= LEAST_CURVATURE * UNIT) & (total_h - hl >= LEAST_CURVATURE * UNIT)
        if not fits.any():
            continue
        gain = np.where(fits, strength(gl, hl, penalty) + strength(total_g - gl, total_h - hl, penalty) - strength(total_g, total_h, 0.0), -np.inf)
        at = int(np.argmax(gain))
        if best is None or gain[at] > best["gain"]:
            best = {"gain": float(gain[at]), "left_bins": order[:at + 1].tolist(), "g": int(gl[at]), "h": int(hl[at]), "n": int(nl[at])}
    if best and not category and not n[-1] and 2 * best["n"] > total_n:
        best["left_bins"].append(len(n) - 1)  # none missing here: later ones go with the most rows
    return best if best and best["gain"] > 1e-12 else None


def opened(bins: np.ndarray, g: np.ndarray, h: np.ndarray, booster: Booster, columns: list[int], leaf_rows: int, most: int) -> list[dict]:
    """A leaf (place 0) and what is below it, best leaf first, up to `most` splits, from its rows (bins: columns x rows).

    Each has its best split (or None), that split's column and the places of its sides, -1 where it was not opened.
    """
    sizes = [booster.bins_of(c) for c in columns]

    def histogram(rows: np.ndarray) -> list[np.ndarray]:
        weights = (g[rows], h[rows], None)
        return [np.stack([np.bincount(own, w, size).astype(np.int64) for w in weights]) for own, size in ((x[rows], n) for x, n in zip(bins, sizes))]

    def looked_at(rows: np.ndarray, sums: list[np.ndarray]) -> dict:
        found = [(-s["gain"], c, s) for c, of in zip(columns, sums) if (s := best_split(*of, booster.cuts[c] is None, leaf_rows))]
        _, column, split = min(found, key=lambda o: o[:2]) if found else (0.0, -1, None)
        held.append((rows, sums))
        return {"column": column, "split": split, "left": -1, "right": -1}

    held: list[tuple[np.ndarray, list[np.ndarray]] | None] = []
    everything = np.arange(bins.shape[1])
    out = [looked_at(everything, histogram(everything))]
    queue = [(-out[0]["split"]["gain"], 0)] if out[0]["split"] else []
    for _ in range(most):
        if not queue:
            break
        place = heapq.heappop(queue)[1]
        node = out[place]
        rows, sums = held[place]
        held[place] = None
        goes_left = np.zeros(booster.most_bins, bool)
        goes_left[node["split"]["left_bins"]] = True
        is_left = goes_left[bins[columns.index(node["column"]), rows]]
        halves = [rows[is_left], rows[~is_left]]
        less = int(len(halves[1]) < len(halves[0]))
        own = histogram(halves[less]) if max(map(len, halves)) >= 2 * leaf_rows else None
        for side, name in enumerate(("left", "right")):
            node[name] = len(out)
            if len(halves[side]) < 2 * leaf_rows:
                held.append(None)
                out.append({"column": -1, "split": None, "left": -1, "right": -1})
                continue
            out.append(looked_at(halves[side], own if side == less else [a - b for a, b in zip(sums, own)]))
            if out[-1]["split"]:
                heapq.heappush(queue, (-out[-1]["split"]["gain"], len(out) - 1))
    return out


def splits(blocks: DataFrame, booster: Booster, pending: list[Tree], tree: Tree, nodes: list[int], columns: list[int], number: int,
           row_share: float, leaf_rows: int, seed: int, small: tuple[int, ...] = (), most: int = 0) -> tuple[dict, list[int]]:
    """One pass: the best split of each (node, column), and in the root's pass the sums of the drawn rows and the held-out loss.

    Of the nodes that are `small`, what a task `opened`, up to `most` splits, is found under (node, INNER) instead.
    """
    most_bins, root = booster.most_bins, nodes == [0]
    large = [node for node in nodes if node not in small]
    kind = np.uint8 if most_bins <= 256 else np.uint16

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(len(tree.left), -1)
        place[large] = np.arange(len(large))
        place[list(small)] = len(large) + np.arange(len(small))
        size = len(large) * most_bins
        sums = np.zeros((len(columns), 3, size), np.int64)
        seen = np.zeros(5, np.int64)  # g, h and n of drawn rows; loss and number of held-out rows
        for batch in batches:
            for row in batch.to_pylist():
                if row["held_out"] and not root:
                    continue
                bins, label, key, raw = _arrays(row, pending, most_bins)
                if row["held_out"]:
                    loss = np.logaddexp(0, raw) - label * raw
                    seen[3:] += [int(np.rint(loss * UNIT).sum()), len(label)]
                    continue
                chosen = np.flatnonzero(drawn(key, number, seed, row_share)) if row_share < 1 else np.arange(len(label))
                at = place[tree.leaf_of(bins[:, chosen], most_bins)]
                chosen, at = chosen[at >= 0], at[at >= 0]
                p = 1 / (1 + np.exp(-raw[chosen]))
                g, h = np.rint((p - label[chosen]) * UNIT), np.rint(p * (1 - p) * UNIT)
                seen[:3] += [int(g.sum()), int(h.sum()), len(g)]
                for k, node in enumerate(small):
                    if len(own := np.flatnonzero(at == len(large) + k)):
                        rows = bins[np.ix_(columns, chosen[own])].astype(kind).tobytes() + g[own].astype(np.int32).tobytes() + h[own].astype(np.int32).tobytes()
                        yield batch_of([node], [INNER], [[]], [[]], [[len(own)]], [rows])
                if not large:
                    continue
                chosen, g, h, at = (x[at < len(large)] for x in (chosen, g, h, at))
                for i, c in enumerate(columns):
                    cell = at * most_bins + bins[c, chosen]
                    for j, weights in enumerate((g, h, None)):
                        sums[i, j] += np.bincount(cell, weights, size).astype(np.int64)
        split = sums.reshape(len(columns), 3, len(large), most_bins)
        used = [(i, k) for i in range(len(columns)) for k in range(len(large)) if split[i, 2, k].any()]
        of = [[split[i, j, k, :booster.bins_of(columns[i])] for i, k in used] for j in range(3)]
        yield batch_of([large[k] for _, k in used] + [-1], [columns[i] for i, _ in used] + [-1], *[[*x, seen] for x in of], [None] * (len(used) + 1))

    def batch_of(node: list, column: list, g: list, h: list, n: list, rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(node, pa.int32()), pa.array(column, pa.int32()), *[pa.array(x, pa.list_(pa.int64())) for x in (g, h, n)],
                                           pa.array(rows, pa.binary())], names=["node", "column", "g", "h", "n", "rows"])

    def grow(pieces: list[tuple[int, bytes]]) -> list[dict]:
        parts = []
        for n, rows in pieces:
            cut = len(rows) - 8 * n
            parts.append((np.frombuffer(rows, kind, cut // kind().itemsize).reshape(len(columns), n), np.frombuffer(rows, np.int32, n, cut),
                          np.frombuffer(rows, np.int32, n, cut + 4 * n)))
        bins, g, h = (np.concatenate(x, axis=-1) for x in zip(*parts))
        return opened(bins, g.astype(float), h.astype(float), booster, columns, leaf_rows, most)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}  # the keys of one partition
        grown_here: dict[tuple[int, int], list[dict]] = {}
        node, pieces = -1, []  # rows of one small leaf at a time: they come in order
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            flat = [batch.column(i).flatten().to_numpy() for i in (2, 3, 4)]
            ends = [np.cumsum(pc.list_value_length(batch.column(i)).to_numpy()) for i in (2, 3, 4)]
            for at, key in enumerate(keys):
                part = [x[e[at - 1] if at else 0:e[at]] for x, e in zip(flat, ends)]
                if key[1] == INNER:
                    if pieces and node != key[0]:
                        grown_here[node, INNER], pieces = grow(pieces), []
                    node = key[0]
                    pieces.append((int(part[2][0]), batch.column(5)[at].as_py()))
                    continue
                part = np.stack(part)
                sums[key] = sums[key] + part if key in sums else part
        if pieces:
            grown_here[node, INNER] = grow(pieces)
        found = grown_here | {(node, column): {"seen": of[0].tolist()} if column < 0 else best_split(*of, booster.cuts[column] is None, leaf_rows)
                              for (node, column), of in sums.items()}
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.int32()),
                                          pa.array([json.dumps(x) for x in found.values()], pa.string())], names=["node", "column", "split"])

    partial = blocks.mapInArrow(histograms, "node int, column int, g array<long>, h array<long>, n array<long>, rows binary")
    tasks = max(1, min(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(len(large) * len(columns) // KEYS_A_TASK, len(small))))
    dealt = partial.repartition(tasks, "node", "column")
    if small:
        dealt = dealt.sortWithinPartitions("node", "column")
    rows = dealt.mapInArrow(choose, "node int, column int, split string").collect()  # nodes x columns
    found = {(r.node, r.column): json.loads(r.split) for r in rows}
    return found, found.get((-1, -1), {}).get("seen", [0] * 5)


def growing(columns: list[int], leaves: int, leaf_rows: int, rows: int | None = None) -> Generator[tuple, tuple[dict, list[int]], tuple[Tree, list[int]]]:
    """The next tree, best leaf first, and the sums of its first pass. `rows`: at most so many are drawn, if that is known.

    Gives (columns, tree, nodes, those that are small, most splits below these) of every pass and takes what `splits` answers.
    """
    tree, sums, best, opened_nodes = Tree(), {}, {}, {}
    inner: dict[int, tuple[list[dict], int]] = {}  # where a task has opened a node already
    tree.add()

    def known(node: int, part: list[dict], place: int) -> None:
        of = part[place]
        inner[node], best[node] = (part, place), (-of["split"]["gain"], of["column"], of["split"]) if of["split"] else None

    def look(nodes: list[int]) -> Generator[tuple, tuple[dict, list[int]], list[int]]:
        small = tuple(node for node in nodes if (sums[node][2] if node else rows if rows is not None else NODE_ROWS + 1) <= NODE_ROWS)
        found, seen = yield columns, tree, nodes, small, leaves - 1
        for node in nodes:
            if (node, INNER) in found:
                known(node, found[node, INNER], 0)
                continue
            options = [(-s["gain"], c, s) for c in columns if (s := found.get((node, c)))]
            best[node] = min(options, key=lambda o: o[:2]) if options else None
        return seen

    seen = yield from look([0])
    sums[0] = tuple(seen[:3])
    while True:
        # take leaves from the queue as if no unseen child were better, and look at the unseen children
        queue = [(best[0][0], 0)] if best[0] else []
        taken, unseen = [], []
        while queue and len(taken) < leaves - 1:
            _, node = heapq.heappop(queue)
            taken.append(node)
            if node not in opened_nodes:
                column, split = best[node][1:]
                left, right = opened_nodes[node] = tree.add(), tree.add()
                tree.column[node], tree.left_bins[node], tree.left[node], tree.right[node] = column, split["left_bins"], left, right
                tree.gain[node] = split["gain"]
                g, h, n = sums[node]
                sums[left], sums[right] = (split["g"], split["h"], split["n"]), (g - split["g"], h - split["h"], n - split["n"])
                part, place = inner.get(node, ([], 0))
                for child, side in ((left, "left"), (right, "right")):
                    best[child] = None
                    if part and part[place][side] >= 0:
                        known(child, part, part[place][side])
                    elif sums[child][2] >= 2 * leaf_rows:
                        unseen.append(child)
            for child in opened_nodes[node]:
                if best[child]:
                    heapq.heappush(queue, (best[child][0], child))
        if not unseen:
            break
        yield from look(unseen)
    for node, (g, h, _) in sums.items():
        tree.value[node] = -STEP * g / max(h, 1)
    for node in set(opened_nodes) - set(taken):  # looked at, not taken
        tree.left[node] = tree.right[node] = -1
    return tree, seen


def answered(blocks: DataFrame, booster: Booster, pending: list[Tree], number: int, asked: tuple, row_share: float, leaf_rows: int,
             seed: int) -> tuple[dict, list[int]]:
    columns, tree, nodes, small, most = asked
    return splits(blocks, booster, pending, tree, nodes, columns, number, row_share, leaf_rows, seed, small, most)


def grown(blocks: DataFrame, booster: Booster, pending: list[Tree], columns: list[int], number: int, leaves: int, row_share: float,
          leaf_rows: int, seed: int, rows: int | None = None) -> tuple[Tree, list[int]]:
    """The next tree and the sums of its first pass, as in `growing`."""
    passes = growing(columns, leaves, leaf_rows, rows)
    asked = next(passes)
    while True:
        try:
            asked = passes.send(answered(blocks, booster, pending, number, asked, row_share, leaf_rows, seed))
        except StopIteration as end:
            return end.value


def with_scores(blocks: DataFrame, booster: Booster, pending: list[Tree]) -> DataFrame:
    most_bins = booster.most_bins

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [_arrays(row, pending, most_bins)[3].tobytes() for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(raw, pa.binary())], names=batch.schema.names)

    return written_once(blocks.mapInArrow(add, blocks.schema), "boosting-blocks")


def fitting(out: Booster, columns: list[str], most: int, leaves: int, patience: int, column_share: float, leaf_rows: int, seed: int,
            rows: int) -> Generator[tuple, tuple[dict, list[int]], None]:
    """Gives `out` its trees and losses; gives and takes what `growing` does for one tree after the other."""
    usable = [c for c, name in enumerate(out.columns) if name in columns]
    best, rng = 0, np.random.default_rng(seed)
    while True:
        picked = sorted(rng.choice(usable, max(1, round(column_share * len(usable))), replace=False).tolist())
        tree, seen = yield from growing(picked, leaves if len(out.trees) < most else 1, leaf_rows, rows)
        out.losses.append(seen[3] / UNIT / max(seen[4], 1))
        if out.losses[-1] < out.losses[best]:
            best = len(out.losses) - 1
        if len(out.trees) >= most or len(out.losses) - 1 - best >= patience or tree.left[0] < 0:
            break
        out.trees.append(tree)
    out.trees = out.trees[:best] if best else out.trees[:1]


def bare(booster: Booster) -> Booster:
    return Booster(booster.columns, booster.cuts, booster.categories, booster.missing, booster.base)


def best_columns(sums: list[np.ndarray], booster: Booster, columns: list[int], leaf_rows: int) -> list[int | None]:
    """For each leaf the column of the largest gain by `best_split`, the first of equal ones. Numbers of a leaf are looked at together.

    `sums` hold g, h and n by bin, the columns one after the other.
    """
    starts = np.cumsum([0, *(booster.bins_of(c) for c in columns)])
    numbers = [i for i, c in enumerate(columns) if booster.cuts[c] is not None]
    shown = np.array([booster.bins_of(columns[i]) - 1 for i in numbers])
    places = starts[numbers][:, None] + np.minimum(np.arange(shown.max(initial=0)), shown[:, None] - 1)
    filled = np.arange(shown.max(initial=0)) < shown[:, None]
    out = []
    for of in sums:
        gains = {i: s["gain"] for i, c in enumerate(columns) if booster.cuts[c] is None and (s := best_split(*of[:, starts[i]:starts[i + 1]], True, leaf_rows))}
        if numbers:
            g, h, n = np.cumsum(np.where(filled, of[:, places], 0), axis=2)
            missing = of[:, starts[numbers] + shown][:, :, None]
            total_g, total_h, total_n = of[:, starts[0]:starts[1]].sum(axis=1)

            def strength(g, h):
                return (g / UNIT) ** 2 / np.maximum(h / UNIT, 1e-300)

            def gain(g, h, n, valid):
                fits = valid & (n >= leaf_rows) & (total_n - n >= leaf_rows) & (h >= LEAST_CURVATURE * UNIT) & (total_h - h >= LEAST_CURVATURE * UNIT)
                parted = strength(g, h) + strength(total_g - g, total_h - h) - strength(total_g, total_h)
                return np.where(fits, parted, -np.inf).max(axis=1)

            alone = missing[2] > 0
            best = np.maximum(gain(g, h, n, filled), gain(g + missing[0], h + missing[1], n + missing[2], filled & alone))
            best = np.maximum(best, gain(*missing, alone))
            gains |= {i: x for i, x in zip(numbers, best.tolist()) if x > 1e-12}
        out.append(columns[min(gains, key=lambda i: (-gains[i], i))] if gains else None)
    return out


class Held:
    """The blocks of one task of a barrier job."""

    def __init__(self, booster: Booster, batches: Iterator[pa.RecordBatch]):
        kind = np.uint8 if booster.most_bins <= 256 else np.uint16
        parts: dict[bool, list[tuple[np.ndarray, ...]]] = {False: [], True: []}
        for batch in batches:
            for row in batch.to_pylist():
                bins, label, key, raw = _arrays(row, [], booster.most_bins)
                parts[row["held_out"]].append((bins.astype(kind), label, key, raw))
        empty = np.zeros((len(booster.columns), 0), kind), np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0)
        (self.bins, self.label, self.key, self.raw), (self.later_bins, self.later_label, _, self.later_raw) = (
            [np.concatenate(x, axis=-1) for x in zip(*(parts[held_out] or [empty]))] for held_out in (False, True))


class HeldFit:
    """One fit over the blocks a task holds: its part of the sums of a pass, and the splits by the sums of all tasks."""

    def __init__(self, held: Held, booster: Booster, row_share: float, leaf_rows: int, seed: int):
        self.held, self.booster, self.row_share, self.leaf_rows, self.seed = held, booster, row_share, leaf_rows, seed
        self.raw, self.later_raw, self.trees = held.raw.copy(), held.later_raw.copy(), 0

    def begin(self) -> np.ndarray:
        """Takes the trees that are new and draws the rows of the next one; g, h and n of these, loss and number of held-out rows."""
        held = self.held
        for tree in self.booster.trees[self.trees:]:
            self.raw += tree.values(held.bins, self.booster.most_bins)
            self.later_raw += tree.values(held.later_bins, self.booster.most_bins)
        self.trees = len(self.booster.trees)
        p = 1 / (1 + np.exp(-self.raw))
        self.g, self.h = np.rint((p - held.label) * UNIT), np.rint(p * (1 - p) * UNIT)
        rows = np.flatnonzero(drawn(held.key, self.trees, self.seed, self.row_share)) if self.row_share < 1 else np.arange(len(held.label))
        self.rows, self.sums = {0: rows}, {}
        loss = np.logaddexp(0, self.later_raw) - held.later_label * self.later_raw
        return np.array([self.g[rows].sum(), self.h[rows].sum(), len(rows), np.rint(loss * UNIT).sum(), len(loss)]).astype(np.int64)

    def histogram(self, rows: np.ndarray) -> np.ndarray:
        """g, h and n by bin, the columns one after the other."""
        weights, out = (self.g[rows], self.h[rows], None), np.empty((3, sum(self.sizes)), np.int64)
        for c, end, size in zip(self.columns, np.cumsum(self.sizes), self.sizes):
            own = self.held.bins[c][rows].astype(np.intp)
            for j, w in enumerate(weights):
                out[j, end - size:end] = np.bincount(own, w, size)
        return out

    def part(self, asked: tuple) -> np.ndarray:
        """What this task adds to the sums of a pass: of the root, or of the smaller sides of the nodes just opened."""
        self.columns, self.tree, self.nodes = asked[:3]
        self.sizes = [self.booster.bins_of(c) for c in self.columns]
        if self.nodes == [0]:
            return np.concatenate([self.begin(), self.histogram(self.rows[0]).ravel()])
        tree, wanted, self.sides, parts = self.tree, set(self.nodes), [], []
        for node in [n for n in self.sums if {tree.left[n], tree.right[n]} & wanted]:
            goes_left = np.zeros(self.booster.most_bins, bool)
            goes_left[tree.left_bins[node]] = True
            rows, at = self.rows.pop(node), self.columns.index(tree.column[node])
            is_left = goes_left[self.held.bins[tree.column[node]][rows]]
            self.rows |= {tree.left[node]: rows[is_left], tree.right[node]: rows[~is_left]}
            n = self.sums[node][2, sum(self.sizes[:at]):sum(self.sizes[:at + 1])]
            sides = tree.left[node], tree.right[node]
            self.sides.append((node, *(sides if 2 * n[tree.left_bins[node]].sum() <= n.sum() else sides[::-1])))
            parts.append(self.histogram(self.rows[self.sides[-1][1]]).ravel())
        return np.concatenate(parts)

    def answer(self, sums: np.ndarray) -> tuple[dict, list[int]]:
        """What `splits` answers, from the sums of all tasks."""
        seen, size = [0] * 5, 3 * sum(self.sizes)
        if self.nodes == [0]:
            seen, self.sums[0] = sums[:5].tolist(), sums[5:].reshape(3, -1)
        else:
            for (node, less, more), own in zip(self.sides, sums.reshape(-1, size)):
                self.sums[less] = own.reshape(3, -1)
                self.sums[more] = self.sums.pop(node) - self.sums[less]
        starts, found = np.cumsum([0, *self.sizes]), {}
        for node, column in zip(self.nodes, best_columns([self.sums[node] for node in self.nodes], self.booster, self.columns, self.leaf_rows)):
            if column is not None:  # the other columns of the node are not asked for
                at = self.columns.index(column)
                found[node, column] = best_split(*self.sums[node][:, starts[at]:starts[at + 1]], self.booster.cuts[column] is None, self.leaf_rows)
        return found, seen


class Exchange:
    """Sums over the tasks of a barrier job, by files in the shared folder: a barrier of Spark's own takes a second each time."""

    def __init__(self, folder: str):
        job = BarrierTaskContext.get()
        self.own, self.tasks, self.number = job.partitionId(), len(job.getTaskInfos()), 0
        self.store, self.folder = fs.FileSystem.from_uri(f"{folder}/{job.allGather(uuid.uuid4().hex)[0]}")  # a job that starts again has another
        self.store.create_dir(self.folder, recursive=True)

    def name(self, number: int, task: int) -> str:
        return f"{self.folder}/{number}-{task}"

    def sum(self, part: np.ndarray) -> np.ndarray:
        """The sum of the parts of all tasks, which are equally long. Once all are there, nobody reads the ones before."""
        planes = np.ascontiguousarray(part.view(np.uint8).reshape(-1, 8).T)  # like bytes side by side: most are zero
        name = self.name(self.number, self.own)
        with self.store.open_output_stream(f"{name}.part", compression=None) as stream:
            stream.write(pa.compress(planes, codec="lz4", asbytes=True))
        self.store.move(f"{name}.part", name)
        total, missing, waits = part.copy(), [task for task in range(self.tasks) if task != self.own], 0.001
        while missing:
            there = self.store.get_file_info([self.name(self.number, task) for task in missing])
            if not any(x.is_file for x in there):
                time.sleep(waits := min(2 * waits, 0.05))
                continue
            for info in (x for x in there if x.is_file):
                with self.store.open_input_stream(info.path, compression=None) as stream:
                    planes = np.frombuffer(pa.decompress(stream.read(), part.nbytes, codec="lz4", asbytes=True), np.uint8)
                total += np.ascontiguousarray(planes.reshape(8, -1).T).view(np.int64).ravel()
            missing, waits = [task for task, x in zip(missing, there) if not x.is_file], 0.001
        if self.number:
            self.store.delete_file(self.name(self.number - 1, self.own))
        self.number += 1
        return total


def holders(blocks: DataFrame, booster: Booster, fits: int) -> int:
    """How many tasks of a barrier job can hold the blocks in memory; 0 where they cannot, or cannot exchange sums."""
    spark = blocks.sparkSession
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    try:
        fs.FileSystem.from_uri(shared_dir(spark))
        context = spark.sparkContext._jsc.sc()
        slots = context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())
    except Exception:  # no store that pyarrow can open, or no such figure
        return 0
    number, most, rows = blocks.agg(F.count("n"), F.max("n"), F.sum("n")).first()
    tasks = min(slots, MOST_HOLDERS, number)
    bytes_a_row = len(booster.columns) * (1 if booster.most_bins <= 256 else 2) + 17 + 40 * fits
    return tasks if tasks and (rows / tasks + most) * bytes_a_row <= HELD_BYTES else 0


def boost_held(blocks: DataFrame, booster: Booster, of_columns: dict[str, list[str]], most: int = MOST_TREES, leaves: int = LEAVES,
               patience: int = PATIENCE, row_share: float = ROW_SHARE, column_share: float = COLUMN_SHARE, leaf_rows: int = LEAF_ROWS,
               seed: int = SEED) -> dict[str, Booster] | None:
    """The boosters of several sets of columns by one barrier job, or None where the blocks do not fit."""
    tasks = holders(blocks, booster, len(of_columns))
    if not tasks:
        return None
    rows = blocks.where("not held_out").agg(F.sum("n")).first()[0]
    folder = f"{shared_dir(blocks.sparkSession).rstrip('/')}/boosting-sums-{uuid.uuid4().hex}"

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, exchange, outs, fits, asked = Held(booster, batches), Exchange(folder), {}, {}, {}
        for name, columns in of_columns.items():
            outs[name] = bare(booster)
            run = fitting(outs[name], columns, most, leaves, patience, column_share, leaf_rows, seed, rows)
            fits[name], asked[name] = (HeldFit(held, outs[name], row_share, leaf_rows, seed), run), next(run)
        while asked:
            parts = {name: fits[name][0].part(of) for name, of in asked.items()}
            sums = np.split(exchange.sum(np.concatenate(list(parts.values()))), np.cumsum([len(x) for x in parts.values()])[:-1])
            for name, own in zip(parts, sums):
                try:
                    asked[name] = fits[name][1].send(fits[name][0].answer(own))
                except StopIteration:
                    del asked[name]
        if exchange.own == 0:
            found = [json.dumps([out.losses, [vars(t) for t in out.trees]]) for out in outs.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(outs), pa.string()), pa.array(found, pa.string())], names=["name", "found"])

    found = {r.name: json.loads(r.found) for r in blocks.repartition(tasks).mapInArrow(fit, "name string, found string", barrier=True).collect()}
    out = {}
    for name in of_columns:
        out[name] = bare(booster)
        out[name].losses, out[name].trees = found[name][0], [Tree(**t) for t in found[name][1]]
    return out


def boost(blocks: DataFrame, booster: Booster, columns: list[str], most: int = MOST_TREES, leaves: int = LEAVES, patience: int = PATIENCE,
          row_share: float = ROW_SHARE, column_share: float = COLUMN_SHARE, leaf_rows: int = LEAF_ROWS, seed: int = SEED) -> Booster:
    """The booster with its trees, `losses` on held-out rows by number of trees (from none), best number kept."""
    if held := boost_held(blocks, booster, {"": columns}, most, leaves, patience, row_share, column_share, leaf_rows, seed):
        return held[""]
    rows = blocks.where("not held_out").agg(F.sum("n")).first()[0]
    if blocks.rdd.getNumPartitions() > MOST_TASKS:
        blocks = blocks.coalesce(MOST_TASKS)
    out, written = bare(booster), 0
    passes = fitting(out, columns, most, leaves, patience, column_share, leaf_rows, seed, rows)
    asked = next(passes)
    while True:
        if asked[2] == [0] and len(out.trees) - written == PENDING:
            blocks, written = with_scores(blocks, out, out.trees[written:]), len(out.trees)
        try:
            asked = passes.send(answered(blocks, out, out.trees[written:], len(out.trees), asked, row_share, leaf_rows, seed))
        except StopIteration:
            return out
