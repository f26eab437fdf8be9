"""Near-duplicate documents by the chosen-path set similarity join on word shingles.

1. `shingled`: one pass over the texts gives each document its number of distinct shingles, a digest of the set, and
   64 minhash values. Documents with equal sets become one class, represented by the smallest id.
2. `tree_nodes`: a tree's root splits the classes by one minhash value; a node of more than WHOLE_NODES * `node` classes branches by
   two further values each, and so on. A larger node of classes that are alike anyway, and one of more than `node` classes that
   does not branch, is cut into blocks instead (see `blocks`).
3. `verified`: in each small node all classes are compared, first by their minhash values, then on their full shingle
   sets, read from the texts again. Only links that join what is not yet joined are given back.
4. `components`: links are contracted to stars with the smallest id in the middle.

Independent trees repeat this: the first trees find most groups; later trees look only at nodes whose classes are not all
in one component yet, and compare no pair again that met in a root before. A pair of similarity s meets in a tree's root with probability s, so TREES trees miss a pair at the
threshold with probability 0.25 ** TREES, about one in a million, and pairs above it less often.

Hot groups: equal sets are one class whatever their number; nodes hold at most `node` classes, and joins on node or class
keys are on narrow rows with salts. Every step's result is written to the shared folder.

Defined cases: null and empty texts have no shingle, no link, and are kept; rows without an id likewise; rows that repeat an
id count as one document where they share a text, and are linked by their id otherwise; other columns are ignored; an empty
table gives no row.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from departure_risk.llm.memory import given_back
from departure_risk.llm.shingles import shingle_sets, signature
from departure_risk.session import written_once

#: Trees of the first and of the second pass; deeper levels of a node; classes compared in a node at most.
TREES, DEPTH, NODE = (2, 8), 8, 240
ROOTS = sum(TREES)
#: Rows of a block of a larger node, in nodes: every two blocks are a task, so a class is copied once for each block of its node.
BLOCK_NODES = 4
#: Nodes of so many times `node` classes are compared whole in blocks, alike or not: branching doubles their rows level by level.
WHOLE_NODES = 16
#: Minhash values that tell whether the classes of a node are alike, and their mean similarity from which they are.
PROBES, ALIKE = 3, 0.25
#: Salts of the join that gives documents their class.
SALTS = 8
#: Ids whose texts are picked out where they are read (about 60 bytes each in an executor); for more, texts are shuffled.
BROADCAST_IDS = 1_000_000
#: Bytes of text handled at a time.
TEXT_BYTES = 2 << 20


def text_slices(batch: pa.RecordBatch, column: int, most: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about `most` bytes or are one row."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.binary_length(batch.column(column).fill_null("")).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        until = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, until - at)
        at = until


def shingled(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n, digest (null without shingles) and minhash, per row."""
    shape = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("minhash", pa.list_(pa.int32()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1):
                sets = shingle_sets(part.column(1), size)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                     pa.array([signature(s) if len(s) else None for s in sets], pa.list_(pa.int32()))], schema=shape)

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(lambda batches: given_back(measure(batches)), "doc_id long, n long, digest binary, minhash array<int>")


def tree_nodes(classes: DataFrame, trees: range, node: int, depth: int, whole: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (task, tree, id, label) of nodes to compare; the same with `size` of larger nodes of similar classes; and
    (id, tree) of the classes whose root is not compared as a whole.

    A larger node whose classes are alike on average gains nothing by branching (all stay together on every branch), so it
    is set aside to be cut into blocks that compare it whole; so is one of at most WHOLE_NODES * `node` classes, so that the rows
    of a group do not double with every level. The others branch. Without `whole`, all larger nodes are set
    aside right away, and blocks compare parts of them. Nodes whose classes all carry one label are left out.
    `classes`: id, label, minhash.
    """
    roots = F.explode(F.array(*[F.struct(F.lit(t).alias("tree"), F.col("minhash")[t].alias("value")) for t in trees]))
    rows = classes.select("id", "label", roots.alias("r")).select(
        "id", "label", "r.tree", F.xxhash64("r.tree", "r.value").alias("task"))
    small, alike_nodes, split = [], [], []
    for level in range(depth + 1):
        sizes = rows.groupBy("task").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high")).where(
            "size > 1 and low < high").select("task", "size")
        sized = written_once(rows.join(sizes, "task"), f"nodes-{level}")
        small.append(sized.where(F.col("size") <= node).select("task", "tree", "id", "label"))
        large = sized.where(F.col("size") > node)
        if not whole:
            return small[0], large.select("task", "tree", "id", "label", "size"), large.select("id", "tree")
        alike_nodes.append(large.where(F.col("size") <= WHOLE_NODES * node).select("task", "tree", "id", "label", "size"))
        large = large.where(F.col("size") > WHOLE_NODES * node)
        if large.isEmpty():
            break
        # the mean similarity of a node's classes: how often two of them agree, over some minhash values no root uses
        probes = F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.col("minhash")[ROOTS + i].alias("value")) for i in range(PROBES)]))
        large = written_once(large.join(classes.select("id", "minhash"), "id"), "large-nodes")
        agree = large.select("task", "size", probes.alias("p")).groupBy("task", "size", "p").agg(F.count(F.lit(1)).alias("n"))
        mean = agree.groupBy("task", "size").agg(F.sum(F.col("n") * F.col("n")).alias("pairs")).select(
            "task", (F.col("pairs") / (PROBES * F.col("size").cast("double") * F.col("size")) >= ALIKE).alias("alike"))
        large = written_once(large.join(mean, "task"), "large-nodes")
        alike_nodes.append((large if level == depth else large.where("alike")).select("task", "tree", "id", "label", "size"))
        if level == 0:
            split.append(large.where("not alike").select("id", "tree"))
        branching = large.where("not alike")
        if level == depth or branching.isEmpty():
            break
        # the two values a node branches by are chosen from the tree and the level, the same for all its classes
        places = [F.pmod(F.xxhash64("tree", F.lit(level), F.lit(i)), F.lit(64 - ROOTS)) + ROOTS for i in range(2)]
        branch = F.explode(F.array(*[F.struct(p.cast("int").alias("at"), F.element_at("minhash", (p + 1).cast("int")).alias("value")) for p in places]))
        rows = branching.select("id", "label", "tree", "task", branch.alias("b")).select(
            "id", "label", "tree", F.xxhash64("task", "b.at", "b.value").alias("task")).distinct()
    return _all(small), _all(alike_nodes), _all(split).distinct() if split else classes.where("false").selectExpr("id", "0 as tree")


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def blocks(large: DataFrame, node: int) -> DataFrame:
    """Rows (task, tree, id, label, earlier, side) that let every two differently labelled classes of a large node meet once, but
    for those of one `earlier` node, which met before. In a task of two blocks these are the sides, and meet each other only.

    A node is cut into blocks of BLOCK_NODES * `node` classes: labels with many classes get blocks of their own, the others share
    blocks. Every two blocks are a task, except two blocks of one label or of many classes that met before. A node that is one
    component but for a few classes so costs in proportion to its size.
    """
    most = BLOCK_NODES * node
    # the largest node a class was in in an earlier tree: classes that share it met there and need not meet again
    before = Window.partitionBy("id").orderBy("tree").rangeBetween(Window.unboundedPreceding, -1)
    large = written_once(large.withColumn("earlier", F.coalesce(F.max(F.struct("size", "task")).over(before)["task"], F.lit(0))), "met-classes")
    # everything else is told from the classes of each label in a node that met, counted once
    counted = written_once(large.groupBy("task", "earlier", "label").agg(F.count(F.lit(1)).alias("own")), "met-labels")
    # few classes that met share blocks with others, or each such few would be a block that meets all others
    many = counted.where("earlier <> 0").groupBy("task", "earlier").agg(F.sum("own").alias("together")).where(F.col("together") >= most)
    folded = counted.join(many, ["task", "earlier"], "left").withColumn("met", F.when(F.col("together").isNull(), F.lit(0).cast("long")).otherwise(F.col("earlier")))
    per_label = folded.groupBy("task", "met", "label").agg(F.sum("own").alias("own"), F.collect_list("earlier").alias("of"))
    rest = per_label.where(F.col("own") < most).groupBy("task", "met").agg(F.sum("own").alias("mixed"))
    cut = per_label.join(rest, ["task", "met"], "left").select(
        "task", "met", "label", "own", F.explode("of").alias("earlier"),
        F.when(F.col("own") < most, F.pmod(F.xxhash64("label"), F.ceil(F.col("mixed") / most))).alias("shared"))
    own_block = F.xxhash64("met", "label", F.pmod(F.xxhash64("id"), F.ceil(F.col("own") / most)))
    placed = written_once(large.join(cut, ["task", "earlier", "label"]).select(
        "task", "tree", "id", "label", "earlier", "met", F.when(F.col("shared").isNull(), F.col("label")).alias("pure"),
        F.when(F.col("shared").isNull(), own_block).otherwise(F.xxhash64(F.lit("shared"), "met", "shared")).alias("block")), "node-blocks")
    kinds = placed.select("task", "block", "pure", "met").distinct()
    left, right = kinds.alias("a"), kinds.alias("b")
    sides = [F.struct(F.col(f"{of}.block").alias("block"), F.lit(side).cast("long").alias("side")) for side, of in enumerate("aab")]
    pairs = left.join(right, (F.col("a.task") == F.col("b.task")) & (F.col("a.block") <= F.col("b.block"))).where(
        F.col("a.pure").isNull() | F.col("b.pure").isNull() | (F.col("a.pure") != F.col("b.pure"))).where(
        (F.col("a.met") != F.col("b.met")) | (F.col("a.met") == 0)).select(
        "a.task", F.explode(F.when(F.col("a.block") == F.col("b.block"), F.array(sides[0])).otherwise(F.array(*sides[1:]))).alias("of"),
        F.xxhash64("a.task", "a.block", "b.block").alias("pair")).select("task", "of.block", "of.side", "pair")
    return placed.join(pairs, ["task", "block"]).select(F.col("pair").alias("task"), "tree", "id", "label", "earlier", "side")


def id_blocks(large: DataFrame, node: int) -> DataFrame:
    """Rows (task, tree, id, label): large nodes cut into nodes at random, so similar classes of a group get joined at all."""
    block = F.pmod(F.xxhash64("id", "task"), F.ceil(F.col("size") / (node // 2)))
    return large.select(F.xxhash64("task", block).alias("task"), "tree", "id", "label")


def groups(batches: Iterator[pa.RecordBatch], key: str = "task") -> Iterator[pa.Table]:
    """Tables that hold whole groups of sorted rows."""
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
        keys = table.column(key).to_numpy()
        last = len(keys) - int(np.argmax(keys[::-1] != keys[-1])) if keys[0] != keys[-1] else 0
        if last:
            yield table.slice(0, last).combine_chunks()
        kept = table.slice(last)
    if kept is not None and kept.num_rows:
        yield kept.combine_chunks()


def _bounds(keys: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])).tolist()
    return list(zip(cuts, cuts[1:]))


def alike(minhash: np.ndarray, labels: np.ndarray, tree: int, split: np.ndarray, apart: np.ndarray, threshold: float,
          left: slice = slice(None), right: slice = slice(None)) -> np.ndarray:
    """Which pairs of rows (of `left` and of `right`) are to be compared: labels differ, enough minhash values agree (4.5 standard
    deviations are allowed), and no earlier tree had both in a root that was compared as a whole (`split`: by row and root, that
    it was not). Rows with an equal number other than 0 in a column of `apart` are not compared.
    """
    least = (threshold - 4.5 * np.sqrt(threshold * (1 - threshold) / minhash.shape[1])) * minhash.shape[1]
    same = minhash[left, None, :] == minhash[None, right, :]
    met = (same[:, :, :tree] & ~split[left, None, :tree]).any(axis=2)
    free = ((apart[left, None] != apart[None, right]) | (apart[left, None] == 0)).all(axis=2)
    return (same.sum(axis=2) >= least) & (labels[left, None] != labels[None, right]) & ~met & free


def task_part(task: int, i: int, j: int) -> int:
    """The number of a part of a task."""
    return int.from_bytes(hashlib.blake2b(np.array([task, i, j], "<i8").tobytes(), digest_size=8).digest(), "little", signed=True)


def verified(tasks: DataFrame, classes: DataFrame, docs: DataFrame, size: int, threshold: tuple[int, int], node: int = NODE) -> DataFrame:
    """Pairs (a, b) of labels that links between classes of a task join, every link confirmed on full sets.

    Of a task of more than `node` classes, those with a close one go on in parts of at most `node`, so few texts are held at a time.
    `tasks`: task, tree, id, label, earlier, side; `classes`: id, digest, minhash and split, the trees whose root is not compared whole.
    """
    part, whole = threshold
    half = max(1, node // 2)

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().reshape(len(column), -1)

    def trees_split(column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), ROOTS), bool)
        for row, trees in enumerate(column.to_pylist()):
            out[row, trees or []] = True
        return out

    def separate(table: pa.Table) -> np.ndarray:
        return np.column_stack([table.column("earlier").to_numpy(), table.column("side").to_numpy()])

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            keys, labels = table.column("task").to_numpy(), table.column("label").to_numpy()
            values, tree = matrix(table.column("minhash").combine_chunks()), table.column("tree").to_numpy()
            split, apart = trees_split(table.column("split")), separate(table)
            rows, parts = [], []
            for a, b in _bounds(keys):
                of = values[a:b], labels[a:b], tree[a], split[a:b], apart[a:b], part / whole
                if b - a <= node:
                    rows.append(a + np.flatnonzero(alike(*of).any(axis=1)))
                    parts.append(keys[rows[-1]])
                    continue
                pieces = [slice(at, min(at + half, b - a)) for at in range(0, b - a, half)]
                for i, left in enumerate(pieces):
                    for j, right in enumerate(pieces[i:], i):
                        if apart[a + left.start, 1] == apart[a + right.stop - 1, 1] > 0:
                            continue  # of one side
                        close = alike(*of, left, right)
                        own = left.start + np.flatnonzero(close.any(axis=1)), right.start + np.flatnonzero(close.any(axis=0))
                        if len(own[0]):
                            rows.append(a + np.union1d(*own))
                            parts.append(np.full(len(rows[-1]), task_part(int(keys[a]), i, j)))
            kept = table.take(pa.array(np.concatenate(rows)))
            yield from kept.set_column(0, "task", pa.array(np.concatenate(parts), pa.int64())).to_batches()

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            keys, labels = table.column("task").to_numpy(), table.column("label").to_numpy()
            digests, tree = table.column("digest").to_pylist(), table.column("tree").to_numpy()
            values, split = matrix(table.column("minhash").combine_chunks()), trees_split(table.column("split"))
            texts, apart = table.column("text").combine_chunks(), separate(table)
            out = []
            for a, b in _bounds(keys):
                sets = shingle_sets(texts.slice(a, b - a), size)
                right = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d for s, d in zip(sets, digests[a:b])]
                pairs = np.argwhere(np.triu(alike(values[a:b], labels[a:b], tree[a], split[a:b], apart[a:b], part / whole), 1))
                root = {int(x): int(x) for x in labels[a:b]}

                def find(x: int) -> int:
                    while root[x] != x:
                        root[x] = x = root[root[x]]
                    return x

                for i, j in pairs.tolist():
                    x, y = find(int(labels[a + i])), find(int(labels[a + j]))
                    if x == y or not (right[i] and right[j]):
                        continue
                    few, many = sorted((len(sets[i]), len(sets[j])))
                    if whole * few < part * many:
                        continue
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if whole * common >= part * (few + many - common):
                        root[max(x, y)] = min(x, y)
                out += [(x, find(x)) for x in root if root[x] != x]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    known = classes.select("id", "minhash", "digest", "split")
    columns = ["task", "tree", "id", "label", "earlier", "side", "minhash", "digest", "split"]
    met = tasks.join(known, "id").select(*columns).repartition("task").sortWithinPartitions("task", "side", "id")
    close = written_once(met.mapInArrow(lambda batches: given_back(survivors(batches)), met.schema), "close-classes")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    ids = written_once(close.select("id").distinct(), "close-ids")
    if ids.count() <= BROADCAST_IDS:  # then only their texts are shuffled
        texts = texts.join(F.broadcast(ids), "id", "left_semi")
    wanted = close.join(texts, "id").select(*columns, "text").repartition("task").sortWithinPartitions("task", "id")
    return written_once(wanted.mapInArrow(lambda batches: given_back(links(batches)), "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """id and label (the smallest id of its component) of every id in a link, by alternating star contractions."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()

    def pairs(*ends: tuple[str, str]) -> DataFrame:
        return edges.select(F.explode(F.array(*[F.struct(F.col(x).alias("u"), F.col(y).alias("v")) for x, y in ends])).alias("e")).select("e.u", "e.v")

    def star(around: DataFrame, kept: str) -> DataFrame:
        """Every vertex's kept neighbours are tied to the smallest of them all, instead of to the vertex."""
        low = around.groupBy("u").agg(F.min("v").alias("m"))
        tied = around.join(low, "u").where(f"{kept} and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return written_once(tied.distinct(), "stars")

    while True:
        # only stars are left when every vertex is either a middle or tied to one middle
        ends = pairs(("u", "v"), ("v", "v")).groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
        if ends.where("low <> high").isEmpty():
            return edges.select(F.col("u").alias("id"), F.col("v").alias("label"))
        edges = star(pairs(("u", "v"), ("v", "u"), ("u", "u"), ("v", "v")), "v >= u")
        edges = star(pairs(("u", "v"), ("u", "u")), "true")


def same_id_links(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that share a document id: rows that repeat an id with another text."""
    repeated = rows.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high").select("doc_id")
    repeated = written_once(repeated, "repeated-ids")
    if repeated.isEmpty():
        return repeated.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
    of_id = rows.where("n > 0").join(repeated, "doc_id").select("doc_id", "digest").distinct().join(classes.select("digest", "id"), "digest")
    return of_id.join(of_id.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").select("a", F.col("id").alias("b")).where("a <> b")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (75, 100), id_col: str = "doc_id",
                    text_col: str = "text", trees: tuple[int, int] = TREES, node: int = NODE, depth: int = DEPTH) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links, its own without any) and kept, per row.

    A link is a share of common shingles of at least threshold[0] / threshold[1].
    """
    if sum(trees) > ROOTS:
        raise ValueError(f"there are minhash values for {ROOTS} roots")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = written_once(shingled(docs, size), "shingled")
    classes = written_once(rows.where("n > 0 and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.any_value("minhash").alias("minhash"), F.count(F.lit(1)).alias("rows")), "classes")
    labels = split = None
    first = 0
    for last, count in enumerate(trees):
        labelled = classes.select("id", "minhash", "digest")
        labelled = labelled.withColumn("label", F.col("id")) if labels is None else written_once(labelled.join(labels, "id", "left").withColumn(
            "label", F.coalesce("label", "id")), "labelled")  # joined once, read by every step of the trees
        small, large, parted = tree_nodes(labelled, range(first, first + count), node, depth, bool(last))
        # in the first trees, random blocks join the bulk of a large group; in the later ones all that is not joined meets
        free = {name: F.lit(0).cast("long") for name in ("earlier", "side")}
        tasks = small.withColumns(free).unionByName(blocks(large, node) if last else id_blocks(large, node).withColumns(free))
        split = parted if split is None else split.unionByName(parted)
        labelled = labelled.join(split.groupBy("id").agg(F.collect_set("tree").alias("split")), "id", "left")
        links = verified(tasks, labelled, docs, size, threshold, node)
        found = components(links if last else links.unionByName(same_id_links(rows, classes)))
        if labels is not None:  # from joined labels to the classes that carry them
            moved = found.select(F.col("id").alias("label"), F.col("label").alias("joined"))
            found = labels.join(moved, "label", "left").select("id", F.coalesce("joined", "label").alias("label")).unionByName(
                found.join(labels, "id", "left_anti"))
        labels = written_once(found, "labels")
        first += count
    told = classes.join(labels, "id", "left").where("rows > 1 or label is not null").select(
        "digest", F.coalesce("label", "id").alias("component_id"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.select("doc_id", "n", "digest", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    joined = salted.join(told, ["digest", "salt"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component, the one with the smallest id, with all columns; rows without an id all stay.

    Of rows that repeat the id that stays, the one with the smallest text stays (nulls first).
    """
    found = written_once(near_duplicates(docs, id_col=id_col, text_col=text_col, **options), "components")
    gone = written_once(found.where(~F.col("kept")).select(F.col("doc_id").alias(id_col)).distinct(), "gone-ids")
    if gone.count() <= BROADCAST_IDS:  # then no text is shuffled
        gone = F.broadcast(gone)
    kept = docs.join(gone, id_col, "left_anti").select(docs.columns)
    repeated = found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(id_col))
    if repeated.isEmpty():
        return kept
    # whole rows in one column, so that no name of theirs is in the way
    again = kept.join(repeated, id_col, "left_semi").select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*docs.columns).alias("doc"))
    first = Window.partitionBy("id").orderBy(F.col("text").asc_nulls_first())
    one = again.withColumn("place", F.row_number().over(first)).where("place = 1").select("doc.*")
    return kept.join(repeated, id_col, "left_anti").select(docs.columns).unionByName(one)
