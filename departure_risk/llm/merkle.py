"""A Merkle manifest of a table, kept as a persistent tree: a tampered leaf makes a version that shares every untouched node.

1. Every row is a leaf, the SHA-256 of its fields. Leaves are put in order (by language, then id) with one range
   partitioning and offsets per partition, so no task holds a language.
2. Aligned blocks of FAN ** BLOCK_LEVELS leaves are trees of their own, each built in one task. Their roots are the leaves
   of the next tier, in blocks again, until one node of a language is left, its subroot; subroots make a tree the same way.
3. Downwards, every block gets the siblings on its way to the root. With these, each leaf's proof is hashed and folded.
4. A tampered leaf copies only its ancestors: first inside its block, then its version goes on through the upper tiers, a
   join to the siblings of its node at each tier, dealt over as many salts as the leaves below that node ask for. Nodes off
   the path are those of the original. The tables of `Manifest.versions` hold the copied nodes and nothing else.

A digest is lower-case hex text where it is hashed; 32 bytes in tables of leaves.

Defined cases: a null field is `-`; empty texts are fields of no bytes; leaves are ordered by id, null ids first, then by
digest, and rows that are equal in every field are a leaf each; a null language is a tree of its own, first in order; rows
without an id are not tampered with; no rows, no tree, and an empty result; columns other than the fields and the language
are ignored.
"""

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from departure_risk.session import written_once

FAN = 8
#: Levels of a block; a block has up to FAN ** BLOCK_LEVELS nodes.
BLOCK_LEVELS = 4
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Versions that share a copy of the siblings of their node.
SALT_VERSIONS = 50_000


@dataclass
class Manifest:
    """trees: lang, tree, leaves. tiers and top: the inner nodes above the first blocks. versions: a table per tier."""

    root: str
    trees: DataFrame
    tiers: list[DataFrame]
    top: list[DataFrame]
    versions: list[DataFrame]
    leaves: DataFrame


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each `-` or its bytes' number, a colon and itself."""
    def encoded(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[encoded(f) for f in fields]), 256))


def ranked(rows: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """Add `position` (from 0 in its group by `order`, nulls first) and `members` (rows of the group).

    Rows are sorted in ranges and written; a range's first position follows from the counts of the ranges before it.
    """
    columns = [F.col(c).asc_nulls_first() for c in [*groups, *order]]
    sorted_rows = written_once(rows.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn(
        "at", F.monotonically_increasing_id()), name).withColumn("part", F.shiftright("at", 33))
    parts = sorted_rows.groupBy(*groups, "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    of_group = Window.partitionBy(*groups)  # a row for each range of a group
    offsets = parts.select(*groups, "part", "first", (F.sum("rows").over(of_group.orderBy("part")) - F.col("rows")).alias("before"),
                           F.sum("rows").over(of_group).alias("members"))
    return sorted_rows.join(offsets, [*groups, "part"]).withColumn("position", F.col("at") - F.col("first") + F.col("before")).drop(
        "at", "part", "first", "before")


def run_digest(children: list[bytes]) -> bytes:
    return sha256(b"".join(children)).hexdigest().encode()


def steps_of(members: int, fan: int, block_levels: int) -> int:
    """Levels that a block of a tier with so many nodes adds."""
    steps = 0
    while members > 1 and steps < block_levels:
        members, steps = -(-members // fan), steps + 1
    return steps


def block_nodes(leaves: list[bytes], steps: int, fan: int) -> list[list[bytes]]:
    """The levels of a block, the given nodes first."""
    levels = [leaves]
    for _ in range(steps):
        levels.append([run_digest(levels[-1][i:i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def copied_path(levels: list[list[bytes]], slot: int, digest: bytes, fan: int) -> list[bytes]:
    """The new ancestors inside a block when the node at `slot` becomes `digest`; every other node is shared."""
    copies = []
    for level in levels[:-1]:
        first = slot - slot % fan
        digest = run_digest([*level[first:slot], digest, *level[slot + 1:first + fan]])
        copies.append(digest)
        slot //= fan
    return copies


def siblings(levels: list[list[bytes]], slot: int, fan: int) -> list[bytes]:
    """The other nodes of the runs on the way up, level by level, left to right."""
    out = []
    for level in levels[:-1]:
        first = slot - slot % fan
        out += level[first:slot]
        out += level[slot + 1:first + fan]
        slot //= fan
    return out


def tier_of(nodes: DataFrame, fan: int, block_levels: int) -> DataFrame:
    """A row per block: tree, block, members (nodes of the tree at this tier), digest (its root) and levels, from the
    nodes: tree, position, members, digest (hex)."""
    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("position")
        members = rows["members"][0].as_py()
        levels = block_nodes([d.encode() for d in rows["digest"].to_pylist()], steps_of(members, fan, block_levels), fan)
        return pa.table({"tree": rows["tree"][:1], "block": rows["block"][:1], "members": rows["members"][:1],
                         "digest": [levels[-1][0].decode()], "levels": [[[d.decode() for d in level] for level in levels]]})

    blocked = nodes.withColumn("block", F.expr(f"position div {fan ** block_levels}"))
    return blocked.groupBy("tree", "block").applyInArrow(
        build, "tree long, block long, members long, digest string, levels array<array<string>>")


def block_roots(tier: DataFrame, fan: int, block_levels: int) -> DataFrame:
    """The nodes of the next tier: the blocks of trees that have more than one."""
    size = fan ** block_levels
    return tier.where(F.col("members") > size).select(
        "tree", F.col("block").alias("position"), F.expr(f"(members + {size - 1}) div {size}").alias("members"), "digest")


def tiers_above(first: DataFrame, most: int, fan: int, block_levels: int) -> list[DataFrame]:
    """All tiers, from the written first one of trees with at most `most` nodes."""
    tiers = [first]
    while most > fan ** block_levels:
        most = -(-most // fan ** block_levels)
        tiers.append(written_once(tier_of(block_roots(tiers[-1], fan, block_levels), fan, block_levels), "merkle-tier"))
    return tiers


def node_paths(tier: DataFrame, fan: int, block_levels: int) -> DataFrame:
    """tree, position, block and path, for every node that a tier's blocks stand on: (left, right) siblings per level."""
    at, run = f"cast(floor(s / pow({fan}, l)) as int)", f"cast(floor(s / pow({fan}, l + 1)) as int) * {fan}"
    pair = (f"named_struct('left', array_join(slice(levels[l], {run} + 1, {at} - {run}), ''),"
            f" 'right', array_join(slice(levels[l], {at} + 2, {run} + {fan - 1} - {at}), ''))")
    path = f"transform(filter(sequence(0, size(levels) - 1), l -> l < size(levels) - 1), l -> {pair})"
    slots = F.expr(f"transform(sequence(0, size(levels[0]) - 1), s -> named_struct('slot', s, 'path', {path}))")
    return tier.select("tree", "block", F.explode(slots).alias("node")).select(
        "tree", (F.col("block") * fan ** block_levels + F.col("node.slot")).alias("position"), "block", F.col("node.path").alias("path"))


def below(tier: DataFrame, over: DataFrame, fan: int, block_levels: int) -> DataFrame:
    """The whole path to the root of every node a tier stands on, from that of its blocks (tree, block, path)."""
    own = node_paths(tier, fan, block_levels).alias("own")
    return own.join(over.alias("over"), ["tree", "block"]).select(
        "tree", "position", F.concat("own.path", "over.path").alias("path"))


def paths_to_root(tiers: list[DataFrame], top: list[DataFrame], fan: int, block_levels: int) -> DataFrame:
    """tree, block and path to the root, for every block of the first tier. Upper tiers are small: a node for each block."""
    over = top[-1].select("tree", "block", F.expr("array()").cast("array<struct<left:string,right:string>>").alias("path"))
    for tier in reversed(top[1:]):
        over = below(tier, over, fan, block_levels).withColumnRenamed("position", "block")
    of_trees = written_once(below(top[0], over, fan, block_levels).select(F.col("position").alias("tree"), "path"), "merkle-tree-paths")
    over = None
    for number in range(len(tiers) - 1, -1, -1):
        last = tiers[number].where(F.col("members") <= fan ** block_levels).select("tree", "block")  # one block of a tree
        ended = last.join(of_trees, "tree").select("tree", "block", "path")
        over = ended if over is None else over.unionByName(ended)
        if number:
            over = below(tiers[number], over, fan, block_levels).withColumnRenamed("position", "block")
    return over


def checked_leaves(leaves: DataFrame, paths: DataFrame, fan: int, block_levels: int) -> DataFrame:
    """Each leaf with its proof's hash and what it folds to; a changed one with the ancestors its version copies in its block."""
    def check(rows: pa.Table, over: pa.Table) -> pa.Table:
        rows = rows.sort_by("position")
        members = rows["members"][0].as_py()
        digests = [d.hex().encode() for d in rows["digest"].to_pylist()]
        levels = block_nodes(digests, steps_of(members, fan, block_levels), fan)
        path = [(p["left"].encode(), p["right"].encode()) for p in over["path"][0].as_py()]
        upper, folded = b"".join(a + b for a, b in path), {}

        def to_root(digest: bytes) -> str:
            if digest not in folded:
                now = digest
                for left, right in path:
                    now = sha256(left + now + right).hexdigest().encode()
                folded[digest] = now.decode()
            return folded[digest]

        proofs, ends, copies, now = [], [], [], []
        for slot, (digest, changed) in enumerate(zip(digests, rows["changed"].to_pylist())):
            proofs.append(sha256(b"".join(siblings(levels, slot, fan)) + upper).hexdigest())
            new = digest if changed is None else changed.hex().encode()
            copy = copied_path(levels, slot, new, fan)
            last = copy[-1] if copy else new
            ends.append(to_root(last) if changed is None else None)
            copies.append(None if changed is None else [c.decode() for c in copy])
            now.append(None if changed is None else last.decode())
        return pa.table({
            "doc_id": rows["doc_id"], "tree": rows["tree"], "position": rows["position"], "block": rows["block"],
            "members": rows["members"], "leaf": [d.decode() for d in digests], "proof_sha256": proofs, "folded_root": pa.array(ends, pa.string()),
            "nodes": pa.array(copies, pa.list_(pa.string())), "digest": pa.array(now, pa.string())})

    blocked = leaves.withColumn("block", F.expr(f"position div {fan ** block_levels}"))
    # language, id and digest only: a group is one block
    return blocked.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")).applyInArrow(check, (
        "doc_id long, tree long, position long, block long, members long, leaf string, proof_sha256 string, folded_root string,"
        " nodes array<string>, digest string"))


def go_on(versions: DataFrame, paths: DataFrame, salts: Column) -> DataFrame:
    """Versions after one more tier: `nodes` are the copied ancestors there, `digest` the last of them.

    Both sides have tree, position and `leaves` (of the tree); `salts` is the copies a node's siblings are kept in.
    """
    spread = paths.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("leaves")
    dealt = versions.withColumn("salt", F.pmod(F.xxhash64("leaf", "doc_id"), salts)).drop("block", "nodes")
    start = F.struct(F.col("digest").alias("now"), F.expr("cast(array() as array<string>)").alias("nodes"))

    def copy(so_far: Column, pair: Column) -> Column:
        new = F.sha2(F.concat(pair["left"], so_far["now"], pair["right"]), 256)
        return F.struct(new.alias("now"), F.array_append(so_far["nodes"], new).alias("nodes"))

    joined = dealt.join(spread, ["tree", "position", "salt"]).withColumn("copied", F.aggregate("path", start, copy))
    return joined.withColumns({"digest": F.col("copied.now"), "nodes": F.col("copied.nodes")}).drop("path", "copied", "salt")


def all_versions(checked: DataFrame, trees: DataFrame, tiers: list[DataFrame], top: list[DataFrame], fan: int, block_levels: int
                 ) -> list[DataFrame]:
    """A table of versions per tier, from blocks of leaves to the root; the last table's digests are roots."""
    size = fan ** block_levels
    leaves_of = trees.select("tree", "leaves")
    now = checked.where("digest is not null").select("doc_id", "leaf", "proof_sha256", "tree", "block", "members", "nodes", "digest").join(
        leaves_of, "tree")
    tables, ended, beneath = [now], now.where(F.col("members") <= size), 1

    def salts(most: Column) -> Column:
        return F.ceil(most / SALT_VERSIONS).cast("long")

    for tier in tiers[1:]:
        beneath *= size
        going = now.where(F.col("members") > size).withColumns({
            "position": F.col("block"), "members": F.expr(f"(members + {size - 1}) div {size}")})
        of_nodes = node_paths(tier, fan, block_levels).join(leaves_of, "tree")
        now = written_once(go_on(going, of_nodes, salts(F.least(F.lit(beneath), F.col("leaves")))).drop("position"), "merkle-versions")
        tables.append(now)
        ended = ended.unionByName(now.where(F.col("members") <= size), allowMissingColumns=True)
    now = ended.withColumns({"position": F.col("tree"), "of_tree": F.col("tree"), "tree": F.lit(0).cast("long")})
    for number, tier in enumerate(top):
        of_nodes = node_paths(tier, fan, block_levels)
        if number == 0:
            own = leaves_of.select(F.col("tree").alias("position"), "leaves")
            now = go_on(now, of_nodes.join(own, "position"), salts(F.col("leaves")))
        else:  # above FAN ** BLOCK_LEVELS languages: few nodes, left to the planner
            now = go_on(now.withColumn("position", F.col("block")), of_nodes, F.lit(1).cast("long"))
        now = written_once(now.drop("position"), "merkle-versions")
        tables.append(now)
    return tables


def manifest(docs: DataFrame, chosen: Column, changes: dict[str, Column], fields: list[str] = FIELDS, id_col: str = "doc_id",
             lang_col: str = "lang", fan: int = FAN, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The tree over `docs`, each leaf's proof, and a version for each row that is `chosen`, with its fields as `changes` says."""
    after = leaf_digest([changes.get(f, F.col(f)) for f in fields])
    hashed = written_once(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
        leaf_digest([F.col(f) for f in fields]).alias("digest"), F.when(chosen, after).alias("changed"),
        F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    # the tree of each language: its place in order
    trees = written_once(ranked(hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("leaves")), [], ["lang"], "merkle-languages").select(
        "lang", F.col("position").alias("tree"), "leaves"), "merkle-trees")
    most, count = trees.agg(F.coalesce(F.max("leaves"), F.lit(0)), F.count(F.lit(1))).first()  # two numbers
    of_tree = hashed.join(trees.select("lang", "tree"), hashed["lang"].eqNullSafe(trees["lang"])).drop("lang")
    leaves = ranked(of_tree, ["tree"], ["doc_id", "digest", "row"], "merkle-order").drop("row")
    first = tier_of(leaves.withColumn("digest", F.lower(F.hex("digest"))), fan, block_levels).drop("levels")
    tiers = tiers_above(written_once(first, "merkle-tier"), most, fan, block_levels)
    size = fan ** block_levels
    subroots = None  # a tree ends at the tier where it has one block
    for tier in tiers:
        ended = tier.where(F.col("members") <= size).select(F.col("tree").alias("position"), "digest")
        subroots = ended if subroots is None else subroots.unionByName(ended)
    subroots = written_once(subroots.withColumns({"tree": F.lit(0).cast("long"), "members": F.lit(count).cast("long")}), "merkle-subroots")
    top = tiers_above(written_once(tier_of(subroots, fan, block_levels), "merkle-tier"), count, fan, block_levels)
    root = [r.digest for r in top[-1].select("digest").collect()]  # one row, or none
    paths = paths_to_root(tiers, top, fan, block_levels)
    checked = written_once(checked_leaves(leaves, paths, fan, block_levels), "merkle-checked")
    versions = all_versions(checked, trees, tiers, top, fan, block_levels)
    trees = trees.join(subroots.select(F.col("position").alias("tree"), F.col("digest").alias("subroot")), "tree")
    return Manifest(root[0] if root else "", trees, tiers, top, versions, checked)


def report(found: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row."""
    columns = ["doc_id", "tree", "leaf", "proof_sha256", "folded_root"]
    same = found.leaves.where("digest is null").select(*columns)
    changed = found.versions[-1].select("doc_id", F.col("of_tree").alias("tree"), "leaf", "proof_sha256", F.col("digest").alias("folded_root"))
    rows = same.unionByName(changed).join(found.trees.select("tree", "subroot"), "tree")
    return rows.select("doc_id", "leaf", "subroot", F.lit(found.root).alias("root"), "proof_sha256", "folded_root",
                       (F.col("folded_root") == found.root).alias("verified"))
