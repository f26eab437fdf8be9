from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from departure_risk.llm import merkle
from llm.conftest import sentence, table

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def manifest(docs, **options):
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.manifest(docs, third, {"text": lowered}, **options)


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def folded(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def near(levels, at, fan):
    out = []
    for level in levels[:-1]:
        first = at - at % fan
        out.append(("".join(level[first:at]), "".join(level[at + 1:first + fan])))
        at //= fan
    return out


def brute(rows, fan=8):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {}
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        levels[lang] = folded([leaf(r) for r in trees[lang]], fan)
    top = folded([levels[lang][-1][0] for lang in langs], fan)
    out = []
    for place, lang in enumerate(langs):
        for at, row in enumerate(trees[lang]):
            path = near(levels[lang], at, fan) + near(top, place, fan)
            changed = row[0] is not None and row[4] is not None and crc32(str(row[0]).encode()) % 3 == 0
            now = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))) if changed else leaf(row)
            for left, right in path:
                now = digest(left, now, right)
            out.append((row[0], leaf(row), levels[lang][-1][0], top[-1][0], digest(*[a + b for a, b in path]), now, now == top[-1][0]))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))
                   for r in frame.collect()), key=repr)


def documents(n, langs, seed=3):
    rng = np.random.default_rng(seed)
    return [(i * 7 % 1009, f"s{i % 3}", langs[min(int(rng.exponential(len(langs) / 3)), len(langs) - 1)], i,
             sentence(rng, 3).title() if i % 4 else sentence(rng, 2)) for i in range(n)]


@pytest.mark.parametrize("fan, block_levels", [(8, 4), (2, 1), (3, 2)])
def test_against_a_plain_tree(spark, fan, block_levels):
    rows = documents(300, ["en", "de", None, "", "é", "z", "zz"])
    found = manifest(table(spark, rows, SCHEMA).repartition(5), fan=fan, block_levels=block_levels)
    got = rows_of(merkle.report(found))
    assert got == brute(rows, fan) and {r[-1] for r in got} == {True, False}


def test_more_languages_than_a_block_has_nodes(spark):
    rows = documents(200, [f"l{i}" for i in range(90)], seed=8)
    got = merkle.report(manifest(table(spark, rows, SCHEMA), fan=3, block_levels=1))
    assert rows_of(got) == brute(rows, 3)


def test_many_versions_of_one_node(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SALT_VERSIONS", 7)
    rows = documents(250, ["en"])
    got = merkle.report(manifest(table(spark, rows, SCHEMA), fan=2, block_levels=2))
    assert rows_of(got) == brute(rows, 2)


def test_defined_cases(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (3, "a", "en", 0, ""), (3, "a", "en", 0, ""),
            (3, "b", "en", 1, "X"), (4, "s", "de", None, None), (5, None, None, 9, "É Ü A"), (-6, "s", "de", 2, "AB"),
            (2 ** 62, "s", "de", 10 ** 12, "A" * 300_000), (9, "s:1", "-", 3, "-"), (12, "s", "", 3, "MiXed")]
    got = rows_of(merkle.report(manifest(table(spark, rows, SCHEMA))))
    assert got == brute(rows)
    one = [(1, "s", "en", 4, "Text")]
    assert rows_of(merkle.report(manifest(table(spark, one, SCHEMA)))) == brute(one)
    none = manifest(table(spark, [], SCHEMA))
    assert none.root == "" and merkle.report(none).count() == 0


def test_versions_share_what_they_do_not_copy(spark):
    """A version's nodes are exactly the ancestors of its leaf, one per level, in the tables of the tiers."""
    fan, block_levels = 2, 2
    rows = documents(100, ["en", "de"])
    found = manifest(table(spark, rows, SCHEMA), fan=fan, block_levels=block_levels)
    copied = {}
    for tier in found.versions:
        for r in tier.collect():
            copied.setdefault(r.doc_id, []).extend(r.nodes)
    height = {r.lang: len(folded(["x"] * r.leaves, fan)) - 1 for r in found.trees.collect()}
    lang = {r[0]: r[2] for r in rows}
    assert copied and all(len(nodes) == height[lang[i]] + 1 for i, nodes in copied.items())  # and one level over two languages
    original = {d for row in merkle.report(found).collect() for d in (row.subroot, row.root)}
    # only where lower case changes nothing is a copy equal to an original node
    same = {r.doc_id for r in merkle.report(found).collect() if r.verified}
    assert all((nodes[-1] in original) == (i in same) for i, nodes in copied.items())
