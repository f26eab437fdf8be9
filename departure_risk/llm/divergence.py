"""How far the sources of a language are apart in the words they use, by a three-dimensional partitioning.

A group is a (language, source) that occurs. Words are counted per group, and a language keeps those of at least `least_docs`
of its documents. A group gives each kept word p = 1 + floor(SCALE * (count + 5) / (N + 5 * V)), in whole numbers; two groups
differ by the sum of |p - q| over all kept words.

The sum is cut along three axes. Groups of a language come in blocks, kept words in blocks, and a cell is
(group block, group block, word block). A slice, the counts of one group block in one word block, is copied to every cell
that stands on it; the cell's task lays its two slices out as arrays and gives partial sums for pairs of groups. Partial sums
are added along the word axis. A task holds two slices, whatever the number of groups, words or documents.

Defined cases: null text, language and source count as empty ones; a group without words takes part with count 0; a
language that keeps no word has p = 1 for nothing, so its pairs differ by 0; rows that repeat an id are documents each; ties
in value are ordered by item, bytewise; other columns are ignored; an empty table gives no row.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from departure_risk.session import written_once

SCALE = 1_000_000_000
#: Groups and words of a block. A slice is at most GROUP_BLOCK x WORD_BLOCK numbers.
GROUP_BLOCK, WORD_BLOCK = 64, 4096
#: Kept words that are broadcast at most (about 60 bytes each); more are joined by shuffling.
BROADCAST_WORDS = 1_000_000
#: Entries of counts that a task holds before it sends them on.
HELD = 400_000

#: Bytes of words: letters in lower case and all bytes of other alphabets; the rest counts as space.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, word, count and docs (documents with the word)."""
    def empty(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def held() -> Iterator[pa.RecordBatch]:
            for (lang, source), (words, docs_of) in counts.items():
                names = list(words)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(names), pa.string()), pa.array([source] * len(names), pa.string()),
                    pa.array(names, pa.binary()).cast(pa.string()), pa.array(words.values(), pa.int64()),
                    pa.array([docs_of[w] for w in names], pa.int64())], names=["lang", "source", "word", "count", "docs"])
            counts.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = Counter(text.as_py().encode().translate(_WORD).split())
                whole, docs_of = counts.setdefault((lang, source), (Counter(), Counter()))
                size -= len(whole)
                whole.update(words)
                docs_of.update(words.keys())
                size += len(whole)
                if size > HELD:
                    yield from held()
                    size = 0
        yield from held()

    texts = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), empty(text_col).alias("text"))
    counted = texts.mapInArrow(count, "lang string, source string, word string, count long, docs long")
    return counted.groupBy("lang", "source", "word").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 * kept)), exact beyond 64 bits; 1 where no word is kept."""
    wide = "decimal(20,0)"
    above = (count + 5).cast(wide) * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(kept == 0, F.lit(1).cast("long")).otherwise(
        F.floor(F.call_function("div", above, F.greatest(total + 5 * kept, F.lit(1)).cast(wide))) + 1).cast("long")


def partial_sums(entries: DataFrame, group_block: int, word_block: int) -> DataFrame:
    """lang, a, b and value: what a word block adds to a pair of groups a < b, one task for each cell.

    The rows of a cell are the entries of its two slices (group, slot of the word, p) and, with slot null, each group's p
    of a word it doesn't have; `words` is the number of kept words in the block.
    """
    def cell(rows: pa.Table) -> pa.Table:
        side, group = rows["group_of"].to_numpy(), rows["number"].to_numpy()
        slot, p = rows["slot"].to_numpy(), rows["p"].to_numpy()
        words, one = rows["words"][0].as_py(), rows["row_block"][0].as_py() == rows["column_block"][0].as_py()

        def slice_of(block: int) -> tuple[np.ndarray, np.ndarray]:
            mine = side == block
            numbers = np.unique(group[mine])
            table = np.empty((len(numbers), words), np.int64)
            common = mine & (slot < 0)
            table[np.searchsorted(numbers, group[common])] = p[common][:, None]
            own = mine & (slot >= 0)
            table[np.searchsorted(numbers, group[own]), slot[own]] = p[own]
            return numbers, table

        rows_of, left = slice_of(rows["row_block"][0].as_py())
        columns_of, right = (rows_of, left) if one else slice_of(rows["column_block"][0].as_py())
        a, b, value = [], [], []
        for i, number in enumerate(rows_of):
            first = i + 1 if one else 0
            a.append(np.full(len(columns_of) - first, number))
            b.append(columns_of[first:])
            value.append(np.abs(right[first:] - left[i]).sum(axis=1))
        a, b, value = (np.concatenate(x).astype(np.int64) for x in (a, b, value))
        return pa.table({"lang": pa.array([rows["lang"][0].as_py()] * len(a), pa.string()), "a": a, "b": b, "value": value})

    return entries.groupBy("lang", "row_block", "column_block", "word_block").applyInArrow(cell, "lang string, a long, b long, value long")


def pair_sums(groups: DataFrame, entries: DataFrame, blocks: DataFrame, group_block: int, word_block: int) -> DataFrame:
    """lang, a, b (numbers of groups, a < b) and value."""
    of_group = F.expr(f"number div {group_block}")
    present = entries.select("lang", "number", of_group.alias("group_of"), "group_blocks", "word_block", "slot", "p", "words")
    missing = groups.withColumn("group_of", of_group).join(blocks, "lang").select(
        "lang", "number", "group_of", "group_blocks", "word_block", F.lit(-1).alias("slot"), F.col("p_of_none").alias("p"), "words")
    # a slice goes to every cell in its row and its column
    copied = present.unionByName(missing).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("group_blocks") - 1)))
    cells = copied.withColumns({"row_block": F.least("group_of", "other"), "column_block": F.greatest("group_of", "other")})
    return partial_sums(cells, group_block, word_block).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = 30, top_words: int = 50, group_block: int = GROUP_BLOCK, word_block: int = WORD_BLOCK,
          **columns) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part `pair` has every other source of the language by their distance. Part `term` has the `top_words` kept words that
    the source uses most above the language as a whole.
    """
    counts = written_once(word_counts(docs, **columns), "divergence-counts")
    lang, source = (F.coalesce(F.col(columns.get(c, d)).cast("string"), F.lit("")).alias(n) for c, d, n in (
        ("lang_col", "lang", "lang"), ("source_col", "source", "source")))
    by_lang = Window.partitionBy("lang")
    kept = counts.groupBy("lang", "word").agg(F.sum("docs").alias("docs"), F.sum("count").alias("of_lang")).where(
        F.col("docs") >= least_docs).drop("docs")
    kept = written_once(kept, "divergence-kept")
    per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("of_lang").alias("total_of_lang"))
    per_lang = per_lang.withColumn("word_blocks", F.ceil(F.col("kept") / word_block).cast("long"))
    # a word's block by its hash, its slot by its order in the block
    in_block = Window.partitionBy("lang", "word_block").orderBy("word")
    dealt = kept.join(per_lang, "lang").withColumn("word_block", F.pmod(F.xxhash64("word"), F.col("word_blocks"))).repartition(
        "lang", "word_block")  # else the window would stay with the join's languages
    words = written_once(dealt.withColumns({
        "slot": (F.row_number().over(in_block) - 1).cast("int"),
        "q": share(F.col("of_lang"), F.col("total_of_lang"), F.col("kept"))}).select("lang", "word", "word_block", "slot", "q"), "divergence-words")
    few = words.count() <= BROADCAST_WORDS
    own = counts.select("lang", "source", "word", "count").join(F.broadcast(words) if few else words, ["lang", "word"])
    own = written_once(own, "divergence-own")
    totals = own.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    # sources of a language are numbered in one window: their pairs are the result
    numbered = docs.select(lang, source).distinct().join(totals, ["lang", "source"], "left").join(per_lang, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"), F.coalesce("kept", F.lit(0)).cast("long").alias("kept"),
        (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("number"), F.count(F.lit(1)).over(by_lang).alias("in_lang"))
    groups = written_once(numbered.withColumns({
        "p_of_none": share(F.lit(0).cast("long"), F.col("total"), F.col("kept")),
        "group_blocks": F.ceil(F.col("in_lang") / group_block).cast("long")}), "divergence-groups")
    sizes = words.groupBy("lang", "word_block").agg(F.count(F.lit(1)).cast("int").alias("words"))
    # a language without kept words has one empty block
    blocks = written_once(groups.select("lang").distinct().join(sizes, "lang", "left").select(
        "lang", F.coalesce("word_block", F.lit(0)).cast("long").alias("word_block"), F.coalesce("words", F.lit(0)).alias("words")), "divergence-blocks")
    shares = own.join(groups, ["lang", "source"]).withColumn("p", share(F.col("count"), F.col("total"), F.col("kept")))
    sums = written_once(pair_sums(groups, shares.join(blocks, ["lang", "word_block"]), blocks, group_block, word_block), "divergence-pairs")
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = groups.select("lang", "number", "source")
    pairs = both.join(name.withColumnRenamed("number", "a"), ["lang", "a"]).join(
        name.select("lang", F.col("number").alias("b"), F.col("source").alias("item")), ["lang", "b"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("word").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    return ranked.unionByName(terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_words))
