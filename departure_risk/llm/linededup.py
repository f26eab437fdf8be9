"""Duplicate lines across all documents, equal or one word apart, by a deletion-neighbourhood join.

A line is a sequence of words (see `shingles`); two lines are duplicates if one word replaced, inserted or deleted, or none,
turns one into the other. Every line that has an earlier duplicate, by document id and place, is removed.

1. One pass gives every line a 128-bit key of its words. Equal lines are one class with its first place.
2. Lines one edit apart share their first or their second half, cut by the longer one's length. Four keys a class find the
   classes that share a half with another; only those go on (no pair is lost by it).
3. Each of them emits its deletion variants: the key of its words without the i-th, for every i, and of all its words.
   Equal variants with the same i are a replacement; a variant equal to a whole line is an insertion. Groups are reduced to
   their earliest class, never expanded to pairs.
4. The earliest neighbour of a class is verified on the words themselves.

Defined cases: lines without words stay; lines of fewer than `shortest` words are removed only for equal ones; a null text
has no line to remove, an empty one has one line without words; rows without an id stay as they are and count for none; rows
that repeat an id share their places, so equal lines at equal places of them all stay; an empty table gives no row; other
columns are ignored by `line_report` and kept by `deduplicated`.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from departure_risk.llm.neardup import text_slices
from departure_risk.llm.shingles import mix, word_hashes
from departure_risk.session import written_once

SHORTEST = 6
SALTS = 8
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2 ** 64))
OTHER = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Lines:
    """Word keys of lines with sums that give the key of any run of a line's words, wherever it begins."""

    def __init__(self, lines: pa.Array):
        self.words, bounds = word_hashes(lines)
        self.first, self.last = bounds[:-1], bounds[1:]
        self.n = self.last - self.first
        place = np.arange(len(self.words)) - np.repeat(self.first, self.n)
        most = int(self.n.max(initial=0)) + 2
        self.down = _powers(INVERSE, most)
        self.sums = self._sums(self.words, _powers(BASE, most)[place])
        self.others = self._sums(mix(self.words ^ OTHER), _powers(OTHER, most)[place])

    @staticmethod
    def _sums(words: np.ndarray, powers: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers, dtype=np.uint64)])

    def run(self, line: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The sum for words start .. start + length of lines, as if they began the line."""
        a = self.first[line] + start
        return (self.sums[a + length] - self.sums[a]) * self.down[start]

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        n = self.n.astype(np.uint64)
        return mix((self.sums[self.last] - self.sums[self.first]) ^ mix(n)), mix((self.others[self.last] - self.others[self.first]) ^ n)

    def halves(self) -> list[np.ndarray]:
        """Keys of the first and the second half, cut for the own length and for a line longer by one."""
        every, out = np.arange(len(self.n)), []
        for more in (0, 1):
            m = self.n + more
            head = np.minimum(m // 2, self.n)
            tail = np.minimum(m - m // 2, self.n)
            out.append(mix(self.run(every, np.zeros_like(head), head) ^ mix((2 * m).astype(np.uint64))))
            out.append(mix(self.run(every, self.n - tail, tail) ^ mix((2 * m + 1).astype(np.uint64))))
        return out

    def variants(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """line, place of the word left out (-1: none) and key, of all variants of all lines."""
        line = np.repeat(np.arange(len(self.n)), self.n)
        place = np.arange(len(line)) - np.repeat(self.first, self.n)
        rest = self.n[line] - place - 1
        head = self.run(line, np.zeros_like(place), place)
        end = self.first[line] + self.n[line]
        tail = (self.sums[end] - self.sums[end - rest]) * INVERSE
        lengths = self.n[line] - 1
        whole = self.sums[self.last] - self.sums[self.first]
        return (np.concatenate([line, np.arange(len(self.n))]), np.concatenate([place, np.full(len(self.n), -1)]),
                np.concatenate([mix((head + tail) ^ mix(lengths.astype(np.uint64))), mix(whole ^ mix(self.n.astype(np.uint64)))]))


def one_edit_apart(a: list[str], b: list[str]) -> bool:
    """Whether one word replaced, inserted or deleted, or none, turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def words_of(line: str) -> list[bytes]:
    return line.encode().lower().split()  # of bytes: only A to Z, only ASCII white space


def line_keys(docs: DataFrame) -> DataFrame:
    """doc_id, line, n (words), h1, h2 and halves (an array of four keys), per line."""
    shape = pa.schema([("doc_id", pa.int64()), ("line", pa.int32()), ("n", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()),
                       ("halves", pa.list_(pa.int64()))])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1):
                split = pc.split_pattern(part.column(1).cast(pa.large_string()), "\n")
                offsets = split.offsets.to_numpy()
                counts = np.diff(offsets)
                lines = Lines(split.values.slice(offsets[0], offsets[-1] - offsets[0]) if len(offsets) > 1 else split.values)
                one, two = lines.keys()
                halves = np.stack(lines.halves(), axis=1).view(np.int64).reshape(-1)
                number = np.arange(len(lines.n)) - np.repeat(offsets[:-1] - offsets[0], counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column(0).to_numpy(), counts)), pa.array(number.astype(np.int32)),
                     pa.array(lines.n.astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, len(halves) + 1, 4, dtype=np.int32)), pa.array(halves))], schema=shape)

    return docs.mapInArrow(keyed, "doc_id long, line int, n int, h1 long, h2 long, halves array<long>")


def line_variants(candidates: DataFrame) -> DataFrame:
    """key, place, h1, h2 and first of all variants of the candidate lines (h1, h2, first, text)."""
    first = candidates.schema["first"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 3):
                line, place, key = Lines(part.column(3)).variants()
                taken = part.select(["h1", "h2", "first"]).take(pa.array(line))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(place.astype(np.int32)), taken.column(0), taken.column(1), taken.column(2)],
                    names=["key", "place", "h1", "h2", "first"])

    return candidates.select("h1", "h2", "first", "text").mapInArrow(emit, f"key long, place int, h1 long, h2 long, first {first}")


def candidate_lines(lines: DataFrame, docs: DataFrame, shortest: int) -> DataFrame:
    """h1, h2, first (place) and text of the classes that share a half with another class."""
    classes = lines.where(F.col("n") >= shortest).groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "line")).alias("first"), F.min("halves").alias("halves"))
    halves = written_once(classes.select("h1", "h2", "first", F.explode("halves").alias("half")), "line-halves")
    shared = halves.groupBy("half").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low < high").select("half")
    near = halves.join(shared, "half").select("h1", "h2", "first").distinct()
    by_doc = near.groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.collect_list(F.struct("h1", "h2", "first")).alias("found"))
    texts = docs.join(by_doc, "doc_id").select(F.split("text", "\n").alias("lines"), F.explode("found").alias("c"))
    return texts.select("c.h1", "c.h2", "c.first", F.get("lines", F.col("c.first.line")).alias("text")).where("text is not null")


def nearest_earlier(candidates: DataFrame) -> DataFrame:
    """h1, h2 and near: the place of the earliest class within one edit that lies before the class itself."""
    variants = written_once(line_variants(candidates), "line-variants")
    own = F.struct("first", "h1", "h2")
    shorter, whole = variants.where("place >= 0"), variants.where("place < 0")
    groups = shorter.groupBy("key", "place").agg(F.min(own).alias("other"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    replaced = shorter.join(groups, ["key", "place"]).select("first", "h1", "h2", "other")
    # a longer line x that becomes the whole line y: every x meets y, so there are no more pairs than variants
    pairs = shorter.select("key", own.alias("x")).join(whole.select("key", own.alias("y")), "key")
    inserted = pairs.select("x.*", F.col("y").alias("other")).unionByName(pairs.select("y.*", F.col("x").alias("other")))
    links = replaced.unionByName(inserted).where("other.first < first").groupBy("h1", "h2").agg(F.min("other").alias("other"))
    words = candidates.select("h1", "h2", "text")
    both = links.join(words, ["h1", "h2"]).join(words.select(
        F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("text").alias("other_text")),
        (F.col("other.h1") == F.col("o1")) & (F.col("other.h2") == F.col("o2"))).select(
        "h1", "h2", F.col("other.first").alias("near"), "text", "other_text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = [one_edit_apart(words_of(a), words_of(b)) for a, b in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield batch.select(["h1", "h2", "near"]).filter(pa.array(right, pa.bool_()))

    near = candidates.schema["first"].dataType.simpleString()
    return both.mapInArrow(verify, f"h1 long, h2 long, near {near}")


def removed_lines(docs: DataFrame, shortest: int = SHORTEST) -> tuple[DataFrame, DataFrame]:
    """All lines (doc_id, line, n, h1, h2), and the removed ones: doc_id, line, kept_doc_id, kept_line."""
    docs = docs.where("doc_id is not null and text is not null")
    lines = written_once(line_keys(docs), "lines")
    candidates = written_once(candidate_lines(lines, docs, shortest), "candidate-lines")
    near = written_once(nearest_earlier(candidates), "near-lines")
    classes = lines.where("n > 0").groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("rows"))
    best = classes.join(near, ["h1", "h2"], "left").where("rows > 1 or near is not null").select(
        "h1", "h2", F.least("first", F.coalesce("near", "first")).alias("kept"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = lines.where("n > 0").select("doc_id", "line", "h1", "h2", F.pmod(F.xxhash64("doc_id", "line"), F.lit(SALTS)).cast("int").alias("salt"))
    removed = salted.join(best, ["h1", "h2", "salt"]).where(F.struct("doc_id", "line") > F.col("kept")).select(
        "doc_id", "line", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.line").alias("kept_line"))
    return lines, removed


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _by_document(removed: DataFrame) -> DataFrame:
    return removed.groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("gone"))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_lines, n_removed and removed (the places of the removed lines, joined by commas): a row per id."""
    lines, removed = removed_lines(_narrow(docs, id_col, text_col), shortest)
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id")).distinct()
    counted = lines.groupBy("doc_id").agg(F.count_distinct("line").alias("n_lines"))
    return ids.join(counted, "doc_id", "left").join(_by_document(removed), "doc_id", "left").select(
        "doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.concat_ws(",", F.transform("gone", lambda x: x.cast("string"))), F.lit("")).alias("removed"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """The documents with all their columns, their removed lines cut out of the text."""
    _, removed = removed_lines(_narrow(docs, id_col, text_col), shortest)
    gone = _by_document(removed)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.struct(*docs.columns).alias("doc"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).cast(dict(docs.dtypes)[text_col])
    return rows.join(gone, "doc_id", "left").select(*[text.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns])
