"""Benchmark passages in documents, found by spaced seeds.

A seed is a fixed mask over SPAN words: it keeps some positions and ignores the others, so a window still meets its test
window when ignored words were replaced. Windows of the test items are hashed under every mask and broadcast, in blocks of
at most SEED_ROWS seeds; each block is joined to the windows of all documents where those are read. Hits are reduced to
the places at which a document and an item lie beside each other, once each, however many hits agree on it. There the best
stretch of the two is scored: +1 for an equal word, -1 for another. A stretch of at least `least` is an overlap; items of 8 to
11 words need two less than their length, so one replaced word is found anywhere, and shorter ones their whole length. Items of
fewer than 12 words also have seeds of their own: their whole, or their first and last half.

Only columns and SQL functions are used. Words are lower-cased runs of characters other than space and \\t to \\r.

Defined cases: items of fewer than SHORTEST words are too common to tell and match nothing; items of equal words count as one
with the smallest id; null and empty texts match nothing; pairs have no rows for documents without an id, but `decontaminated`
judges these by their text; rows that repeat an id are judged together; very long items are cut into pieces of PIECE words
that overlap by `SPAN + least`, each judged by what the whole item needs, and `overlap` is the best stretch within one piece
(at most PIECE + SPAN + least); other columns are ignored; an empty table on either side gives no row.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from departure_risk.session import written_once

SPAN = 10
#: Positions that count, one mask a line.
MASKS = ["1100100101",
         "1010010011",
         "1100010011"]
SHORTEST = 5
#: Items from which on one replaced word is tolerated, and up to which they have seeds of their own.
TOLERANT, WHOLE = 8, 11
PIECE = 4096
#: Seeds that are broadcast at a time (about 100 bytes each in an executor), and hits; more hits are joined by shuffling.
SEED_ROWS = 1_000_000


def word_keys(text: Column) -> Column:
    """A 64-bit key of each word."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    return F.transform(F.split(trimmed, "[ \\t-\\r]+"), lambda w: F.xxhash64(w))


def seed_keys(keys: Column, at: Column, short: list[int]) -> Column:
    """The keys of all seeds at a place: one for each mask, and one for each length of the seeds of short items."""
    kinds = [[i for i, c in enumerate(m) if c == "1"] for m in MASKS] + [list(range(n)) for n in short]
    return F.array(*[F.xxhash64(F.lit(kind), *[F.get(keys, at + F.lit(i)) for i in places]) for kind, places in enumerate(kinds)])


def best_stretch(a: Column, b: Column) -> Column:
    """The best sum over a stretch of places of +1 where the two arrays agree and -1 where they don't."""
    steps = F.zip_with(a, b, lambda x, y: F.when(x.eqNullSafe(y), 1).otherwise(-1))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))
    return F.aggregate(steps, start, lambda s, x: F.struct(
        F.greatest(F.lit(0), s["now"] + x).alias("now"), F.greatest(s["best"], s["now"] + x).alias("best")), lambda s: s["best"])


def test_pieces(benchmark: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """piece, item_id, words (keys) and need, the score of an overlap: items, the long ones in pieces."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), word_keys(F.col(text_col)).alias("words")).where(
        (F.size("words") >= SHORTEST) & F.col("item_id").isNotNull()).groupBy("words").agg(F.min("item_id").alias("item_id"))
    # a piece begins only where the one before does not reach the item's end
    last = F.greatest(F.ceil((F.size("words") - SPAN - least) / PIECE) - 1, F.lit(0)).cast("int")
    need = F.least(F.lit(least), F.when(F.size("words") < TOLERANT, F.size("words")).otherwise(F.size("words") - 2))
    cut = items.withColumns({"number": F.explode(F.sequence(F.lit(0), last)), "need": need}).select(
        "item_id", "number", "need", F.slice("words", F.col("number") * PIECE + 1, F.lit(PIECE + SPAN + least)).alias("words"))
    return cut.select(F.xxhash64("item_id", "number").alias("piece"), "item_id", "words", "need")


def short_length(words: Column) -> Column:
    """The length of the seeds that only short items have: all their words, or half of them."""
    return F.when(words < TOLERANT, words).when(words <= WHOLE, F.floor(words / 2).cast("int"))


def test_seeds(pieces: DataFrame, short: list[int]) -> DataFrame:
    """seed, piece and at (the place of the window in the piece)."""
    n = F.size("words")

    def seeds_at(places: Column, first: int, number: int) -> Column:
        return F.transform(places, lambda at: F.struct(
            at.alias("at"), F.slice(seed_keys(F.col("words"), at, short), first, number).alias("seeds")))

    masked = F.when(n >= SPAN, seeds_at(F.sequence(F.lit(0), F.greatest(n - SPAN, F.lit(0))), 1, len(MASKS))).otherwise(F.array())
    own = F.array()
    for kind, length in enumerate(short):
        ends = F.array_distinct(F.array(F.lit(0), n - length))
        own = F.when(short_length(n) == length, seeds_at(ends, len(MASKS) + 1 + kind, 1)).otherwise(own)
    placed = pieces.select("piece", F.explode(F.concat(masked, own) if short else masked).alias("w"))
    return placed.select(F.explode("w.seeds").alias("seed"), "piece", F.col("w.at").alias("at"))


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = 10, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", seed_rows: int = SEED_ROWS) -> DataFrame:
    """doc_id, item_id and overlap (the best stretch) of every document and test item that overlap."""
    pieces = written_once(test_pieces(benchmark, item_col, item_text_col, least), "test-pieces")
    lengths = pieces.select(short_length(F.size("words")).alias("n")).where("n is not null").distinct().orderBy("n").collect()
    short = [r.n for r in lengths]  # at most SPAN numbers
    seeds = written_once(test_seeds(pieces, short), "test-seeds")
    count = max(1, -(-seeds.count() // seed_rows))
    # a document's hits are its own by id and text
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    keyed = rows.select("doc_id", "row", word_keys(F.col("text")).alias("keys"))
    last = F.size("keys") - (min(short) if short else SPAN)
    windows = keyed.where(last >= 0).select("doc_id", "row", "keys", F.explode(F.sequence(F.lit(0), last)).alias("place")).select(
        "doc_id", "row", "place", F.explode(seed_keys(F.col("keys"), F.col("place"), short)).alias("seed"))

    def part(of: DataFrame, block: int) -> DataFrame:
        return F.broadcast(of.where(F.pmod("piece", F.lit(count)) == block))  # seed_rows at a time, by count

    hits = [windows.join(part(seeds, b), "seed").select("doc_id", "row", "piece", (F.col("place") - F.col("at")).alias("start")) for b in range(count)]
    laid = written_once(reduce(DataFrame.unionByName, hits).distinct(), "test-hits")
    few = laid.count() <= seed_rows

    def found(block: int) -> DataFrame:
        own = laid.where(F.pmod("piece", F.lit(count)) == block)
        both = rows.join(F.broadcast(own) if few else own, ["doc_id", "row"]).withColumn("keys", word_keys(F.col("text"))).join(part(pieces, block), "piece")
        start = F.col("start")
        # the item's words from its place 0, or from the place that meets the document's first word
        doc_part = F.slice("keys", F.greatest(start, F.lit(0)) + 1, F.size("words"))
        item_part = F.slice("words", F.greatest(-start, F.lit(0)) + 1, F.size("words"))
        length = F.least(F.size("keys") - F.greatest(start, F.lit(0)), F.size("words") - F.greatest(-start, F.lit(0)))
        score = best_stretch(F.slice(doc_part, F.lit(1), length), F.slice(item_part, F.lit(1), length))
        return both.select("doc_id", "item_id", "need", score.alias("overlap")).where("overlap >= need").drop("need")

    return reduce(DataFrame.unionByName, [found(b) for b in range(count)]).groupBy("doc_id", "item_id").agg(
        F.max("overlap").cast("long").alias("overlap"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that overlap no test item, with all their columns. Rows without an id are told apart by their text."""
    known = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col)))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), known.alias("known"), F.col(text_col).alias("text"))
    leaked = overlaps(rows, benchmark, id_col="known", **options).select(F.col("doc_id").alias("known")).distinct()
    return rows.join(leaked, "known", "left_anti").select("doc.*")
