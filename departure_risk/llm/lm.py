"""Scores of whole documents by a gated recurrent language model, and by word counts.

1. Words (see `shingles`; one end token closes each text) are counted over all training texts in Spark.
2. The `shape.words` most frequent ones, with one id for all others, are the network's words; classes hold words of similar
   frequency. The probability of another word is that of the common id times the word's share, by add-one counts, of what
   the network's words leave over: probabilities of all words add up to one.
3. A bounded sample of training texts starts the network on the driver (`gru.train`). Then every partition of the training
   texts goes on from there by truncated backpropagation over all words of its texts, with the state carried from window to
   window of a text, and the networks are averaged in Spark by their words, so the whole corpus has a part in the result.
4. Every text is scored from its first word to its end with the state carried through.

The `known` most frequent words (a bound on memory) go to all tasks as arrays of keys and counts; the other words of a text are
joined to the table of counts in Spark. Words are told apart by 64-bit keys.

Defined cases: null and empty texts are the end token alone; rows without an id are scored and never learned from; rows that
repeat an id are scored each; without training texts every word has count 0 and the network's start is used; other columns
are ignored; an empty table gives no row.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from departure_risk.llm import gru
from departure_risk.llm.neardup import text_slices
from departure_risk.llm.shingles import word_hashes
from departure_risk.session import written_once

#: The key of the token that ends a text.
END = 1
#: Most frequent words that every task holds (16 bytes each).
KNOWN = 1_000_000
#: Training texts that start the network, and words of each from a place given by its key.
SAMPLED, SAMPLED_WORDS = 1500, 512
#: Words that a partition backpropagates through, lanes of texts it learns from at a time, and words of a step at least.
WINDOW_WORDS, LANES, STEP_WORDS = 32, 512, 8192
#: Bytes of text read at a time: enough texts to fill the lanes.
SLICE = 16 << 20
#: Entries of a network that are averaged by one task.
PART = 16384
#: Networks that are added up at a time, and how often before the last sum: enough for 262,144 partitions.
TOGETHER, LEVELS = 64, 2


def fold(id_col: Column, folds: int = 7) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))


def text_words(part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of each text with END behind them, and where each text begins (and the last one ends)."""
    words, bounds = word_hashes(part)
    n = np.diff(bounds)
    out = np.empty(len(words) + len(n), np.int64)
    ends = np.cumsum(n + 1) - 1
    rest = np.ones(len(out), bool)
    rest[ends] = False
    out[ends], out[rest] = END, words.view(np.int64)
    return out, np.concatenate([[0], ends + 1])


def word_counts(texts: DataFrame) -> DataFrame:
    """word (its key) and count over all texts, END included."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 0, SLICE):
                words, counts = np.unique(text_words(part.column(0))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts.astype(np.int64))], names=["word", "count"])

    return texts.select("text").mapInArrow(count, "word long, count long").groupBy("word").agg(F.sum("count").alias("count"))


@dataclass
class Vocabulary:
    """Sorted keys of the known words with their counts and network ids; the id of all others; sums over all words."""
    keys: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    other: int
    end: int
    tokens: int
    distinct: int
    left_over: float

    def place(self, words: np.ndarray) -> np.ndarray:
        """Places of words among the known ones, -1 for others."""
        unique, back = np.unique(words, return_inverse=True)
        at = np.searchsorted(self.keys, unique).clip(max=max(0, len(self.keys) - 1))
        found = np.where(self.keys[at] == unique, at, -1) if len(self.keys) else np.full(len(unique), -1)
        return found[back]

    def log_base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.tokens + self.distinct + 1.0))


def vocabulary(counts: DataFrame, words: int, known: int) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary and the counts of the network's ids. Reads at most `known` rows of the counts."""
    tokens, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    # the smallest count that at most `known` words reach, from how many words have each count
    steps = counts.groupBy("count").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("count")).limit(known).toPandas()
    enough = steps[steps["n"].cumsum() <= known]
    least = int(enough["count"].min()) if len(enough) else 1 << 62
    rows = counts.where((F.col("count") >= least) | (F.col("word") == END)).toArrow()
    keys, count = rows.column("word").to_numpy(), rows.column("count").to_numpy()
    order = np.argsort(keys)
    keys, count = keys[order], count[order]
    by_count = np.lexsort((keys, -count))
    chosen = by_count[keys[by_count] != END][:words - 2]
    left = tokens - int(count[chosen].sum()) - int(count[keys == END].sum())
    ranked = sorted([(int(c), 1, int(i)) for c, i in zip(count[chosen], chosen)] + [(left, 0, -1), (int(count[keys == END].sum()), 0, -2)], reverse=True)
    ids, other, end = np.full(len(keys), -1, np.int64), 0, 0
    of_id = np.zeros(words)
    for number, (c, _, place) in enumerate(ranked):
        of_id[number] = c
        if place >= 0:
            ids[place] = number
        elif place == -1:
            other = number
        else:
            end = number
    ids[ids < 0] = other
    ids[keys == END] = end
    total = tokens + distinct + 1.0
    left_over = 1.0 - float((count[chosen] + 1.0).sum()) / total - (float(count[keys == END].sum()) + 1.0) / total
    return Vocabulary(keys, count, ids, other, end, int(tokens), int(distinct), max(left_over, 1.0 / total)), of_id


def network_ids(words: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    place = vocab.place(words)
    ids = np.full(len(words), vocab.other, np.int64)
    ids[place >= 0] = vocab.ids[place[place >= 0]]
    ids[words == END] = vocab.end
    return ids.astype(np.int32)


def _start_place(words: np.ndarray, length: int) -> int:
    """Where a text's window begins: any place, by the text's words."""
    room = len(words) - length
    return int((int(words.sum(dtype=np.int64)) & 0x7FFFFFFF) % (room + 1)) if room > 0 else 0


def _sample(texts: DataFrame, vocab: Vocabulary, sampled: int, length: int) -> list[np.ndarray]:
    ids = texts.where("id is not null").select("id").orderBy(F.xxhash64("id"), "id").limit(sampled)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bounds = text_words(batch.column(1))
            out = []
            for a, b in zip(bounds, bounds[1:]):
                at = _start_place(words[a:b], length)
                out.append(words[a + at:min(b, a + at + length)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["id", "words"])

    rows = texts.join(F.broadcast(ids.distinct()), "id").select("id", "text").mapInArrow(  # at most `sampled` rows
        cut, f"id {dict(texts.dtypes)['id']}, words array<long>").orderBy("id", "words").limit(2 * sampled).collect()  # ids may repeat
    return [network_ids(np.array(r.words, np.int64), vocab) for r in rows]


def _flat(net: gru.Net) -> np.ndarray:
    return np.concatenate([net[k].reshape(-1) for k in sorted(net)])


def _unflat(flat: np.ndarray, like: gru.Net) -> gru.Net:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def averaged(net: gru.Net, texts: DataFrame, vocab, rate: float = 1.5e-3, lanes: int = LANES, step_words: int = STEP_WORDS) -> gru.Net:
    """The network after a pass over all words of every training text, one network per partition, averaged by words read."""
    shared = texts.sparkSession.sparkContext.broadcast(net)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {k: v.copy() for k, v in shared.value.items()}
        adam, weight, waiting, gathered = gru.Adam(own, rate), 0, 0, {}
        vocabulary = vocab.value

        def step() -> None:
            adam.apply({k: g / waiting for k, g in gathered.items()}, 0.0)
            gathered.clear()

        for batch in batches:
            for part in text_slices(batch, 0, SLICE):
                words, bounds = text_words(part.column(0))
                ids = np.split(network_ids(words, vocabulary), bounds[1:-1])
                weight += len(words)
                # where few lanes are left, windows gather until they have the words of a step
                for n, _ in gru.windows(own, ids, vocabulary.end, lanes, WINDOW_WORDS, gathered):
                    waiting += n
                    if waiting >= step_words:
                        step()
                        waiting = 0
        if waiting:
            step()
        flat = _flat(own).astype(np.float64) * weight
        if weight:
            for number, at in enumerate(range(0, len(flat), PART)):
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([TaskContext.get().partitionId()], pa.int64()),
                                                  pa.array([float(weight)]), pa.array([flat[at:at + PART].tobytes()])],
                                                 names=["part", "slot", "weight", "sum"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot", kind="stable")
        total = sum(np.frombuffer(s) for s in rows["sum"])
        return pd.DataFrame({"part": rows["part"].iloc[:1].to_numpy(), "slot": [int(rows["slot"].iloc[0]) // TOGETHER],
                             "weight": [rows["weight"].sum()], "sum": [total.tobytes()]})

    kind = "part long, slot long, weight double, sum binary"
    sums = texts.select("text").mapInArrow(learn, kind)
    for _ in range(LEVELS):
        sums = sums.groupBy("part", F.expr(f"slot div {TOGETHER}")).applyInPandas(lambda rows: add(rows), kind)
    parts = sorted(sums.groupBy("part").applyInPandas(add, kind).collect())  # one network
    return _unflat(np.concatenate([np.frombuffer(r["sum"]) / r["weight"] for r in parts]), net) if parts else net


def scored(docs: DataFrame, net, vocab) -> DataFrame:
    """row, doc_id, held_out, n_tokens, n_known, base and score (of known words), others and times (words to join)."""
    shape = pa.schema([("row", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
                       ("others", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, number = vocab.value, net.value, TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in text_slices(batch, 2, SLICE):
                words, bounds = text_words(part.column(2))
                starts, n = bounds[:-1], np.diff(bounds)
                place = vocabulary.place(words)
                found = place >= 0
                ids = np.full(len(words), vocabulary.other, np.int32)
                ids[found] = vocabulary.ids[place[found]]
                ids[words == END] = vocabulary.end
                counts = np.where(found, vocabulary.counts[place] if len(vocabulary.counts) else 0, 0)
                logs = np.where(found, vocabulary.log_base(counts), 0.0)
                base = np.add.reduceat(logs, starts)
                # a word of the common id: its share of what the network's words leave over
                common = ids == vocabulary.other
                extra = np.add.reduceat(np.where(common, logs - np.log10(vocabulary.left_over), 0.0), starts)
                model = gru.score(weights, np.split(ids, bounds[1:-1]), vocabulary.end) / np.log(10) + extra
                known = np.add.reduceat((counts > 0).astype(np.int64), starts)
                others, times = [], []
                missing = ~found & (words != END)
                for a, b in zip(starts.tolist(), bounds[1:].tolist()):
                    own, how_often = np.unique(words[a:b][missing[a:b]], return_counts=True)
                    others.append(own)
                    times.append(how_often.astype(np.int64))
                rows = np.arange(number, number + len(n))
                number += len(n)
                out = pa.RecordBatch.from_arrays([pa.array(rows), pa.array(n), pa.array(known), pa.array(base), pa.array(model),
                                                  pa.array(others, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))], schema=shape)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *out.columns], names=["doc_id", "held_out", *shape.names])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(read, f"doc_id {kind}, held_out boolean, row long, n_tokens long, n_known long, base double, score double, "
                                 "others array<long>, times array<long>")


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_out: int = 2,
           shape: gru.Shape = gru.Shape(), known: int = KNOWN, sampled: int = SAMPLED, epochs: int = 3) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10), per row.

    Learns from rows whose fold (crc32 of the id's text, modulo `folds`) is not `held_out`.
    """
    spark = docs.sparkSession
    out = F.coalesce(fold(F.col(id_col), folds) == held_out, F.lit(False))
    own = docs.select(F.col(id_col).alias("doc_id"), out.alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    training = own.where("not held_out and doc_id is not null").select(F.col("doc_id").alias("id"), "text")
    counts = written_once(word_counts(training), "word-counts")
    found, of_id = vocabulary(counts, shape.words, known)
    vocab = spark.sparkContext.broadcast(found)  # at most `known` words
    net = gru.new_net(shape, of_id)
    if sample := _sample(training, found, sampled, SAMPLED_WORDS):
        net = averaged(gru.train(net, sample, found.end, epochs), training, vocab)
    first = written_once(scored(own, spark.sparkContext.broadcast(net), vocab), "lm-rows")
    # words that are not among the most frequent ones: their counts come by a join
    rest = first.select("row", F.explode(F.arrays_zip("others", "times")).alias("w")).select("row", F.col("w.others").alias("word"), F.col("w.times").alias("times"))
    log_share = F.log10((F.coalesce("count", F.lit(0)) + 1) / F.lit(float(found.tokens + found.distinct + 1)))
    told = rest.join(counts, "word", "left").groupBy("row").agg(
        F.sum(log_share * F.col("times")).alias("logs"), F.sum("times").alias("n"),
        F.sum(F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0)).alias("seen"))
    full = first.drop("others", "times").join(told, "row", "left")
    logs, n = F.coalesce("logs", F.lit(0.0)), F.coalesce("n", F.lit(0))
    return full.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
                       F.lit(found.tokens).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"),
                       (F.col("score") + logs - n * float(np.log10(found.left_over))).alias("score"))
