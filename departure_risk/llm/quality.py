"""A byte-level convolutional network that tells document quality.

A text's UTF-8 bytes are embedded; filters over WIDTH bytes, moved by STEP bytes, run over chunks of CHUNK bytes that overlap
by WIDTH - STEP and cover the whole text. Each filter's largest value in a chunk is kept, a hidden layer reads those of a
chunk, and the means and largest values of the hidden units over all chunks give one probability.

`train` fits the network in numpy on at most `documents` labelled documents (a parameter) on the driver, on all chunks of
each; chunks go through the filters some at a time, so a long document costs no more memory than its bytes. `scores` reads
whole texts, in batches on executors.

Defined cases: null and empty texts are one chunk of zero bytes and get its score; rows without an id are scored and never
learned from; rows that repeat an id are scored each; without labels of both kinds every score is 1.0, so nothing is
rejected; other columns are ignored by `scores`, and kept by `accepted`; an empty table gives no row.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from departure_risk.llm.memory import given_back

WIDTH, STEP, CHUNK = 16, 4, 128
DEEP, FILTERS, HIDDEN = 8, 24, 16
PARTS = WIDTH // STEP
WINDOWS = CHUNK // STEP
#: Bytes that go through the filters at a time.
AT_ONCE = 1 << 18
Network = dict[str, np.ndarray]


def _filtered(data: np.ndarray, net: Network) -> np.ndarray:
    """Filter values of all windows of a run of bytes: every filter is a sum over PARTS consecutive groups of STEP bytes."""
    embedded = net["bytes"][data].reshape(-1, STEP * DEEP)
    parts = embedded @ net["filters"]
    n = len(parts) - PARTS + 1
    out = parts[:n, :FILTERS].copy()
    for j in range(1, PARTS):
        out += parts[j:n + j, j * FILTERS:(j + 1) * FILTERS]
    return out


def _hidden(largest: np.ndarray, net: Network) -> np.ndarray:
    return np.maximum(np.maximum(largest + net["filter_bias"], 0) @ net["hidden"] + net["hidden_bias"], 0)


def chunk_count(size: int) -> int:
    return max(1, -(-size // CHUNK))


def _pool(texts: list[bytes], net: Network) -> tuple[np.ndarray, np.ndarray]:
    """Sums and largest values of the hidden units over the chunks of each text (padded to whole chunks)."""
    counts = np.array([chunk_count(len(t)) for t in texts])
    sizes = counts * CHUNK + WIDTH
    starts = np.cumsum(sizes) - sizes
    data = np.zeros(int(sizes.sum()), np.uint8)
    for text, at in zip(texts, starts.tolist()):
        data[at:at + len(text)] = np.frombuffer(text, np.uint8)
    first = np.repeat(starts // STEP - (np.cumsum(counts) - counts) * WINDOWS, counts) + np.arange(counts.sum()) * WINDOWS
    # between two texts lie windows of padding: they get groups of their own, which are dropped
    edges = np.unique(np.concatenate([first, (starts + counts * CHUNK) // STEP]))
    values = _filtered(data, net)
    edges = edges[edges < len(values)]
    largest = np.maximum.reduceat(values, edges, axis=0)[np.searchsorted(edges, first)]
    hidden = _hidden(largest, net)
    at = np.cumsum(counts) - counts
    return np.add.reduceat(hidden, at, axis=0), np.maximum.reduceat(hidden, at, axis=0)


def score_texts(texts: list[bytes], net: Network) -> np.ndarray:
    """Probabilities of label 1. Long texts go through in pieces of whole chunks; nothing is left out."""
    means, tops = np.zeros((2, len(texts), HIDDEN))
    waiting, size = [], 0

    def flush() -> None:
        if waiting:
            total, top = _pool([texts[i] for i in waiting], net)
            means[waiting] = total / np.array([[chunk_count(len(texts[i]))] for i in waiting])
            tops[waiting] = top

    for i, text in enumerate(texts):
        if len(text) > AT_ONCE:
            for at in range(0, len(text), AT_ONCE):
                piece = text[at:at + AT_ONCE]
                total, top = _long_piece(piece, text[at + AT_ONCE:at + AT_ONCE + WIDTH], net)
                means[i] += total / chunk_count(len(text))
                tops[i] = np.maximum(tops[i], top)
            continue
        if size + len(text) > AT_ONCE:
            flush()
            waiting, size = [], 0
        waiting.append(i)
        size += len(text) + CHUNK
    flush()
    z = means @ net["mean"] + tops @ net["top"] + net["bias"]
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _long_piece(piece: bytes, after: bytes, net: Network) -> tuple[np.ndarray, np.ndarray]:
    count = chunk_count(len(piece))
    data = np.zeros(count * CHUNK + WIDTH, np.uint8)
    both = np.frombuffer(piece + after, np.uint8)[:len(data)]
    data[:len(both)] = both
    largest = _filtered(data, net)[:count * WINDOWS].reshape(count, WINDOWS, FILTERS).max(axis=1)
    hidden = _hidden(largest, net)
    return hidden.sum(axis=0), hidden.max(axis=0)


def new_network(seed: int) -> Network:
    rng = np.random.default_rng(seed)
    return {k: v.astype(np.float32) for k, v in {
        "bytes": rng.normal(0, 0.5, (256, DEEP)), "filters": rng.normal(0, 0.25, (STEP * DEEP, PARTS * FILTERS)),
        "filter_bias": np.zeros(FILTERS), "hidden": rng.normal(0, 0.3, (FILTERS, HIDDEN)), "hidden_bias": np.full(HIDDEN, 0.1),
        "mean": rng.normal(0, 0.3, HIDDEN), "top": rng.normal(0, 0.1, HIDDEN), "bias": np.zeros(1)}.items()}


def _gradients(chunks: np.ndarray, counts: np.ndarray, labels: np.ndarray, net: Network) -> Network:
    """Of the mean log loss of some documents. chunks: CHUNK + WIDTH bytes each, the documents' one after the other.

    Filter values of all chunks are made a part at a time, of which only the largest ones and their places are kept.
    """
    n = len(chunks)
    parts = [slice(at, at + AT_ONCE // CHUNK) for at in range(0, n, AT_ONCE // CHUNK)]
    where, largest = zip(*[_largest(chunks[part], net) for part in parts])
    where, largest = np.concatenate(where), np.concatenate(largest)
    active = np.maximum(largest + net["filter_bias"], 0)
    hidden = np.maximum(active @ net["hidden"] + net["hidden_bias"], 0)
    at = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    mean, top = np.add.reduceat(hidden, at, axis=0) / counts[:, None], np.maximum.reduceat(hidden, at, axis=0)
    z = mean @ net["mean"] + top @ net["top"] + net["bias"]
    dz = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) / len(labels)
    is_top = hidden == top[doc]
    share = is_top / np.add.reduceat(is_top, at, axis=0, dtype=np.float32)[doc]
    dh = dz[doc, None] * (net["mean"] / counts[doc, None] + net["top"] * share) * (hidden > 0)
    da = (dh @ net["hidden"].T) * (largest + net["filter_bias"] > 0)
    of_bytes, of_filters = np.zeros((256, DEEP)), np.zeros((FILTERS, WIDTH * DEEP), da.dtype)
    weights = net["filters"].reshape(STEP * DEEP, PARTS, FILTERS).transpose(2, 1, 0).reshape(FILTERS, WIDTH, DEEP)
    for part in parts:
        d = da[part]
        windows = chunks[part][np.arange(len(d))[:, None, None], where[part][:, :, None] * STEP + np.arange(WIDTH)]  # chunks, filters, WIDTH
        of_filters += np.einsum("nf,nfk->fk", d, net["bytes"][windows].reshape(len(d), FILTERS, WIDTH * DEEP))
        back = (d[:, :, None, None] * weights[None]).reshape(-1, DEEP)
        flat = windows.reshape(-1)
        of_bytes += np.stack([np.bincount(flat, back[:, i], 256) for i in range(DEEP)], axis=1)
    own = of_filters.T.reshape(PARTS, STEP * DEEP, FILTERS)
    return {"bytes": of_bytes, "filters": own.transpose(1, 0, 2).reshape(STEP * DEEP, PARTS * FILTERS), "filter_bias": da.sum(axis=0),
            "hidden": active.T @ dh, "hidden_bias": dh.sum(axis=0), "mean": mean.T @ dz, "top": top.T @ dz,
            "bias": dz.sum(keepdims=True)}


def _largest(chunks: np.ndarray, net: Network) -> tuple[np.ndarray, np.ndarray]:
    """Where each filter is largest in each chunk, and its value there."""
    parts = (net["bytes"][chunks].reshape(-1, STEP * DEEP) @ net["filters"]).reshape(len(chunks), -1, PARTS * FILTERS)
    values = sum(parts[:, j:WINDOWS + j, j * FILTERS:(j + 1) * FILTERS] for j in range(PARTS))
    where = values.argmax(axis=1)
    return where, np.take_along_axis(values, where[:, None], axis=1)[:, 0]


def fit(samples: list[tuple[bytes, int]], epochs: int = 6, batch: int = 48, rate: float = 4e-3, seed: int = 5) -> Network:
    """Adam on documents given as (chunks of CHUNK + WIDTH bytes one after the other, label)."""
    net, rng = new_network(seed), np.random.default_rng(seed)
    if len({y for _, y in samples}) < 2:
        return net | {"mean": np.zeros(HIDDEN, np.float32), "top": np.zeros(HIDDEN, np.float32), "bias": np.full(1, 40, np.float32)}
    one, two, step = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2)), None, 0
    one, two = one
    total = epochs * -(-len(samples) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for at in range(0, len(order), batch):
            chosen = [samples[i] for i in order[at:at + batch]]
            chunks = np.frombuffer(b"".join(c for c, _ in chosen), np.uint8).reshape(-1, CHUNK + WIDTH)
            counts = np.array([len(c) // (CHUNK + WIDTH) for c, _ in chosen])
            grads = _gradients(chunks, counts, np.array([y for _, y in chosen], np.float32), net)
            step += 1
            pace = rate * (1 - 0.9 * step / total)
            for k, g in grads.items():
                one[k] = 0.9 * one[k] + 0.1 * g
                two[k] = 0.999 * two[k] + 0.001 * g * g
                net[k] = (net[k] - pace * (one[k] / (1 - 0.9 ** step)) / (np.sqrt(two[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def all_chunks(text: bytes) -> bytes:
    """The chunks of a text one after the other, each with the bytes of the next that its last windows reach."""
    count = chunk_count(len(text))
    padded = np.frombuffer(text.ljust(count * CHUNK, b"\0") + bytes(WIDTH), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK + WIDTH)[::CHUNK].tobytes()


def held_out(id_col: Column, folds: int = 5) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          documents: int = 6000, **options) -> Network:
    """Fit on labelled documents outside the held-out fold: the `documents` first ones by the hash of their id."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.min(label_col).cast("int").alias("label")).where(~held_out(F.col("id")))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(documents)

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    own = texts.join(F.broadcast(chosen), "id").select("id", "label", F.coalesce("text", F.lit("")).alias("text"))  # at most `documents` rows
    rows = own.orderBy("id", "text").limit(2 * documents).toPandas()  # ids may repeat
    return fit([(all_chunks(t.encode()), y) for t, y in zip(rows["text"], rows["label"])], **options)


def scorer(net: Network):
    """A column function: the probability of label 1 of a text."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from given_back(pd.Series(score_texts([(t or "").encode() for t in texts], net).astype(np.float64)) for texts in batches)

    return score


def scores(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from `least` on), per row."""
    scored = docs.select(F.col(id_col).alias("doc_id"), scorer(net)(F.col(text_col).cast("string")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= least).cast("int").alias("predicted"))


def accepted(docs: DataFrame, net: Network, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The documents with a score of at least `least`, with all their columns."""
    return docs.where(scorer(net)(F.col(text_col).cast("string")) >= least)
