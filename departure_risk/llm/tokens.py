"""Token ids of documents in Simple-8b files.

`write_tokens` gives every document its ids and one end id, in ascending order of the id column, and writes them to
numbered files; `read_tokens` decodes the files. A file is

    words      uint64: the packed blocks, one after the other
    escaped    uint64: values of more than 60 bits, by block
    blocks     int64 x 3: words, escaped values and values of each block; sums give the offsets
    documents  int64 x 3: whether there is an id (0 or 1), the id, the number of token ids with the end id
    footer     int64 x 4: words, escaped values, blocks, documents; then the 8 bytes of MAGIC

Defined cases: a null text counts as empty and has the end id only; null ids come first; rows that repeat an id stay,
in order of their text; other columns are ignored; an empty table gives no file and no row.
"""

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from departure_risk.llm import files, simple8b
from departure_risk.llm.memory import given_back
from departure_risk.session import written_once

MAGIC = b"S8BIDS01"
#: Ids packed at a time: bounds a task's memory.
PACKED = 512 * simple8b.BLOCK
#: Pieces of text whose ids a Python worker keeps; beyond twice as many, those met last stay.
KEPT = 300_000

_loaded: dict = {}


class Encoder:
    """Ids of whole texts by a tokenizer file of byte-level BPE with the usual split into words.

    Such a split always cuts before a single space between two other characters, so the pieces between such spaces are
    encoded once and looked up after that. Texts with other white space around a space, or with the text of a special
    token, go to the tokenizer whole.
    """

    def __init__(self, path: str, kept: int = KEPT):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():  # a token has a character for each byte
            self.bytes[number] = len(token)
        self.kept, self.batch = kept, 0
        # the pieces met so far, all different: whether a piece is odd, how many ids it has, and the batch it was in last
        self.pieces = pa.array([], pa.large_string())
        self.odd, self.lengths, self.used = np.zeros(0, bool), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool = np.zeros(0, "<u4")

    def whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    @staticmethod
    def space_at(pieces: pa.Array, start: int, stop: int | None) -> np.ndarray:
        """Whether the character cut out of each piece is white space, or there is none."""
        cut = pc.utf8_slice_codeunits(pieces, start, stop).dictionary_encode()
        space = np.array([not c or c.isspace() for c in cut.dictionary.to_pylist()], bool)
        return space[cut.indices.to_numpy()]

    def learn(self, pieces: pa.Array) -> None:
        """Encode pieces not met yet, each with its space before it, some hundred in one text, and part them by their bytes."""
        odd = self.space_at(pieces, 0, 1) | self.space_at(pieces, -1, None)
        even = pieces.filter(pa.array(~odd)) if odd.any() else pieces
        sizes = pc.binary_length(even).to_numpy() + 1
        starts = np.append(np.arange(0, len(even), 512), len(even))
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), even), pa.scalar(" ", even.type)).to_pylist()
        lengths, pool, counted = np.zeros(len(pieces), np.int32), [self.pool], [np.zeros(0, np.int64)]
        for at, e in zip(starts, self.tokenizer.encode_batch_fast([" " + g for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            pool.append(ids)
            ends = np.cumsum(sizes[at:at + 512])
            counted.append(np.diff(np.searchsorted(np.cumsum(self.bytes[ids]), ends) + 1, prepend=0))
        lengths[~odd] = np.concatenate(counted)
        self.pool = np.concatenate(pool)
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.odd, self.lengths = np.concatenate([self.odd, odd]), np.concatenate([self.lengths, lengths])
        self.used = np.concatenate([self.used, np.full(len(pieces), self.batch, np.int32)])

    def forget(self) -> None:
        """Only the `kept` pieces met last stay."""
        stay = np.sort(np.argsort(-self.used, kind="stable")[:self.kept])
        self.pool = self.pool[np.repeat(np.isin(np.arange(len(self.used)), stay), self.lengths)]
        self.pieces = self.pieces.take(pa.array(stay))
        self.odd, self.lengths, self.used = self.odd[stay], self.lengths[stay], self.used[stay]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (no nulls). Pieces are told apart by pyarrow, behind those met before, whose places they so get."""
        texts = texts.cast(pa.large_string())
        pieces = pc.split_pattern(texts, " ")
        offsets = pieces.offsets.to_numpy()
        known = len(self.pieces)
        both = pa.concat_arrays([self.pieces, pieces.values]).dictionary_encode()
        place = both.indices.to_numpy()[known:]
        self.batch += 1
        if len(both.dictionary) > known:
            self.learn(both.dictionary.slice(known))
        self.used[place] = self.batch
        # a text goes to the tokenizer whole if a piece is odd; its first piece has no space before it
        first = offsets[:-1]
        odd_before = np.concatenate([[0], np.cumsum(self.odd[place])])
        whole = odd_before[offsets[1:]] > odd_before[first]
        for special in self.special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        taken = self.lengths[place]
        taken[first] = 0
        ends = np.cumsum(taken, dtype=np.int64)
        starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        where = np.repeat((starts[place] - (ends - taken)).astype(np.int32), taken)
        where += np.arange(len(where), dtype=np.int32)
        body = self.pool[where].tobytes()
        bounds = np.concatenate([[0], 4 * ends])[offsets].tolist()
        beginnings = pieces.values.take(pa.array(first)).to_pylist()
        heads = self.whole([texts[i].as_py() if w else p for i, (w, p) in enumerate(zip(whole, beginnings))])
        if len(self.pieces) > 2 * self.kept:
            self.forget()
        return [head if w else head + body[a:b] for head, w, a, b in zip(heads, whole, bounds, bounds[1:])]


def encoder(path: str, kept: int) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, kept) not in _loaded:
        _loaded[path, kept] = Encoder(path, kept)
    return _loaded[path, kept]


def slices(batch: pa.RecordBatch, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts (column 1) hold about `most` bytes or are one row."""
    sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy())
    at = 0
    while at < len(sizes):
        until = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right"))
        until = max(at + 1, until)
        yield batch.slice(at, until - at)
        at = until


class _File:
    """Packs ids as they come and writes the tables behind them."""

    def __init__(self, stream):
        self.stream, self.waiting, self.count = stream, [], 0
        self.blocks, self.escaped = [], []

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.count += len(ids) // 4
        if self.count >= PACKED:
            self.flush(False)

    def flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        take = len(ids) if last else len(ids) // simple8b.BLOCK * simple8b.BLOCK
        for at in range(0, take, PACKED):
            part = ids[at:min(at + PACKED, take)]
            words, per_block, escaped, escaped_per_block = simple8b.pack(part)
            self.stream.write(words.astype("<u8").tobytes())
            lengths = np.full(len(per_block), simple8b.BLOCK)
            lengths[-1] = len(part) - (len(per_block) - 1) * simple8b.BLOCK
            self.blocks.append(np.column_stack([per_block, escaped_per_block, lengths]))
            self.escaped.append(escaped)
        self.waiting, self.count = [ids[take:].tobytes()], len(ids) - take

    def close(self, documents: list[tuple[int, int, int]]) -> None:
        self.flush(True)
        blocks = np.concatenate(self.blocks).astype("<i8")
        escaped = np.concatenate(self.escaped).astype("<u8")
        self.stream.write(escaped.tobytes())
        self.stream.write(blocks.tobytes())
        self.stream.write(np.array(documents, "<i8").tobytes())
        self.stream.write(np.array([blocks[:, 0].sum(), len(escaped), len(blocks), len(documents)], "<i8").tobytes())
        self.stream.write(MAGIC)


def write_tokens(docs: DataFrame, tokenizer: str, end: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", kept: int = KEPT) -> DataFrame:
    """Write the files; one row per file: file (its number, in order of ids), uri, documents, ids.

    `kept` bounds the pieces of text a Python worker remembers. One shuffle, by ranges of the id column. The table of files is written too, so no file is made twice by a reader.
    """
    folder = files.new_folder(docs.sparkSession, "tokens")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        number, encode = TaskContext.get().partitionId(), encoder(tokenizer, kept).encode
        uri, tail = f"{folder}/{number:06d}.s8b", np.array([end], "<u4").tobytes()
        documents, total = [], 0
        with files.written(uri) as stream:
            out = _File(stream)
            for batch in (b for again in ([first], batches) for b in again):
                for part in slices(batch):
                    for doc, encoded in zip(part.column(0).to_pylist(), encode(part.column(1))):
                        out.add(encoded + tail)
                        n = len(encoded) // 4 + 1
                        documents.append((int(doc is not None), doc or 0, n))
                        total += n
            out.close(documents)
        yield pa.RecordBatch.from_pydict({"file": [number], "uri": [uri], "documents": [len(documents)], "ids": [total]},
                                         pa.schema([("file", pa.int64()), ("uri", pa.string()),
                                                    ("documents", pa.int64()), ("ids", pa.int64())]))

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = narrow.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(
        F.col("id").asc_nulls_first(), "text")
    return written_once(ordered.mapInArrow(lambda batches: given_back(shard(batches)), "file long, uri string, documents long, ids long"), "token-files")


def read_tokens(written: DataFrame) -> DataFrame:
    """One row per document, decoded from the files: doc_id, start, n_tokens, ids_crc32 and file.

    `start` counts the ids of all documents before it; only one row per file is summed up for that.
    """
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = written.select("file", "uri", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    shape = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                       ("ids_crc32", pa.int64()), ("file", pa.int64())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                documents = list(read_documents(row["uri"]))
                counts = np.array([n for _, n, _ in documents], np.int64)
                starts = row["first"] + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _, _ in documents], pa.int64()), pa.array(starts), pa.array(counts),
                     pa.array([c for _, _, c in documents], pa.int64()),
                     pa.array([row["file"]] * len(documents), pa.int64())], schema=shape)

    files_each = placed.repartition(max(1, min(written.count(), 10_000)))  # a file or more a task
    return files_each.mapInArrow(lambda batches: given_back(decode(batches)), "doc_id long, start long, n_tokens long, ids_crc32 long, file long")


def read_ids(uri: str) -> Iterator[np.ndarray]:
    """All ids of a file, some blocks at a time. A document may go on in the next array."""
    with files.opened(uri) as source:
        words, escaped_all, blocks, _ = _footer(source)
        table = np.frombuffer(source.read_at(24 * blocks, 8 * (words + escaped_all)), "<i8").reshape(-1, 3)
        word, escape, step = 0, 8 * words, PACKED // simple8b.BLOCK
        for at in range(0, blocks, step):
            part = table[at:at + step]
            n, e = int(part[:, 0].sum()), int(part[:, 1].sum())
            yield simple8b.unpack(np.frombuffer(source.read_at(8 * n, 8 * word), "<u8"), part[:, 0],
                                  np.frombuffer(source.read_at(8 * e, escape), "<u8"), part[:, 1], part[:, 2])
            word, escape = word + n, escape + 8 * e


def read_documents(uri: str) -> Iterator[tuple[int | None, int, int]]:
    """Id, number of token ids and their crc32, of each document of a file."""
    with files.opened(uri) as source:
        words, escaped, blocks, documents = _footer(source)
        table = np.frombuffer(source.read_at(24 * documents, 8 * (words + escaped) + 24 * blocks), "<i8").reshape(-1, 3)
    parts, left, at = read_ids(uri), b"", 0
    for has_id, doc, count in table.tolist():
        crc, need = 0, 4 * count
        while need:
            if at == len(left):
                left, at = next(parts).astype("<u4").tobytes(), 0
            taken = left[at:at + need]
            crc, need, at = zlib.crc32(taken, crc), need - len(taken), at + len(taken)
        yield doc if has_id else None, count, crc


def _footer(source) -> tuple[int, int, int, int]:
    size = source.size()
    tail = source.read_at(40, size - 40) if size >= 40 else b""
    if tail[32:] != MAGIC:
        raise ValueError("not a complete token file")
    return tuple(np.frombuffer(tail[:32], "<i8").tolist())
