"""Secrets in texts: fixed patterns, and strings that zstandard cannot compress although it knows their surroundings.

1. Names and words are counted over all texts. The most frequent ones are a dictionary of identifiers (`identifiers` of them,
   the last KEPT_BYTES bytes, most frequent last), which is broadcast. Secrets do not get into it: it has letter runs only.
2. Every text is searched for the patterns of BASE.
3. A candidate is a run of at least LEAST_CHARS characters of tokens, with letters and digits, that has a word of a sensitive
   context (password, bearer, access key, ...) on its line, at most NEAR characters before it. It is measured by its marginal
   bytes: its surroundings are compressed with and without it, both times primed with the dictionary. Names and words cost
   little, as their parts are in the dictionary or around them; a secret costs about what its characters carry.
   One that costs at least LEAST_SHARE of its length, and LEAST_NOVELTY of the bits of its kinds of characters, is reported.
   Its other occurrences nearby are taken out of the surroundings, so a secret that is repeated does not hide itself.

A span of a pattern is its whole match. A candidate that overlaps a match is left to the pattern.

Defined cases: a null text is empty and has no span; null and repeated ids are rows as any other; without any text the
dictionary is empty; other columns are ignored; an empty table gives no row.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

#: kind, pattern, the group that is measured and its least length.
BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),  # shorter runs stop no longer one
]
NOVEL = "novel"
CONTEXT = (r"(?<![a-z])(?:pass(?:word|wd|phrase|code)|pwd|secrets?|tokens?|(?:api|access|private|signing|encryption)[ _-]?keys?|credentials?"
           r"|auth(?:orization)?|bearer|signature)(?![a-z])")
CANDIDATE = r"[A-Za-z0-9+/_=-]"
LEAST_CHARS, NEAR, AROUND = 16, 48, 256
LEAST_SHARE, LEAST_NOVELTY = 0.65, 1.0
IDENTIFIERS, KEPT_BYTES, LEVEL, TOP_PARTS = 8000, 65536, 9, 16

_context = re.compile(CONTEXT, re.A | re.I)
_candidate = re.compile(rf"{CANDIDATE}{{{LEAST_CHARS},}}")
_part = re.compile(rb"[A-Za-z][a-z]{3,23}")
#: Texts without any of these have no span, and are told in one pass over a batch.
_ANY_BASE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"""
_ANY_CONTEXT = r"(?i:pass(?:word|wd|phrase|code)|pwd|secret|token|key|credential|auth|bearer|signature)"
_ANY_CANDIDATE = rf"{CANDIDATE}{{{LEAST_CHARS}}}"
#: Entries of counts that a task holds before it sends them on.
HELD = 400_000

SPAN = "struct<kind:string,start:bigint,end:bigint,text:string,marginal_bytes:int,novelty:double>"


def identifiers(docs: DataFrame, text_col: str = "text", most: int = IDENTIFIERS) -> bytes:
    """The dictionary: the most frequent letter runs of 4 to 24 bytes in all texts; runs are cut before a capital letter.

    At most `most` rows of each of TOP_PARTS partitions come to the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def held() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())],
                                             names=["part", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                counts.update(_part.findall((text.as_py() or "").encode()))
                if len(counts) > HELD:
                    yield held()
        yield held()

    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "part string, n long")
    # the first of TOP_PARTS parts of the counts hold the first of all
    in_part = Window.partitionBy(F.pmod(F.xxhash64("part"), F.lit(TOP_PARTS))).orderBy(F.desc("n"), "part")
    first = parts.groupBy("part").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(in_part)).where(F.col("rank") <= most)
    top = first.orderBy(F.desc("n"), "part").limit(most).collect()
    return " ".join(r.part for r in reversed(top)).encode()[-KEPT_BYTES:]


class Novelty:
    """Marginal bytes of strings in their surroundings, primed with a dictionary."""

    def __init__(self, dictionary: bytes):
        known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
        if known is not None:
            known.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)

    def marginal_bytes(self, text: str, start: int, end: int) -> int:
        own = text[start:end]
        before, after = (side.replace(own, "") for side in (text[max(0, start - AROUND):start], text[end:end + AROUND]))
        with_it = self.compressor.compress((before + own + after).encode("utf-8", "replace"))
        return len(with_it) - len(self.compressor.compress((before + after).encode("utf-8", "replace")))


def novelty_of(own: str, marginal: int) -> float:
    """Marginal bits as a share of what characters drawn at random from the kinds in the string carry."""
    symbols = {c for c in own if not c.isalnum()}
    kinds = (10 * any(c.isdigit() for c in own) + (26 if any("g" <= c <= "z" for c in own) else 6 * any("a" <= c <= "f" for c in own))
             + (26 if any("G" <= c <= "Z" for c in own) else 6 * any("A" <= c <= "F" for c in own)) + len(symbols))
    return 8.0 * marginal / (len(own) * math.log2(max(kinds, 2)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the patterns' matches."""
    return [(m.start(), kind, m.end()) for kind, (_, pattern, group, least) in enumerate(BASE)
            for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs with letters and digits that have a sensitive word shortly before them on their line."""
    out = []
    for m in _candidate.finditer(text):
        line = text[max(0, m.start() - NEAR):m.start()].rpartition("\n")[2]
        own = m.group()
        if _context.search(line) and any(c.isdigit() for c in own) and any(c.isalpha() for c in own):
            out.append(m.span())
    return out


def spans(text: str, novelty: Novelty) -> list[dict]:
    """All spans of a text by start, then in the order of kinds."""
    found = [(start, kind, end, None, None) for start, kind, end in base_spans(text)]
    taken = sorted((start, end) for start, _, end, _, _ in found)
    at, reach = 0, -1
    for start, end in candidates(text):
        while at < len(taken) and taken[at][0] < end:  # candidates come in order
            reach, at = max(reach, taken[at][1]), at + 1
        if reach > start:
            continue
        marginal = novelty.marginal_bytes(text, start, end)
        share = novelty_of(text[start:end], marginal)
        if marginal >= LEAST_SHARE * (end - start) and share >= LEAST_NOVELTY:
            found.append((start, len(BASE), end, marginal, share))
    names = [kind for kind, *_ in BASE] + [NOVEL]
    return [{"kind": names[kind], "start": start, "end": end, "text": text[start:end], "marginal_bytes": marginal, "novelty": share}
            for start, kind, end, marginal, share in sorted(found, key=lambda f: f[:3])]


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = IDENTIFIERS) -> DataFrame:
    """A row per row of `docs`: doc_id and spans (kind, start, end, text, and for novel ones marginal_bytes and novelty)."""
    known = docs.sparkSession.sparkContext.broadcast(identifiers(docs, text_col, most))  # KEPT_BYTES at most

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(known.value)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string()),
                                   ("marginal_bytes", pa.int32()), ("novelty", pa.float64())]))
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            sensitive = pc.and_(pc.match_substring_regex(texts, _ANY_CANDIDATE), pc.match_substring_regex(texts, _ANY_CONTEXT))
            worth = pc.or_(pc.match_substring_regex(texts, _ANY_BASE), sensitive).to_pylist()
            found = [spans(texts[i].as_py(), novelty) if look else [] for i, look in enumerate(worth)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(search, f"doc_id long, spans array<{SPAN}>")


def report(found: DataFrame) -> DataFrame:
    """doc_id, the number of matches of each pattern, base_sha256 over their places, and the places of all spans."""
    def joined(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[number(kind) for kind, *_ in BASE], number(NOVEL),
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != NOVEL)), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
