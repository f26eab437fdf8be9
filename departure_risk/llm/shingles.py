"""Words and word shingles of whole texts as 64-bit hashes, batch by batch in numpy.

Words are runs of characters other than space and \\t to \\r; A to Z count as a to z.
"""

import hashlib

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: Words longer than this are hashed one at a time.
LONG = 512
#: Words hashed at a time, so that a block stays in the processor's cache.
BLOCK = 1 << 15
#: The bytes of a word that eight bytes from its start hold.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_odd = np.random.default_rng(20240607).integers(0, 2 ** 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashed(eights: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of words of up to LONG bytes, eight bytes after the other; those of longer words are of no use."""
    h = mix((lengths.astype(np.uint64) * _odd[0] ^ eights[starts] & MASKS[np.minimum(lengths, 8)]) * _odd[1])
    at, place = 8, np.flatnonzero((lengths > 8) & (lengths <= LONG))
    while len(place):
        rest = lengths[place] - at
        h[place] = mix((h[place] ^ eights[starts[place] + at] & MASKS[np.minimum(rest, 8)]) * _odd[1])
        at += 8
        place = place[rest > 8]
    return h


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin (one more entry than texts); null is empty."""
    texts = pa.array(texts, pa.large_string()) if not isinstance(texts, pa.Array) else texts.cast(pa.large_string())
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] if len(texts) else np.zeros(1, np.int64)
    low = np.zeros(len(data) + 8, np.uint8)
    np.take(LOWER, data, out=low[:len(data)])
    word = ~np.take(SPACE, data)
    before = np.zeros(len(data) + 1, bool)  # whether the byte before is of a word of the same text
    before[1:] = word
    before[offsets] = False
    starts = np.flatnonzero(word & ~before[:-1])
    ends = np.flatnonzero(word & ~np.concatenate([word[1:] & before[1:-1], [False]])[:len(word)]) + 1 if len(word) else starts
    lengths = ends - starts
    eights = np.ndarray((len(data) + 1,), "<u8", low, strides=(1,))
    h = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), BLOCK):
        h[at:at + BLOCK] = _hashed(eights, starts[at:at + BLOCK], lengths[at:at + BLOCK])
    for i in np.flatnonzero(lengths > LONG):
        digest = hashlib.blake2b(low[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        h[i] = np.uint64(int.from_bytes(digest, "little"))
    return h, np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: of `size` words, or of all words where there are fewer."""
    h, bounds = word_hashes(texts)
    parts = [h * _odd[2 + j] for j in range(size)]
    n = len(h) - size + 1
    whole = mix(sum(p[j:n + j] for j, p in enumerate(parts))) if n > 0 else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(whole[a:b - size + 1]))
        elif b > a:
            out.append(mix(np.array([sum(int(parts[j][a + j]) for j in range(b - a)) + (b - a) & (2 ** 64 - 1)], np.uint64) ^ _odd[40]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


_scale = (_odd[:, None] >> np.uint64(7)).astype(np.uint32) | np.uint32(1)
_shift = mix(_odd).astype(np.uint32)[:, None]


def signature(hashes: np.ndarray) -> np.ndarray:
    """64 minhash values (int32) of a set of hashes that is not empty."""
    low = np.full(len(_scale), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), 4096):
        part = (hashes[at:at + 4096] >> np.uint64(32)).astype(np.uint32)
        np.minimum(low, (part * _scale + _shift).min(axis=1), out=low)
    return low.view(np.int32)
