"""Simple-8b: whole numbers packed into 64-bit words, in blocks that numpy packs and unpacks side by side.

The upper 4 bits of a word select how many values follow and how wide each is. A value of more than 60 bits is an
escape: its word holds the place of the value among the block's escaped values. Blocks hold BLOCK values (the last
one fewer) and are packed on their own, so a block is read from its offset without the ones before it.
"""

import numpy as np

BLOCK = 4096
ESCAPE = 1
#: Values and bits by selector; selector 1 is the escape.
SELECTORS = [(240, 0), (1, 60), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
             (4, 15), (3, 20), (2, 30), (1, 60)]
COUNTS = np.array([n for n, _ in SELECTORS], np.int64)
PADDED = BLOCK + 240


def _runs(small: np.ndarray, count: int) -> np.ndarray:
    """Where `count` values in a row are small, by doubling the length of the runs."""
    runs, length = small, 1
    while length < count:
        step = min(length, count - length)
        runs = runs[:, :-step] & runs[:, step:]
        length += step
        if length < count and not runs[:, :BLOCK].any():  # the padding behind a block always runs on
            return np.zeros((len(small), BLOCK), bool)
    return runs[:, :BLOCK]


def _choices(padded: np.ndarray) -> np.ndarray:
    """For each place of each block, the selector that takes most of the values from there on."""
    chosen = np.full((len(padded), BLOCK), ESCAPE, np.int8)
    values = padded.astype(np.uint32) if not (padded >> np.uint64(32)).any() else padded
    for selector in range(len(SELECTORS) - 1, -1, -1):
        count, bits = SELECTORS[selector]
        if selector != ESCAPE:
            fits = _runs(values <= (1 << bits) - 1, count) if bits < 32 or values is padded else np.ones_like(chosen, bool)
            np.copyto(chosen, selector, where=fits)
    return chosen


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, words per block, escaped values, escaped values per block."""
    blocks = -(-len(values) // BLOCK)
    padded = np.zeros((blocks, PADDED), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:len(values)] = values
    padded[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    lengths = np.full(blocks, BLOCK, np.int64)
    if blocks:
        lengths[-1] = len(values) - (blocks - 1) * BLOCK
    chosen = _choices(padded)
    at, active = np.zeros(blocks, np.int64), np.arange(blocks)
    steps = []
    while len(active):  # one word of every unfinished block at a time
        place = at[active]
        selector = chosen[active, place]
        steps.append((active, place, selector))
        at[active] = place + COUNTS[selector]
        active = active[at[active] < lengths[active]]
    if not steps:
        none = np.zeros(0, np.uint64)
        return none, np.zeros(0, np.int64), none, np.zeros(0, np.int64)
    block, place, selector = (np.concatenate(x) for x in zip(*steps))
    order = np.argsort(block, kind="stable")
    block, place, selector = block[order], place[order], selector[order]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s, (count, bits) in enumerate(SELECTORS):
        here = np.flatnonzero(selector == s)
        if s == ESCAPE or not bits or not len(here):
            continue
        group = padded[block[here][:, None], place[here][:, None] + np.arange(count)]
        words[here] |= np.bitwise_or.reduce(group << (np.arange(count, dtype=np.uint64) * np.uint64(bits)), axis=1)
    escaped = np.flatnonzero(selector == ESCAPE)
    per_block = np.bincount(block[escaped], minlength=blocks).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(per_block)[:-1]])
    words[escaped] |= (np.arange(len(escaped)) - first[block[escaped]]).astype(np.uint64)
    return words, np.bincount(block, minlength=blocks).astype(np.int64), padded[block[escaped], place[escaped]], per_block


def unpack(words: np.ndarray, words_per_block: np.ndarray, escaped: np.ndarray, escaped_per_block: np.ndarray,
           lengths: np.ndarray) -> np.ndarray:
    """The values of consecutive blocks, from the four arrays of `pack` and the number of values of each block."""
    blocks = len(lengths)
    block = np.repeat(np.arange(blocks), words_per_block)
    selector = (words >> np.uint64(60)).astype(np.int64)
    after = np.cumsum(COUNTS[selector])
    before = after - COUNTS[selector]
    first_word = np.concatenate([[0], np.cumsum(words_per_block)])[:-1]
    place = before - (before[first_word] if len(before) else before)[block] if blocks else before
    out = np.zeros((blocks, PADDED), np.uint64)
    for s, (count, bits) in enumerate(SELECTORS):
        here = np.flatnonzero(selector == s)
        if not bits or not len(here):
            continue
        if s == ESCAPE:
            first = np.concatenate([[0], np.cumsum(escaped_per_block)])[block[here]]
            number = (words[here] & np.uint64((1 << 60) - 1)).astype(np.int64)
            out[block[here], place[here]] = escaped[first + number]
            continue
        shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
        values = (words[here][:, None] >> shifts) & np.uint64((1 << bits) - 1)
        out[block[here][:, None], place[here][:, None] + np.arange(count)] = values
    return out[:, :BLOCK][np.arange(BLOCK) < np.asarray(lengths)[:, None]]
