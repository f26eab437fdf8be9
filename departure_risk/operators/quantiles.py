"""Exact order statistics of many columns at once, in memory that depends on the ranks asked for, not on the rows.

Values are read as whole numbers in the same order. An interval of them that holds a wanted rank is cut into PIECES; one scan
counts the pieces of all intervals of all columns, with the least and greatest value of each. The piece with the rank is the
next interval, down to its own least and greatest value, until these are equal: a column of few values needs two or three scans,
any column nine at most.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PIECES = 256
_LOW = 0x7FFFFFFFFFFFFFFF


def in_order(values: np.ndarray) -> np.ndarray:
    """Doubles as whole numbers in the same order; -0.0 is 0.0."""
    bits = (values + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & _LOW)


def as_double(number: int) -> float:
    number = np.int64(number)
    return float((number ^ ((number >> np.int64(63)) & np.int64(_LOW))).view(np.float64))


def piece_of(numbers: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of PIECES pieces of its interval a number is in."""
    width = ((high.view(np.uint64) - low.view(np.uint64)) // np.uint64(PIECES) + np.uint64(1))
    return ((numbers.view(np.uint64) - low.view(np.uint64)) // width).astype(np.int64)


def counted(rows: DataFrame, intervals: dict[int, list[tuple[int, int]]]) -> dict[tuple[int, int, int], tuple[int, int, int]]:
    """(column, interval, piece) -> (rows, least, greatest): at most PIECES entries an interval reach the driver."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {c: [np.array(x, np.int64) for x in zip(*of)] for c, of in intervals.items()}
        sums = {c: (np.zeros(len(of) * PIECES, np.int64), np.full(len(of) * PIECES, np.iinfo(np.int64).max), np.full(len(of) * PIECES, np.iinfo(np.int64).min))
                for c, of in intervals.items()}
        for batch in batches:
            for c, (low, high) in held.items():
                column = batch.column(c).drop_null()
                numbers = in_order(column.to_numpy(zero_copy_only=False))
                at = np.searchsorted(low, numbers, side="right") - 1
                inside = (at >= 0) & (numbers <= high[at])
                numbers, at = numbers[inside], at[inside]
                cell = at * PIECES + piece_of(numbers, low[at], high[at])
                number, least, greatest = sums[c]
                number += np.bincount(cell, minlength=len(number))
                np.minimum.at(least, cell, numbers)
                np.maximum.at(greatest, cell, numbers)
        for c, (number, least, greatest) in sums.items():
            used = np.flatnonzero(number)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), c, np.int32)), pa.array(used.astype(np.int32)), pa.array(number[used]),
                                              pa.array(least[used]), pa.array(greatest[used])], names=["c", "cell", "n", "least", "greatest"])

    partial = rows.mapInArrow(scan, "c int, cell int, n long, least long, greatest long")
    found = partial.groupBy("c", "cell").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest")).collect()
    return {(r.c, r.cell // PIECES, r.cell % PIECES): (r.n, r.least, r.greatest) for r in found}


def order_statistics(rows: DataFrame, columns: list[str], ranks: Callable[[int], list[int]]) -> dict[str, list[float]]:
    """For each column the values at `ranks(n)`, from 0, of its n values in order; empty where it has none.

    Nulls and NaN are no values. Columns are read as doubles.
    """
    numbers = rows.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)])
    if not columns:
        return {}
    first = numbers.agg(*[f(f"c{i}").alias(f"{n}{i}") for i in range(len(columns)) for n, f in (("n", F.count), ("a", F.min), ("b", F.max))]).first()
    # open ranks: (column, low, high, rank within the interval), by the place in the answer
    wanted, answer, state = {}, {c: [] for c in columns}, {}
    for i, c in enumerate(columns):
        n = first[f"n{i}"]
        wanted[i] = sorted(set(ranks(n))) if n else []
        if n:
            low, high = (int(in_order(np.array([first[f"{x}{i}"]]))[0]) for x in ("a", "b"))
            state |= {(i, r): (low, high, r) for r in wanted[i]}
    while open_ranks := {k: v for k, v in state.items() if v[0] < v[1]}:
        intervals = {}
        for (i, _), (low, high, _) in open_ranks.items():
            intervals.setdefault(i, set()).add((low, high))
        intervals = {i: sorted(of) for i, of in intervals.items()}
        places = {i: {interval: at for at, interval in enumerate(of)} for i, of in intervals.items()}
        cells: dict[tuple[int, int], list] = {}
        for (i, at, piece), values in sorted(counted(numbers, intervals).items()):
            cells.setdefault((i, at), []).append(values)
        for (i, r), (low, high, rank) in open_ranks.items():
            for n, least, greatest in cells[i, places[i][low, high]]:
                if rank < n:
                    state[i, r] = (least, greatest, rank)
                    break
                rank -= n
    for i, c in enumerate(columns):
        answer[c] = [as_double(state[i, r][0]) for r in ranks(first[f"n{i}"])] if wanted[i] else []
    return answer


def medians(rows: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians, the mean of the middle two where the number is even; columns without values are left out."""
    middle = order_statistics(rows, columns, lambda n: [(n - 1) // 2, n // 2])
    return {c: (a + b) / 2 for c, of in middle.items() if of for a, b in [of]}
