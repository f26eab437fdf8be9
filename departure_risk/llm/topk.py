"""Exact top-k by inner product with a pivot table.

With one more component, sqrt(M - |x|^2) for candidates and 0 for queries (M: the largest |x|^2), the candidate of the
larger inner product is the nearer one: |q - x|^2 = |q|^2 + M - 2 q.x. The triangle inequality then bounds it: for any
pivot p, |q - x| >= |d(q, p) - d(x, p)|. Distances to all pivots are computed once for each vector; the largest of these
lower bounds gives an upper bound of the score, and candidates are evaluated in the order of it until no bound reaches
the k-th score found. Ties with that score are evaluated too, so the result is exact.

Candidates lie in blocks of about BLOCK_ROWS rows, packed with their pivot distances. Blocks of queries visit each block
of candidates: a stated query set against all rows, in blocks. A sample of the vectors gives each query a score that its
k best surely reach; blocks return only what reaches it, at most k rows a query.

Defined cases: vectors that are null or hold null or non-finite components, and rows without an id, take no part; vectors
of different lengths are filled up with zeros; of rows that repeat an id, the one with the smallest vector counts; an empty
vector has score 0 with all; scores beyond a long stop at its limits; other columns are ignored; an empty table gives no row.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from departure_risk.session import written_once

BLOCK_ROWS, QUERY_ROWS = 4096, 1024
#: Pivots, and vectors (by the hash of their id) they are chosen from on the driver.
PIVOTS, SAMPLED = 24, 4096
SCORES = "query_id long, vec_id long, score long"


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """id and v: floor(scale * component) as doubles, of the vectors that take part."""
    scaled = F.transform(F.col(vector_col), lambda x: F.lit(float(scale)) * x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col(id_col).cast("long").alias("id"), scaled.alias("v")).where("id is not null and v is not null").where(
        fine).select("id", F.transform("v", lambda x: F.rint(x - F.pmod(x, F.lit(1.0)))).alias("v"))


def sample_of(vectors: DataFrame, count: int, width: int, sampled: int) -> list:
    """id and v of the `sampled` ids of the least hashes, each with its vector that counts, in that order.

    Of `count` rows only those below a bound of the hash are looked at, some 2 * `sampled` at first. A limit alone takes
    `sampled` rows from every task to the driver.
    """
    hashed, share = F.xxhash64("id"), 2 * sampled / count
    filled = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))
    while True:
        below = vectors if share >= 1 else vectors.where(hashed < F.lit(int(share * 2 ** 64) - 2 ** 63))
        found = below.groupBy("id").agg(F.min(filled).alias("v")).orderBy(hashed, "id").limit(sampled).collect()
        if share >= 1 or len(found) == sampled:
            return found
        share *= 8


def choose_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Far-apart rows of the sample: each next one is the farthest from those chosen."""
    chosen = [0]
    nearest = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(pivots, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _lifted(x: np.ndarray, largest: float) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.column_stack([x, np.sqrt(np.maximum(0.0, largest - (x * x).sum(axis=1)))])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots])


def small_enough(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether doubles add up inner products of the rows exactly."""
    return a.size == 0 or b.size == 0 or bool(np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0 ** 53)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, as int64."""
    if a.size == 0 or b.size == 0:
        return np.zeros((len(a), len(b)), np.int64)
    if small_enough(a, b):
        return (a @ b.T).astype(np.int64)
    x, y = ([[int(v) for v in row] for row in m] for m in (a, b))
    low, high = -2 ** 63, 2 ** 63 - 1
    return np.array([[max(low, min(high, sum(map(int.__mul__, p, q)))) for q in y] for p in x], np.int64)


def best(query: np.ndarray, own: int, bound: np.ndarray, at_least: float, x: np.ndarray, ids: np.ndarray,
         k: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows of x: evaluated in the order of their bounds, eight times as many each time.

    `exact`: that query and x are known to be `small_enough`; then much of x is not gathered first.
    """
    open_ = np.flatnonzero((bound >= at_least) & (ids != own))
    found_ids, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
    step = 4 * k
    while len(open_):
        if len(open_) > step:
            parted = np.argpartition(-bound[open_], step)
            now, open_ = open_[parted[:step]], open_[parted[step:]]
        else:
            now, open_ = open_, open_[:0]
        found_ids = np.concatenate([found_ids, ids[now]])
        if exact:
            value = ((x @ query)[now] if 8 * len(now) > len(x) else x[now] @ query).astype(np.int64)
        else:
            value = scores(query[None, :], x[now])[0]
        found = np.concatenate([found, value])
        if len(found) > 4 * k:  # the k best and their ties
            tops = found >= -np.partition(-found, k - 1)[k - 1]
            found_ids, found = found_ids[tops], found[tops]
        order = np.lexsort((found_ids, -found))[:k]
        found_ids, found = found_ids[order], found[order]
        if len(found) == k:
            open_ = open_[bound[open_] >= found[-1]]
        step *= 8
    keep = found >= at_least
    return found_ids[keep], found[keep]


def top_k(rows: DataFrame, k: int = 20, query_every: int | None = None, queries: Column | None = None,
          id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0, pivots: int = PIVOTS,
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, sampled: int = SAMPLED) -> DataFrame:
    """query_id, rank, vec_id and score: the k best other rows of every query, ties to the smaller id.

    Queries are the rows where `queries` (a condition on `id`) holds, or whose id `query_every` divides.
    """
    vectors = written_once(whole_vectors(rows, id_col, vector_col, scale), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    count, width, largest = vectors.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(norm)).first()
    asked = queries if queries is not None else F.col("id") % query_every == 0
    if not count:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    by_hash = sample_of(vectors, count, width, sampled)
    sample_ids = np.array([r.id for r in by_hash], np.int64)
    sample = _matrix([r.v for r in by_hash], width)
    pivot_rows = choose_pivots(_lifted(sample, largest), pivots)
    blocks = -(-count // block_rows)
    query_blocks = max(1, -(-vectors.where(asked).count() // query_rows))

    def unique(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        ids, x = group["id"].to_numpy(np.int64), _matrix(list(group["v"]), width)
        order = np.lexsort((*x.T[::-1], ids))
        ids, x = ids[order], x[order]
        first = np.concatenate([[True], ids[1:] != ids[:-1]])
        return ids[first], x[first]

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        ids, x = unique(group)
        far = _distances(_lifted(x, largest), pivot_rows).astype(np.float32)
        return pd.DataFrame({"block": [group["block"].iloc[0]], "ids": [ids.tobytes()], "x": [x.tobytes()], "far": [far.tobytes()]})

    def pack_queries(group: pd.DataFrame) -> pd.DataFrame:
        ids, x = unique(group)
        far = _distances(np.column_stack([x, np.zeros(len(x))]), pivot_rows).astype(np.float32)
        known = scores(x, sample).astype(np.float64)
        known[ids[:, None] == sample_ids[None, :]] = -np.inf
        reached = np.full(len(x), -np.inf) if known.shape[1] < k else -np.partition(-known, k - 1, axis=1)[:, k - 1]
        return pd.DataFrame({"query_block": [group["query_block"].iloc[0]], "query_ids": [ids.tobytes()], "q": [x.tobytes()],
                             "query_far": [far.tobytes()], "reached": [reached.tobytes()]})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: c[at].as_buffer() for n, c in zip(batch.schema.names, batch.columns)}
                ids, query_ids = (np.frombuffer(row[n], np.int64) for n in ("ids", "query_ids"))
                x, q = (np.frombuffer(row[n], np.float64).reshape(-1, width) for n in ("x", "q"))
                far = np.frombuffer(row["far"], np.float32).reshape(-1, len(ids))
                query_far = np.frombuffer(row["query_far"], np.float32).reshape(-1, len(query_ids))
                reached, exact = np.frombuffer(row["reached"], np.float64), small_enough(q, x)
                out = []
                for i, own in enumerate(query_ids):
                    nearest = np.zeros(len(ids), np.float32)
                    for d, e in zip(query_far[:, i], far):
                        np.maximum(nearest, np.abs(e - d), out=nearest)
                    whole = float((q[i] * q[i]).sum()) + largest
                    bound = (whole - nearest.astype(np.float64) ** 2) / 2 + 1e-5 * whole + 1
                    bound[~np.isfinite(bound)] = np.inf
                    got, value = best(q[i], own, bound, reached[i], x, ids, k, exact)
                    out.append((np.full(len(got), own), got, value))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=["query_id", "vec_id", "score"])

    packed = written_once(
        vectors.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks))).groupBy("block").applyInPandas(
            pack, "block long, ids binary, x binary, far binary"), "pivot-table")
    asking = written_once(
        vectors.where(asked).withColumn("query_block", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(query_blocks))).groupBy(
            "query_block").applyInPandas(pack_queries, "query_block long, query_ids binary, q binary, query_far binary, reached binary"),
        "pivot-queries")
    visits = asking.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    # no broadcast: sizes are estimated without the explode, so all copies of the queries would meet on the driver
    found = packed.join(visits.hint("merge"), "block").drop("block", "query_block").mapInArrow(search, SCORES)
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
