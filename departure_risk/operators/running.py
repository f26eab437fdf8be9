"""Exact running totals over a whole table without a one-task window."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

MOST_PIECES = 4096


def cut_points(rows: DataFrame, order: str, pieces: int) -> list[float]:
    """Values that cut `order` into pieces of similar size: at most pieces-1 numbers on the driver.

    Only the balance of the pieces depends on them, never a result, so an approximation is enough.
    """
    shares = [i / pieces for i in range(1, pieces)]
    return sorted(set(rows.stat.approxQuantile(order, shares, 0.25 / pieces))) if shares else []


def in_ranges(rows: DataFrame, order: str, name: str, pieces: int | None = None) -> DataFrame:
    """Add `name`: which of at most `pieces` ranges of `order` a row falls in, in order.

    The cut points are literals, so a recomputed task cuts at the same values.
    """
    pieces = pieces or min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_PIECES)
    edges = [float("-inf"), *cut_points(rows, order, pieces), float("inf")]
    if len(edges) == 2:
        return rows.withColumn(name, F.lit(0.0))
    return Bucketizer(splits=edges, inputCol=order, outputCol=name, handleInvalid="keep").transform(rows)


def add_running_totals(rows: DataFrame, groups: list[str], order: str, totals: list[str],
                       pieces: int | None = None) -> DataFrame:
    """Add `{c}_before` (sum over smaller `order` in the group) and `{c}_all` for every column c of `totals`.

    `order` is a double, unique within a group. The table is cut into value ranges; sums per range give
    each range its offset (groups x pieces rows, broadcast), and a window adds up inside a range only.
    """
    pieced = in_ranges(rows, order, "piece", pieces)
    earlier = Window.partitionBy(*groups).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = pieced.groupBy(*groups, "piece").agg(*[F.sum(c).alias(c) for c in totals]).select(
        *groups, "piece",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_offset") for c in totals],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in totals],
    )
    inside = Window.partitionBy(*groups, "piece").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = pieced.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in totals})
    joined = placed.join(F.broadcast(offsets), [*groups, "piece"])
    return joined.withColumns(
        {f"{c}_before": F.col(f"{c}_before") + F.col(f"{c}_offset") for c in totals}
    ).drop("piece", *[f"{c}_offset" for c in totals])
