"""Finding and setting apart groups too large for one task."""

from pyspark.sql import DataFrame, Window, functions as F

# A group above this many rows is processed in pieces.
HOT_ROWS = 1_000_000
#: Most groups whose keys are broadcast.
MOST_HOT = 100_000


def hottest(groups: DataFrame, size: str, limit: int = HOT_ROWS, most: int = MOST_HOT) -> DataFrame | None:
    """The groups (one row each) with more than `limit` rows, at most `most` of them so that they can be broadcast; None without any.

    Where more are that large, the limit rises until `most` are left. A group below it then holds less than 1 / `most` of all
    rows, however many rows there are, and goes the usual way. The check runs right away over the number of groups of each
    size: there are at most some square root of all rows of those.
    """
    sizes = groups.filter(F.col(size) > limit).groupBy(size).agg(F.count("*").alias("groups"))
    larger = sizes.select(size, F.sum("groups").over(Window.orderBy(F.desc(size))).alias("as_large"))
    found = larger.agg(F.max(size).alias("largest"), F.max(F.when(F.col("as_large") > most, F.col(size))).alias("raised")).first()
    if found.largest is None or found.largest == found.raised:
        return None
    return groups.filter(F.col(size) > (limit if found.raised is None else found.raised))


def hot_keys(rows: DataFrame, keys: list[str], limit: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than `limit` rows: at most rows/limit of them and MOST_HOT; usually none, then None."""
    counts = rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("rows_of_key"))
    hot = hottest(counts, "rows_of_key", limit)
    return None if hot is None else hot.select(*keys)


def set_apart(rows: DataFrame, keys: list[str], limit: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys and of null keys, rows of hot keys or None when there are none).

    The check runs right away over the key columns alone, so the usual plan carries no trace of it. The
    broadcast list is bounded by rows/limit and by MOST_HOT.
    """
    hot = hot_keys(rows, keys, limit)
    if hot is None:
        return rows, None
    hot = F.broadcast(hot)
    return rows.join(hot, keys, "left_anti"), rows.join(hot, keys, "left_semi")
