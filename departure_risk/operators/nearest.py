"""Requests to snapshot rows: same carrier and route, closest scheduled hour."""

from pyspark.sql import DataFrame, functions as F

from departure_risk.config import SNAPSHOT_LATEST, SNAPSHOT_MEDIANS

ROUTE = ["carrier", "origin", "dest"]
# Statuses and notes of the answers.
FOUND = "ok"
NOT_FOUND = "no_history"
INVALID = "invalid_hour"
EXACT = "exact scheduled hour"
NEAREST = "nearest scheduled hour on this route used for history"


def match_requests(requests: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Add status, note, matched_hour and the snapshot columns to every request.

    The snapshot is folded to one row per carrier and route with its hours (24 at most), so a request
    joins one row and no shuffle by request follows. Distance in hours is linear; ties take the lower hour.
    """
    columns = [*SNAPSHOT_MEDIANS, *SNAPSHOT_LATEST]
    hours = snapshot.groupBy(*ROUTE).agg(
        F.collect_list(F.struct(F.col("dep_hour").alias("hour"), *columns)).alias("hours"))
    valid = F.coalesce(F.col("dep_hour").between(0, 23), F.lit(False))
    joined = requests.join(hours, ROUTE, "left")
    ranked = F.transform("hours", lambda h: F.struct(
        F.abs(h["hour"] - F.col("dep_hour")).alias("gap"), h["hour"].alias("hour"), h.alias("row")))
    nearest = F.when(valid, F.array_min(ranked))
    picked = joined.withColumn("nearest", nearest)
    found = F.col("nearest").isNotNull()
    status = F.when(~valid, INVALID).when(found, FOUND).otherwise(NOT_FOUND)
    note = F.when(found, F.when(F.col("nearest.gap") == 0, EXACT).otherwise(NEAREST))
    return picked.select(
        *requests.columns,
        status.alias("status"),
        F.col("nearest.hour").alias("matched_hour"),
        note.alias("note"),
        *[F.col(f"nearest.row.{c}").alias(c) for c in columns],
    )
