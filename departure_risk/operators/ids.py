"""Row numbers 1..n over a whole table without a one-task window."""

from pyspark.sql import DataFrame, Window, functions as F

from departure_risk.session import written_once

# monotonically_increasing_id keeps the partition above this many bits and the position below.
POSITION_BITS = 33


def dense_ids(rows: DataFrame, order_by: list[str] | None = None, name: str = "flight_id") -> DataFrame:
    """Number the rows 1..n: in `order_by` order, or in scan order, which needs no shuffle.

    The rows are written once with Spark's (partition, position) id, so counting and numbering see the
    same rows whatever is lost or retried in between. Offsets are one row per partition. In `order_by`
    order the scan position breaks ties, so copies of one row spread over partitions too.
    """
    if order_by:
        at = "scan_position"
        rows = (
            rows.withColumn(at, F.monotonically_increasing_id())
            .repartitionByRange(*order_by, at).sortWithinPartitions(*order_by, at).drop(at)
        )
    placed = written_once(rows.withColumn("place", F.monotonically_increasing_id()), "row-places")
    part = F.shiftright("place", POSITION_BITS)
    position = F.col("place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    numbered = placed.withColumn("part", part).join(F.broadcast(offsets), "part")
    return numbered.withColumn(name, F.col("offset") + position + 1).drop("part", "place", "offset")
