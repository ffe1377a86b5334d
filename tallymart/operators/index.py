"""Dense 0-based row numbers over a whole table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.tables import durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def dense_index(df: DataFrame, order_by: Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0..n-1 in the given order, without a single-task step over the rows.

    Rows are range-partitioned and sorted, which fixes each row's partition and
    its position there. That frame is frozen in the checkpoint folder, since two
    passes over it must agree. Then only the partition sizes (one row per
    partition) are summed up and sent back to the rows.

    Rows that tie are ordered by a hash of the whole row, so the numbers depend on
    the rows alone, not on their number or layout, and a repeated key does not fill one partition.
    Equal rows come one after the other. ``partitions`` defaults to the session's number of shuffle partitions.
    """
    spread = [*order_by, "_tie_hash", "_tie_id"]
    tied = df.withColumn("_tie_hash", F.xxhash64(*df.columns)).withColumn("_tie_id", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(partitions, *spread) if partitions else tied.repartitionByRange(*spread)
    placed = durable(
        ranged.sortWithinPartitions(*spread)
        .drop("_tie_hash", "_tie_id")
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftrightunsigned("_place", _ROW_BITS))
        .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_place")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    # one row of two numbers per partition
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_part", "_row", "_start")
    )
