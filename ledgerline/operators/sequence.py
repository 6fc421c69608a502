"""Distributed dense row numbering in a global sort order.

``row_number() OVER (ORDER BY k)`` without a partition moves every row into a
single task.  This helper numbers rows the way ``zipWithIndex`` does, but on
DataFrames:

1. range-partition on the sort key and sort inside each partition;
2. tag each row with its partition id and its position in the partition,
   and write that to the checkpoint folder so the assignment survives
   recomputation and lost executors;
3. count rows per partition, turn the counts into offsets by a prefix sum
   and join them back on the partition number.  Counts and offsets have one
   row per partition, a proven bound for the broadcast and for the one task
   that forms the prefix sum.

Used for surrogate keys of dimensions whose size grows with the data, and for
exact quantiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators.materialize import materialize


def with_row_index_counted(
    df: DataFrame,
    order: list[Column | str],
    name: str = "row_index",
    start: int = 0,
    num_partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """Add a BIGINT column numbering rows ``start, start+1, ...`` in ``order``;
    also return the row count.

    Ties are numbered in an arbitrary but fixed order; give a unique ``order``
    for deterministic numbers.
    """
    # Without an explicit count AQE may coalesce the range partitions; it only
    # merges adjacent ones, so partition order still follows the sort order.
    ranged = (
        (df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order))
        .sortWithinPartitions(*order)
        .withColumn("_ri_part", F.spark_partition_id())
        .withColumn("_ri_mono", F.monotonically_increasing_id())
    )
    # Freeze the partition assignment: a table in the shared checkpoint folder
    # survives recomputation and lost executors.
    ranged = materialize(ranged, "rowindex")
    counts = ranged.groupBy("_ri_part").agg(F.count(F.lit(1)).alias("_ri_cnt"))
    offsets = materialize(partition_offsets(counts), "rowoffsets")
    total = offsets.agg(F.sum("_ri_cnt")).first()[0] or 0
    out = ranged.join(F.broadcast(offsets.drop("_ri_cnt")), "_ri_part")
    local = F.col("_ri_mono") - F.shiftleft(F.col("_ri_part").cast("bigint"), 33)
    out = out.withColumn(name, (F.col("_ri_before") + local + F.lit(start)).cast("bigint"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], name), total


def partition_offsets(counts: DataFrame) -> DataFrame:
    """The counts with ``_ri_before``: rows of the partitions before each one."""
    before = Window.orderBy("_ri_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = F.coalesce(F.sum("_ri_cnt").over(before), F.lit(0).cast("bigint"))
    return counts.select("_ri_part", "_ri_cnt", sums.alias("_ri_before"))


def with_row_index(
    df: DataFrame,
    order: list[Column | str],
    name: str = "row_index",
    start: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """:func:`with_row_index_counted` without the count."""
    return with_row_index_counted(df, order, name, start, num_partitions)[0]
