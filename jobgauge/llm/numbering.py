"""Dense row numbers in a total order, without a window over all rows or over a large group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobgauge.sources.scratch import written

_LOCAL_BITS = 33  # of monotonically_increasing_id: the partition is above them, the row's place in it below


def numbered(rows: DataFrame, order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """`rows` with rank, counted from 0 in each group of equal `within` by `order`, and total, the rows of the group.

    NULL comes first and is a group of its own. Rows equal in all these columns have ranks of their own, in any order.
    The rows are sorted over range partitions, where a group or a run of equal rows may span several of them, and written
    out. A row's rank is its place in its partition plus the rows of its group in earlier ones; those counts are one row
    per partition and group that meet. `rows` has no columns named at, part, rank or total.
    """
    placed = (
        rows.withColumn("part", F.monotonically_increasing_id())  # splits runs of equal rows
        .repartitionByRange(*within, *order, "part")
        .sortWithinPartitions(*within, *order)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", _LOCAL_BITS))
    )
    placed = written(placed, "numbered")
    runs = placed.groupBy("part", *within).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    group = Window.partitionBy(*within)
    before = F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        F.col("part").alias("run_part"),
        *[F.col(name).alias(f"run_{name}") for name in within],
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(group).alias("total"),
    )
    same = F.col("part") == F.col("run_part")
    for name in within:
        same &= F.col(name).eqNullSafe(F.col(f"run_{name}"))
    joined = placed.join(written(runs, "number-runs"), same)
    return joined.select(*rows.columns, (F.col("at") + F.col("shift")).alias("rank"), "total")
