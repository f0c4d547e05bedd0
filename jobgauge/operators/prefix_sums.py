"""Running totals over rows in the order of any key, without a window over more than one task's rows.

Rows are dealt to ranges of the key, so that each task holds a stretch of the order. A window inside each stretch gives local
sums, one row per stretch what comes before it. Totals are exact sums of doubles, see `functions.exact`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobgauge.functions.exact import bin_columns, exact_parts, folded_columns, present_bins
from jobgauge.sources.scratch import written


def with_prefix_sum(
    df: DataFrame, value: str, order: Sequence[str], name: str, within: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """`df` with the total of `value` over all rows up to and including each one, per `within` if given, as column `name`.

    Rows equal in `order` and `within` share their total, wherever they lie: they are added up before, so that each key is one
    row, and a key with very many rows costs a few partial rows. NULL keys come first and are keys like others. Values that are
    NULL or no number count nothing; the total is NULL up to the first value. An empty table stays empty.

    Keys go to `ranges` ranges, by default the session's shuffle partitions. The window over the ranges sees one row each, per
    value of `within`. Ranges are drawn from a sample, which may differ from run to run, so the dealt rows are written once.
    Columns of `df` keep their names and values; `df` is read twice and should be a stored table.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*within, *order]
    plain = {key: f"key{i}" for i, key in enumerate(keys)}
    keyed = df.select(*[F.col(key).alias(plain[key]) for key in keys], exact_parts(F.col(value)).alias("parts"))
    groups, places = [plain[key] for key in within], [plain[key] for key in order]
    bins = present_bins(keyed, "parts")
    parts = bin_columns("parts", bins)
    per_key = keyed.groupBy(*plain.values()).agg(*[F.sum(part).alias(part_name) for part_name, part in parts.items()])
    dealt = per_key.repartitionByRange(ranges, *plain.values()).withColumn("stretch", F.spark_partition_id())
    dealt = written(dealt, "stretches")

    local = Window.partitionBy("stretch", *groups).orderBy(*places)
    before = Window.partitionBy(*groups).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("stretch", *groups).agg(*[F.sum(part).alias(part) for part in parts])
    offsets = totals.select(
        F.col("stretch").alias("_stretch"),
        *[F.col(group).alias(f"_{group}") for group in groups],
        *[F.sum(part).over(before).alias(f"_before{part}") for part in parts],
    )
    same = F.col("stretch") == F.col("_stretch")
    for group in groups:
        same &= F.col(group).eqNullSafe(F.col(f"_{group}"))

    def upto(part: str) -> Column:
        return F.coalesce(F.col(f"_upto{part}"), F.lit(0)) + F.coalesce(F.col(f"_before{part}"), F.lit(0))

    sums = (
        dealt.select("stretch", *plain.values(), *[F.sum(part).over(local).alias(f"_upto{part}") for part in parts])
        .join(offsets, same)
        .select(
            F.struct(*[F.col(own) for own in plain.values()]).alias("at"), folded_columns(bins, upto).alias("total")
        )
    )
    # Structs of the caller's row and of the key keep names apart.
    rows = df.select(F.struct(*[F.col(key).alias(plain[key]) for key in keys]).alias("at"), F.struct(*df.columns).alias("row"))
    joined = rows.join(sums, "at")
    return joined.select(*[F.col("row")[column].alias(column) for column in df.columns], F.col("total").alias(name))
