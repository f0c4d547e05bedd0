"""Dimension joins."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgauge.sources.scratch import written


def unique_by_key(dimension: DataFrame, key: str) -> DataFrame:
    """One row per key, so that a lookup never multiplies rows; see `repeated_keys` for what it leaves out.

    Where a key repeats, the row with the fewest NULLs stays, then the smallest.
    """
    others = [c for c in dimension.columns if c != key]
    nulls = sum((F.col(c).isNull().cast("int") for c in others), F.lit(0))
    best = dimension.groupBy(key).agg(F.min(F.struct(nulls.alias("_nulls"), F.struct(*others).alias("_row"))).alias("_best"))
    return best.select(key, "_best._row.*")


def repeated_keys(dimension: DataFrame, key: str) -> DataFrame:
    """The keys with several rows and their number: all but one row of each take no part in a `lookup`."""
    return dimension.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def lookup(fact: DataFrame, dimension: DataFrame, key: str, unique: bool = True) -> DataFrame:
    """Left join to a dimension; unmatched rows get NULL.

    No broadcast hint: Spark broadcasts a side it knows or measures to be below spark.sql.autoBroadcastJoinThreshold,
    and otherwise sort-merges with adaptive skew handling.
    """
    side = unique_by_key(dimension, key) if unique else dimension
    return fact.join(side, key, "left")


#: Keys that the frequent-items sketch keeps a count of, for each hot key asked for.
TRACKED_PER_KEY = 64


def frequent_keys(fact: DataFrame, key: str, most: int) -> DataFrame:
    """About the `most` most frequent keys but NULL, and the share of all rows that each has at least.

    From a sketch that tracks 64 keys for each of these: one pass over the key column without a shuffle of keys, as sketches
    of tasks merge. A count is off by one part in 24 * `most` of the rows at the most (3.5 / size for a sketch of frequent
    items), so a key with a share above 1 / `most` is always among them.
    """
    sketch = F.expr(f"approx_top_k(`{key}`, {most}, {most * TRACKED_PER_KEY})")
    found = fact.agg(sketch.alias("top"), F.count(F.lit(1)).alias("all_rows")).select("all_rows", F.explode("top").alias("top"))
    return found.filter(F.col("top.item").isNotNull()).select(F.col("top.item").alias(key), (F.col("top.count") / F.col("all_rows")).alias("share"))


def salted_lookup(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    row_key: Sequence[str],
    salts: int,
    hot_keys: int | None,
) -> DataFrame:
    """Left join that spreads frequent fact keys over up to `salts` partitions; the dimension is repeated per salt.

    `hot_keys=None` spreads every key and repeats every dimension row, which is for small dimensions only. With a number, as
    many keys of `frequent_keys`, and NULL, are spread, each over salts in proportion to its share, so that none of its parts
    has much more than one part in `salts` of the rows; only their dimension rows are repeated. The list of these keys is
    bounded by its length, so it is broadcast.
    """
    spread = F.pmod(F.xxhash64(*row_key), F.lit(salts)).cast("int")
    side = unique_by_key(dimension, key)
    if hot_keys is None:
        salted_fact = fact.withColumn("_salt", spread)
        salted_side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    else:
        parts = F.greatest(F.lit(1), F.least(F.lit(salts), F.ceil(F.col("share") * salts))).cast("int")
        hot = F.broadcast(written(frequent_keys(fact, key, hot_keys).select(key, parts.alias("_parts")), "hot-keys"))
        own = F.when(F.col(key).isNull(), spread).otherwise(F.pmod(F.xxhash64(*row_key), F.coalesce("_parts", F.lit(1))).cast("int"))
        salted_fact = fact.join(hot, key, "left").withColumn("_salt", own).drop("_parts")
        last = F.coalesce("_parts", F.lit(1)) - 1
        salted_side = side.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_parts")
    return salted_fact.join(salted_side, [key, "_salt"], "left").drop("_salt")
