"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers. Spark expressions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobgauge.llm.numbering import numbered

SHARDS = 8
SEED = "shards"
ROUNDS = 8


@dataclass(frozen=True)
class Shuffle:
    """A permutation of the numbers 0 to rows - 1, and the shards that its places are dealt to.

    The numbers lie in a grid of `high` times `low` cells, hardly more than there are rows. A round adds a keyed hash of
    one coordinate to the other one. A result beyond the last row is permuted again, `walks` times at most; that is the
    longest chain of cells beyond the last row, so the walk of every row has ended by then.
    """

    rows: int
    walks: int
    shards: int = SHARDS
    seed: str = SEED
    rounds: int = ROUNDS

    @property
    def high(self) -> int:
        return max(1, math.isqrt(max(self.rows - 1, 0)) + 1)

    @property
    def low(self) -> int:
        return max(1, -(-self.rows // self.high))

    def place(self, number: Column) -> Column:
        """The place of a row in the shuffled order."""
        return self._walked(number, forward=True)

    def number(self, place: Column) -> Column:
        """The row at a place; the way back of `place`."""
        return self._walked(place, forward=False)

    def shard(self, number: Column) -> Column:
        return (self.place(number) % self.shards).cast("int")

    def slot(self, number: Column) -> Column:
        return _div(self.place(number), self.shards)

    def number_at(self, shard: Column, slot: Column) -> Column:
        """The row in a slot of a shard, computed without reading anything."""
        return self.number(slot * self.shards + shard)

    def permuted(self, cell: Column, forward: bool = True) -> Column:
        """The Feistel rounds alone, a permutation of all cells."""

        def rounded(at: Column, step: Column) -> Column:
            sign = 1 if forward else -1
            moved_high = F.pmod(at["high"] + sign * self._hash(step, at["low"], self.high), F.lit(self.high))
            moved_low = F.pmod(at["low"] + sign * self._hash(step, at["high"], self.low), F.lit(self.low))
            even = step % 2 == 0
            return F.struct(
                F.when(even, moved_high).otherwise(at["high"]).alias("high"),
                F.when(even, at["low"]).otherwise(moved_low).alias("low"),
            )

        steps = range(self.rounds) if forward else reversed(range(self.rounds))
        start = F.struct(_div(cell, self.low).alias("high"), (cell % self.low).alias("low"))
        return F.aggregate(
            F.array(*map(F.lit, steps)), start, rounded, lambda at: at["high"] * F.lit(self.low).cast("long") + at["low"]
        )

    def _hash(self, step: Column, half: Column, modulus: int) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(self.seed), step, half))
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % modulus

    def _walked(self, start: Column, forward: bool) -> Column:
        first = self.permuted(start.cast("long"), forward)
        if not self.walks:
            return first
        again = F.array_repeat(F.lit(0), self.walks)
        return F.aggregate(again, first, lambda at, _: F.when(at < self.rows, at).otherwise(self.permuted(at, forward)))


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("long"))


def shuffle_of(spark: SparkSession, rows: int, shards: int = SHARDS, seed: str = SEED, rounds: int = ROUNDS) -> Shuffle:
    """The permutation for a number of rows.

    The cells beyond them, fewer than the square root of their number, are followed home from those that a row enters first;
    cells that lead in a ring to each other are never entered.
    """
    shuffle = Shuffle(rows, 0, shards, seed, rounds)
    cell = F.col("id")
    beyond = spark.range(rows, shuffle.high * shuffle.low).filter(shuffle.permuted(cell, forward=False) < rows)
    walks = 0
    while rows and (entered := beyond.select("id").collect()):
        walks += 1
        beyond = spark.createDataFrame(entered, "id bigint").select(shuffle.permuted(cell).alias("id")).filter(cell >= rows)
    return Shuffle(rows, walks, shards, seed, rounds)


def shard_documents(
    documents: DataFrame, shards: int = SHARDS, seed: str = SEED, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `documents`: shard, slot, number, and the whole row as the struct `document`.

    Rows are numbered from 0 by `key`, then the MD5 hash of `text`, then a hash of all columns, NULL first, whatever files
    they come from; equal rows are interchangeable. The number is permuted, and the place dealt round: shard place % shards,
    slot place / shards. So the rows of shards differ by one at most, slots have no gaps, and reruns agree. NULL and empty
    texts and repeated rows are rows like any other, an empty table gives an empty one, and no column of the caller clashes.
    The rows are shuffled once. `Shuffle` computes shard and slot of a number, and the number in a slot.
    """
    hashed = [f.name for f in documents.schema if "map<" not in f.dataType.simpleString() and not isinstance(f.dataType, T.VariantType)]
    keyed = documents.select(
        F.col(key).alias("key"),
        F.md5(text).alias("of_text"),
        F.xxhash64(*[F.col(f"`{name}`") for name in hashed]).alias("of_row"),
        F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("document"),
    )
    rows = numbered(keyed, ["key", "of_text", "of_row"])
    total = rows.select("total").limit(1).collect()
    shuffle = shuffle_of(documents.sparkSession, total[0][0] if total else 0, shards, seed)
    placed = rows.select(F.col("rank").alias("number"), shuffle.place(F.col("rank")).alias("place"), "document")
    return placed.select((F.col("place") % shards).cast("int").alias("shard"), _div(F.col("place"), shards).alias("slot"), "number", "document")


def write_shards(sharded: DataFrame, path: str) -> None:
    """The documents below a folder per shard, in files that follow the slots; one shuffle of the documents."""
    ordered = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.select("shard", "slot", "document").write.partitionBy("shard").parquet(path)
