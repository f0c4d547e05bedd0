"""Exact join of near-duplicate texts on the Jaccard similarity of their word shingles, by parity sketches.

A parity sketch flips one bit for every shingle, so the Hamming distance of two sketches never exceeds the symmetric
difference of the two sets. Sets are joined within bands of similar size. In a band, linked sets differ in at most D
shingles; the shingles are dealt to more than D parts by their hash, so at least one part is the same in both, and the
XOR of its shingles is a join key. Candidates whose sketches are too far apart are left out, the others verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobgauge.llm.components import connected_components
from jobgauge.llm.words import NOT_SPACE, U64, mixed, run_hashes, signed, split_words, text_blocks, word_hashes
from jobgauge.sources.scratch import discard, remove, scratch_path, written

#: Words of a shingle, and the least similarity in percent.
SHINGLE_WORDS = 4
PERCENT = 85
#: Bits of a sketch for each shingle in which a set may differ from a linked one, about. The fewer flips meet in one bit, the
#: fewer sets beyond the limit seem within it: in a large group of near copies, most pairs are a little too far apart.
SKETCH_BITS = 16
#: Ratio of the sizes at the ends of a band.
BAND_RATIO = 1.35
#: Keys of one group are compared with this many chosen members first; further pairs only where that leaves parts apart.
LEADERS = 8
#: Bands are told apart by their number modulo this; a set has keys in three adjacent ones at most.
BAND_CODES = 4
#: Slices of the keys, of which one is on its way between tasks at a time.
KEY_SLICES = 4
_BATCH_KEYS = 1 << 18


def shingle_sets(column: pa.Array, shingle_words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text; a shorter text is one shingle, one without words has none."""
    for low, high, offset, data in text_blocks(column):
        words = split_words(offset, data, NOT_SPACE, fold=True)
        hashes = word_hashes(words)
        for row in range(low, high):
            own = hashes[words.first[row - low] : words.first[row - low + 1]]
            yield row, np.unique(run_hashes(own, min(shingle_words, len(own)))) if len(own) else own


def set_class(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit fingerprints of a set; the first one names it."""
    united = np.bitwise_xor.reduce(mixed(shingles), keepdims=True) + U64(len(shingles))
    return int(mixed(united)[0]), int(np.sum(mixed(~shingles), dtype=U64))


def most_different(size: int, other: int, percent: int) -> int:
    """Most shingles in which linked sets of these sizes differ.

    Linked sets have (100 + p) * common >= p * (a + b), so a + b - 2 * common <= (100 - p) / (100 + p) * (a + b).
    """
    return (100 - percent) * (size + other) // (100 + percent)


def parity_sketch(shingles: np.ndarray, percent: int) -> np.ndarray:
    """64-bit words whose bits are flipped once for each shingle; a power of two of them, by the band of sizes.

    Half of the words, each with its bits flipped by those of the other half, are the sketch of half the length.
    """
    size = len(shingles)
    bits = SKETCH_BITS * most_different(size, 100 * size // percent, percent)
    words = 1 << max(0, (bits - 1) >> 6).bit_length()
    flipped = np.bincount((shingles & U64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(flipped.astype(np.uint8), bitorder="little").view(np.int64)


def size_bands(largest: int, ratio: float = BAND_RATIO) -> list[int]:
    """First sizes of the bands up to `largest`, and the end of the last."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(edges[-1] * ratio)))
    return edges


def part_count(last_size: int, percent: int) -> tuple[int, int]:
    """Most shingles in which linked sets of at most `last_size` differ, and the number of parts to deal them to.

    The further parts make up for empty ones.
    """
    differ = most_different(last_size, last_size, percent)
    return differ, differ + 1 + (differ * 6 + 99) // 100 + min(differ, 2)


def _band_parts(shingles: np.ndarray, percent: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """Per band in which a set can be linked: band, parts, the filled ones, their first shingles, and the spare ones.

    A set and a linked one of the band differ in at most D shingles, so all but D of its filled parts are the same in both.
    Any D + 1 of their keys find the other set; the rest are spare.
    """
    size = len(shingles)
    edges = size_bands(100 * size // percent)
    for band in range(int(np.searchsorted(edges, size, "right")) - 1, len(edges) - 1):
        last = edges[band + 1] - 1
        _, parts = part_count(last, percent)
        differ = most_different(size, min(last, 100 * size // percent), percent)
        part = ((shingles >> U64(32)) * U64(parts)) >> U64(32)  # rises with the sorted hashes
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        yield band, parts, part[first], first, len(first) - differ - 1


def band_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """The join keys of a set, in its own band and in those of larger sets that it can be linked with.

    Empty parts give no key as long as more parts have shingles than the set can differ in from a linked one of the band,
    because then linked sets agree in one of these. Two sets that both have fewer still find each other by the keys of their
    empty parts. The last bits of a key tell its band, see `key_band`.
    """
    keys = []
    values = mixed(shingles)
    for band, parts, used, first, spare in _band_parts(shingles, percent):
        value = np.bitwise_xor.reduceat(values, first)
        if spare < 0:
            empty = np.setdiff1d(np.arange(parts, dtype=U64), used)
            used, value = np.concatenate((used, empty)), np.concatenate((value, np.zeros(len(empty), U64)))
        named = mixed(value ^ mixed(used + (U64(band + 1) << U64(40))))
        keys.append((named & ~U64(BAND_CODES - 1)) | U64(band % BAND_CODES))
    return np.concatenate(keys) if keys else np.empty(0, U64)


def spare_keys(shingles: np.ndarray, percent: int) -> list[int]:
    """How many keys of the set are spare, by band code; see `_band_parts`."""
    spares = [0] * BAND_CODES
    for band, _, _, _, spare in _band_parts(shingles, percent):
        spares[band % BAND_CODES] = max(0, spare)
    return spares


def key_band(key: Column) -> Column:
    return key.bitwiseAND(F.lit(BAND_CODES - 1)).cast("int")


def set_table(documents: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, row (a hash of the text), n_shingles, and of sets that are not empty two fingerprints, sketch and spare keys."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, names, more = np.zeros(len(batch), np.int64), [], []
            sketches: list[np.ndarray | None] = [None] * len(batch)
            spares: list[list[int] | None] = [None] * len(batch)
            for row, shingles in shingle_sets(batch.column(2), shingle_words):
                count[row] = len(shingles)
                first, second = set_class(shingles) if len(shingles) else (None, None)
                names.append(first)
                more.append(second)
                if len(shingles):
                    sketches[row] = parity_sketch(shingles, percent)
                    spares[row] = spare_keys(shingles, percent)
            columns = [*batch.columns[:2], pa.array(count), _signed_or_null(names), _signed_or_null(more)]
            columns += [pa.array(sketches, pa.list_(pa.int64())), pa.array(spares, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_shingles", "class", "class2", "sketch", "spares"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(
        describe, f"doc_id {kind}, row bigint, n_shingles bigint, class bigint, class2 bigint, sketch array<bigint>, spares array<int>"
    )


def _signed_or_null(values: list[int | None]) -> pa.Array:
    return pa.array([None if v is None else v - (v >> 63 << 64) for v in values], pa.int64())


def key_table(documents: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """(key, class) of every distinct set; a task emits copies once."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys: list[np.ndarray] = []
        names: list[np.ndarray] = []

        def flushed() -> pa.RecordBatch:
            arrays = [signed(np.concatenate(keys)), signed(np.concatenate(names))]
            keys.clear()
            names.clear()
            return pa.RecordBatch.from_arrays(arrays, ["key", "class"])

        for batch in batches:
            for _, shingles in shingle_sets(batch.column(0), shingle_words):
                if not len(shingles) or (name := set_class(shingles)[0]) in seen:
                    continue
                seen.add(name)
                keys.append(band_keys(shingles, percent))
                names.append(np.full(len(keys[-1]), U64(name)))
                if sum(map(len, keys[-1:])) >= _BATCH_KEYS or len(keys) >= 512:
                    yield flushed()
        if keys:
            yield flushed()

    return documents.select("text").mapInArrow(emit, "key bigint, class bigint")


def close(a: str, b: str, percent: int) -> Column:
    """Whether sizes and sketches allow two sets, columns with the prefixes `a` and `b`, to be linked.

    Sizes of linked sets are so near that one sketch has twice the words of the other at most; it is folded then.
    """
    size_a, size_b = F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles")
    own, other = F.col(f"{a}sketch"), F.col(f"{b}sketch")
    words = F.least(F.size(own), F.size(other))

    def folded(sketch: Column) -> Column:
        halves = F.zip_with(F.slice(sketch, 1, words), F.slice(sketch, words + 1, words), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(sketch) > words, halves).otherwise(sketch)

    flipped = F.zip_with(folded(own), folded(other), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    distance = F.aggregate(flipped, F.lit(0), lambda total, bits: total + bits)
    most = F.floor((size_a + size_b) * (100 - percent) / (100 + percent))
    return (100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)) & (distance <= most)


def link_documents(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of `documents`: doc_id, row (a hash of the text), n_shingles, class (equal for equal sets), root
    (the class that names the component) and component_id.

    Words are runs between ASCII white space with A to Z lower-cased; a document's set has its distinct shingles of
    `shingle_words` words, or its whole sequence where it has fewer. Documents link when
    100 * intersection >= percent * union, and component_id is the smallest doc_id reachable by links. NULL, empty and
    blank texts have an empty set, class NULL, no links, root NULL, and their own doc_id. Repeated rows stay and are linked.
    Rows with a NULL doc_id take part; a component of such rows only has a NULL component_id. Only root tells components
    apart where doc_id is NULL or repeated. Other columns are ignored.
    Shingles and sets are compared by 64-bit and 128-bit hashes.
    """
    documents = documents.select("doc_id", "text")
    described = written(set_table(documents, shingle_words, percent), "sets")
    rows = described.drop("sketch", "spares")
    filled = rows.filter("n_shingles > 0")
    groups = described.filter("n_shingles > 0").groupBy("class", "class2")
    of_set = [F.any_value(name).alias(name) for name in ("n_shingles", "sketch", "spares")]  # alike in equal sets
    classes = written(groups.agg(F.min("doc_id").alias("first_doc"), *of_set), "classes")
    members = _without_spares(_members(key_table(documents, shingle_words, percent)), classes)

    def links_of(pairs: DataFrame) -> DataFrame:
        pairs = written(pairs, "pairs")
        sets = _pair_sets(documents, pairs, classes, shingle_words)
        links = written(_verified(pairs, sets, percent), "links")
        discard(pairs, sets)
        return links

    first = links_of(_close_pairs(_leader_pairs(members), classes, percent))
    found = connected_components(first, "a", "b")
    rest = links_of(_remaining_pairs(members, found, classes, percent))
    roots = connected_components(first.unionByName(rest), "a", "b")
    named = classes.join(roots, classes["class"] == roots["node"], "left").withColumn("root", F.coalesce("root", "class"))
    named = written(named.select("class", "class2", "root", "first_doc"), "named-classes")
    discard(members, first, found, rest, roots, classes)
    components = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    known = named.join(components, "root").select("class", "class2", "root", "component_id")
    return (
        filled.join(known, ["class", "class2"])
        .select("doc_id", "row", "n_shingles", "class", "root", "component_id")
        .unionByName(
            rows.filter("n_shingles = 0").select(
                "doc_id", "row", "n_shingles", "class", F.col("class").alias("root"), F.col("doc_id").alias("component_id")
            )
        )
    )


def keep_first(documents: DataFrame, linked: DataFrame) -> DataFrame:
    """`documents` with one row of each component of `linked`, the result of `link_documents` for them.

    The row with the smallest doc_id stays, then the one with the smallest text hash; of rows equal in both, the one with
    the smallest hash of all columns. Unlinked texts both stay, whatever their doc_id. Texts without words all stay.
    """
    rows = linked.filter("class IS NOT NULL").groupBy("root", "doc_id", "row").agg(F.count("*").alias("n"))
    rows = written(rows, "linked-rows")
    identity = F.struct("doc_id", "row")
    groups = rows.groupBy(F.col("root").alias("of")).agg(F.min(identity).alias("first"), F.sum("n").alias("total"))
    # Rows that are alone in their component need no decision.
    decided = rows.join(groups.filter("total > 1"), F.col("root") == F.col("of")).select(
        F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), (identity == F.col("first")).alias("_stays"), F.col("n").alias("_n")
    )
    decided = written(decided, "decisions")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_row"))
    # The list grows with the documents and is never broadcast, so that the plan is alike at every size.
    joined = documents.join(decided.hint("shuffle_merge"), same, "left").filter("_stays OR _stays IS NULL")
    single = joined.filter("_n IS NULL OR _n = 1").select(*documents.columns)
    order = Window.partitionBy("doc_id", "_row").orderBy(F.xxhash64(*documents.columns))
    repeated = joined.filter("_n > 1").withColumn("_rank", F.row_number().over(order)).filter("_rank = 1")
    return single.unionByName(repeated.select(*documents.columns))


def _members(keys: DataFrame) -> DataFrame:
    """The rows of `keys`, key and class, whose group has another set."""
    # A semi-join instead of a window or a list: a group with very many sets is split. Read from a table, the keys are made
    # once; they take more room than the texts, so they are shuffled one slice after the other, once for both sides.
    spark, path = keys.sparkSession, scratch_path(keys.sparkSession, "keys")
    keys.write.parquet(path)
    keys = spark.read.schema(keys.schema).parquet(path)
    other = (F.col("a_key") == F.col("b_key")) & (F.col("a_class") != F.col("b_class"))
    found = []
    for number in range(KEY_SLICES):
        own = keys.filter(F.pmod(F.xxhash64("key"), F.lit(KEY_SLICES)) == number)
        left, right = _prefixed(own, "a_"), _prefixed(own, "b_")
        found.append(written(_unprefixed(left.join(right, other, "left_semi"), "a_").distinct(), "members-slice"))
    remove(spark, path)
    shared = written(reduce(DataFrame.unionByName, found), "members")
    discard(*found)
    return shared


def _without_spares(members: DataFrame, classes: DataFrame) -> DataFrame:
    """`members` without the spare keys of each set, its most frequent ones.

    Linked sets share all but D of their keys. In one order of all keys, here by frequency, the keys that remain of both
    have one in common, so passages that many documents share, in a smaller part of their texts, bring nobody together.
    """
    counts = members.groupBy(F.col("key").alias("of")).agg(F.count("*").alias("n"))
    counted = members.join(counts, F.col("key") == F.col("of")).drop("of")
    spares = classes.select(F.col("class").alias("c"), "spares")
    described = counted.join(spares, F.col("class") == F.col("c")).withColumn("band", key_band(F.col("key")))
    order = Window.partitionBy("class", "band").orderBy(F.desc("n"), "key")
    ranked = described.withColumn("place", F.row_number().over(order))
    kept = written(ranked.filter(F.col("place") > F.get("spares", F.col("band"))).select("key", "class"), "kept-members")
    discard(members)
    return kept


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def _unprefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c.removeprefix(prefix)) for c in df.columns])


def _pair_sets(documents: DataFrame, pairs: DataFrame, classes: DataFrame, shingle_words: int) -> DataFrame:
    """class and shingles of the sets of `pairs`, computed anew from one document of each."""
    either = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
    wanted = either.distinct().join(classes.select("class", "first_doc"), "class")
    needed = wanted.select("first_doc").hint("shuffle_merge")
    texts = documents.join(needed, documents["doc_id"].eqNullSafe(needed["first_doc"]), "left_semi")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[np.ndarray] = []
            for _, shingles in shingle_sets(batch.column(0), shingle_words):
                if len(shingles):
                    found.append(shingles)
                if sum(map(len, found[-1:])) >= _BATCH_KEYS or len(found) >= 256:
                    yield _set_batch(found)
                    found = []
            if found:
                yield _set_batch(found)

    sets = texts.select("text").mapInArrow(emit, "class bigint, shingles array<bigint>")
    return written(sets, "member-sets")


def _set_batch(found: list[np.ndarray]) -> pa.RecordBatch:
    names = np.array([set_class(shingles)[0] for shingles in found], U64)
    offsets = np.concatenate(([0], np.cumsum([len(shingles) for shingles in found]))).astype(np.int32)
    values = pa.ListArray.from_arrays(pa.array(offsets), signed(np.concatenate(found)))
    return pa.RecordBatch.from_arrays([signed(names), values], ["class", "shingles"])


def _leader_pairs(members: DataFrame) -> DataFrame:
    """Every member of a key's group with the member chosen for it, one of a few choices so that chains soon close."""
    choice = F.pmod(F.xxhash64("key"), F.lit(LEADERS))
    order = F.struct(F.xxhash64("class", choice).alias("order"), F.col("class").alias("leader"))
    leaders = members.groupBy("key").agg(F.min(order)["leader"].alias("b_class"))
    pairs = members.withColumnRenamed("class", "a_class").join(leaders, "key")
    return _distinct_pairs(pairs.filter(F.col("a_class") != F.col("b_class")))


def _remaining_pairs(members: DataFrame, components: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Close pairs within a key's group that the links found so far leave in different components.

    Sizes and sketches are compared inside the join, so that pairs that are not close are never written.
    """
    placed = members.join(components.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.withColumn("root", F.coalesce("root", "class"))
    split = placed.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most")
    described = classes.select("class", "n_shingles", "sketch")
    open_groups = written(placed.join(split.select("key"), "key", "left_semi").join(described, "class"), "open-groups")
    left, right = _prefixed(open_groups, "a_"), _prefixed(open_groups, "b_")
    apart = (F.col("a_class") < F.col("b_class")) & (F.col("a_root") != F.col("b_root"))
    return _distinct_pairs(left.join(right, (F.col("a_key") == F.col("b_key")) & apart & close("a_", "b_", percent)))


def _close_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b of classes whose sizes and sketches allow a link."""
    side = classes.select("class", "n_shingles", "sketch")
    with_a = pairs.join(_prefixed(side, "a_"), F.col("a") == F.col("a_class"))
    both = with_a.join(_prefixed(side, "b_"), F.col("b") == F.col("b_class"))
    return both.filter(close("a_", "b_", percent)).select("a", "b")


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.least("a_class", "b_class").alias("a"), F.greatest("a_class", "b_class").alias("b")
    ).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough, by their exact intersection."""
    with_a = pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a")), "a")
    both = with_a.join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b")), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    similar = common * (100 + percent) >= (F.size("set_a") + F.size("set_b")) * percent
    return both.filter(similar).select("a", "b").distinct()
