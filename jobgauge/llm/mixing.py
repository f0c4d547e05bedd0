"""Mix sources to target weights by a low-discrepancy schedule. Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobgauge.sources.scratch import written

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Most times a source, and so a document, may be taken.
MOST_PASSES = 3
#: Words of a block, and the share of the smallest target that a block may have at most.
BLOCK_WORDS = 4096
BLOCK_SHARE = 64
#: Slots of the schedule that are ranked together.
CHUNK_SLOTS = 1 << 16
#: Documents of a source that are laid out together, about.
CHUNK_DOCUMENTS = 1 << 14
_GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_passes: int = MOST_PASSES
) -> DataFrame:
    """One row per source: source, source_size, weight and target.

    `sizes` has source and source_size, one row per source. Sources by name, NULL last, have the weights in turn. The
    targets share the sum of all sizes by weight; a target stops at `most_passes` times its source's size and the excess
    is shared by weight among the others, until none is above. Each sharing is one aggregate of this small table.
    """
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(ordered) - 1) % len(weights) + 1))
    sources = written(sizes.withColumn("weight", weight), "mix-sources")
    limit = F.col("source_size") * most_passes
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    share = None
    while True:
        above = F.lit(False) if share is None else F.col("weight") * share > limit
        capped, free = sources.agg(F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))).first()
        next_share = (total - (capped or 0)) / free if free else share
        if next_share == share or next_share is None:
            break
        share = next_share
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(share or 0.0), limit.cast("double")))


def mix(
    documents: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most_passes: int = MOST_PASSES,
    seed: str = "mix",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The plan: every document with size, source_size, target and taken, the sum of its words in `mix_rows`.

    Reads doc_id, text and source and keeps them out of the result but for doc_id and source.
    """
    laid, slots, block = _planned(documents, weights, most_passes, seed, block_words)
    return _taken(laid, _mixed(laid, slots, block, most_passes))


def mix_rows(
    documents: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most_passes: int = MOST_PASSES,
    seed: str = "mix",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The mix, one row per slot, document and word range: slot, at, source, doc_id, row, pass, first and end.

    Ordered by slot, then at, the word of the slot's block where the range begins, the words first to end (exclusive) of
    the documents are the corpus. row is a hash of the text, which tells documents with one doc_id apart; pass counts how
    often the source has been gone through before. Slots may leave out numbers. The documents of a source
    are laid on a line in the order of a keyed hash and cut into blocks of equal size. Slot t of the schedule goes to the
    source into whose part of the cumulative weights the fractional part of t times the golden ratio falls, and the r-th
    slot of a source takes its r-th block, round and round; a last block may be shorter. A NULL text has size 0 and is never taken; documents with
    equal doc_id and size are neighbours on the line; NULL is a source of its own. Reruns give the same rows. A source
    ends at its target, rounded down to a word, so that no document is taken more than `most_passes` times.
    """
    laid, slots, block = _planned(documents, weights, most_passes, seed, block_words)
    return _mixed(laid, slots, block, most_passes).drop("size", "source_size", "target", "begin")


def _planned(
    documents: DataFrame, weights: tuple[float, ...], most_passes: int, seed: str, block_words: int
) -> tuple[DataFrame, DataFrame, int]:
    """The documents on their sources' lines, the schedule, and the words of a block."""
    row = F.xxhash64("text").alias("row")
    sized = documents.select("doc_id", "source", row, word_count(F.col("text")).alias("size"))
    sized = written(sized.withColumn("draw", F.md5(F.concat_ws("\n", F.lit(seed), F.col("doc_id")))), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = source_targets(sizes, weights, most_passes).withColumn("needed", F.floor("target"))
    smallest, total = targets.agg(F.min(F.when(F.col("needed") > 0, F.col("target"))), F.sum("target")).first()
    block = max(1, min(block_words, int((smallest or 1) // BLOCK_SHARE)))
    return _laid_out(sized, targets), schedule(targets, total or 0.0, block), block


def _laid_out(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """The documents with the place where each begins on its source's line, from prefix sums over chunks of the order."""
    chunks = F.greatest(F.lit(1), F.ceil(F.col("n") / CHUNK_DOCUMENTS)).cast("long")
    head = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    chunked = (
        sized.join(targets, sized["source"].eqNullSafe(targets["source"]))
        .drop(targets["source"])
        .withColumn("chunk", F.shiftright(head * chunks, 32))
    )
    inside = Window.partitionBy("source", "chunk").orderBy("draw", "doc_id", "size", "row")
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = chunked.groupBy(F.col("source").alias("chunk_source"), F.col("chunk").alias("chunk_number")).agg(
        F.sum("size").alias("words")
    )
    offsets = counts.withColumnsRenamed({"chunk_source": "source", "chunk_number": "chunk"}).withColumn(
        "offset", F.coalesce(F.sum("words").over(before), F.lit(0))
    )
    offsets = offsets.withColumnsRenamed({"source": "chunk_source", "chunk": "chunk_number"}).drop("words")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        chunked.withColumn("upto", F.sum("size").over(upto))
        .join(offsets, F.col("source").eqNullSafe(F.col("chunk_source")) & (F.col("chunk") == F.col("chunk_number")))
        .withColumn("begin", F.col("offset") + F.col("upto") - F.col("size"))
        .select("doc_id", "source", "row", "size", "source_size", "target", "needed", "begin")
    )


def schedule(targets: DataFrame, total: float, block: int) -> DataFrame:
    """One row per slot: source, rank (the number of earlier slots of the source) and slot, its place in the mix.

    A slot takes one block of `block` words. The slots that a source still lacks after the last point follow it, the
    sources by turns. Ranks are counted inside chunks of the schedule and shifted by the counts of earlier chunks.
    """
    names = Window.orderBy(F.col("source").isNull(), "source")
    ends = targets.select("source", "needed", F.sum("target").over(names.rowsBetween(Window.unboundedPreceding, 0)).alias("end"))
    parts = ends.select(
        "source",
        (F.row_number().over(names) - 1).alias("number"),
        F.ceil(F.col("needed") / block).alias("wanted"),
        (F.coalesce(F.lag("end").over(names), F.lit(0.0)) / (total or 1.0)).alias("low"),
        (F.col("end") / (total or 1.0)).alias("high"),
    )
    parts = written(parts, "mix-parts")
    # A grid turns the search for the part that holds a point into a join on the cell; a cell holds few parts.
    n_sources, n_points = parts.count(), int(total // block) + 1
    cells = 4 * max(n_sources, 256)
    gridded = parts.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") * cells), F.floor(F.col("high") * cells)))
    )
    points = parts.sparkSession.range(n_points).select(
        F.col("id").alias("slot"), ((F.col("id") + 1) * F.lit(_GOLDEN) % 1).alias("point")
    )
    points = points.withColumn("cell", F.floor(F.col("point") * cells))
    chunk = F.floor(F.col("slot") / CHUNK_SLOTS).alias("chunk")
    placed = (
        points.join(gridded, "cell")
        .filter((F.col("low") <= F.col("point")) & (F.col("point") < F.col("high")))
        .select("source", "wanted", "slot", chunk)
    )
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("source", "chunk").agg(F.count("*").alias("slots"))
    counts = written(counts.withColumn("offset", F.coalesce(F.sum("slots").over(earlier), F.lit(0))), "mix-chunks")
    inside = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1
    offsets = counts.select(F.col("source").alias("of"), F.col("chunk").alias("at"), "offset")
    ranked = (
        placed.withColumn("inside", inside)
        .join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("at")))
        .withColumn("rank", F.col("offset") + F.col("inside"))
        .filter(F.col("rank") < F.col("wanted"))
        .select("source", "rank", "slot")
    )
    reached = counts.groupBy(F.col("source").alias("of")).agg(F.sum("slots").alias("slots"))
    lacking = (
        parts.join(reached, F.col("source").eqNullSafe(F.col("of")), "left")
        .withColumn("slots", F.coalesce("slots", F.lit(0)))
        .filter(F.col("slots") < F.col("wanted"))
        .withColumn("rank", F.explode(F.sequence(F.col("slots"), F.col("wanted") - 1)))
        .select("source", "rank", (n_points + (F.col("rank") - F.col("slots")) * n_sources + F.col("number")).alias("slot"))
    )
    return ranked.unionByName(lacking)


def _mixed(laid: DataFrame, slots: DataFrame, block: int, most_passes: int) -> DataFrame:
    """Join the blocks that each document reaches into, in each pass over its source's line, with their slots."""
    passes = laid.filter("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most_passes - 1))))
    low = F.col("pass") * F.col("source_size") + F.col("begin")
    reached = (
        passes.withColumn("low", low)
        .withColumn("high", F.least(F.col("low") + F.col("size"), F.col("needed")))
        .filter("low < high")
        .withColumn(
            "rank", F.explode(F.sequence(F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block)))
        )
    )
    slots = slots.select(F.col("source").alias("slot_source"), F.col("rank").alias("slot_rank"), "slot")
    first = F.greatest("low", F.col("rank") * block)
    return reached.join(
        slots, F.col("source").eqNullSafe(F.col("slot_source")) & (F.col("rank") == F.col("slot_rank"))
    ).select(
        "slot",
        (first - F.col("rank") * block).alias("at"),
        "source",
        "doc_id",
        "row",
        "pass",
        (first - F.col("low")).alias("first"),
        (F.least("high", (F.col("rank") + 1) * block) - F.col("low")).alias("end"),
        *["size", "source_size", "target", "begin"],
    )


def _taken(laid: DataFrame, mixed: DataFrame) -> DataFrame:
    """Every document with the words that the rows of the mix take of it."""
    columns = ["doc_id", "source", "size", "source_size", "target", "begin"]
    joined = mixed.select(*columns, (F.col("end") - F.col("first")).alias("words"))
    # One row of 0 words keeps the documents that no slot reaches; (source, begin) is one document of size above 0.
    none = laid.filter("size > 0").select(*columns, F.lit(0).cast("long").alias("words"))
    taken = joined.unionByName(none).groupBy(*columns).agg(F.sum("words").alias("taken"))
    empty = laid.filter("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"))
    return taken.unionByName(empty).drop("begin")
