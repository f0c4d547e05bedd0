"""Removal of boilerplate lines that spread over many sites. Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgauge.sources.scratch import written

#: Distinct sources from which on a line counts as boilerplate.
MIN_SITES = 10
#: Size of the sketches (log2 of the registers), and the relative error allowed for: six standard errors of 2^-12 registers.
SKETCH_SIZE = 12
SKETCH_ERROR = 6 * 1.04 / 2 ** (SKETCH_SIZE / 2)


def line_key(line: Column) -> Column:
    """Two independent 64-bit hashes of a line without the blanks around it; NULL for a blank line."""
    text = F.trim(F.regexp_replace(line, r"[\t\r]", " "))
    return F.when(text != "", F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b")))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The rows of `lines` (key, source, doc_id and others) with boilerplate, and first_doc, the smallest doc_id with it.

    Sketches of the sources merge by aggregation, one row per line hash and map task. Lines whose estimate is clearly
    below the threshold are left there, clearly higher ones are taken, and those in between are counted exactly. A NULL
    source counts as one site.
    """
    site = F.coalesce("source", F.lit("\x00"))
    sketched = lines.groupBy("key").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(site, SKETCH_SIZE)).alias("sites"),
        F.min("doc_id").alias("first_doc"),
    )
    low, high = min_sites * (1 - SKETCH_ERROR) - 1, min_sites * (1 + SKETCH_ERROR) + 1
    sketched = written(sketched.filter(F.col("sites") >= low), "line-sketches")
    found = written(lines.join(sketched, "key"), "line-candidates")
    near = found.filter(F.col("sites") <= high).select("key", site.alias("site")).distinct()
    exact = near.groupBy("key").agg(F.count("*").alias("exact")).filter(F.col("exact") < min_sites)
    return found.join(exact, "key", "left_anti").drop("sites")


def dedup_lines(documents: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """`documents` with its text rebuilt, and two more columns: _n_lines, and _removed, the sorted positions removed.

    A line found on `min_sites` or more distinct sources is removed from every document but the one with the smallest
    doc_id, so that its wording stays in the corpus once; repeats inside that document stay. Lines are compared without
    the blanks around them; blank lines are never removed. A document that consists of such lines only becomes empty.
    NULL texts stay NULL; repeated rows, also of one doc_id, stay and are treated alike; NULL doc_ids come last. Reads
    doc_id, source and text; other columns pass through, but for ones named _n_lines, _removed, _lines or _hit.
    """
    documents = documents.drop("_n_lines", "_removed", "_lines", "_hit")
    own = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text"))
    lines = documents.filter(F.col("text").isNotNull()).select(
        own.alias("row"), "source", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("at", "line")
    )
    keyed = lines.select("row", "at", "doc_id", "source", line_key(F.col("line")).alias("key")).filter("key IS NOT NULL")
    hits = (
        spread_lines(keyed, min_sites)
        .filter(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("at")).alias("removed"))
        .select(F.struct("row", "removed").alias("_hit"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_hit.row.doc_id")) & (F.xxhash64("text") == F.col("_hit.row.text"))
    # The hits grow with the documents, so they are never broadcast: the plan is the same at every size.
    marked = documents.join(hits.hint("shuffle_merge"), same, "left").withColumn("_lines", F.split("text", "\n", -1))
    # array_except works by hashing, so that a long document with many removed lines stays linear.
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_hit.removed"))
    rebuilt = F.concat_ws("\n", F.transform(kept, lambda i: F.get("_lines", i)))
    text = F.when(F.col("_hit").isNull(), F.col("text")).otherwise(rebuilt)
    return marked.select(
        *[text.alias(c) if c == "text" else F.col(c) for c in documents.columns],
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("_n_lines"),
        F.coalesce("_hit.removed", F.expr("CAST(array() AS array<int>)")).alias("_removed"),
    )
