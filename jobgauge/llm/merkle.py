"""Merkle manifest of a dataset: one hash tree per source, one above their roots, and a proof for every row.

A node is labelled with the interval of leaf ranks that it covers. The nodes of `BUCKET_LEVELS` levels below one ancestor
form a bucket, one row that covers the ancestor's interval. Containment joins of buckets attach the ancestors above, from
the top down, and the siblings of a node are the nodes of its level in its parent's interval less its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgauge.llm.numbering import numbered
from jobgauge.sources.scratch import written

#: Columns that a leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node.
FAN = 3
#: Levels of a bucket above its own items, and the items it has at most.
BUCKET_LEVELS = 5
BUCKET = FAN**BUCKET_LEVELS
_STEP = "struct<left:string,right:string>"


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values, each as its UTF-8 byte count, a colon and the value, or `-` for NULL."""
    texts = [value.cast("string") for value in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings on its way up lead to."""
    return F.aggregate(proof, leaf, lambda own, step: F.sha2(F.concat(step["left"], own, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.concat_ws("", F.transform(proof, lambda step: F.concat(step["left"], step["right"]))), 256)


@dataclass(frozen=True)
class Manifest:
    """proofs: tree, rank, leaf, subroot, carried, proof. nodes: tree, level, first, end, digest. root: NULL without rows.

    In `nodes` the trees of the sources have `top` false; the one above them has `top` true and ranks of sources.
    """

    proofs: DataFrame
    nodes: DataFrame
    root: str | None


def manifest(documents: DataFrame, leaf: Column, tree: str = "source", order: str = "doc_id", carried: Column | None = None) -> Manifest:
    """The hash trees over all rows of `documents`, and for every row the siblings on its way to the root.

    The rows of a `tree` value, NULL first and a tree of its own, are its leaves by `order`, NULL first, ties by leaf digest;
    repeated rows are leaves of their own. Runs of three nodes, the last one possibly shorter, become their common hash until
    one is left; the roots of the trees, by the values' UTF-8 bytes, do likewise. A proof lists, from the leaf up, the joined
    digests to the left and to the right. `carried` is kept for each row (by default the `order` column). An empty table
    gives no rows and no root. Columns other than those named play no part, whatever their names.

    Rows are shuffled twice, by rank and by bucket; the tables above have a 243rd of the rows and less. Groups have 243 rows
    at most, so one tree may hold any share of the rows.
    """
    rows = documents.select(
        F.col(tree).alias("tree"),
        F.col(order).alias("order"),
        leaf.alias("digest"),
        F.struct((F.col(order) if carried is None else carried).alias("value")).alias("carried"),
    )
    leaves = numbered(rows, ["order", "digest"], within=["tree"])
    buckets = _buckets(leaves.select("tree", F.col("rank").alias("no"), F.col("total").alias("n"), "digest", "carried"))
    ends = [b.filter(f"n <= {BUCKET}").select("tree", _last(F.col("levels")).alias("digest")) for b in buckets]
    subroots = _united(ends)
    above = numbered(subroots.withColumn("top", F.lit(True)), ["tree"], within=["top"])
    carried_tree = F.struct(F.col("tree").alias("value")).alias("carried")
    top = _buckets(above.select(F.col("top").alias("tree"), F.col("rank").alias("no"), F.col("total").alias("n"), "digest", carried_tree))
    found = top[-1].select(_last(F.col("levels"))).collect()
    over = top[-1].select("tree", F.lit(None).cast("string").alias("subroot"), F.array().cast(f"array<{_STEP}>").alias("above"))
    to_trees = written(_proofs(top, over), "subroot-proofs")
    to_trees = to_trees.select(F.col("carried.value").alias("tree"), F.col("digest").alias("subroot"), F.col("proof").alias("above"))
    proofs = _proofs(buckets, to_trees).select(
        "tree", F.col("no").alias("rank"), F.col("digest").alias("leaf"), "subroot", F.col("carried.value").alias("carried"), "proof"
    )
    kind = documents.schema[tree].dataType.simpleString()
    nodes = _nodes(buckets).withColumn("top", F.lit(False)).unionByName(
        _nodes(top).withColumns({"tree": F.lit(None).cast(kind), "top": F.lit(True)})
    )
    return Manifest(proofs, nodes, found[0][0] if found else None)


def _buckets(items: DataFrame) -> list[DataFrame]:
    """Buckets of the items tree, no (of n), digest and carried; then of what these become, until every tree has one node.

    A bucket has bucket (its number), n, width (leaves below an item), first and end (the leaf ranks it covers, end possibly
    beyond the last), items in order, and levels: the digests of its nodes, from its items up.
    """
    most = items.agg(F.max("n")).first()[0] or 0
    found, width = [], 1
    while True:
        packed = items.groupBy("tree", "n", _div(F.col("no"), BUCKET).alias("bucket")).agg(
            F.sort_array(F.collect_list(F.struct("no", "digest", "carried"))).alias("items")
        )
        span = F.lit(width * BUCKET)
        packed = packed.select(
            "tree", "n", "bucket", (F.col("bucket") * span).alias("first"), ((F.col("bucket") + 1) * span).alias("end"),
            "items", _levels(F.transform("items", lambda item: item["digest"]), F.col("n")).alias("levels"),
        )
        found.append(written(packed, "buckets"))
        if most <= BUCKET:
            return found
        most, width = -(-most // BUCKET), width * BUCKET
        items = found[-1].filter(f"n > {BUCKET}").select(
            "tree", F.col("bucket").alias("no"), _div(F.col("n") + (BUCKET - 1), BUCKET).alias("n"),
            _last(F.col("levels")).alias("digest"), F.struct(F.lit(None).cast("string").alias("value")).alias("carried"),
        )


def _levels(digests: Column, n: Column) -> Column:
    """The digests, and those of the nodes above them: all levels of a bucket, or up to the root in a tree's only one."""
    height = sum((F.when(n > FAN**level, 1).otherwise(0) for level in range(BUCKET_LEVELS)), F.lit(0))

    def next_level(levels: Column, _: Column) -> Column:
        below = F.element_at(levels, -1)
        runs = F.sequence(F.lit(0), _div(F.size(below) - 1, FAN).cast("int"))
        hashed = F.transform(runs, lambda run: F.sha2(F.concat_ws("", F.slice(below, run * FAN + 1, FAN)), 256))
        return F.concat(levels, F.array(hashed))

    steps = F.array_repeat(F.lit(0), height)
    return F.aggregate(steps, F.array(digests), next_level)


def _last(levels: Column) -> Column:
    return F.element_at(levels, -1)[0]


def _steps(levels: Column, position: Column) -> Column:
    """The siblings of an item and of its ancestors in its bucket: per level, the parent's interval less the node's own."""
    size = F.array(*[F.lit(FAN**level) for level in range(BUCKET_LEVELS)])

    def step(level: Column, number: Column) -> Column:
        node = _div(position, F.get(size, number)).cast("int")
        parent = node - node % FAN
        return F.struct(
            F.concat_ws("", F.slice(level, parent + 1, node - parent)).alias("left"),
            F.concat_ws("", F.slice(level, node + 2, parent + FAN - 1 - node)).alias("right"),
        )

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), step)


def _proofs(buckets: list[DataFrame], over: DataFrame) -> DataFrame:
    """The items of the first buckets with their proofs; `over` has subroot and the steps above for each tree's root."""
    over = over.select(F.col("tree").alias("of"), "subroot", "above")
    parents = None
    for level in reversed(range(len(buckets))):
        own = buckets[level]
        ends = own.filter(f"n <= {BUCKET}").join(over, F.col("tree").eqNullSafe(F.col("of"))).drop("of")
        placed = ends if parents is None else ends.unionByName(_under(own.filter(f"n > {BUCKET}"), parents, BUCKET ** (level + 2)))
        parents = placed if level == 0 else written(placed, "placed-buckets")
    item = F.transform(
        "items",
        lambda item, i: F.struct(item["no"].alias("no"), item["digest"].alias("digest"), item["carried"].alias("carried"),
                                 F.concat(_steps(F.col("levels"), i), F.col("above")).alias("proof")),
    )
    return parents.select("tree", "subroot", F.explode(item).alias("item")).select("tree", "subroot", "item.*")


def _under(children: DataFrame, parents: DataFrame, span: int) -> DataFrame:
    """Buckets joined with the one, of `span` leaves, whose interval contains theirs, and so with all their ancestors."""
    outer = parents.select(
        F.col("tree").alias("p_tree"), F.col("first").alias("p_first"), F.col("end").alias("p_end"),
        F.col("levels").alias("p_levels"), F.col("bucket").alias("p_bucket"), "subroot", F.col("above").alias("p_above"),
    )
    contained = (
        F.col("tree").eqNullSafe(F.col("p_tree"))
        & (_div(F.col("first"), span) == _div(F.col("p_first"), span))
        & (F.col("p_first") <= F.col("first")) & (F.col("end") <= F.col("p_end"))
    )
    place = F.col("bucket") - F.col("p_bucket") * BUCKET
    steps = F.concat(_steps(F.col("p_levels"), place), F.col("p_above"))
    return children.join(outer, contained).select(*children.columns, "subroot", steps.alias("above"))


def _nodes(buckets: list[DataFrame]) -> DataFrame:
    """tree, level, first, end (leaf ranks covered; end possibly beyond the last) and digest of every node, once."""
    tables = []
    for base, bucket in enumerate(buckets):
        levels = F.when(F.col("n") > BUCKET, F.slice("levels", 1, BUCKET_LEVELS)).otherwise(F.col("levels"))
        by_level = bucket.select("tree", F.col("first").alias("start"), F.posexplode(levels).alias("at", "digests"))
        width = F.pow(F.lit(float(FAN)), F.col("at") + base * BUCKET_LEVELS).cast("long")
        nodes = by_level.select("tree", "start", "at", width.alias("width"), F.posexplode("digests").alias("i", "digest"))
        first = F.col("start") + F.col("i") * F.col("width")
        tables.append(nodes.select(
            "tree", (F.col("at") + base * BUCKET_LEVELS).alias("level"), first.alias("first"), (first + F.col("width")).alias("end"), "digest"
        ))
    return _united(tables)


def _united(tables: list[DataFrame]) -> DataFrame:
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


def _div(value: Column, by: int | Column) -> Column:
    return F.call_function("div", value, by if isinstance(by, Column) else F.lit(by).cast("long"))
