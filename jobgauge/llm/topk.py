"""Exact top-k search by inner product over KD-trees, one per shard of the vectors."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobgauge.sources.scratch import discard, written

#: Vectors of a shard, queries searched together, and vectors of a leaf, about.
SHARD_VECTORS = 8192
BLOCK_QUERIES = 16384
LEAF_VECTORS = 128
#: Cells that neighbouring vectors are dealt to, at most, and components of the sample of vectors that draws them.
MOST_CELLS = 1024
SAMPLE_COMPONENTS = 1 << 20
#: Queries whose bounds are computed at once.
BOUND_QUERIES = 1024

SHARD = ["width", "cell", "salt"]


def quantized(vector: Column, scale: int) -> Column:
    """floor(scale * x) for each component as double; NULL where a component is NULL or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound & (F.size(vector) > 0), F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


@dataclass
class KdTree:
    """Nodes with the tight bounding box of their vectors; node i has children 2i + 1 and 2i + 2, leaves have rows."""

    low: np.ndarray
    high: np.ndarray
    leaves: dict[int, np.ndarray]


def build_tree(vectors: np.ndarray, leaf_vectors: int = LEAF_VECTORS) -> KdTree:
    """Split at the median of the widest side of the box until a node has at most `leaf_vectors`, or one point only."""
    low, high, leaves = {}, {}, {}
    open_nodes = [(0, np.arange(len(vectors)))]
    while open_nodes:
        node, rows = open_nodes.pop()
        part = vectors[rows]
        low[node], high[node] = part.min(axis=0), part.max(axis=0)
        side = int(np.argmax(high[node] - low[node]))
        if len(rows) <= leaf_vectors or high[node][side] == low[node][side]:
            leaves[node] = rows
            continue
        order = rows[np.argsort(part[:, side], kind="stable")]
        open_nodes += [(2 * node + 1, order[: len(order) // 2]), (2 * node + 2, order[len(order) // 2 :])]
    size, width = max(low) + 1, vectors.shape[1]
    lows, highs = np.zeros((size, width)), np.zeros((size, width))
    for node in low:
        lows[node], highs[node] = low[node], high[node]
    return KdTree(lows, highs, leaves)


def search_tree(
    tree: KdTree,
    vectors: np.ndarray,
    ids: np.ndarray,
    rows: np.ndarray,
    query: np.ndarray,
    own: int,
    k: int,
    bounds: np.ndarray,
    least: float,
) -> list[tuple[float, int]]:
    """The k best (score, id) with a score of at least `least`, best first, without the row `own`.

    Nodes are taken by the largest inner product their box allows (`bounds`); the search ends when that is below the
    kth score. An equal bound still counts, because of ties to smaller ids.
    """
    best: list[tuple[float, int]] = []  # a heap of (score, -id)
    nodes = [(-bounds[0], 0)]
    while nodes:
        bound, node = heapq.heappop(nodes)
        worst = best[0][0] if len(best) == k else least
        if -bound < worst:
            break
        leaf = tree.leaves.get(node)
        if leaf is None:
            for child in (2 * node + 1, 2 * node + 2):
                heapq.heappush(nodes, (-bounds[child], child))
            continue
        scores = vectors[leaf] @ query
        good = np.flatnonzero((scores >= worst) & (rows[leaf] != own))
        if len(good) > k:
            good = good[np.lexsort((ids[leaf[good]], -scores[good]))[:k]]
        for at in good:
            entry = (float(scores[at]), -int(ids[leaf[at]]))
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return [(score, -negative) for score, negative in sorted(best, reverse=True)]


def box_bounds(low: np.ndarray, high: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """For each query and box, the largest inner product with a point of the box."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


@dataclass
class Cells:
    """Splits of a KD-tree over a sample: node i sends a vector to 2i + 1 or 2i + 2, and a node without split is a cell."""

    width: int
    splits: dict[int, tuple[int, float]]

    @staticmethod
    def of(sample: np.ndarray, cells: int) -> Cells:
        splits, open_nodes = {}, [(0, sample)] if len(sample) else []
        while open_nodes:
            node, part = open_nodes.pop()
            side = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            at = float(np.median(part[:, side]))
            below = part[:, side] < at
            if 2 * node + 2 >= 2 * cells - 1 or not below.any():
                continue
            splits[node] = (side, at)
            open_nodes += [(2 * node + 1, part[below]), (2 * node + 2, part[~below])]
        return Cells(sample.shape[1] if len(sample) else 0, splits)

    def find(self, vectors: np.ndarray) -> np.ndarray:
        cell, open_nodes = np.zeros(len(vectors), np.int32), [(0, np.arange(len(vectors)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            cell[rows] = node
            if node in self.splits and len(rows):
                side, at = self.splits[node]
                below = vectors[rows, side] < at
                open_nodes += [(2 * node + 1, rows[below]), (2 * node + 2, rows[~below])]
        return cell


def top_k(
    vectors: DataFrame, queries: Column, k: int, scale: int = 64, shard_vectors: int = SHARD_VECTORS
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates for each row of `vectors` for which `queries` holds.

    `vectors` has vec_id and embedding; other columns are ignored. Components become floor(scale * x), and the score is
    their inner product, which doubles hold exactly. Every row but the query's own is a candidate; ties go to the smaller
    vec_id. Vectors that are NULL, empty or have NULL or non-finite components, and rows with a NULL vec_id, take no part.
    Repeated rows are rows like all others: each is a candidate for the others, and each asks on its own. Vectors of another
    length than a query's are no candidates for it. An empty table gives an empty result.

    Vectors of the most common length are dealt to at most `MOST_CELLS` cells of neighbours, whose borders come from a
    sample of `SAMPLE_COMPONENTS` components; a cell has as many shards as its size needs, and each shard's tree is built
    once and stored. A query first searches a shard of the cell whose box promises most. This gives a kth score, and then it
    goes only to shards of cells whose box allows as much, each of which returns only what is at least as good.
    """
    sound = vectors.select("vec_id", quantized(F.col("embedding"), scale).alias("q"))
    sound = sound.filter("vec_id IS NOT NULL AND q IS NOT NULL")
    numbered = written(
        sound.select(F.monotonically_increasing_id().alias("row"), "vec_id", "q", F.size("q").alias("width"), queries.alias("asks")),
        "vectors",
    )
    cells = _draw_cells(numbered, shard_vectors)
    dealt = written(numbered.withColumn("cell", _cell(cells)("q", "width")), "dealt-vectors")
    sizes = dealt.groupBy("width", "cell").agg(F.ceil(F.count("*") / shard_vectors).alias("shards"))
    sizes = written(sizes, "cell-sizes")
    salt = F.pmod(F.xxhash64("row"), F.col("shards"))
    trees = dealt.join(sizes, ["width", "cell"]).select(*SHARD[:2], salt.alias("salt"), "row", "vec_id", "q")
    trees = written(trees.groupBy(*SHARD).applyInPandas(_stored_tree, TREE), "trees")
    boxes = _cell_boxes(trees, cells.width)
    asked = dealt.filter("asks").select("row", "vec_id", "q", "width")

    home = asked.withColumn("cell", F.element_at(_cells_worth(boxes, True)("q", "width", F.lit(None).cast("double")), 1))
    home = home.join(sizes, ["width", "cell"])
    home = home.withColumn("salt", F.pmod(F.xxhash64(F.lit(1), "row"), F.col("shards"))).drop("shards")
    home = written(home.withColumn("least", F.lit(None).cast("double")), "home-shards")
    first = written(_searched(trees, home, k), "home-results")
    kth = first.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("kth"))
    known = home.join(kth, "row", "left").withColumnsRenamed({"cell": "home_cell", "salt": "home_salt"})
    worth = F.explode(_cells_worth(boxes, False)("q", "width", "kth"))
    routed = known.withColumn("cell", worth).join(sizes, ["width", "cell"])
    routed = routed.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    routed = routed.filter("cell <> home_cell OR salt <> home_salt")
    routed = routed.select("row", "vec_id", "q", *SHARD, F.col("kth").alias("least"))
    rest = written(_searched(trees, routed, k), "other-results")
    discard(numbered, dealt, trees, home)
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _draw_cells(numbered: DataFrame, shard_vectors: int) -> Cells:
    """Cells of neighbours among the vectors of the most common length, from a sample of bounded size."""
    common = numbered.groupBy("width").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    if common is None:
        return Cells(0, {})
    wanted = max(1, SAMPLE_COMPONENTS // common.width)
    share = min(1.0, 2 * wanted / common.n)
    sample = numbered.filter(F.col("width") == common.width).sample(share, seed=9).select("q").limit(wanted).toPandas()
    cells = min(MOST_CELLS, -(-common.n // shard_vectors), max(1, len(sample)))
    return Cells.of(np.stack(sample["q"].to_list()).astype(np.float64) if len(sample) else np.zeros((0, 0)), cells)


def _cell(cells: Cells):
    """The cell of a vector; 0 for vectors of other lengths than the cells'."""

    @F.pandas_udf("int")
    def cell(q: pd.Series, width: pd.Series) -> pd.Series:
        found = np.zeros(len(q), np.int32)
        own = np.flatnonzero(width.to_numpy() == cells.width)
        if len(own):
            found[own] = cells.find(np.stack(q.iloc[own].to_list()).astype(np.float64))
        return pd.Series(found)

    return cell


#: A shard's tree: rows and ids in the order of the leaves, the vectors' and the boxes' components one after the other as
#: doubles, and the node of each leaf with its end in that order.
TREE = (
    "width int, cell int, salt bigint, tree_rows array<bigint>, ids array<bigint>, vectors binary, low binary, high binary, "
    "leaf_nodes array<int>, leaf_ends array<int>"
)


def _stored_tree(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack(shard["q"].to_list()).astype(np.float64)
    tree = build_tree(vectors)
    order = np.concatenate(list(tree.leaves.values()))
    return pd.DataFrame(
        {
            **{name: [value] for name, value in zip(SHARD, key)},
            "tree_rows": [shard["row"].to_numpy()[order]],
            "ids": [shard["vec_id"].to_numpy()[order]],
            "vectors": [vectors[order].tobytes()],
            "low": [tree.low.tobytes()],
            "high": [tree.high.tobytes()],
            "leaf_nodes": [list(tree.leaves)],
            "leaf_ends": [np.cumsum([len(leaf) for leaf in tree.leaves.values()]).tolist()],
        }
    )


def _doubles(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(-1, width)


def _cell_boxes(trees: DataFrame, width: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The tight box of each cell, at most `MOST_CELLS`, from the roots of its trees."""

    def roots(batches):
        for batch in batches:
            for _, tree in batch.iterrows():
                low, high = _doubles(tree["low"], width)[0], _doubles(tree["high"], width)[0]
                yield pd.DataFrame({"cell": tree["cell"], "side": np.arange(width), "low": low, "high": high})

    found = trees.filter(F.col("width") == width).select("cell", F.substring("low", 1, 8 * width).alias("low"),
                                                         F.substring("high", 1, 8 * width).alias("high"))
    found = found.mapInPandas(roots, "cell int, side int, low double, high double")
    sides = found.groupBy("cell", "side").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas()
    sides = sides.sort_values(["cell", "side"])
    return {int(c): (s["low"].to_numpy(), s["high"].to_numpy()) for c, s in sides.groupby("cell")}


def _cells_worth(boxes: dict[int, tuple[np.ndarray, np.ndarray]], best_only: bool):
    """The cells whose box allows a score of at least `least`, or the one that allows most; 0 for other lengths."""
    cells = np.array(list(boxes), np.int32)
    low, high = (np.stack([box[side] for box in boxes.values()]) if boxes else np.zeros((0, 0)) for side in (0, 1))

    @F.pandas_udf("array<int>")
    def worth(q: pd.Series, width: pd.Series, least: pd.Series) -> pd.Series:
        result: list = [[0]] * len(q)
        own = np.flatnonzero(width.to_numpy() == low.shape[1]) if len(cells) else []
        bar = least.astype(float).fillna(-np.inf).to_numpy()
        for at in range(0, len(own), BOUND_QUERIES):
            part = own[at : at + BOUND_QUERIES]
            bounds = box_bounds(low, high, np.stack(q.iloc[part].to_list()).astype(np.float64))
            for row, bound in zip(part, bounds):
                result[row] = cells[[bound.argmax()] if best_only else bound >= bar[row]].tolist()
        return pd.Series(result)

    return worth


def _searched(trees: DataFrame, routed: DataFrame, k: int) -> DataFrame:
    """Search each tree with the queries sent to its shard, in blocks: a tree is copied once per block that needs it."""
    load = routed.groupBy(*SHARD).agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("blocks"))
    asked = routed.join(load, SHARD).withColumn("block", F.pmod(F.xxhash64(F.lit(2), "row"), F.col("blocks"))).drop("blocks")
    needed = trees.join(load, SHARD)
    needed = needed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        result: list[tuple] = []
        width = int(key[0])
        if len(left) and len(right):
            stored = left.iloc[0]
            ends = [0, *stored["leaf_ends"]]
            leaves = {int(node): np.arange(a, b) for node, a, b in zip(stored["leaf_nodes"], ends, ends[1:])}
            tree = KdTree(_doubles(stored["low"], width), _doubles(stored["high"], width), leaves)
            ids, rows, vectors = np.asarray(stored["ids"]), np.asarray(stored["tree_rows"]), _doubles(stored["vectors"], width)
            for at in range(0, len(right), BOUND_QUERIES):
                part = right.iloc[at : at + BOUND_QUERIES]
                queries = np.stack(part["q"].to_list()).astype(np.float64)
                bounds = box_bounds(tree.low, tree.high, queries)
                least = part["least"].astype(float).fillna(-np.inf).to_numpy()
                for i, (own, query_id) in enumerate(zip(part["row"], part["vec_id"])):
                    found = search_tree(tree, vectors, ids, rows, queries[i], own, k, bounds[i], least[i])
                    result += [(own, query_id, vec_id, int(score)) for score, vec_id in found]
        return pd.DataFrame(result, columns=["row", "query_id", "vec_id", "score"])

    return (
        needed.groupBy(*SHARD, "block")
        .cogroup(asked.groupBy(*SHARD, "block"))
        .applyInPandas(search, "row bigint, query_id bigint, vec_id bigint, score bigint")
    )
