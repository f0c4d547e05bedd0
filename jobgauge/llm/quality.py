"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgauge.llm.words import NOT_SPACE, U64, Words, mixed, run_hashes, split_words, text_blocks, word_hashes
from jobgauge.sources.scratch import written


@dataclass(frozen=True)
class QualityParams:
    """`max_rows` bounds the labelled rows that are learnt from, and `max_features` the features of all of them together,
    and so what reaches the driver."""

    bits: int = 18
    max_rows: int = 4000
    max_features: int = 16_000_000
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02


DEFAULTS = QualityParams()

# Kinds of bytes for the shape of a word: lower case, upper case, digit, beyond ASCII, and every mark by itself.
_KIND = np.arange(256, dtype=np.uint8)
_KIND[0x61:0x7B] = 1
_KIND[0x41:0x5B] = 2
_KIND[0x30:0x3A] = 3
_KIND[0x80:] = 1


def text_features(column: pa.Array, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, buckets, values) of each text: hashed uni- and bigrams of its words and of their shapes.

    A shape keeps the kinds of a word's characters without repeats, so that it says something about unknown words; a
    bigram of shapes also says whether both words are equal. Values are logarithms of counts, scaled to length 1.
    """
    for low, high, offset, data in text_blocks(column):
        words = split_words(offset, data, NOT_SPACE)
        hashes, shapes = word_hashes(words), _shape_hashes(words)
        for row in range(low, high):
            own = slice(words.first[row - low], words.first[row - low + 1])
            word, shape = hashes[own], shapes[own]
            equal = (word[1:] == word[:-1]).astype(U64)
            grams = np.concatenate(
                (word, run_hashes(word, 2), mixed(shape + U64(1)), mixed(run_hashes(shape, 2) + equal + U64(2)))
            )
            buckets, counts = np.unique(grams >> U64(64 - bits), return_counts=True)
            values = np.log1p(counts)
            norm = float(np.sqrt(np.sum(values * values))) or 1.0
            yield row, buckets.astype(np.int32), (values / norm).astype(np.float32)


def _shape_hashes(words: Words) -> np.ndarray:
    kinds = _KIND[words.data]
    begins = np.zeros(len(kinds) + 1, bool)
    begins[words.start] = True
    inside = np.zeros(len(kinds) + 1, np.int8)
    np.add.at(inside, words.start, 1)
    np.add.at(inside, words.end, -1)
    keep = (np.cumsum(inside[:-1]) > 0) & (begins[:-1] | np.concatenate(([True], kinds[1:] != kinds[:-1])))
    place = np.concatenate(([0], np.cumsum(keep)))
    return word_hashes(Words(kinds[keep], place[words.start], place[words.end], words.first))


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    bits: int

    def score(self, buckets: np.ndarray, values: np.ndarray) -> float:
        """Probability of label 1, from a sparse dot product."""
        return float(_sigmoid(self.bias + float(np.dot(self.weights[buckets], values))))


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], params: QualityParams = DEFAULTS) -> QualityModel:
    """Per-coordinate FTRL-proximal updates over (buckets, values, label), in the given order, several times.

    Both labels weigh the same in total. Without rows of both labels every score is the share of label 1, or 0.5.
    """
    labels = np.array([label for _, _, label in rows], int)
    positive = int(labels.sum())
    if not 0 < positive < len(rows):
        return QualityModel(np.zeros(1 << params.bits), 0.0 if not len(rows) else (30.0 if positive else -30.0), params.bits)
    z, n = np.zeros((1 << params.bits) + 1), np.zeros((1 << params.bits) + 1)
    bias = 1 << params.bits
    cost = {1: len(rows) / (2 * positive), 0: len(rows) / (2 * (len(rows) - positive))}
    for _ in range(params.epochs):
        for buckets, values, label in rows:
            at, x = np.append(buckets, bias), np.append(values, 1.0)
            weight = _weights(z[at], n[at], params)
            gradient = (float(_sigmoid(float(weight @ x))) - label) * cost[label] * x
            step = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / params.alpha
            z[at] += gradient - step * weight
            n[at] += gradient * gradient
    weights = _weights(z, n, params)
    return QualityModel(weights[:-1].astype(np.float32), float(weights[-1]), params.bits)


def _weights(z: np.ndarray, n: np.ndarray, params: QualityParams) -> np.ndarray:
    shrunk = np.sign(z) * params.l1 - z
    return np.where(np.abs(z) > params.l1, shrunk / ((params.beta + np.sqrt(n)) / params.alpha + params.l2), 0.0)


def held_out(doc_id) -> F.Column:
    """Rows that are never learnt from. A NULL doc_id has no label and is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit_quality(documents: DataFrame, labels: DataFrame, params: QualityParams = DEFAULTS) -> QualityModel:
    """A model from at most `max_rows` labelled rows, taken by a hash of doc_id; held-out rows take no part.

    A document with both labels, or with a NULL one, is left out; repeated rows of one doc_id and text count once. The
    whole text makes the features, in training as in scoring. Rows are taken whole, in the order of the hash, up to
    `max_features` features in all.
    """
    known = labels.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
    known = known.filter((F.col("label") == F.col("other")) & F.col("label").isin(0, 1) & ~held_out("doc_id"))
    order = F.xxhash64(F.lit("quality"), F.col("doc_id"))
    chosen = written(known.orderBy(order, "doc_id").limit(params.max_rows).select("doc_id", "label", order.alias("draw")), "quality-labels")
    rows = documents.select("doc_id", "text").join(chosen, "doc_id").select("draw", "label", "text")

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, values = [], []
            for _, bucket, value in text_features(batch.column(2), params.bits):
                buckets.append(bucket)
                values.append(value)
            columns = [pa.array(buckets, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *columns], ["draw", "label", "buckets", "weights"]
            )

    schema = "draw bigint, label int, buckets array<int>, weights array<float>"
    features = written(rows.mapInArrow(featurize, schema).distinct(), "quality-features")
    # The updates follow the draw, whatever the partitions; equal rows count once.
    row = F.xxhash64("buckets", "weights")
    sizes = features.select("draw", row.alias("row"), F.size("buckets").alias("n")).orderBy("draw", "row").limit(params.max_rows)
    sizes = sizes.toArrow().to_pylist()
    n_taken = int(np.searchsorted(np.cumsum([size["n"] for size in sizes]), params.max_features, "right"))
    if not n_taken:
        return train_ftrl([], params)
    last = F.struct(F.lit(sizes[n_taken - 1]["draw"]).alias("draw"), F.lit(sizes[n_taken - 1]["row"]).alias("row"))
    taken = features.filter(F.struct("draw", row.alias("row")) <= last).toArrow()
    drawn = zip(*[taken.column(name) for name in taken.column_names], strict=True)
    learnt = [
        (draw.as_py(), np.array(buckets.values, np.int32), np.array(values.values, np.float32), label.as_py())
        for draw, label, buckets, values in drawn
    ]
    learnt.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))
    return train_ftrl([(buckets, values, label) for _, buckets, values, label in learnt], params)


def score_quality(documents: DataFrame, model: QualityModel) -> DataFrame:
    """`documents` with _score, the probability of label 1 for the whole text; NULL counts as empty. Repeated rows stay."""
    documents = documents.drop("_score")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = np.zeros(len(batch))
            for row, buckets, values in text_features(batch.column(place), model.bits):
                scores[row] = model.score(buckets, values)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "_score"])

    schema = documents.withColumn("_score", F.lit(0.0)).schema
    return documents.mapInArrow(score, schema)
