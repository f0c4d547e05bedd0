"""Compaction of the analysis history: one row per job and span of batches, in place of one per job and batch.

Snapshots stay where `append_history` puts them. A span covers consecutive batches and holds the partial rollup of each
job. Spans of one level are merged into one of the next, so their number grows with the logarithm of the batches, and each
row is written again once per level. Spans are files of their own that are never changed; the newest row of the small
table `manifest` lists those that count, so readers that have begun on older ones go on.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from itertools import takewhile

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgauge import schemas
from jobgauge.operators.history import history_rollup, merged_rollups, partial_rollups

SPAN = "struct<first: bigint, last: bigint, level: int, name: string>"
MANIFEST = f"sequence bigint, version string, spans array<{SPAN}>"


@dataclass(frozen=True)
class Span:
    """The batches `first` to `last`, in the folder `name`."""

    first: int
    last: int
    level: int
    name: str


def read_spans(spark: SparkSession, store_path: str) -> list[Span]:
    """The spans that count now, oldest first; none where nothing was compacted yet."""
    return _newest(spark, store_path)[1]


def compact_history(spark: SparkSession, history_path: str, store_path: str, fanout: int = 16) -> list[Span]:
    """Cover finished batches by spans of `fanout`, merge `fanout` spans of a level, and return the spans.

    Only finished batches before the first unfinished one are covered, `fanout` at a time; others wait. A covered batch is
    closed: a replay must bring the same rows, as it is not read again. Nothing to do leaves the manifest alone. Of two
    compactions at the same time the one with the larger version counts, and both are right.
    """
    if fanout < 2:
        raise ValueError("a span must merge at least two")
    sequence, spans = _newest(spark, store_path)
    before = list(spans)
    finished = takewhile(lambda batch: batch[1], _batches(spark, history_path, spans))
    waiting = [number for number, _ in finished]
    while len(waiting) >= fanout:
        taken, waiting = waiting[:fanout], waiting[fanout:]
        rows = partial_rollups(_snapshots(spark, history_path, taken))
        spans.append(_write(rows, store_path, taken[0], taken[-1], 0))
        while len(tail := spans[-fanout:]) == fanout and len({span.level for span in tail}) == 1:
            merged = merged_rollups(_read_rollups(spark, store_path, tail))
            spans[-fanout:] = [_write(merged, store_path, tail[0].first, tail[-1].last, tail[0].level + 1)]
    if spans != before:
        listed = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in vars(span).items()]) for span in spans]).cast(f"array<{SPAN}>")
        row = spark.range(0, 1, 1, 1).select(
            F.lit(sequence + 1).cast("bigint").alias("sequence"), F.lit(uuid.uuid4().hex).alias("version"), listed.alias("spans")
        )
        row.write.mode("append").json(f"{store_path}/manifest")
    return spans


def compacted_rollup(spark: SparkSession, history_path: str, store_path: str) -> DataFrame:
    """`history_rollup` of the whole history from the spans, and from the snapshots of batches that no span covers yet."""
    spans = read_spans(spark, store_path)
    open_batches = [number for number, _ in _batches(spark, history_path, spans, finished=False)]
    parts = [_read_rollups(spark, store_path, spans)] if spans else []
    parts.append(partial_rollups(_snapshots(spark, history_path, open_batches)))
    return history_rollup(rollups=reduce(DataFrame.unionByName, parts))


def _newest(spark: SparkSession, store_path: str) -> tuple[int, list[Span]]:
    try:
        manifest = spark.read.schema(MANIFEST).json(f"{store_path}/manifest")
        newest = manifest.agg(F.max_by("spans", F.struct("sequence", "version")).alias("spans"), F.max("sequence").alias("n")).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, []
    return newest.n or 0, [Span(**span.asDict()) for span in newest.spans or []]


def _batches(spark: SparkSession, history_path: str, spans: list[Span], finished: bool = True) -> list[tuple[int, bool]]:
    """Batches beyond the spans, in order, each with whether its write has ended; one listing of names."""
    covered = max((span.last for span in spans), default=None)
    folder = spark._jvm.org.apache.hadoop.fs.Path(history_path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    numbers = sorted(int(name.removeprefix("batch_id=")) for name in names if name.startswith("batch_id="))
    done = spark._jvm.org.apache.hadoop.fs.Path
    return [
        (n, not finished or files.exists(done(f"{history_path}/batch_id={n}/_SUCCESS")))
        for n in numbers
        if covered is None or n > covered
    ]


def _snapshots(spark: SparkSession, history_path: str, batches: list[int]) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], schemas.HISTORY)
    folders = [f"{history_path}/batch_id={number}" for number in batches]
    return spark.read.schema(schemas.HISTORY).option("basePath", history_path).parquet(*folders)


def _read_rollups(spark: SparkSession, store_path: str, spans: list[Span]) -> DataFrame:
    empty = partial_rollups(spark.createDataFrame([], schemas.HISTORY))
    return spark.read.schema(empty.schema).parquet(*[f"{store_path}/spans/{span.name}" for span in spans])


def _write(rows: DataFrame, store_path: str, first: int, last: int, level: int) -> Span:
    span = Span(first, last, level, f"{first}-{last}-{uuid.uuid4().hex}")
    rows.write.parquet(f"{store_path}/spans/{span.name}")
    return span
