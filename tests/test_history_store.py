"""Compaction of the history: the same rollup before and after, with files bounded by spans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from jobgauge import schemas
from jobgauge.operators import history
from jobgauge.operators.history_store import Span, compact_history, compacted_rollup, read_spans


def _append(spark, folder, batch_id, jobs):
    data = [(job, None, None if job == 3 else float(10 * batch_id + (job or 0)), f"advice {batch_id}", None) for job in jobs]
    ts = F.lit(dt.datetime(2024, 3, 1) + dt.timedelta(days=(7 * batch_id) % 11))
    history.append_history(spark.createDataFrame(data, schemas.HISTORY), folder, batch_id, ts)


def _shape(spans):
    return [(span.first, span.last, span.level) for span in spans]


def test_rollup_is_the_same_before_and_after(spark, path):
    folder, store = path("history"), path("store")
    assert compact_history(spark, folder, store) == [] and compacted_rollup(spark, folder, store).count() == 0
    for batch_id in range(7):
        _append(spark, folder, batch_id, [j for j in (1, 2, 3, None) if j != batch_id])
        expected = rows(history.history_rollup(history.read_history(spark, folder)))
        assert rows(compacted_rollup(spark, folder, store)) == expected
        compact_history(spark, folder, store, fanout=2)
        assert rows(compacted_rollup(spark, folder, store)) == expected
    assert _shape(read_spans(spark, store)) == [(0, 3, 1), (4, 5, 0)]
    # Covered snapshots are not read: of the whole history only spans and the open batch are.
    files = compacted_rollup(spark, folder, store).inputFiles()
    assert {f.split("batch_id=")[1].split("/")[0] for f in files if "batch_id=" in f} == {"6"}
    assert {f.split("/spans/")[1].split("-")[0] for f in files if "/spans/" in f} == {"0", "4"}


def test_readers_go_on_while_spans_are_merged(spark, path):
    folder, store = path("history"), path("store")
    for batch_id in range(2):
        _append(spark, folder, batch_id, [1, 2])
    compact_history(spark, folder, store, fanout=2)
    begun = compacted_rollup(spark, folder, store)
    for batch_id in (2, 3):
        _append(spark, folder, batch_id, [1, 2])
    assert _shape(compact_history(spark, folder, store, fanout=2)) == [(0, 3, 1)]
    assert {r.snapshots for r in begun.collect()} == {2}
    assert {r.snapshots for r in compacted_rollup(spark, folder, store).collect()} == {4}
    # Nothing new: no row in the manifest.
    before = spark.read.json(f"{store}/manifest").count()
    compact_history(spark, folder, store, fanout=2)
    assert spark.read.json(f"{store}/manifest").count() == before == 2


def test_unfinished_batch_ends_what_is_covered(spark, path):
    import pathlib

    folder, store = path("history"), path("store")
    for batch_id in (0, 1, 2, 5, 6):
        _append(spark, folder, batch_id, [1])
    (pathlib.Path(folder) / "batch_id=2" / "_SUCCESS").unlink()
    assert _shape(compact_history(spark, folder, store, fanout=2)) == [(0, 1, 0)]
    _append(spark, folder, 2, [1])
    assert _shape(compact_history(spark, folder, store, fanout=2)) == [(0, 5, 1)]
    assert compacted_rollup(spark, folder, store).first().snapshots == 5
    with pytest.raises(ValueError):
        compact_history(spark, folder, store, fanout=1)


def test_compaction_that_fails_leaves_the_spans(spark, path, monkeypatch):
    folder, store = path("history"), path("store")
    for batch_id in range(4):
        _append(spark, folder, batch_id, [1, 2])
    from jobgauge.operators import history_store

    whole = history_store.merged_rollups
    monkeypatch.setattr(history_store, "merged_rollups", lambda rollups: whole(rollups).select(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        compact_history(spark, folder, store, fanout=2)
    monkeypatch.undo()
    assert read_spans(spark, store) == []
    assert {r.snapshots for r in compacted_rollup(spark, folder, store).collect()} == {4}
    span = compact_history(spark, folder, store, fanout=2)[0]
    assert isinstance(span, Span) and (span.first, span.last) == (0, 3)
