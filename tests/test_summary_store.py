"""Stored summaries: the same analysis as of all runs at once, without an exchange."""

import uuid

from helpers import plan, rows, run
from jobgauge import schemas
from jobgauge.operators.summary import analyze_runs
from jobgauge.operators.summary_store import store_summaries, stored_analysis


def test_stored_batches_give_the_analysis_of_all_runs(spark, path):
    table = f"summaries_{uuid.uuid4().hex}"
    first = [run(job, minutes, day) for job in (1, 2, 3) for day, minutes in ((1, 5), (2, 70 * job))]
    second = [run(1, 1e6 + 2.0**-20, 3, output="ERROR: OutOfMemoryError"), run(2, None, 4), run(4, 3, 1), run(4, 0.1, 2), (None, *run(5, 1)[1:])]
    for batch in (first, second, []):
        store_summaries(spark.createDataFrame(batch, schemas.RUNS), table, path("store"), 4)
    stored = stored_analysis(spark, table)
    text = plan(stored)
    assert "Exchange" not in text and "Bucketed: true" in text
    whole = analyze_runs(spark.createDataFrame(first + second, schemas.RUNS))
    assert stored.columns == whole.columns and rows(stored) == rows(whole) and stored.count() == 4
    spark.sql(f"DROP TABLE {table}")
