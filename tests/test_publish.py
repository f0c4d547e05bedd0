"""Tables that are published together, and runs that fail between two of them."""

import pytest

from helpers import run
from jobgauge import schemas
from jobgauge.operators import history
from jobgauge.plans import advisor, silver
from jobgauge.sources.publish import publish_tables, published, read_manifest

RUNS = [run(job, minutes, day) for job in (1, 2) for day, minutes in ((1, 5), (2, 70 * job))]


def _fail(*_, **__):
    raise OSError("disk full")


def test_nothing_is_published_without_tables(spark, path):
    assert published(spark, path("base")) == {}
    assert publish_tables(spark, path("base"), lambda folder: ()) == {} and published(spark, path("base")) == {}
    with pytest.raises(OSError):
        publish_tables(spark, path("base"), _fail)
    assert read_manifest(spark, path("base")).count() == 0


def test_silver_run_that_fails_between_two_outputs(spark, path, tmp_path, monkeypatch):
    def bronze(value):
        rows = spark.range(20).selectExpr("id", "timestamp'2024-03-01' + make_interval(0, 0, 0, int(id)) AS data_date")
        rows = rows.selectExpr("*", "int(id % 2) AS region_id", "'A' AS category", f"double({value}) AS value")
        rows.write.mode("overwrite").parquet(path("bronze"))

    (tmp_path / "regions.csv").write_text("id,region\n0,NORTH\n1,SOUTH\n")
    bronze(1)
    first = silver.publish_silver(spark, path("bronze"), path("regions.csv"), path("silver"))
    assert published(spark, path("silver")) == first and set(first) == set(silver.TARGETS)
    bronze(2)
    with monkeypatch.context() as patch:
        patch.setattr(silver, "export_copy", _fail)
        with pytest.raises(OSError):
            silver.publish_silver(spark, path("bronze"), path("regions.csv"), path("silver"))
    assert published(spark, path("silver")) == first
    assert spark.read.parquet(first["category_metrics"]).first().category_total == 20
    second = silver.publish_silver(spark, path("bronze"), path("regions.csv"), path("silver"))
    assert published(spark, path("silver")) == second != first
    assert spark.read.parquet(second["category_metrics"]).first().category_total == 40
    assert spark.read.parquet(first["export"]).count() == 20  # a reader that began on the former version can finish
    assert [r.sequence for r in read_manifest(spark, path("silver")).orderBy("sequence").collect()] == [1, 2]


def test_advisor_run_that_fails_after_its_tables(spark, path, monkeypatch):
    runs = spark.createDataFrame(RUNS, schemas.RUNS)
    assert advisor.publish_advisor(spark, runs, path("out"), 1).first().status == "completed"
    first = published(spark, path("out"))
    assert set(first) == set(advisor.TABLES) and all(spark.read.parquet(p).columns for p in first.values())
    with monkeypatch.context() as patch:
        patch.setattr(advisor, "append_history", _fail)
        with pytest.raises(OSError):
            advisor.publish_advisor(spark, runs.filter("job_id = 1"), path("out"), 2)
    assert advisor.publish_advisor(spark, runs.limit(0), path("out"), 3).first().status == "failed"
    assert published(spark, path("out")) == first and spark.read.parquet(first["analysis"]).count() == 2
    advisor.publish_advisor(spark, runs.filter("job_id = 1"), path("out"), 2)
    assert spark.read.parquet(published(spark, path("out"))["analysis"]).count() == 1
    assert history.read_history(spark, f"{path('out')}/history").groupBy("batch_id").count().count() == 2
