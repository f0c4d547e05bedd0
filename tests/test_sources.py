import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from helpers import config, plan, rows
from jobgauge import schemas
from jobgauge.operators.ingest import filter_min_value, ingest_metrics, transform_sales
from jobgauge.plans.ingestion import run_ingestion
from jobgauge.operators import ingest
from jobgauge.operators.business import between_dates
from jobgauge.sources import run_log, scratch
from jobgauge.sources.tables import read_bronze, read_regions, read_source
from jobgauge.sources.writers import export_copy, write_single_file, write_table

SALES_CSV = """date,region,category,value,region_id
2024-01-02,EAST,Toys,100.5,1
2024-01-01,WEST,tOOls,250,2
not a date,EAST,,300,
2024-01-03,NORTH,Toys,abc,3
2024-01-03,NORTH,Toys,100,3
2024-01-04,,Books,,4
"""


@pytest.fixture
def sales_csv(tmp_path):
    file = tmp_path / "sales.csv"
    file.write_text(SALES_CSV)
    return str(file)


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError, match="Unsupported format: xml"):
        read_source(spark, "/nowhere", "xml")


def test_csv_without_schema_reads_text(spark, sales_csv):
    df = read_source(spark, sales_csv)
    assert {kind for _, kind in df.dtypes} == {"string"}
    # Text that is not a number is left out, and a fraction is not.
    assert filter_min_value(df, 100).count() == 3


@pytest.mark.parametrize("kind", ["string", "double", "decimal(10,2)"])
def test_only_finite_numbers_pass_the_filter(spark, kind):
    texts = ["100", "100.01", "1e3", None] + ([] if "decimal" in kind else ["NaN", "Infinity", "-Infinity"])
    df = spark.createDataFrame([(t,) for t in texts], "value string").select(F.col("value").cast(kind))
    assert filter_min_value(df, 100).count() == 2


def test_csv_with_schema_turns_bad_fields_into_null(spark, sales_csv):
    values = [r.value for r in read_source(spark, sales_csv, "csv", schemas.SALES).collect()]
    assert values == [100.5, 250.0, 300.0, None, 100.0, None]


def test_csv_with_other_column_order_is_refused(spark, tmp_path):
    file = tmp_path / "moved.csv"
    file.write_text("region,id\nEAST,1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_regions(spark, str(file)).collect()


@pytest.mark.parametrize("source_format", ["csv", "json", "parquet"])
def test_round_trip(spark, sales_csv, path, source_format):
    df = read_source(spark, sales_csv, "csv", schemas.SALES)
    writer = df.write.option("header", True) if source_format == "csv" else df.write
    writer.format(source_format).save(path("out"))
    assert rows(read_source(spark, path("out"), source_format, schemas.SALES)) == rows(df)


def test_transform_sales(spark, sales_csv):
    source = read_source(spark, sales_csv, "csv", schemas.SALES)
    bronze = transform_sales(source)
    # Three rows pass the filter, each paired with all six source rows (fewer than ten).
    assert bronze.count() == 18
    first = bronze.filter(F.col("value") == 250).first()
    assert first["data_date"] == dt.datetime(2024, 1, 1) and first["CATEGORY_UPPERCASE"] == "TOOLS"
    assert [r[0] for r in bronze.filter(F.col("category").isNull()).select("CATEGORY_UPPERCASE").distinct().collect()] == [None]
    paired = sorted(map(str, (r.ref_region for r in bronze.filter(F.col("value") == 250).collect())))
    assert paired == ["EAST", "EAST", "NORTH", "NORTH", "None", "WEST"]


def test_transform_pushes_the_filter_and_stays_out_of_python(spark, sales_csv, path):
    read_source(spark, sales_csv, "csv", schemas.SALES).write.parquet(path("source"))
    text = plan(transform_sales(spark.read.parquet(path("source"))))
    assert "GreaterThan(value,100.0)" in text
    assert "Python" not in text and "NestedLoop" not in text and "CartesianProduct" not in text


def test_metrics_count_null_as_a_category(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, None)], "category string, data_date int")
    assert rows(ingest_metrics(df)) == [(3, 2, 2)]
    assert rows(ingest_metrics(df.limit(0))) == [(0, 0, 0)]


def test_ingestion_job(spark, sales_csv, path):
    metrics = run_ingestion(spark, sales_csv, path("bronze"))
    assert rows(metrics) == [(18, 3, 6)]
    bronze = read_bronze(spark, path("bronze"))
    assert "src_region" in bronze.columns and "region" not in bronze.columns
    january = between_dates(bronze, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert january.count() == 12
    assert "PartitionFilters: [isnotnull(data_month" in plan(january)
    again = run_ingestion(spark, sales_csv, path("bronze"), mode="append").first()
    assert again.row_count == 18
    assert read_bronze(spark, path("bronze")).count() == 36
    run_ingestion(spark, sales_csv, path("bronze"))
    assert read_bronze(spark, path("bronze")).count() == 18


def test_hot_partition_is_written_by_several_tasks(spark, path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        part = F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 4).cast("string"))
        df = spark.range(200_000, numPartitions=8).select(F.xxhash64("id").alias("payload"), part.alias("part"))
        write_table(df, path("skewed"), partition_by=["part"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(path("skewed") + "/part=hot/*.parquet")) > 4
    assert spark.read.parquet(path("skewed")).count() == 200_000


def test_exports_are_copied_without_a_shuffle(spark, path):
    df = spark.range(1000, numPartitions=8)
    write_table(df, path("main"))
    export_copy(spark.read.parquet(path("main")), path("compact"))
    write_single_file(df, path("single"))
    assert spark.read.parquet(path("compact")).count() == 1000
    # The same ranges of ids in each file: no row changed its task.
    ids = spark.read.parquet(path("compact")).groupBy(F.input_file_name()).agg(F.max("id") - F.min("id"), F.count("*"))
    assert all(spread == n - 1 for _, spread, n in ids.collect())
    assert len(glob.glob(path("single") + "/*.parquet")) == 1


def test_scratch_paths_come_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "x")
    assert first.startswith(root) and first != second


RUN_LINES = [
    run_log.HEADER,
    "",
    f'7,load,{config(2)},45,2024-03-01 00:00:00,2024-03-01 00:45:00,"INFO: read a, b\\nINFO: said ""done"""',
    '8,no config,,30,2024-03-01 00:00:00,2024-03-01 00:30:00,"INFO: fine"',
    '9,cut config,{"cluster_config": {"num,30.5,2024-03-01 00:00:00,,"INFO: fine"',
    '10,quoted config,"{""cluster_config"": {""num_workers"": 3}}",,2024-03-01 00:00:00,2024-03-01 00:30:00,',
    ',no job,{},30,2024-03-01 00:00:00,2024-03-01 00:30:00,"x"',
    'seven,text id,{},30,2024-03-01 00:00:00,2024-03-01 00:30:00,"x"',
    '11,bad number,{},1.2.3,2024-03-01 00:00:00,2024-03-01 00:30:00,"x"',
    '12,bad month,{},1,2024-13-01 00:00:00,2024-03-01 00:30:00,"x"',
    "13,short line,{}",
]


def test_run_log_is_repaired_and_the_rest_rejected(spark, tmp_path):
    file = tmp_path / "runs.csv"
    file.write_text("\n".join(RUN_LINES) + "\n")
    parsed = {r.job_id: r for r in run_log.read_run_log(spark, str(file)).collect()}
    assert set(parsed) == {7, 8, 9, 10, None}
    assert parsed[7].configuration == config(2) and parsed[7].runtime_minutes == 45.0
    assert parsed[7].start_time == dt.datetime(2024, 3, 1)
    assert parsed[7].output == 'INFO: read a, b\\nINFO: said "done"'
    assert parsed[8].configuration is None
    assert parsed[9].configuration == '{"cluster_config": {"num' and parsed[9].end_time is None
    assert parsed[10].configuration == '{"cluster_config": {"num_workers": 3}}'
    assert parsed[10].runtime_minutes is None and parsed[10].output is None
    rejected = [r.line.split(",")[0] for r in run_log.rejected_run_lines(run_log.read_run_lines(spark, str(file))).collect()]
    assert sorted(rejected) == ["11", "12", "13", "seven"]
    assert run_log.read_run_log(spark, str(file)).schema.simpleString() == schemas.RUNS.simpleString()


def test_a_repeated_batch_replaces_itself(spark, sales_csv, path):
    for batch_id in ("a", "b", "a"):
        metrics = run_ingestion(spark, sales_csv, path("bronze"), mode="batch", batch_id=batch_id)
        assert rows(metrics) == [(18, 3, 6)]
    batches = spark.read.parquet(path("bronze")).groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in batches} == {"a": 18, "b": 18}
    january = spark.read.option("header", True).csv(sales_csv).filter("date < '2024-02-01'")
    january.write.option("header", True).csv(path("january"))
    run_ingestion(spark, path("january"), path("bronze"), mode="batch", batch_id="a")
    left = spark.read.parquet(path("bronze")).filter("batch_id = 'a'")
    assert left.filter("data_date >= '2024-02-01'").isEmpty() and 0 < left.count() < 18
    with pytest.raises(ValueError):
        run_ingestion(spark, sales_csv, path("bronze"), mode="batch", batch_id="../b")


def test_sketches_of_batches_merge_without_their_rows(spark):
    df = spark.range(30_000).select((F.col("id") % 7).alias("batch_id"), F.when(F.col("id") % 100 > 0, F.col("id") % 9000).cast("string").alias("category"))
    sketches = ingest.batch_sketches(df)
    row = ingest.distinct_over_batches(sketches).first()
    exact = df.select("category").distinct().count()
    assert sketches.count() == 7 and row.row_count == 30_000
    assert abs(row.distinct_estimate - exact) <= 4 * 1.04 / 2 ** (ingest.SKETCH_BITS / 2) * exact
    assert ingest.distinct_over_batches(sketches.limit(0)).first() == (0, 0)
