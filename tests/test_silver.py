import datetime as dt
import decimal
import fractions
import math
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import plan, rows
from jobgauge.operators import business, joins, totals
from jobgauge.operators.prefix_sums import with_prefix_sum
from jobgauge.plans.ingestion import run_ingestion
from jobgauge.plans.silver import TARGETS, run_silver
from workload import sales_queries

DAY = [dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2), dt.datetime(2024, 4, 1), None]


@pytest.fixture
def sales(spark):
    """Repeated days, months without sales, NULL days, regions, categories and values."""
    data = [
        (i, DAY[i % 5], ["EAST", "WEST", None][i % 3], ["a", "b", None][i % 7 % 3], None if i % 11 == 0 else i / 10)
        for i in range(200)
    ]
    return spark.createDataFrame(data, "id long, data_date timestamp, region string, category string, value double")


def test_running_total_equals_the_direct_window(spark, sales):
    daily = totals.daily_totals(sales)
    exact = F.col("total_value").cast("decimal(38,18)")
    direct = daily.withColumn("running_total", F.sum(exact).over(Window.orderBy("data_date")).cast("double"))
    two_level = totals.with_running_total(daily)
    assert two_level.columns == direct.columns
    # A decimal holds what a double prints, not what it is.
    assert rows(two_level.drop("running_total")) == rows(direct.drop("running_total"))
    pairs = two_level.join(direct.select("data_date", "region", F.col("running_total").alias("other")), ["data_date", "region"])
    assert pairs.filter("abs(running_total - other) > 1e-12 * abs(other)").isEmpty()


def test_running_total_of_days_without_values(spark):
    data = [(DAY[0], None), (DAY[1], None), (DAY[1], decimal.Decimal(2)), (DAY[3], None)]
    daily = spark.createDataFrame(data, "data_date timestamp, total_value decimal(20,4)")
    direct = daily.withColumn("running_total", F.sum("total_value").over(Window.orderBy("data_date")))
    assert rows(totals.with_running_total(daily)) == rows(direct)


def test_running_total_has_no_single_partition_over_days(spark, sales):
    text = plan(totals.with_running_total(totals.daily_totals(sales)))
    before = text.split("SinglePartition")
    assert len(before) == 2
    # What reaches the one task has been grouped by range of the order.
    assert "Exchange hashpartitioning(stretch" in before[1]
    regional = plan(totals.with_regional_running_total(totals.daily_totals(sales)))
    assert "SinglePartition" not in regional
    assert "Window" in regional and "hashpartitioning(stretch" in regional


def _plain_prefix(data):
    """The running total of (group, place, value) rows, ties included, by exact fractions."""
    return {
        (g, p): float(sum((fractions.Fraction(v) for h, q, v in data if h == g and (q is None or (p is not None and q <= p))), fractions.Fraction()))
        for g, p, _ in data
    }


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_prefix_sum_over_time_stamps_with_ties_across_ranges(spark, ranges):
    start = dt.datetime(2024, 5, 1)
    hot = start + dt.timedelta(microseconds=40)
    data = [("a" if i % 5 else "b", start + dt.timedelta(microseconds=i // 3), [0.1, 1e16, -1e16, 2.0**-30][i % 4]) for i in range(300)]
    data += [("a", hot, 0.3)] * 200 + [(None, None, 1.5), (None, start, 2.5), ("b", None, 4.0)]
    df = spark.createDataFrame(data, "g string, at timestamp, value double")
    found = with_prefix_sum(df, "value", ["at"], "total", ["g"], ranges)
    expected = _plain_prefix(data)
    got = found.collect()
    assert len(got) == len(data) and found.columns == ["g", "at", "value", "total"]
    assert all(r.total == expected[r.g, r["at"]] for r in got)
    alone = with_prefix_sum(df.drop("g"), "value", ["at"], "total", ranges=ranges).collect()
    whole = _plain_prefix([(None, p, v) for _, p, v in data])
    assert len(alone) == len(data) and all(r.total == whole[None, r["at"]] for r in alone)


def test_totals_by_time_and_type_compute_the_first_totals_once(spark, monkeypatch, tmp_path):
    data = [(i, dt.datetime(2024, 1, 1 + i % 7), "ab"[i % 2], float(i)) for i in range(30)]
    events = spark.createDataFrame(data, "event_id long, ts timestamp_ntz, event_type string, value double")
    events.write.parquet(str(tmp_path / "events.parquet"))
    given = []

    def kept(df, *args):
        given.append(df)
        return with_prefix_sum(df, *args)

    monkeypatch.setattr(sales_queries, "with_prefix_sum", kept)
    found = {r.event_id: (r.running_total, r.running_by_type) for r in sales_queries.running_total_by_time(spark, str(tmp_path)).collect()}
    for i, ts, kind, _ in data:
        before = [(k, v) for _, t, k, v in data if t <= ts]
        assert found[i] == (sum(v for _, v in before), sum(v for k, v in before if k == kind))
    assert len(given) == 2 and all("Exchange" not in plan(df) and "Join" not in plan(df) for df in given)


def test_prefix_sum_with_clashing_columns_missing_values_and_no_rows(spark):
    data = [(1, None, 7, "x"), (2, float("nan"), 8, "y"), (3, 2.0, 9, "z"), (3, 1.0, 9, "z")]
    df = spark.createDataFrame(data, "key0 int, value double, stretch int, total string")
    found = with_prefix_sum(df, "value", ["key0"], "sum")
    assert [(r.key0, r.stretch, r.total, r.sum) for r in found.orderBy("key0").collect()] == [
        (1, 7, "x", None), (2, 8, "y", None), (3, 9, "z", 3.0), (3, 9, "z", 3.0),
    ]
    assert with_prefix_sum(df.limit(0), "value", ["key0"], "sum").count() == 0


def test_regional_running_total(spark, sales):
    daily = totals.daily_totals(sales)
    window = Window.partitionBy("region").orderBy("data_date")
    direct = daily.withColumn("running_total", F.sum("total_value").over(window))
    assert rows(totals.with_regional_running_total(daily)) == rows(direct)


def test_category_metrics_equal_the_join_of_two_aggregates(spark, sales):
    counts = sales.groupBy("category").count()
    values = sales.groupBy("category").agg(F.collect_list("value").alias("values"))
    sums = spark.createDataFrame([(r.category, math.fsum(r["values"])) for r in values.collect()], "category string, category_total double")
    metrics = totals.category_metrics(sales)
    assert rows(metrics.drop("value_misfits")) == rows(counts.join(sums, "category"))
    assert metrics.filter("value_misfits > 0").isEmpty()
    assert metrics.count() == 2
    assert plan(totals.category_metrics(sales)).count("Scan") == 1


def test_daily_totals_do_not_depend_on_the_row_order(spark):
    values = [1e12, 0.1, -1e12, 0.2] * 25
    data = [(DAY[0], "EAST", v) for v in values]
    frames = [spark.createDataFrame(d, "data_date timestamp, region string, value double") for d in (data, data[::-1])]
    results = [rows(totals.daily_totals(df.repartition(n))) for df, n in zip(frames, (1, 7))]
    assert results[0] == results[1] and results[0][0][2] == math.fsum(values)


def test_totals_leave_out_what_is_no_number(spark):
    values = [1.0, 3.0, None, float("nan"), float("inf")]
    df = spark.createDataFrame([(DAY[0], "EAST", v) for v in values], "data_date timestamp, region string, value double")
    assert rows(totals.daily_totals(df)) == [(DAY[0], "EAST", 4.0, 2.0, 5, 2)]
    assert [r.tax_amount for r in business.add_tax(df).collect()] == [0.09, 0.27, None, None, None]


def test_top_days(spark, sales):
    daily = totals.daily_totals(sales)
    top = totals.top_days(daily, 3)
    assert "TakeOrderedAndProject" in plan(top)
    best = sorted((r.total_value for r in daily.collect() if r.total_value is not None), reverse=True)[:3]
    assert [r.total_value for r in top.collect()] == best


@pytest.fixture
def facts(spark):
    """Two thirds of the rows share one key or have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 50)
    return spark.range(3000).select("id", key.cast("int").alias("region_id"))


@pytest.fixture
def dimension(spark):
    return spark.createDataFrame([(i, f"R{i}") for i in range(40)] + [(1, "duplicate")], "region_id int, region string")


@pytest.mark.parametrize("hot_keys", [None, 1, 10, 1000])
def test_salted_lookup_equals_the_plain_one(spark, facts, dimension, hot_keys):
    plain = joins.lookup(facts, dimension, "region_id")
    salted = joins.salted_lookup(facts, dimension, "region_id", ["id"], 8, hot_keys)
    assert sorted(salted.columns) == sorted(plain.columns)
    assert rows(salted.select(plain.columns)) == rows(plain)


def test_salted_rows_of_a_hot_key_spread_over_the_partitions(spark, facts, dimension):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        salted = joins.salted_lookup(facts, dimension, "region_id", ["id"], 32, hot_keys=1)
        assert "hashpartitioning(region_id, _salt" in re.sub(r"#\d+L?", "", plan(salted))
        spread = salted.groupBy("region_id", F.spark_partition_id().alias("part")).count()
        parts = {r.region_id: r["count"] for r in spread.groupBy("region_id").count().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts[1] > 4 and parts[None] > 4
    assert {parts[key] for key in parts if key not in (1, None)} == {1}


def test_lookup_keeps_rows_and_does_not_multiply_them(spark, facts, dimension):
    looked_up = joins.lookup(facts, dimension, "region_id")
    assert looked_up.count() == 3000
    assert looked_up.filter("region_id = 1 and region != 'R1'").count() == 0
    assert looked_up.filter("region_id is null and region is not null").count() == 0
    assert looked_up.filter("region_id >= 40 and region is not null").count() == 0
    plain = joins.lookup(facts, dimension, "region_id", unique=False)
    assert plain.count() > 3000


def test_small_file_dimension_is_broadcast_and_a_large_one_is_not(spark, facts, dimension, path):
    dimension.write.parquet(path("dimension"))
    facts.write.parquet(path("facts"))
    fact, side = spark.read.parquet(path("facts")), spark.read.parquet(path("dimension"))
    assert "BroadcastHashJoin" in plan(joins.lookup(fact, side, "region_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "SortMergeJoin" in plan(joins.lookup(fact, side, "region_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tax_by_region(spark):
    data = [("NORTH", 100.0), ("SOUTH", 100.0), ("EAST", 100.0), ("WEST", 100.0), ("MOON", 100.0), (None, 100.0), ("EAST", None)]
    taxed = business.add_tax(spark.createDataFrame(data, "region string, value double")).collect()
    assert [r.tax_rate for r in taxed] == [0.08, 0.07, 0.09, 0.095, 0.1, 0.1, 0.09]
    assert taxed[3].tax_amount == 100.0 * 0.095 and taxed[3].value_with_tax == 100.0 + 100.0 * 0.095
    assert taxed[6].tax_amount is None and taxed[6].value_with_tax is None


def test_calendar_and_filters(spark):
    data = [(DAY[0], "NORTH", 1000.0), (None, "EAST", 1000.5), (DAY[3], "SOUTH", None)]
    df = spark.createDataFrame(data, "data_date timestamp, region string, value double")
    assert [(r.month, r.year) for r in business.add_calendar(df).collect()] == [("January", "2024"), (None, None), ("April", "2024")]
    assert business.high_value(df).count() == 1
    assert business.priority_regions(df).count() == 2


def test_silver_job(spark, tmp_path, path):
    source = "date,region,category,value,region_id\n" + "\n".join(
        f"2024-0{1 + i % 3}-1{i % 2},X,{'ab'[i % 2]},{101 + i},{i % 5}" for i in range(30)
    )
    (tmp_path / "sales.csv").write_text(source + "\n")
    (tmp_path / "regions.csv").write_text("id,region\n0,NORTH\n1,SOUTH\n2,EAST\n3,WEST\n")
    run_ingestion(spark, path("sales.csv"), path("bronze"))
    targets = {name: path(name) for name in TARGETS}
    assert run_silver(spark, path("bronze"), path("regions.csv"), targets) == targets
    main = spark.read.parquet(targets["main"])
    assert main.count() == 300
    assert {r.region for r in main.select("region").distinct().collect()} == {"NORTH", "SOUTH", "EAST", "WEST", None}
    daily = spark.read.parquet(targets["daily_agg"])
    assert daily.columns == ["data_date", "region", "total_value", "avg_value", "transaction_count", "value_misfits", "running_total"]
    assert daily.agg(F.max("running_total")).first()[0] == main.agg(F.sum("value")).first()[0]
    assert spark.read.parquet(targets["category_metrics"]).agg(F.sum("count")).first()[0] == 300
    assert spark.read.parquet(targets["export"]).count() == 300


def test_frequent_keys_without_a_shuffle_of_keys(spark):
    key = F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 10 == 1, 11).when(F.col("id") % 50 == 2, None).otherwise(100 + F.col("id"))
    fact = spark.range(40_000).select("id", key.alias("k"))
    found = joins.frequent_keys(fact, "k", 5)
    assert "Exchange hashpartitioning" not in plan(found)
    shares = {r.k: r.share for r in found.collect()}
    exact = {r.k: r["count"] / 40_000 for r in fact.groupBy("k").count().collect()}
    assert set(shares) >= {7, 11} and len(shares) <= 5
    assert all(abs(shares[k] - exact[k]) <= 1 / (24 * 5) for k in shares)
    assert joins.frequent_keys(fact.limit(0), "k", 5).count() == 0


def test_parts_of_a_key_follow_its_share(spark, facts, dimension):
    salted = joins.salted_lookup(facts.withColumn("region_id", F.coalesce("region_id", F.lit(2))), dimension, "region_id", ["id"], 8, 10)
    text = plan(salted)
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text
    assert salted.count() == 3000
