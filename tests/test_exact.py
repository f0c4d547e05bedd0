"""Exact sums over the whole range of doubles, against fractions."""

import datetime as dt
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from helpers import plan
from jobgauge.functions.exact import exact_aggregate, exact_parts
from jobgauge.operators import totals

CORNERS = [
    [5e17] * 1000, [1e-19] * 10, [1e300, 1.0, -1e300], [-0.1] * 7, [5e-324] * 3, [1.7e308, 1.7e308, -1.7e308], [0.0, -0.0],
    [2.0**53, 1.0, 2.0**-200], [2.0**53, 1.0, -(2.0**-200)], [1e308, 1e308], [-1e308, -1e308], [-5e-324, 1.0], [2.0**-1022, -5e-324],
]


def _expected(values):
    total = sum(map(Fraction, values))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def _groups():
    rng = random.Random(11)
    groups = list(CORNERS)
    for _ in range(150):
        exponent = rng.choice([0, 2, rng.randint(-320, 300)])
        values = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.choice([exponent, 0]) for _ in range(rng.randint(1, 60))]
        groups.append(values + [-v for v in values[: rng.choice([0, 0, len(values) - 1])]])
    return groups


@pytest.mark.parametrize("seed", [1, 2])
def test_sums_equal_fractions_in_any_order(spark, seed):
    groups = _groups()
    rows = [(g, v) for g, values in enumerate(groups) for v in values]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, v double").repartition(2 + seed)
    out = exact_aggregate(df, ["g"], {"total": F.col("v")}, {"top": (F.max("v"), F.max)}).collect()
    assert {r.g: (r.total, r.total_count, r.top) for r in out} == {
        g: (_expected(values), len(values), max(values)) for g, values in enumerate(groups)
    }


def test_values_that_are_no_number_are_left_out(spark):
    rows = [("a", "1.5"), ("a", "x"), ("a", None), ("b", "NaN"), ("b", "Infinity"), (None, "2"), (None, "3")]
    df = spark.createDataFrame(rows, "g string, v string")
    out = {r.g: (r.total, r.total_count) for r in exact_aggregate(df, ["g"], {"total": F.col("v")}).collect()}
    assert out == {"a": (1.5, 1), "b": (None, 0), None: (5.0, 2)}
    assert exact_aggregate(df.limit(0), ["g"], {"total": F.col("v")}).count() == 0


def test_two_sums_of_different_sizes(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("g"), F.pow(F.lit(2.0), F.col("id") - 150).alias("a"), (1 / (F.col("id") + 1)).alias("b"))
    out = {r.g: (r.a, r.b, r.n) for r in exact_aggregate(df, ["g"], {"a": F.col("a"), "b": F.col("b")}, {"n": (F.count("*"), F.sum)}).collect()}
    for g in range(3):
        ids = range(g, 300, 3)
        assert out[g] == (_expected([2.0 ** (i - 150) for i in ids]), _expected([1 / (i + 1) for i in ids]), 100)


def test_parts_at_the_borders_of_bins(spark):
    edges = [sign * math.ldexp(m, e) for e in range(-1070, 1000, 32) for e in (e, e + 21) for m in (0.5, 1 - 2**-53, 1.0) for sign in (1, -1)]
    edges += [math.ldexp(m, e) for e in range(-110, 150) for m in (1.0, 1 - 2**-53, 1 + 2**-52)]
    df = spark.createDataFrame([(v,) for v in [*edges, 0.0, -0.0, None, math.nan, math.inf]], "v double")
    found = df.select("v", exact_parts(F.col("v")).alias("parts")).collect()
    assert len(found) == len(edges) + 5
    for v, parts in found:
        if v is None or not math.isfinite(v):
            assert parts is None
        else:
            assert (Fraction(parts.high) * 2**40 + parts.low) * Fraction(2) ** (32 * parts.bin) == Fraction(v)
            assert abs(parts.high) < 2**46 and 0 <= parts.low < 2**40


def test_parts_of_usual_numbers_need_no_logarithm(spark):
    """Logarithms and powers stand once each, in the branch for numbers that are very small or large."""
    text = plan(spark.range(1).select(exact_parts(F.col("id").cast("double")).alias("parts")))
    assert text.upper().count("LOG2(") <= 2 and text.upper().count("POWER(") <= 4


def test_rows_are_added_before_they_are_shuffled(spark):
    df = spark.range(1000).select((F.col("id") % 5).alias("g"), F.col("id").cast("double").alias("v"))
    text = plan(exact_aggregate(df, ["g"], {"total": F.col("v")}))
    assert "Python" not in text
    assert "HashAggregate" in text.split("Exchange ")[-1]  # a partial aggregate below the first exchange


def test_running_totals_far_apart(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (start + dt.timedelta(days=rng.randrange(200)), rng.choice("xyz"), rng.choice([-1, 1]) * 10.0 ** rng.randint(-200, 200)) for _ in range(400)
    ]
    rows += [(start - dt.timedelta(days=1), "x", None)]
    df = spark.createDataFrame(rows, "data_date timestamp, region string, value double")
    daily = totals.daily_totals(df)
    by_day = {(r.data_date, r.region): r.total_value for r in daily.collect()}
    for r in totals.with_running_total(daily).collect():
        upto = [v for (day, _), v in by_day.items() if day <= r.data_date and v is not None]
        assert r.running_total == (_expected(upto) if upto else None)
    for r in totals.with_regional_running_total(daily).collect():
        upto = [v for (day, region), v in by_day.items() if day <= r.data_date and region == r.region and v is not None]
        assert r.running_total == (_expected(upto) if upto else None)
