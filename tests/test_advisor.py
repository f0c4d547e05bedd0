import json

import pytest
from pyspark.sql import functions as F

from helpers import config, plan, rows, run
from jobgauge import schemas
from jobgauge.functions.runs import config_fields, matching_patterns, one_decimal
from jobgauge.operators import advice, changes, costs, reports, summary
from jobgauge.plans.advisor import run_advisor
from jobgauge.rules import ADVISOR_DEFAULTS, LONG_RUNNING_HINTS, AdvisorRules, ConfiguredThresholds

FAILED_LOG = r"INFO: go\nERROR: SparkException: stage lost\nERROR: OutOfMemoryError: no heap"


def runs_of(spark, data):
    return spark.createDataFrame(data, schemas.RUNS)


@pytest.fixture
def golden(spark):
    """Three jobs of three runs with the runtimes, clusters and failures of the reference case."""
    data = [run(1001, m, d, FAILED_LOG if m == 60 else "INFO: fine", config(2, "DS3")) for d, m in enumerate((45, 48, 60), 1)]
    data += [run(2001, m, d, r"WARN: skew seen\nINFO: fine", config(3, "DS4")) for d, m in enumerate((30, 32, 38), 1)]
    data += [run(3001, m, d, "INFO: fine", config(2, "DS3")) for d, m in enumerate((15, 14, 16), 1)]
    return runs_of(spark, data)


def test_golden_analysis(golden):
    analysis = {r.job_id: r for r in costs.job_cost(summary.analyze_runs(golden)).collect()}
    measured = {k: (r.avg_runtime, r.max_runtime, r.min_runtime, r.num_workers, r.severity) for k, r in analysis.items()}
    assert measured == {
        1001: (51.0, 60.0, 45.0, 2, "HIGH"),
        2001: (100 / 3, 38.0, 30.0, 3, "HIGH"),
        3001: (15.0, 16.0, 14.0, 2, "LOW"),
    }
    text = "Consider increasing cluster size or optimizing code; increase worker count"
    all_patterns = "; fix errors: OutOfMemoryError, SparkException, Error:, Exception:"
    assert analysis[1001].recommendation == text + all_patterns
    assert analysis[2001].recommendation == text
    assert analysis[3001].recommendation == "Performance acceptable"
    assert (analysis[1001].driver_size, analysis[2001].worker_size) == ("DS3_driver", "DS4")
    assert {k: r.cost_estimate for k, r in analysis.items()} == {1001: 0.85, 2001: pytest.approx(0.8333333333), 3001: 0.25}


def test_golden_suggestions(golden):
    analysis = summary.analyze_runs(golden)
    suggested = advice.suggest(analysis)
    assert {r.job_id: r.suggested_config.num_workers for r in suggested.collect()} == {1001: 3, 2001: 4, 3001: 2}
    assert {r.job_id: len(r.code_changes) for r in suggested.collect()} == {1001: 3, 2001: 3, 3001: 0}
    assert [r.job_id for r in advice.prioritized(suggested).collect()] == [1001, 2001, 3001]
    assert advice.top_priority(suggested).first().job_id == 1001
    assert rows(reports.report_summary(analysis)) == [(3, 2, 0)]
    assert rows(reports.advisor_status(golden, analysis)) == [("completed", 3, None)]


def test_literal_suggestions_keep_sizes_and_sort_by_name(golden):
    analysis = summary.analyze_runs(golden)
    literal = advice.suggest(analysis, literal=True)
    assert {r.job_id: r.suggested_config.num_workers for r in literal.collect()} == {1001: 2, 2001: 3, 3001: 2}
    assert [r.job_id for r in advice.prioritized(literal, literal=True).collect()] == [3001, 1001, 2001]


def test_golden_runs_under_shifted_columns(spark):
    """Text job ids and unreadable configurations, as a plain CSV reader would deliver them."""
    first = [("DS3", m, "fragment") for m in (45, 48, 60, 15, 14, 16)]
    second = [("DS4", m, "fragment") for m in (30, 32, 38)]
    df = spark.createDataFrame(
        [(k, "n", c, float(m), None, None, FAILED_LOG) for k, m, c in first + second],
        "job_id string, job_name string, configuration string, runtime_minutes double, start_time timestamp, "
        "end_time timestamp, output string",
    )
    analysis = costs.job_cost(summary.analyze_runs(df))
    measured = {r.job_id: (r.avg_runtime, r.max_runtime, r.min_runtime, r.num_workers, r.severity, r.cost_estimate)
                for r in analysis.collect()}
    assert measured == {"DS3": (33.0, 60.0, 14.0, 0, "HIGH", 0.0), "DS4": (100 / 3, 38.0, 30.0, 0, "HIGH", 0.0)}
    assert {r.recommendation for r in analysis.collect()} == {"Consider increasing cluster size or optimizing code"}


CONFIGS = [
    (config(5), (True, "small_driver", "small", 5)),
    ("{}", (True, "unknown", "unknown", 0)),
    ('{"cluster_config": {"num_workers": 1, "num_workers": 4}, "a": 1, "a": 2}', (True, "unknown", "unknown", 4)),
    ('{"cluster_config": null}', (True, "unknown", "unknown", 0)),
    ('{"cluster_config": 5}', (True, "unknown", "unknown", 0)),
    (' {"cluster_config": {"num_workers": null, "node_type_id": "x"}} ', (True, "unknown", "x", 0)),
    (None, (False, "unknown", "unknown", 0)),
    ("", (False, "unknown", "unknown", 0)),
    ("[]", (False, "unknown", "unknown", 0)),
    ("5", (False, "unknown", "unknown", 0)),
    ('{"cluster_config": {"num_wor', (False, "unknown", "unknown", 0)),
    ("{'cluster_config': {}}", (False, "unknown", "unknown", 0)),
    ('{"cluster_config": {}} {"a": 1}', (False, "unknown", "unknown", 0)),
    (' "num_workers": 2}}', (False, "unknown", "unknown", 0)),
]


@pytest.mark.parametrize("text,expected", CONFIGS)
def test_config_fields(spark, text, expected):
    df = spark.createDataFrame([(text,)], "c string")
    assert tuple(df.select(config_fields(F.col("c")).alias("f")).select("f.*").first()) == expected


def test_patterns_keep_list_order_and_case(spark):
    logs = ["ERROR: lost", "x OutOfMemoryError: y", "Exception: SparkException", None, ""]
    df = spark.createDataFrame([(i, log) for i, log in enumerate(logs)], "id int, output string")
    found = df.select(matching_patterns(F.col("output"), ADVISOR_DEFAULTS.error_patterns)).collect()
    assert [r[0] for r in found] == ["", "OutOfMemoryError, Error:", "SparkException, Exception:", "", ""]


def severities(spark, data, rules=ADVISOR_DEFAULTS):
    return {r.job_id: (r.severity, r.recommendation) for r in summary.analyze_runs(runs_of(spark, data), rules).collect()}


def test_edge_jobs(spark):
    data = [run(1, 99)]  # one run only
    data += [run(None, 99), run(None, 99, 2)]  # no job
    data += [run(2, None), run(2, None, 2)]  # no runtimes
    data += [run(3, 30), run(3, 30, 2)]  # exactly the limit
    data += [run(4, 4), run(4, 12, 2)]  # exactly 1.5 times the average
    data += [run(5, 4), run(5, 12.1, 2)]  # just above
    data += [run(6, 40), run(6, 40, 2, configuration="[]", output=FAILED_LOG)]  # unreadable: neither suffix
    data += [run(7, 40), run(7, 40, 2, configuration="{}")]  # no cluster: zero workers
    data += [run(8, 10, output=FAILED_LOG), run(8, 10, 2)]  # only the first run failed
    data += [run(9, 4, 2, output="Error: x"), run(9, 13, 1)]  # a skewed job whose latest run failed
    data += [run(10, None), run(10, 10, 2)]  # one runtime missing still makes two runs
    data += [run(11, 10), (11, "x", config(2), float("nan"), None, None, None)]
    data += [run(12, 10), run(12, 10, 2), (12, "x", config(2), float("inf"), None, None, None)]
    ok, skew = "Performance acceptable", "Job has inconsistent performance, check for data skew"
    long = "Consider increasing cluster size or optimizing code"
    assert severities(spark, data) == {
        2: ("LOW", ok),
        3: ("LOW", ok),
        4: ("LOW", ok),
        5: ("MEDIUM", skew),
        6: ("HIGH", long),
        7: ("HIGH", long + "; increase worker count"),
        8: ("LOW", ok),
        9: ("HIGH", skew + "; fix errors: Error:"),
        10: ("LOW", ok),
        11: ("LOW", ok),
        12: ("LOW", ok),
    }


def test_skew_branch_survives_an_error_severity(spark):
    data = [run(9, 13, 1), run(9, 4, 2, output="Error: x", configuration=config(6))]
    suggestion = advice.suggest(summary.analyze_runs(runs_of(spark, data))).first()
    assert suggestion.severity == "HIGH" and suggestion.suggested_config.num_workers == 6
    assert suggestion.code_changes[0] == "Add salting for skewed join keys"


def test_thresholds_are_parameters(spark):
    data = [run(1, 10), run(1, 10, 2), run(1, 11, 3)]
    rules = AdvisorRules(min_runs=3, high_minutes=10, worker_limit=2, error_patterns=("fine",))
    text = "Consider increasing cluster size or optimizing code; fix errors: fine"
    assert severities(spark, data, rules) == {1: ("HIGH", text)}


def test_first_and_latest_do_not_depend_on_row_order(spark):
    data = [run(1, 10, d, f"log {d}", config(d), name=f"name {d}") for d in range(1, 29)]
    data += [run(1, 10, 28, "log 28", config(99), name="same start")]
    results = {tuple(rows(summary.analyze_runs(runs_of(spark, d).repartition(n)))) for d, n in ((data, 1), (data[::-1], 5))}
    assert len(results) == 1
    (row,) = results.pop()
    assert row[1] == "name 1" and row[7] == 99


def test_no_analysable_job_gives_an_empty_table(spark):
    empty = summary.analyze_runs(runs_of(spark, []))
    assert rows(advice.prioritized(advice.suggest(empty))) == []
    assert rows(reports.report_summary(empty)) == [(0, 0, 0)]
    assert rows(reports.advisor_status(runs_of(spark, []), empty)) == [("failed", None, "No job data loaded")]
    assert rows(reports.advisor_status(runs_of(spark, [run(1, 5)]), empty)) == [("completed", 0, None)]


def test_analysis_shuffles_partial_rows_without_the_log(golden):
    text = plan(summary.analyze_runs(golden))
    assert text.count("Exchange ") == 2 and "Python" not in text
    _, merged, below = text.split("Exchange ")
    assert "max(struct(start_time" in merged  # the second one moves a few finished rows per job
    assert "partial_max(struct(start_time" in below and "output#" not in below.split("Project")[0]


def test_workers_grow_by_half_but_not_below_two(spark):
    data = [run(n, 40, d, configuration=config(n)) for n in (0, 1, 2, 3, 5, 8) for d in (1, 2)]
    suggested = advice.suggest(summary.analyze_runs(runs_of(spark, data))).collect()
    assert {r.job_id: r.suggested_config.num_workers for r in suggested} == {0: 2, 1: 2, 2: 3, 3: 4, 5: 7, 8: 12}


def test_one_decimal(spark):
    values = [0.05, 0.25, 0.35, 0.45, 33.25, 33.75, 51.0, 1234567.85, 100 / 3]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(one_decimal(F.col("v"))).collect()] == [f"{v:.1f}" for v in values]


def test_requested_jobs(spark, golden):
    suggested = advice.suggest(summary.analyze_runs(golden))
    requested = spark.createDataFrame([(1001,), (1001,), (5,)], "job_id long")
    found = advice.suggestions_for(suggested, requested)
    assert sorted((r.job_id, r.severity) for r in found.collect()) == [(5, None), (1001, "HIGH")]


DOCUMENTS = {
    1: '{"z": 1.50, "cluster_config": {"num_workers": 1, "zone": "a"}, "big": 12345678901234567890, "n": 1.0}',
    2: '{"a": [1, {"b": null}]}',
    3: '{"cluster_config": ',
    4: '{"cluster_config": null}',
    5: "[1, 2]",
    6: '"cluster_config"',
    8: None,
}


def test_config_documents(spark):
    data = [run(n, 40, d, configuration=config(4), name="naïve") for n in range(1, 9) for d in (1, 2)]
    suggested = advice.suggest(summary.analyze_runs(runs_of(spark, data)))
    existing = spark.createDataFrame(list(DOCUMENTS.items()), "job_id long, content string")
    changed = {r.job_id: r for r in changes.config_changeset(suggested, existing).collect()}
    cluster = {"driver_node_type_id": "small_driver", "node_type_id": "small", "num_workers": 6}
    for job_id in (3, 4, 5, 6, 7, 8):
        created = {"job_id": job_id, "job_name": "naïve", "cluster_config": cluster}
        assert (changed[job_id].action, changed[job_id].content) == ("create", json.dumps(created, indent=2))
    kept = {"z": 1.5, "cluster_config": {"num_workers": 6, "zone": "a"}, "big": 12345678901234567890, "n": 1.0}
    assert (changed[1].action, changed[1].content) == ("update", json.dumps(kept, indent=2))
    extended = {"a": [1, {"b": None}], "cluster_config": cluster}
    assert (changed[2].action, changed[2].content) == ("update", json.dumps(extended, indent=2))
    assert changed[1].path == "jobs/1/job_config.json"


def test_hint_documents_and_descriptions(golden):
    suggested = advice.suggest(summary.analyze_runs(golden))
    documents = {r.job_id: r for r in changes.hints_documents(suggested).collect()}
    assert set(documents) == {1001, 2001}
    header = "# Optimization Suggestions for job 1001\n\n## Suggested Code Changes\n\n"
    assert documents[1001].content == header + "".join(f"- {hint}\n" for hint in LONG_RUNNING_HINTS)
    described = {r.job_id: r for r in changes.change_descriptions(suggested).collect()}
    assert described[2001].title == "Optimize job job 2001 (ID: 2001)"
    assert "- Average Runtime: 33.3 minutes\n- Priority: HIGH" in described[2001].body
    assert "## Suggested Configuration\n- Driver Size: DS4_driver\n- Worker Size: DS4\n- Workers: 4" in described[2001].body
    branch = changes.branch_names(suggested).filter("job_id = 1001").first().branch
    assert branch.startswith("optimize-job-1001-20") and len(branch) == len("optimize-job-1001-") + 14


def test_report_details(golden):
    details = reports.report_details(advice.suggest(summary.analyze_runs(golden))).collect()
    assert sorted((r.job_id, -1 if r.change_no is None else r.change_no) for r in details) == [
        (1001, 0), (1001, 1), (1001, 2), (2001, 0), (2001, 1), (2001, 2), (3001, -1),
    ]


def test_configured_thresholds_and_costs(golden):
    found = summary.configured_severity(summary.summarize_runs(golden), ConfiguredThresholds())
    assert {r.job_id: (r.severity, r.suggested_workers) for r in found.collect()} == {
        1001: ("HIGH", 4), 2001: ("MEDIUM", 3), 3001: ("LOW", 2),
    }
    full = {r.job_id: r.total_cost for r in costs.full_job_cost(golden).collect()}
    per_run = costs.full_run_cost(golden).groupBy("job_id").agg(F.sum("run_cost")).collect()
    assert full == pytest.approx({r[0]: r[1] for r in per_run})
    assert full[1001] == pytest.approx(1.7 * 153 / 60)
    targets = costs.cost_target(costs.job_cost(summary.analyze_runs(golden))).collect()
    assert {r.job_id: r.target_cost for r in targets} == pytest.approx({1001: 0.7225, 2001: 0.70833333, 3001: 0.2125})


def test_advisor_run_writes_every_table(spark, golden, path):
    status = run_advisor(spark, golden, path("out"), batch_id=1)
    assert rows(status) == [("completed", 3, None, path("out"))]
    counts = {name: spark.read.parquet(f"{path('out')}/{name}").count() for name in (
        "analysis", "suggestions", "top_priority", "report_summary", "report_jobs", "report_details", "chart_runtime",
        "chart_scatter", "chart_cost", "config_changes", "hint_documents", "change_descriptions", "history",
        "top_change_request",
    )}
    assert list(counts.values()) == [3, 3, 1, 1, 3, 7, 3, 3, 3, 3, 2, 3, 3, 1]
