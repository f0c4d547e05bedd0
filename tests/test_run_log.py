"""Run logs whose quoted fields hold line breaks, at any split size, and one parse per line."""

import random

import pytest

from helpers import plan
from jobgauge import schemas
from jobgauge.sources import run_log, scratch

CONFIGURATION = '{"cluster_config": {"num_workers": 3}}'


def _log(rng, count):
    """Text of a log, the (job_id, output) in it, and the lines that belong to no run."""
    text, runs, rejected = [run_log.HEADER], [], []
    for job in range(count):
        kind = rng.random()
        parts = rng.choices(["INFO: a", 'say ""x""', "", "1,2,3", run_log.HEADER, "é, b", '""'], k=rng.randint(1, 6))
        name = rng.choice(["etl", '"two, parts"'])
        line = f'{job},{name},{CONFIGURATION},{job}.5,2024-01-01 00:00:00,,"'
        if kind < 0.85:
            text.append(line + "\n".join(parts) + '"')
            runs.append((job, "\n".join(parts).replace('""', '"') or None))
        elif kind < 0.95:
            text += ["no record", ""]
            rejected.append("no record")
        else:
            text += ["a field, \"that nobody", f"closes {job}", f'{job},whole,{CONFIGURATION},1,,,"x"']
            rejected += ["a field, \"that nobody", f"closes {job}"]
            runs.append((job, "x"))
    return "\n".join(text) + "\n", runs, rejected


@pytest.mark.parametrize("split_bytes", [300, 1500, 1 << 20])
def test_records_over_lines_at_any_split_size(spark, tmp_path, split_bytes):
    rng = random.Random(split_bytes)
    folder, runs, rejected = tmp_path / "log", [], []
    folder.mkdir()
    for i in range(2):
        text, own, others = _log(rng, 25)
        (folder / f"{i}.csv").write_text(text)
        runs += own
        rejected += others
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for name in before:
        spark.conf.set(name, str(split_bytes))
    try:
        read = run_log.read_run_records(spark, str(folder))
        found = [(r.job_id, r.output) for r in read.runs.collect()]
        left = [r.line for r in read.rejected.collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(found, key=repr) == sorted(runs, key=repr)
    assert sorted(left) == sorted(rejected)
    assert read.runs.schema.fieldNames() == schemas.RUNS.fieldNames()


@pytest.mark.parametrize("bits", [0, 1, 4])
def test_records_over_lines_in_short_chunks(spark, tmp_path, monkeypatch, bits):
    """Windows over lines see a chunk, not a whole file split, which may be most of a file."""
    rng = random.Random(bits)
    folder, runs, rejected = tmp_path / "log", [], []
    folder.mkdir()
    for i in range(2):
        text, own, others = _log(rng, 30)
        (folder / f"{i}.csv").write_text(text)
        runs += own
        rejected += others
    monkeypatch.setattr(run_log, "_CHUNK_BITS", bits)
    made = {}
    monkeypatch.setattr(run_log, "written", lambda df, label: made.setdefault(label, df) and scratch.written(df, label))
    read = run_log.read_run_records(spark, str(folder))
    assert sorted([(r.job_id, r.output) for r in read.runs.collect()], key=repr) == sorted(runs, key=repr)
    assert sorted(r.line for r in read.rejected.collect()) == sorted(rejected)
    of_lines = [line for line in plan(made["loose-lines"]).splitlines() if "Window [" in line]
    assert of_lines and all("chunk#" in line for line in of_lines)


def test_lines_with_few_commas_are_not_parsed(spark):
    """The lines inside an output have few commas; a line of seven fields has six, whatever they hold."""
    lines = [",,,,,,", "1,a,,1,,,", ",,,,,", "INFO: Processed 1,234 rows", "\u0001".join("1234567"), "1,a,{},1,,,"]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    found = df.select("value", run_log._maybe_record("value").alias("maybe"), run_log._record("value").isNotNull().alias("is")).collect()
    assert {r.value for r in found if r.maybe} == {lines[0], lines[1], lines[4], lines[5]}
    assert all(r.maybe for r in found if r["is"]) and any(r["is"] for r in found)


def test_an_empty_log_gives_empty_tables(spark, tmp_path):
    (tmp_path / "log.csv").write_text(run_log.HEADER + "\n\n")
    read = run_log.read_run_records(spark, str(tmp_path / "log.csv"))
    assert read.runs.count() == 0 and read.rejected.count() == 0


@pytest.mark.parametrize("view", [run_log.parse_run_lines, run_log.split_run_lines, run_log.rejected_run_lines, run_log.run_line_counts])
def test_a_line_is_parsed_once(spark, view):
    text = plan(view(spark.createDataFrame([("1,a,,1,,,",)], "line string")))
    assert text.count("regexp_replace(") == 1
