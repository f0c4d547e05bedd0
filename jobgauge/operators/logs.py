"""Log mining."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgauge.rules import WARNING_MARKERS

# Formats of the run logs. Lines are separated by the two characters backslash and n.
LINE_BREAK = r"\\n"
LEVEL_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEVEL_END = ": "
WARNING = "WARN" + LEVEL_END
ROWS_FORMAT = r"Processed ([0-9,]+) rows"
CATEGORIES_FORMAT = r"Found ([0-9,]+) distinct categories"
SPILL_MARKER = "Shuffle spill"
SPILL_FORMAT = r"Shuffle spill \(memory\) of ([0-9.]+) GB and \(disk\) of ([0-9.]+) GB"


def log_lines(runs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per log line, with its level in capitals, if any, and its message."""
    lines = F.posexplode(F.split("output", LINE_BREAK)).alias("line_no", "line")
    split = runs.select("job_id", "start_time", *keep, lines)
    line = F.col("line")
    head = F.substring_index(line, LEVEL_END, 1)
    has_level = (head != line) & (head != "") & (F.translate(head, LEVEL_LETTERS, "") == "")
    message = F.substring(line, F.length(head) + len(LEVEL_END) + 1, F.length(line))
    return split.select(
        "job_id",
        "start_time",
        *keep,
        "line_no",
        F.when(has_level, head).alias("level"),
        F.when(has_level, message).otherwise(line).alias("message"),
    )


def warning_counts(runs: DataFrame, markers: Mapping[str, str] = WARNING_MARKERS) -> DataFrame:
    """Per job, how many warning lines hold each marker; 0 for jobs without warnings. Lines are counted in their log."""
    lines = F.filter(F.split("output", LINE_BREAK), lambda line: line.startswith(WARNING))
    warnings = F.when(F.contains("output", F.lit(WARNING)), lines)
    found = runs.filter(F.col("job_id").isNotNull()).select("job_id", warnings.alias("lines"))

    def held(text: str) -> Column:
        return F.size(F.filter("lines", lambda line: F.contains(line, F.lit(text))))

    counts = {"warnings": F.size("lines"), **{name: held(text) for name, text in markers.items()}}
    return found.groupBy("job_id").agg(
        *[F.sum(F.when(F.col("lines").isNull(), 0).otherwise(count)).alias(name) for name, count in counts.items()]
    )


def log_metrics(runs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Numbers the logs report; NULL where a log does not report one."""
    return runs.select(
        "job_id",
        "start_time",
        *keep,
        _whole_number(ROWS_FORMAT).alias("rows_processed"),
        _whole_number(CATEGORIES_FORMAT).alias("distinct_categories"),
        _spill(1).alias("spill_memory_gb"),
        _spill(2).alias("spill_disk_gb"),
    )


def _whole_number(pattern: str) -> Column:
    digits = F.replace(F.regexp_extract("output", pattern, 1), F.lit(","), F.lit(""))
    return digits.try_cast("bigint")


def _spill(group: int) -> Column:
    """Few logs report a spill, and a plain search rules the others out faster than the pattern."""
    amount = F.regexp_extract("output", SPILL_FORMAT, group).try_cast("double")
    return F.when(F.contains("output", F.lit(SPILL_MARKER)), amount)
