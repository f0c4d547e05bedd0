"""Reader for run tables whose configuration cell is unquoted JSON.

The commas inside the JSON shift every field for an ordinary CSV reader, so lines are matched as text: the two fields
before the configuration and the number and timestamps after it anchor the split. A name is quoted or has no comma; a
configuration is empty, quoted, or starts with a brace. All other lines are rejected.

A quoted field may hold line breaks. `read_run_records` finds the borders of such records in parallel: lines that are whole
records need no others, and of the rest the parity of the quotes before a line tells whether it goes on with a field. The
parity is counted inside short chunks of file splits, and carried over their borders by a table with one row per chunk.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobgauge import schemas
from jobgauge.sources.scratch import written

HEADER = ",".join(schemas.RUNS.fieldNames())
_STAMP = r"(?:\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})?"
_QUOTED = r'"(?:[^"]|"")*+"'
_NAME = rf'{_QUOTED}|[^,"]*+'
_CONFIGURATION = rf'\{{.*?|{_QUOTED}|'
_LINE = rf'(?s)^([^,]*+),({_NAME}),({_CONFIGURATION}),([0-9.]*),({_STAMP}),({_STAMP}),(?:"(.*)")?$'
_MARK = "\u0001"
#: A chunk has two to the power of this many lines at most.
_CHUNK_BITS = 12
_FIELDS = {name: number for number, name in enumerate(schemas.RUNS.fieldNames())}


def read_run_lines(spark: SparkSession, path: str) -> DataFrame:
    """The data lines below `path`, one column `line`; headers and blank lines are left out."""
    return _without_headers(spark.read.text(path).select(F.col("value").alias("line")))


@dataclass(frozen=True)
class RunRecords:
    """runs: rows of the RUNS schema. rejected: the lines, `line`, that belong to none of them."""

    runs: DataFrame
    rejected: DataFrame


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return read_run_records(spark, path).runs


def read_run_records(spark: SparkSession, path: str) -> RunRecords:
    """All runs below `path`, those whose quoted fields hold line breaks included, and the lines that are left.

    A line that is a whole record and closes its quotes always is one, so a quote that nobody closes does harm up to the next such line at most.
    Lines between two of them are records from a line before which all quotes are closed to the next. What does not parse is
    rejected line by line; headers and blank lines outside of records are left out. Every line is parsed once and written;
    only lines that are no record by themselves are shuffled, by chunk, and again by record.
    """
    source = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
        F.when((_quotes("value") % 2 == 0) & _maybe_record("value"), _record("value")).alias("record"),
    )
    parsed = written(source, "run-lines")
    runs = parsed.filter("record IS NOT NULL").select("record.*")
    joined = _spanning(parsed).select(F.array_join("lines.line", "\n").alias("text"), "lines").select("lines", _record("text").alias("record"))
    joined = written(joined, "joined-run-lines")
    loose = joined.filter("record IS NULL").select(F.explode("lines.line").alias("line"))
    return RunRecords(runs.unionByName(joined.filter("record IS NOT NULL").select("record.*")), _without_headers(loose))


def _spanning(parsed: DataFrame) -> DataFrame:
    """Lines that are no record by themselves, as one array `lines` for each record that they may make up."""
    chunk = F.shiftright("at", _CHUNK_BITS).alias("chunk")
    # A chunk may hold the end of one file split and the start of another one: `first` tells them apart.
    ends = parsed.groupBy("file", "block", chunk).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    ends = written(ends, "line-chunks")
    loose = parsed.filter("record IS NULL").select(chunk, "at", "line", (_quotes("line") % 2).alias("quotes"))
    placed = written(_placed(loose, ends), "loose-lines")
    pieces = written(_pieces(placed, ends), "line-pieces").select(F.col("first").alias("of"), "carried", "head")
    keyed = placed.join(pieces, F.col("first") == F.col("of"))
    odd = (F.col("from") == F.col("first")) & (F.col("carried") == 1)
    start = F.coalesce(F.when(odd, F.col("start_odd")).otherwise(F.col("start_even")), "head", "at")
    lines = F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("lines")
    return keyed.groupBy(start.alias("start")).agg(lines)


def _placed(loose: DataFrame, ends: DataFrame) -> DataFrame:
    """The loose lines with the piece of a file split that they are in, by its number `first`, and what that tells of them.

    from: the first of the lines that follow each other directly up to this one, an island. inside: whether an odd number of
    quotes lies between the two. start_even, start_odd: the last line of the island up to this one that begins a record, if
    an even or odd number of quotes lies before the island.
    """
    pieces = ends.select(F.col("chunk").alias("of"), "block", "first", "last")
    within = (F.col("chunk") == F.col("of")) & F.col("at").between(F.col("first"), F.col("last"))
    placed = loose.join(pieces, within).drop("of", "last")
    # All windows have one order, so that a chunk's lines are sorted once.
    order = Window.partitionBy("chunk", "first").orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def last(value: Column) -> Column:
        return F.last(value, ignorenulls=True).over(upto)

    begins = F.coalesce(F.col("at") - F.lag("at").over(order) > 1, F.lit(True))
    placed = placed.withColumns({"begins": begins, "before": F.sum("quotes").over(upto) - F.col("quotes")})
    placed = placed.withColumns({"from": last(F.when(F.col("begins"), F.col("at"))), "base": last(F.when(F.col("begins"), F.col("before")))})
    placed = placed.withColumn("inside", (F.col("before") - F.col("base")) % 2).drop("begins", "before", "base")
    starts = {"start_even": last(F.when(F.col("inside") == 0, F.col("at"))), "start_odd": last(F.when(F.col("inside") == 1, F.col("at")))}
    placed = placed.withColumns(starts)
    return placed.withColumns({name: F.when(F.col(name) >= F.col("from"), F.col(name)) for name in starts})


def _pieces(placed: DataFrame, ends: DataFrame) -> DataFrame:
    """Per piece: carried, the parity of the open quotes before it, and head, the last line before it that begins a record."""
    tail = F.max(F.struct("at", "from", ((F.col("inside") + F.col("quotes")) % 2).alias("odd"), "start_even", "start_odd")).alias("tail")
    last_lines = placed.groupBy(F.col("first").alias("of")).agg(tail)
    joined = ends.join(last_lines, F.col("first") == F.col("of"), "left")
    touches = F.coalesce(F.col("tail.at") == F.col("last"), F.lit(False))
    pieces = joined.select(
        "file",
        "block",
        "first",
        F.when(touches, F.col("tail.odd")).otherwise(0).alias("odd"),
        (touches & (F.col("tail.from") == F.col("first"))).alias("whole"),
        F.when(touches, F.col("tail.start_even")).alias("even_tail"),
        F.when(touches, F.col("tail.start_odd")).alias("odd_tail"),
    ).withColumn("through", F.coalesce("whole", F.lit(False)))
    by_file = Window.partitionBy("file").orderBy("block", "first")
    # The parity at the end of a piece goes back to the last piece with a whole record in it.
    chain = F.sum(F.when(F.col("through"), 0).otherwise(1)).over(by_file)
    in_chain = Window.partitionBy("file", "chain").orderBy("block", "first")
    pieces = pieces.withColumn("chain", chain).withColumn("odd_end", F.sum("odd").over(in_chain) % 2)
    pieces = pieces.withColumn("carried", F.coalesce(F.lag("odd_end").over(by_file), F.lit(0)))
    tails = F.when(F.col("through") & (F.col("carried") == 1), F.col("odd_tail")).otherwise(F.col("even_tail"))
    before = F.last(tails, ignorenulls=True).over(by_file.rowsBetween(Window.unboundedPreceding, -1))
    return pieces.select("first", "carried", before.alias("head"))


def _maybe_record(column: str) -> Column:
    """False only for lines with too few commas to be a record, which need no parsing."""
    commas = F.length(column) - F.length(F.replace(F.col(column), F.lit(","), F.lit("")))
    return (commas >= len(_FIELDS) - 1) | F.contains(F.col(column), F.lit(_MARK))


def _quotes(column: str) -> Column:
    return F.length(column) - F.length(F.replace(F.col(column), F.lit('"'), F.lit("")))


def _without_headers(lines: DataFrame) -> DataFrame:
    line = F.col("line")
    return lines.filter((line != HEADER) & (F.trim(line) != ""))


def split_run_lines(lines: DataFrame) -> DataFrame:
    """Every line with its record, a struct of the RUNS schema, or NULL where it does not parse completely.

    One pass for both: write the result, then read runs and rejects from it.
    """
    return lines.select("line", _record("line").alias("record"))


def parse_run_lines(lines: DataFrame) -> DataFrame:
    """Rows of the RUNS schema from lines that parse completely; see `run_line_counts` for the others."""
    return lines.select(F.inline(_records("line")))


def rejected_run_lines(lines: DataFrame) -> DataFrame:
    """The lines parse_run_lines leaves out."""
    return lines.filter(F.size(_records("line")) == 0).select("line")


def run_line_counts(lines: DataFrame) -> DataFrame:
    """One row: how many lines parse and how many are rejected."""
    counts = lines.agg(F.count("*").alias("lines"), F.count_if(F.size(_records("line")) == 0).alias("rejected"))
    return counts.select((F.col("lines") - F.col("rejected")).alias("parsed"), "rejected")


def _record(column: str) -> Column:
    return F.get(_records(column), F.lit(0))


def _records(column: str) -> Column:
    """An array with the record of a text column, or an empty one.

    The array functions bind the split line to a variable. As a column of its own it would be computed anew for every
    field and condition that reads it.
    """
    marked = F.regexp_replace(column, _LINE, _MARK.join(f"${group}" for group in range(1, len(_FIELDS) + 1)))
    fields = F.split(marked, _MARK, len(_FIELDS))
    complete = F.filter(F.transform(F.array(fields), _typed), _complete)
    return F.transform(complete, lambda record: F.struct(*[record[name].alias(name) for name in _FIELDS]))


def _text(fields: Column, name: str) -> Column:
    text = F.get(fields, F.lit(_FIELDS[name]))
    return F.when(text != "", text)


def _plain(text: Column) -> Column:
    """A field without its quotes, if it has some."""
    inner = _unquoted(F.substring(text, 2, F.length(text) - 2))
    return F.when(text.startswith('"'), inner).otherwise(text)


def _typed(fields: Column) -> Column:
    stamp = F.lit("yyyy-MM-dd HH:mm:ss")
    return F.struct(
        fields.alias("fields"),
        _text(fields, "job_id").try_cast("bigint").alias("job_id"),
        _plain(_text(fields, "job_name")).alias("job_name"),
        _plain(_text(fields, "configuration")).alias("configuration"),
        _text(fields, "runtime_minutes").try_cast("double").alias("runtime_minutes"),
        F.try_to_timestamp(_text(fields, "start_time"), stamp).alias("start_time"),
        F.try_to_timestamp(_text(fields, "end_time"), stamp).alias("end_time"),
        _unquoted(_text(fields, "output")).alias("output"),
    )


def _complete(record: Column) -> Column:
    """All fields are there, and a typed one is empty or holds text of its type."""
    complete = F.size(record["fields"]) == len(_FIELDS)
    for name in ("job_id", "runtime_minutes", "start_time", "end_time"):
        complete &= record[name].isNotNull() | _text(record["fields"], name).isNull()
    return complete


def _unquoted(text: Column) -> Column:
    return F.replace(text, F.lit('""'), F.lit('"'))
