"""Table writes."""

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

MAX_RECORDS_PER_FILE = 20_000_000


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    rebalance: bool = True,
) -> None:
    """Write Parquet, optionally partitioned.

    A partitioned write is rebalanced on its partition columns first: each directory gets few files, and adaptive
    execution splits a directory that holds a large share of the rows over many tasks. Without `rebalance` each task
    writes its own files to the directories of its rows, and nothing is shuffled.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_tables(tables: Mapping[str, DataFrame], at_once: int = 4) -> None:
    """Write several tables, keyed by path. A few jobs run side by side, as a small one leaves most executors idle."""
    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(lambda path: write_table(tables[path], path), tables))


def export_copy(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Copy a table that was read from files, without a shuffle.

    Each scan split becomes one file: no file holds more than spark.sql.files.maxPartitionBytes of the table, and small
    tables give one file for each core at most.
    """
    table.write.mode(mode).parquet(path)


def write_single_file(aggregate: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write one file. Only for aggregates whose row count does not grow with the input.

    The rows are brought together after the aggregate, whose last stage keeps its tasks.
    """
    aggregate.repartition(1).write.mode(mode).parquet(path)
