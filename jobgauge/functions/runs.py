"""Column expressions of job runs."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEVERITY_RANKS = {"HIGH": 0, "MEDIUM": 1}


_CONFIGURATION = "array<struct<cluster_config: struct<driver_node_type_id: string, node_type_id: string, num_workers: string>>>"


def config_fields(configuration: Column) -> Column:
    """Struct (readable, driver_size, worker_size, num_workers) of a JSON configuration.

    `readable` is false for NULL, malformed and non-object documents; their fields, and missing ones, get defaults. Of a
    repeated key the last one counts. Wrapping the text in brackets makes trailing content a syntax error, which the
    plain parser would ignore. The document is parsed once: the array function binds it to a variable.
    """
    documents = F.from_json(F.concat(F.lit("["), configuration, F.lit("]")), _CONFIGURATION, {"allowSingleQuotes": "false"})
    is_object = F.coalesce(F.trim(configuration).like("{%}"), F.lit(False))

    def fields(found: Column) -> Column:
        readable = is_object & F.coalesce(F.size(found) == 1, F.lit(False))
        cluster = F.when(readable, F.get(found, F.lit(0))["cluster_config"])
        workers = cluster["num_workers"].try_cast("double").try_cast("int")
        return F.struct(
            readable.alias("readable"),
            F.coalesce(cluster["driver_node_type_id"], F.lit("unknown")).alias("driver_size"),
            F.coalesce(cluster["node_type_id"], F.lit("unknown")).alias("worker_size"),
            F.coalesce(workers, F.lit(0)).alias("num_workers"),
        )

    return F.get(F.transform(F.array(documents), fields), F.lit(0))


def matching_patterns(output: Column, patterns: Sequence[str]) -> Column:
    """The patterns a log contains, in list order, joined by commas; empty for a missing log."""
    return F.concat_ws(", ", *[F.when(F.contains(output, F.lit(p)), F.lit(p)) for p in patterns])


def severity_rank(severity: Column) -> Column:
    """0 for HIGH, 1 for MEDIUM, 2 for the rest."""
    rank = F.lit(2)
    for name, value in SEVERITY_RANKS.items():
        rank = F.when(severity == name, F.lit(value)).otherwise(rank)
    return rank


def grown_workers(workers: Column, growth: float, floor: int) -> Column:
    """Worker count times `growth`, fraction cut off, but at least `floor`."""
    return F.greatest(F.lit(floor), (workers * F.lit(growth)).cast("int"))


def run_cost(workers: Column, minutes: Column, hourly_rate: float) -> Column:
    return workers * minutes / F.lit(60) * F.lit(hourly_rate)


def one_decimal(value: Column) -> Column:
    """Text with one decimal, half-way cases to the even digit."""
    return F.call_function("format_number", value, F.lit("0.0"))
