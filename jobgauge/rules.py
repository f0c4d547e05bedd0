"""Tunable rules with the default numbers."""

from dataclasses import dataclass, field


# The defaults of the three rule sets below.


@dataclass(frozen=True)
class SalesRules:
    ingest_min_value: float = 100
    high_value: float = 1000
    priority_regions: tuple[str, ...] = ("NORTH", "SOUTH")
    tax_rates: dict[str, float] = field(
        default_factory=lambda: {"NORTH": 0.08, "SOUTH": 0.07, "EAST": 0.09, "WEST": 0.095}
    )
    default_tax_rate: float = 0.10
    reference_rows: int = 10


@dataclass(frozen=True)
class AdvisorRules:
    min_runs: int = 2
    high_minutes: float = 30.0
    spike_ratio: float = 1.5
    worker_limit: int = 4
    worker_growth: float = 1.5
    worker_floor: int = 2
    worker_hourly_rate: float = 0.5
    # Texts whose presence in a log marks a failed run.
    error_patterns: tuple[str, ...] = ("OutOfMemoryError", "SparkException", "Error:", "Exception:")


@dataclass(frozen=True)
class ConfiguredThresholds:
    """The alternative threshold set: two average limits, a fixed worker step, full node rates."""

    high_minutes: float = 40.0
    medium_minutes: float = 20.0
    worker_step: int = 2
    worker_hourly_rate: float = 0.5
    driver_hourly_rate: float = 0.7
    cost_reduction_percent: float = 15.0


# Wording of the recommendations and hints.
LONG_RUNNING_TEXT = "Consider increasing cluster size or optimizing code"
SKEW_TEXT = "Job has inconsistent performance, check for data skew"
ACCEPTABLE_TEXT = "Performance acceptable"
MORE_WORKERS_SUFFIX = "; increase worker count"
FIX_ERRORS_SUFFIX = "; fix errors: "

LONG_RUNNING_HINTS = (
    "Consider using broadcast joins for small tables",
    "Evaluate partition count and size",
    "Review any UDFs for optimization opportunities",
)
SKEW_HINTS = (
    "Add salting for skewed join keys",
    "Consider repartitioning before join operations",
    "Review any aggregations that might cause skew",
)

# Paths and texts of the change documents. The placeholders of CHANGE_BODY are the job name, the current
# and the suggested driver size, worker size and worker count, the recommendation, the average and the severity.
CONFIG_PATH = "jobs/%s/job_config.json"
HINTS_PATH = "jobs/%s/OPTIMIZATIONS.md"
HINTS_HEADER = "# Optimization Suggestions for %s\n\n## Suggested Code Changes\n\n"
HINTS_BULLET = "- "
BRANCH_PREFIX = "optimize-job"
COMMIT_TEXTS = {"update": "Optimize configuration for job %s", "create": "Add configuration for job %s"}
HINTS_COMMIT_TEXT = "Add optimization suggestions for job %s"
NO_DATA_TEXT = "No job data loaded"
CHANGE_TITLE = "Optimize job %s (ID: %s)"
CHANGE_BODY = """# Job Optimization PR

This PR contains suggested optimizations for job **%s**.

## Current Configuration
- Driver Size: %s
- Worker Size: %s
- Workers: %s

## Suggested Configuration
- Driver Size: %s
- Worker Size: %s
- Workers: %s

## Recommendation
%s

## Performance Analysis
- Average Runtime: %s minutes
- Priority: %s"""

# Known log warnings, by the text that marks them.
WARNING_MARKERS = {
    "scheduling_delay": "executor scheduling",
    "cartesian_join": "cartesian join",
    "skew": "skew",
    "shuffle_spill": "Shuffle spill",
}

SALES_DEFAULTS = SalesRules()
ADVISOR_DEFAULTS = AdvisorRules()
CONFIGURED_DEFAULTS = ConfiguredThresholds()
