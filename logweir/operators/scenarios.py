"""Scenario checks: expectations of a test run as rows of (scenario, metric, expected, actual).

``scenario_report`` measures a run once and compares the values with a list of expectations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.quality import log_gaps


@dataclass(frozen=True)
class Expectation:
    """``metric`` must be ``test`` (<, <=, =, >=, >) ``bound``; = allows for ``tolerance`` either way."""

    scenario: str
    metric: str
    test: str
    bound: int
    tolerance: int = 0

    @property
    def text(self) -> str:
        return f"{self.test} {self.bound}" + (f" +- {self.tolerance}" if self.tolerance else "")


# The expected-results tables of the five scenarios.
EXPECTATIONS = (
    Expectation("normal_load", "dlq_messages", "=", 0),
    Expectation("normal_load", "max_latest_lag", "<", 50),
    Expectation("normal_load", "error_rate_basis_points", "<", 1500),
    Expectation("normal_load", "throughput_windows", ">", 0),
    Expectation("malformed_logs", "malformed_basis_points", "=", 3000),
    Expectation("malformed_logs", "unaccounted_messages", "=", 0),
    Expectation("malformed_logs", "empty_failure_reasons", "=", 0),
    Expectation("malformed_logs", "retried_schema_failures", "=", 0),
    Expectation("traffic_spike", "pause_events", ">", 0),
    Expectation("traffic_spike", "resume_events", ">", 0),
    Expectation("traffic_spike", "max_lag", ">=", 500),
    Expectation("traffic_spike", "partitions_not_recovered", "=", 0),
    Expectation("slow_consumer", "max_lag", "<=", 1000),
    Expectation("slow_consumer", "pause_events", ">", 0),
    Expectation("slow_consumer", "resume_events", ">", 0),
    Expectation("slow_consumer", "unaccounted_messages", "=", 0),
    Expectation("worker_failure", "log_gaps", "=", 0),
    Expectation("worker_failure", "max_latest_lag", "<", 100),
)


def holds(e: Expectation, actual: Column) -> Column:
    """Whether ``actual`` meets the expectation."""
    return {
        "<": actual < e.bound, "<=": actual <= e.bound, ">=": actual >= e.bound, ">": actual > e.bound,
        "=": actual.between(e.bound - e.tolerance, e.bound + e.tolerance),
    }[e.test]


def measurements(
    validated: DataFrame, letters: DataFrame, reconciled: DataFrame, counts: DataFrame,
    latest: DataFrame, recovery: DataFrame, turns: DataFrame, gap_seconds: int,
) -> DataFrame:
    """(metric, actual) rows. Each input is aggregated once to one row and unpivoted."""
    whole = F.lit(0).cast("bigint")

    def rows(df: DataFrame, **metrics) -> DataFrame:
        named = df.agg(*[F.coalesce(c.cast("bigint"), whole).alias(n) for n, c in metrics.items()])
        return named.unpivot([], list(metrics), "metric", "actual")

    n = F.count(F.lit(1))
    bad = F.count_if(F.col("rule").isNotNull())
    schema_failure = F.col("failure_reason").startswith("JSON schema validation failed")
    parts = [
        rows(validated,
             malformed_basis_points=F.when(n > 0, F.call_function("div", bad * 10000, n))),
        rows(reconciled, unaccounted_messages=F.max("missing")),
        rows(letters,
             dlq_messages=n,
             empty_failure_reasons=F.count_if(F.coalesce(F.col("failure_reason"), F.lit("")) == ""),
             retried_schema_failures=F.count_if(schema_failure & (F.col("retry_count") > 0))),
        rows(counts,
             throughput_windows=n,
             error_rate_basis_points=F.when(F.sum("total_messages") > 0, F.call_function(
                 "div", F.sum("error_messages") * 10000, F.sum("total_messages")))),
        rows(latest, max_latest_lag=F.max("lag")),
        rows(recovery,
             max_lag=F.max("peak_lag"),
             partitions_not_recovered=F.count_if(~F.col("recovered_in_time"))),
        rows(turns,
             pause_events=F.count_if(F.col("action") == "PAUSE"),
             resume_events=F.count_if(F.col("action") == "RESUME")),
        rows(log_gaps(validated.filter(F.col("rule").isNull()), gap_seconds), log_gaps=n),
    ]
    return reduce(DataFrame.unionByName, parts)


def scenario_report(
    measured: DataFrame, expectations: Sequence[Expectation] = EXPECTATIONS
) -> DataFrame:
    """One row per expectation on a measured metric: scenario, metric, expected, actual, passed.

    The expectations of a metric are attached to its row as an array and exploded.
    """
    by_metric: dict[str, list[Expectation]] = {}
    for e in expectations:
        by_metric.setdefault(e.metric, []).append(e)
    attached = F.coalesce(*[
        F.when(F.col("metric") == metric, F.array(*[
            F.struct(F.lit(e.scenario).alias("scenario"), F.lit(e.text).alias("expected"),
                     holds(e, F.col("actual")).alias("passed"))
            for e in wanted]))
        for metric, wanted in by_metric.items()
    ])
    return (
        measured.select("metric", "actual", F.inline(attached))
        .select("scenario", "metric", "expected", "actual", "passed")
    )
