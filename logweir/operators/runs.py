"""Runs of test scenarios: found by their silences, measured one by one, judged by their own scenario.

A run is a stretch of one scenario's activity without a silence of more than ``run_gap`` seconds. Two
instants within one cell of that width are never further apart, so a run always begins at the first
instant of a cell: activity is reduced to a row for each scenario and cell, the cells are compared in
order, and every row finds its run by equality of scenario and cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.functions.text import is_error
from logweir.operators.backpressure import pause_resume_events
from logweir.operators.lag import lag_recovery, latest_lag
from logweir.operators.scenarios import EXPECTATIONS, Expectation, holds
from logweir.session import cut_lineage
from logweir.settings import (
    BUFFER_HIGH_WATER, BUFFER_LOW_WATER, LAG_BASELINE, LOG_GAP_SECONDS, RECOVERY_SECONDS, WINDOW_SECONDS)

SCENARIO, RUN = "scenario", "run_start"

#: A single run is held to more than the measurements of a whole table can be: shares are met within
#: a tolerance, and only malformed logs may leave dead letters.
RUN_EXPECTATIONS = tuple(
    replace(e, tolerance=300) if e.metric == "malformed_basis_points" else e for e in EXPECTATIONS
) + (
    Expectation("traffic_spike", "dlq_messages", "=", 0),
    Expectation("traffic_spike", "max_lag", "<=", 2000),
    Expectation("traffic_spike", "unaccounted_messages", "=", 0),
    Expectation("slow_consumer", "dlq_messages", "=", 0),
    Expectation("slow_consumer", "partitions_not_recovered", "=", 0),
    Expectation("worker_failure", "dlq_messages", "=", 0),
    Expectation("worker_failure", "unaccounted_messages", "=", 0),
)


def _cell(time_col: str, seconds: int) -> Column:
    """Number of the stretch of ``seconds`` that an instant lies in."""
    width = F.lit(seconds * 1_000_000).cast("bigint")
    micros = F.unix_micros(time_col)
    return F.call_function("div", micros - F.pmod(micros, width), width)


def run_cells(activity: Sequence[tuple[DataFrame, str]], run_gap: int) -> DataFrame:
    """(scenario, cell, run_start, run_end) for each cell in which a scenario was active.

    ``activity`` lists frames with their time columns. Each is counted down to its cells on the map
    side; what is put in order is one row for each cell of a scenario, however many messages it had.
    """
    width = F.lit(run_gap * 1_000_000).cast("bigint")
    seen = reduce(DataFrame.unionByName, [
        df.filter(F.col(at).isNotNull()).select(SCENARIO, _cell(at, run_gap).alias("cell"), F.unix_micros(at).alias("at"))
        for df, at in activity])
    cells = seen.groupBy(SCENARIO, "cell").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    in_order = W.partitionBy(SCENARIO).orderBy("cell")
    before = F.lag("last").over(in_order)
    begun = cells.withColumn("begins", F.when(before.isNull() | (F.col("first") - before > width), F.col("first")))
    named = begun.withColumn(RUN, F.last("begins", ignorenulls=True).over(in_order))
    return named.select(SCENARIO, "cell", F.timestamp_micros(RUN).alias(RUN), F.timestamp_micros(
        F.max("last").over(W.partitionBy(SCENARIO, RUN))).alias("run_end"))


def in_runs(rows: DataFrame, cells: DataFrame, run_gap: int, time_col: str) -> DataFrame:
    """``rows`` with the ``run_start`` of their run."""
    located = rows.withColumn("cell", _cell(time_col, run_gap))
    return located.join(cells.select(SCENARIO, "cell", RUN), [SCENARIO, "cell"]).drop("cell")


def _counted(outcomes: DataFrame, run_gap: int, log_gap: int, window: int) -> DataFrame:
    """Messages as a row for each scenario, cell, service, window and stretch of ``log_gap`` seconds."""
    dead = F.col("failure_reason").isNotNull()
    schema_failure = F.col("failure_reason").startswith("JSON schema validation failed")
    one = F.lit(1)
    return (
        outcomes.withColumn("log_ts", F.when(~dead, F.col("log_ts")))
        .groupBy(SCENARIO, _cell("ts", run_gap).alias("cell"), _cell("log_ts", log_gap).alias("stretch"),
                 _cell("log_ts", window).alias("window"), F.when(~dead, F.col("service")).alias("service"))
        .agg(F.count(one).alias("n"), F.count_if(dead).alias("dead"),
             F.count_if(dead & (F.col("failure_reason") == "")).alias("empty"),
             F.count_if(schema_failure & (F.col("retry_count") > 0)).alias("retried"),
             F.count_if(~dead & is_error(F.col("severity"))).alias("errors"),
             F.min("ts").alias("begin"), F.max("ts").alias("end"),
             F.min(F.unix_micros("log_ts")).alias("first"), F.max(F.unix_micros("log_ts")).alias("last"))
    )


def _message_metrics(counted: DataFrame, cells: DataFrame, log_gap: int) -> DataFrame:
    """One row per run. A gap lies between the first log of a stretch and the last log of all before it."""
    earlier = W.partitionBy(SCENARIO, RUN).orderBy("stretch").rangeBetween(W.unboundedPreceding, -1)
    own = W.partitionBy(SCENARIO, RUN, "stretch")
    silence = F.min("first").over(own) - F.max("last").over(earlier)
    gap = silence > F.lit(log_gap * 1_000_000).cast("bigint")
    good = F.sum("n") - F.sum("dead")
    placed = counted.join(cells.select(SCENARIO, "cell", RUN), [SCENARIO, "cell"])
    return placed.withColumn("gap_at", F.when(gap, F.col("stretch"))).groupBy(SCENARIO, RUN).agg(
        F.sum("n").alias("accounted"), F.sum("dead").alias("dlq_messages"),
        F.call_function("div", F.sum("dead") * 10000, F.sum("n")).alias("malformed_basis_points"),
        F.sum("empty").alias("empty_failure_reasons"), F.sum("retried").alias("retried_schema_failures"),
        F.when(good > 0, F.call_function("div", F.sum("errors") * 10000, good)).alias("error_rate_basis_points"),
        F.count_distinct(F.when(F.col("window").isNotNull(), F.struct("window", "service"))).alias("throughput_windows"),
        F.count_distinct("gap_at").alias("log_gaps"))


def measure_runs(
    produced: DataFrame, outcomes: DataFrame, readings: DataFrame, samples: DataFrame, run_gap: int,
    log_gap: int = LOG_GAP_SECONDS, window: int = WINDOW_SECONDS, baseline: int = LAG_BASELINE,
    within: int = RECOVERY_SECONDS, high: int = BUFFER_HIGH_WATER, low: int = BUFFER_LOW_WATER,
) -> DataFrame:
    """scenario, run_start, run_end and one column per metric, for each run.

    ``produced(scenario, ts)`` are the messages sent; ``outcomes`` what the tables hold of them: scenario,
    ts, log_ts, service, severity and, of dead letters only, failure_reason and retry_count.
    ``readings`` and ``samples`` are those of ``lag`` and ``backpressure`` with their scenario. Partitions
    are followed within a run: none is paused, or behind, because of the run before. A metric of which a
    run has no rows is 0. Messages that are lost and others stored twice balance each other
    in ``unaccounted_messages``; ``offsets`` tells them apart.

    Two jobs run when the frame is built: they checkpoint the counted messages, which so are read
    and parsed once, and the cells, which everything else is joined with.
    """
    counted = cut_lineage(_counted(outcomes, run_gap, log_gap, window))
    cells = cut_lineage(run_cells([(produced, "ts"), (counted, "begin"), (counted, "end"), (readings, "recorded_at"),
                                   (samples, "ts")], run_gap))
    sent = produced.groupBy(SCENARIO, _cell("ts", run_gap).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    sent = sent.join(cells, [SCENARIO, "cell"]).groupBy(SCENARIO, RUN).agg(F.sum("n").alias("produced"))
    ends = cells.groupBy(SCENARIO, RUN).agg(F.unix_micros(F.max("run_end")).alias("end_micros"))

    followed = F.struct(SCENARIO, RUN, "partition_id")
    polls = in_runs(readings, cells, run_gap, "recorded_at").withColumn("partition_id", followed)
    depths = in_runs(samples, cells, run_gap, "ts").withColumn("partition_id", followed)
    run = [F.col(f"partition_id.{c}").alias(c) for c in (SCENARIO, RUN)]
    latest = latest_lag(polls).groupBy(*run).agg(F.max("lag").alias("max_latest_lag"))
    recovered = lag_recovery(polls, baseline, within, high).groupBy(*run).agg(
        F.max("peak_lag").alias("max_lag"), F.count_if(~F.col("recovered_in_time")).alias("partitions_not_recovered"))
    turns = pause_resume_events(depths, high, low).groupBy(*run).agg(
        F.count_if(F.col("action") == "PAUSE").alias("pause_events"),
        F.count_if(F.col("action") == "RESUME").alias("resume_events"))

    parts = [ends, sent, _message_metrics(counted, cells, log_gap), latest, recovered, turns]
    names = [c for part in parts for c in part.columns if c not in (SCENARIO, RUN)]
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    measured = wide.groupBy(SCENARIO, RUN).agg(*[
        F.coalesce(F.max(c).cast("bigint"), F.lit(0).cast("bigint")).alias(c) for c in names])
    return measured.select(
        SCENARIO, RUN, F.timestamp_micros("end_micros").alias("run_end"),
        *[c for c in names if c not in ("end_micros", "accounted")],
        (F.col("produced") - F.col("accounted")).alias("unaccounted_messages"))


def run_report(measured: DataFrame, expectations: Sequence[Expectation] = RUN_EXPECTATIONS) -> DataFrame:
    """One row for each run and expectation of its own scenario; runs of other scenarios have none."""
    own: dict[str, list[Expectation]] = {}
    for e in expectations:
        own.setdefault(e.scenario, []).append(e)
    verdicts = F.coalesce(*[
        F.when(F.col(SCENARIO) == scenario, F.array(*[
            F.struct(F.lit(e.metric).alias("metric"), F.lit(e.text).alias("expected"),
                     F.col(e.metric).alias("actual"), holds(e, F.col(e.metric)).alias("passed"))
            for e in wanted]))
        for scenario, wanted in own.items()])
    return measured.select(SCENARIO, RUN, "run_end", F.inline(verdicts))


def run_verdicts(report: DataFrame) -> DataFrame:
    """One row for each run: how many expectations it was held to, and which it failed."""
    return report.groupBy(SCENARIO, RUN, "run_end").agg(
        F.count(F.lit(1)).alias("expectations"), F.count_if(~F.col("passed")).alias("failed"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), F.concat_ws(" ", "metric", "expected")))), ", ")
        .alias("failures"))
