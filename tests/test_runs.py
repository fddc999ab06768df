"""Runs of scenarios against a plain loop, and delay counts against sorted delays."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logweir import schemas
from logweir.operators import delays, quality, runs
from logweir.operators.scenarios import Expectation
from logweir.streaming.pipeline import Pipeline

T0 = datetime(2024, 1, 1)
GAP, LOG_GAP, WINDOW = 600, 30, 60
OUTCOME = ("scenario string, ts timestamp, log_ts timestamp, service string, severity string, "
           "failure_reason string, retry_count int")
READING = "scenario string, id long, recorded_at timestamp, partition_id int, lag long, consumer_id string"
SAMPLE = "scenario string, event_id long, ts timestamp, partition_id int, depth long"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def good(scenario, seconds, severity="INFO", service="a"):
    return (scenario, at(seconds), at(seconds), service, severity, None, None)


def bad(scenario, seconds, reason="JSON schema validation failed: x", retries=0):
    return (scenario, at(seconds), None, None, None, reason, retries)


def measured(spark, outcomes, sent=(), readings=(), samples=()):
    produced = spark.createDataFrame([r[:2] for r in outcomes] + list(sent), "scenario string, ts timestamp")
    return runs.measure_runs(
        produced, spark.createDataFrame(outcomes, OUTCOME), spark.createDataFrame(list(readings), READING),
        spark.createDataFrame(list(samples), SAMPLE), GAP, LOG_GAP, WINDOW, high=1000, low=200)


def test_a_silence_ends_a_run_and_only_its_own_scenario_judges_it(spark):
    outcomes = [good("normal_load", s) for s in range(0, 500, 20)]
    outcomes += [good("normal_load", 1100 + s) for s in (0, 40)]          # 620 s after the last one
    outcomes += [bad("malformed_logs", s) for s in range(30)] + [good("malformed_logs", s) for s in range(70)]
    df = measured(spark, outcomes)
    found = {(r["scenario"], r["run_start"]): r for r in df.collect()}
    assert sorted(found) == [("malformed_logs", at(0)), ("normal_load", at(0)), ("normal_load", at(1100))]
    assert found["normal_load", at(0)]["run_end"] == at(480)
    assert found["normal_load", at(0)]["throughput_windows"] == 9
    assert [found["normal_load", at(s)]["log_gaps"] for s in (0, 1100)] == [0, 1]
    verdicts = {(r["scenario"], r["run_start"]): r for r in runs.run_verdicts(runs.run_report(df)).collect()}
    assert all(v["failed"] == 0 for v in verdicts.values())  # 30 % malformed is no fault of the normal load
    assert {v["expectations"] for k, v in verdicts.items() if k[0] == "normal_load"} == {4}


def test_a_silence_of_exactly_the_gap_does_not_end_a_run(spark):
    df = measured(spark, [good("normal_load", s) for s in (599, 1199, 1800)])
    assert sorted((r["run_start"], r["run_end"]) for r in df.collect()) == [(at(599), at(1199)), (at(1800), at(1800))]


def test_losses_reasons_and_retries_are_counted_in_their_run(spark):
    outcomes = [good("malformed_logs", 1, "ERROR"), good("malformed_logs", 2), bad("malformed_logs", 3, ""),
                bad("malformed_logs", 4, retries=2), bad("malformed_logs", 5, "timeout", 3)]
    row = measured(spark, outcomes, sent=[("malformed_logs", at(6)), ("malformed_logs", at(7))]).first()
    assert row["unaccounted_messages"] == 2 and row["produced"] == 7
    assert (row["dlq_messages"], row["empty_failure_reasons"], row["retried_schema_failures"]) == (3, 1, 1)
    assert row["error_rate_basis_points"] == 5000 and row["malformed_basis_points"] == 6000
    report = {r["metric"]: r for r in runs.run_report(measured(spark, outcomes)).collect()}
    assert report["malformed_basis_points"]["expected"] == "= 3000 +- 300"
    assert not report["malformed_basis_points"]["passed"]


def test_partitions_begin_each_run_anew(spark):
    depths = [(0, 1500), (10, 500), (2000, 100), (2010, 1200), (2020, 50)]  # paused when the first run ends
    samples = [("traffic_spike", i, at(s), 0, d) for i, (s, d) in enumerate(depths)]
    lags = [(0, 900), (30, 700), (2000, 600), (2030, 20)]
    readings = [("traffic_spike", i, at(s), 0, n, "C1") for i, (s, n) in enumerate(lags)]
    first, second = sorted(measured(spark, [good("traffic_spike", 5)], readings=readings, samples=samples).collect(),
                           key=lambda r: r["run_start"])
    assert (first["pause_events"], first["resume_events"]) == (1, 0)
    assert (second["pause_events"], second["resume_events"]) == (1, 1)
    assert [(r["max_lag"], r["max_latest_lag"], r["partitions_not_recovered"]) for r in (first, second)] == [
        (900, 700, 1), (600, 20, 0)]
    assert second["produced"] == 0 and second["throughput_windows"] == 0  # a run of samples alone


def test_log_gaps_equal_a_loop(spark):
    rng = random.Random(5)
    outcomes, times = [], {}
    for scenario in ("normal_load", "worker_failure"):
        t = 0
        for _ in range(300):
            t += rng.choice([1, 5, 29, 30, 31, 60, 700])
            outcomes.append(good(scenario, t, service=rng.choice("ab")))
            times.setdefault(scenario, []).append(t)
    want = {}
    for scenario, ts in times.items():
        start = ts[0]
        want[scenario, at(start)] = 0
        for a, b in zip(ts, ts[1:]):
            if b - a > GAP:
                start = b
                want[scenario, at(start)] = 0
            else:
                want[scenario, at(start)] += b - a > LOG_GAP
    assert {(r["scenario"], r["run_start"]): r["log_gaps"] for r in measured(spark, outcomes).collect()} == want


def test_runs_without_expectations_and_without_rows(spark):
    assert runs.run_report(measured(spark, [good("soak", 1)])).count() == 0
    nothing = measured(spark, [])
    assert nothing.count() == 0 and runs.run_verdicts(runs.run_report(nothing)).count() == 0
    own = runs.run_report(measured(spark, [good("soak", 1)]), [Expectation("soak", "produced", "=", 1)])
    assert own.first()["passed"]


def delayed(spark, values, service="a"):
    return spark.createDataFrame([(at(0), at(0) + timedelta(milliseconds=v), service) for v in values],
                                 "log_ts timestamp, ingested_at timestamp, service string")


@pytest.mark.parametrize("seed", range(3))
def test_delay_estimates_hold_the_exact_quantiles(spark, seed):
    rng = random.Random(seed)
    values = [int(rng.lognormvariate(6, 3)) * rng.choice([1, 1, 1, -1]) for _ in range(2000)] + [0] * 50
    rng.shuffle(values)
    parts = [delays.delay_rows(delayed(spark, values[i::4]), 60) for i in range(4)]  # four batches, in any order
    rows = delays.merged(parts[2].unionByName(parts[0]).unionByName(parts[3])).unionByName(parts[1])
    got, exact = delays.delay_quantiles(rows).first(), quality.ingest_delay(delayed(spark, values)).first()
    assert (got["messages"], got["min_ms"], got["max_ms"]) == (len(values), min(values), max(values))
    ordered = sorted(values)
    for p in (50, 95, 99):
        low, high, true = got[f"p{p}_from_ms"], got[f"p{p}_ms"], exact[f"p{p}_ms"]
        assert low <= true <= high and high - low <= abs(true) / 2 ** (delays.BITS - 2)
        rank = sum(v <= high for v in ordered)
        assert got[f"p{p}_rank_error"] == rank - -(-len(values) * p // 100) >= 0
    leading = {(v < 0, max(0, abs(v).bit_length() - delays.BITS), abs(v) >> max(0, abs(v).bit_length() - delays.BITS)) for v in values}
    assert delays.merged(rows).count() == len(leading)  # a row for each bucket met, not for each delay


def test_delay_rows_leave_out_rows_without_a_time_and_take_empty_tables(spark):
    rows = spark.createDataFrame([(at(0), None, "a"), (None, at(0), "a")], "log_ts timestamp, ingested_at timestamp, service string")
    assert delays.delay_rows(rows, 60).count() == 0
    assert delays.delay_quantiles(delays.delay_rows(rows, 60)).count() == 0


def test_folded_delays_answer_without_logs(spark, tmp_path):
    text = ('{"timestamp": "%s.000Z", "service": "a", "severity": "INFO", "message": "m", "trace_id": "%s"}')
    pipeline, offset = Pipeline(str(tmp_path)), 0
    waits = [[100, 200], [300, 86_400_000 - 5000], [150]]
    for batch, chosen in enumerate(waits):
        rows = []
        for wait in chosen:
            sent = at(3600 + batch)
            rows.append((None, (text % (sent.isoformat(), "0" * 32)).encode(), "logs", 0, offset, sent + timedelta(milliseconds=wait)))
            offset += 1
        pipeline.process(spark.createDataFrame(rows, schemas.KAFKA_RECORD), batch)
        if batch == 1:
            pipeline.fold(spark)
    pipeline.fold(spark)
    found = pipeline.delay_quantiles(spark, 120, at(7200))
    row = found.first()
    assert (row["messages"], row["min_ms"], row["p50_ms"], row["max_ms"]) == (5, 100, 200, 86_395_000)
    paths = {f.split("/write=")[0].rsplit("/", 1)[-1] for f in found.inputFiles()}
    assert paths == {"metrics_ingest_delay"}
    assert pipeline.delay_quantiles(spark, 10, at(7200)).count() == 0
    stored = pipeline.snapshot(spark).folded("metrics_ingest_delay", schemas.METRICS_INGEST_DELAY)
    assert stored.groupBy(*delays.KEYS).count().filter(F.col("count") > 1).isEmpty()
