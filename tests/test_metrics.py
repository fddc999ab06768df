"""Window metrics, trends and completeness checks on small inputs."""

import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from logweir.functions.rates import messages_per_sec, percentage
from logweir.operators import feed, metrics, quality, scenarios, trends

T0 = datetime(2024, 1, 1, 12)
LOGS = "event_id long, log_ts timestamp, service string, severity string"


def logs(spark, rows):
    return spark.createDataFrame(
        [(i, T0 + timedelta(seconds=s), svc, sev) for i, (s, svc, sev) in enumerate(rows)], LOGS)


def test_one_minute_windows_keep_services_without_errors(spark):
    df = logs(spark, [(0, "a", "INFO"), (59.999, "a", "CRITICAL"), (60, "a", "INFO"), (1, "b", "DEBUG")])
    rows = metrics.error_rate_windows(metrics.window_counts(df)).orderBy("window_start", "service").collect()
    got = [(r["service"], r["total_messages"], r["error_messages"], str(r["error_rate_pct"])) for r in rows]
    assert got == [("a", 2, 1, "50.00"), ("b", 1, 0, "0.00"), ("a", 1, 0, "0.00")]
    assert rows[0]["window_end"] - rows[0]["window_start"] == timedelta(seconds=60)


def test_rates_round_half_up_and_guard_zero(spark):
    df = spark.createDataFrame(
        [(T0, T0 + timedelta(seconds=400), 1, 8), (T0, T0, 5, 0), (T0, T0 + timedelta(seconds=60), 600, 3)],
        "s timestamp, e timestamp, n long, total long")
    rows = df.select(messages_per_sec(F.col("n"), F.col("s"), F.col("e")).alias("r"),
                     percentage(F.lit(1), F.col("total")).alias("p")).collect()
    assert [r["r"] for r in rows] == [Decimal("0.00"), Decimal("0.00"), Decimal("10.00")]
    assert [r["p"] for r in rows] == [Decimal("12.50"), Decimal("0.00"), Decimal("33.33")]
    half = spark.range(1).select(percentage(F.lit(1), F.lit(800)).alias("p")).first()["p"]
    assert half == Decimal("0.13")  # 0.125 rounds up


def test_rates_survive_huge_counts(spark):
    big = 9_000_000_000_000_000_000
    row = spark.range(1).select(percentage(F.lit(big), F.lit(big)).alias("p")).first()
    assert row["p"] == Decimal("100.00")


def test_empty_inputs(spark):
    counts = metrics.window_counts(logs(spark, []))
    summary = metrics.throughput_summary(metrics.throughput_windows(counts)).first()
    assert [str(v) for v in summary] == ["0.00", "0.00", "0.00", "0"]
    overall = metrics.error_overall(metrics.error_rate_windows(counts)).first()
    assert [str(v) for v in overall] == ["0", "0", "0.00"]
    assert quality.log_gaps(logs(spark, [])).count() == 0
    assert trends.throughput_spikes(metrics.throughput_windows(counts)).count() == 0


def test_lookback_limits_and_service(spark):
    df = metrics.throughput_windows(metrics.window_counts(
        logs(spark, [(0, "a", "INFO"), (3600, "a", "INFO"), (3600, "b", "INFO")])))
    as_of = T0 + timedelta(seconds=3660)
    assert metrics.lookback(df, 60, as_of).count() == 2
    assert metrics.lookback(df, 61, as_of, "").count() == 3
    assert metrics.lookback(df, 61, as_of, "b").count() == 1
    for minutes in (0, 1441):
        with pytest.raises(ValueError):
            metrics.lookback(df, minutes)


def test_lookback_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    metrics.throughput_windows(metrics.window_counts(logs(spark, [(0, "a", "INFO")]))).write.parquet(path)
    df = metrics.lookback(spark.read.parquet(path), 60, T0, "a").select("messages_per_sec")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(window_start" in pushed and "EqualTo(service,a)" in pushed
    assert "message_count" not in pushed[pushed.index("ReadSchema"):].splitlines()[0]


def brute_gaps(times, seconds):
    times = sorted(times)
    return [(a, b) for a, b in zip(times, times[1:]) if (b - a).total_seconds() > seconds]


@pytest.mark.parametrize("seed", range(4))
def test_gaps_match_a_sorted_walk(spark, seed):
    import random
    rng = random.Random(seed)
    times = [T0 + timedelta(seconds=rng.choice([rng.uniform(0, 300), rng.uniform(0, 400_000)]))
             for _ in range(200)] + [T0, T0 + timedelta(seconds=30), T0 + timedelta(seconds=60)]
    df = spark.createDataFrame([(t,) for t in times], "log_ts timestamp")
    got = sorted((r["gap_start"], r["gap_end"]) for r in quality.log_gaps(df, 30).collect())
    assert got == brute_gaps(times, 30)


def test_delay_quantiles(spark):
    rows = [(T0, T0 + timedelta(milliseconds=i), "a") for i in range(1, 101)]
    df = spark.createDataFrame(rows, "log_ts timestamp, ingested_at timestamp, service string")
    row = quality.ingest_delay(df).first()
    assert [row[c] for c in ("messages", "min_ms", "p50_ms", "p95_ms", "p99_ms", "max_ms")] == [
        100, 1, 50, 95, 99, 100]


def test_spike_needs_a_history(spark):
    df = spark.createDataFrame(
        [(T0 + timedelta(minutes=i), T0 + timedelta(minutes=i + 1), "a", n, None)
         for i, n in enumerate([50, 10, 10, 60])],
        "window_start timestamp, window_end timestamp, service string, message_count long, r string")
    assert [r["message_count"] for r in trends.throughput_spikes(df, preceding=2).collect()] == [60]


def test_reconciliation_names_the_lost(spark):
    made = spark.range(10).withColumnRenamed("id", "event_id")
    done, dead = made.filter("event_id < 5"), made.filter("event_id in (5, 6, 7)")
    assert quality.reconcile_counts(made, done, dead).first()["missing"] == 2
    assert sorted(r[0] for r in quality.lost_messages(made, done, dead).collect()) == [8, 9]


def test_report_judges_every_expectation(spark):
    measured = spark.createDataFrame([("dlq_messages", 0), ("max_lag", 700), ("other", 1)],
                                     "metric string, actual long")
    report = {(r["scenario"], r["metric"]): r["passed"] for r in scenarios.scenario_report(measured).collect()}
    assert report == {("normal_load", "dlq_messages"): True, ("traffic_spike", "max_lag"): True,
                      ("slow_consumer", "max_lag"): True}


def test_feed_merges_all_kinds(spark):
    turns = spark.createDataFrame([(T0, 1, "PAUSE", 1200)], "ts timestamp, partition_id int, action string, depth long")
    letters = spark.createDataFrame([(7, T0 + timedelta(1), "why")], "id long, failed_at timestamp, failure_reason string")
    slo = spark.createDataFrame([(T0 + timedelta(2), "a", Decimal("12.50"))],
                                "window_end timestamp, service string, error_rate_pct decimal(5,2)")
    rows = feed.recent_events(turns, letters, slo, rows=2).collect()
    assert [r["text"] for r in rows] == ["a error rate 12.50 percent", "dead letter 7: why"]


def test_delay_quantiles_of_one_service_with_many_delays(spark, capsys):
    n = 100_003
    logs = spark.range(n).selectExpr(
        "'a' AS service", "timestamp_micros(0) AS log_ts",
        f"timestamp_micros(((id * 7919 % {n}) * (id * 7919 % {n}) - 5000) * 1000) AS ingested_at")
    delays = sorted(i * i - 5000 for i in range(n))
    delayed = quality.ingest_delay(logs)
    row = delayed.first()
    at = lambda p: delays[-(-n * p // 100) - 1]
    assert tuple(row) == ("a", n, delays[0], at(50), at(95), at(99), delays[-1])
    delayed.explain()
    windows = re.findall(r"windowspecdefinition\(([^)]*)", capsys.readouterr().out)
    assert windows and all("bucket" in w.split("delay_ms")[0] for w in windows)  # never the service alone
