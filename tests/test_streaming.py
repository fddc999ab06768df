"""Streams against batch results, and restarts."""

import json
import random
import threading
import time
from datetime import datetime, timedelta, timezone
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweir import schemas
from logweir.operators import backpressure as bp
from logweir.operators import offsets
from logweir.operators.lag import consumer_lag
from logweir.operators.metrics import window_counts
from logweir.operators.validation import valid_only, validate_logs
from logweir.plans.inputs import stored_records
from logweir.sinks import tables
from logweir.sinks.commits import Ledger
from logweir.sources.streams import file_stream
from logweir.streaming import keyed_backpressure
from logweir.streaming.backpressure import BackpressureTracker
from logweir.streaming.feed import LiveFeed
from logweir.streaming.lifecycle import Lifecycle
from logweir.streaming.pipeline import Pipeline
from logweir.streaming.progress import LagSampler, observe_delivery, offsets_from_progress
from logweir.streaming.windows import latest_version, streaming_counts

T0 = datetime(2024, 1, 1, 23, 58)


def record(offset, rng):
    at = T0 + timedelta(seconds=rng.randrange(240))
    value = {"timestamp": at.isoformat() + ".000Z", "service": rng.choice(["a", "b"]),
             "severity": rng.choice(["INFO", "ERROR"]), "message": f"m{offset}", "trace_id": "0" * 32}
    topic = "logs"
    text = json.dumps(value)
    if offset % 10 == 3:
        text = text[:-1]
    if offset % 10 == 7:
        topic = "logs-dlq"
        text = json.dumps({"original_message": "x", "failure_reason": "timeout", "retry_count": 3,
                           "failed_at": "2024-01-01T00:00:00Z"})
    return (None, text.encode(), topic, offset % 4, offset, at)


def write_records(spark, path, start, n):
    rng = random.Random(start)
    rows = [record(i, rng) for i in range(start, start + n)]
    spark.createDataFrame(rows, schemas.KAFKA_RECORD).coalesce(1).write.mode("append").parquet(path)


def sorted_rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


WINDOW = ("window_start", "window_end", "service", "total_messages", "error_messages")


@pytest.fixture
def run(spark, tmp_path):
    source = str(tmp_path / "in")
    pipeline = Pipeline(str(tmp_path / "out"))
    for start in (0, 200, 400):
        write_records(spark, source, start, 200)

    def go():
        query = pipeline.start(file_stream(spark, source, max_files=1), str(tmp_path / "checkpoint"))
        query.awaitTermination()
        return query

    return source, pipeline, go


def test_stream_equals_batch(spark, run):
    source, pipeline, go = run
    go()
    logs = spark.read.parquet(source).filter("topic = 'logs'").drop("timestamp")
    valid = valid_only(validate_logs(logs))
    want = sorted_rows(window_counts(valid), *WINDOW)
    assert sorted_rows(pipeline.counts(spark), *WINDOW) == want
    assert pipeline.processed_logs(spark).count() == valid.count() == 480
    reasons = pipeline.dlq_log(spark).groupBy("failure_reason").count().collect()
    assert {r[0]: r[1] for r in reasons} == {"timeout": 60, "Deserialization error: invalid JSON": 60}
    assert pipeline.throughput(spark).schema.names == schemas.METRICS_THROUGHPUT.names
    assert pipeline.error_rates(spark).schema.names == schemas.METRICS_ERROR_RATE.names


def test_restart_and_replay_store_nothing_twice(spark, run):
    source, pipeline, go = run
    go()
    before = sorted_rows(pipeline.counts(spark), *WINDOW)
    go()
    write_records(spark, source, 600, 100)
    go()
    assert pipeline.processed_logs(spark).count() == 560
    run = pipeline.snapshot(spark).commits[0].run
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", run)
    try:
        pipeline.process(file_free_batch(spark, source, 600), 3)  # the last batch once more
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert pipeline.processed_logs(spark).count() == 560
    assert pipeline.processed_logs(spark).select("id").distinct().count() == 560
    assert sorted_rows(pipeline.counts(spark), *WINDOW) != before


def file_free_batch(spark, source, first_offset):
    return spark.read.parquet(source).filter(F.col("offset") >= first_offset)


def test_folding_touches_only_days_with_new_rows(spark, run):
    source, pipeline, go = run
    go()
    names, before = schemas.METRICS_THROUGHPUT.names, sorted_rows(pipeline.throughput(spark), *schemas.METRICS_THROUGHPUT.names)
    assert pipeline.fold(spark) == ["2024-01-01", "2024-01-02"]
    seen = pipeline.snapshot(spark)
    assert not seen.commits and sorted_rows(seen.folded("metrics_throughput", schemas.METRICS_THROUGHPUT), *names) == before
    assert sorted_rows(pipeline.throughput(spark), *names) == before and pipeline.fold(spark) == []
    at = T0 + timedelta(days=3)
    late = json.dumps({"timestamp": (T0 + timedelta(seconds=150)).isoformat() + "Z", "service": "a", "severity": "ERROR", "message": "m", "trace_id": "0" * 32})
    other = late.replace("2024-01-02", "2024-01-04")
    pipeline.process(spark.createDataFrame([(None, t.encode(), "logs", 0, 10_000 + i, at) for i, t in enumerate((late, other))],
                                           schemas.KAFKA_RECORD), 0)
    want = sorted_rows(pipeline.error_rates(spark), *schemas.METRICS_ERROR_RATE.names)
    assert pipeline.fold(spark) == ["2024-01-02", "2024-01-04"]
    again = pipeline.snapshot(spark)
    for table in ("window_totals", "metrics_throughput", "metrics_error_rate"):
        old, new = seen.fold.files[table], again.fold.files[table]
        assert {d for d in new if new[d] != old.get(d)} == {"2024-01-02", "2024-01-04"}
    assert sorted_rows(again.folded("metrics_error_rate", schemas.METRICS_ERROR_RATE), *schemas.METRICS_ERROR_RATE.names) == want
    assert pipeline.processed_logs(spark).count() == 482
    recent = pipeline.lookback(spark, "metrics_error_rate", 600, datetime(2024, 1, 4, 6))
    assert {r["window_start"].day for r in recent.collect()} == {4}
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(window_start)" in plan
    run_id = seen.fold.upto.popitem()[0]
    assert pipeline.ledger(spark).is_committed(run_id, 2) and not pipeline.ledger(spark).is_committed(run_id, 3)


def test_a_batch_that_fails_between_two_tables_changes_none(spark, run, monkeypatch):
    _, pipeline, go = run
    go()
    state = lambda: (pipeline.processed_logs(spark).count(), pipeline.dlq_log(spark).count(),
                     sorted_rows(pipeline.counts(spark), *WINDOW))
    before, rng = state(), random.Random(1)
    batch = spark.createDataFrame([record(i, rng) for i in range(1000, 1100)], schemas.KAFKA_RECORD)
    write = Ledger.write

    def failing(self, table, *args):
        if table == "window_deltas":
            raise OSError("the disk is full")
        return write(self, table, *args)

    monkeypatch.setattr(Ledger, "write", failing)
    with pytest.raises(OSError):
        pipeline.process(batch, 7)
    assert len(list((Path(pipeline.root) / "processed_logs").glob("write=by-hand-7-*"))) == 1  # written, and not read
    assert state() == before
    monkeypatch.setattr(Ledger, "write", write)
    pipeline.process(batch, 7)
    after = state()
    assert [a - b for a, b in zip(after[:2], before[:2])] == [80, 20]
    pipeline.process(batch, 7)
    assert state() == after


def test_runs_do_not_replace_each_other(spark, tmp_path):
    pipeline, rng = Pipeline(str(tmp_path / "out")), random.Random(2)
    for n, query in enumerate(("one", "two")):
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", query)
        try:
            pipeline.process(spark.createDataFrame([record(i, rng) for i in range(100 * n, 100 * n + 100)], schemas.KAFKA_RECORD), 0)
        finally:
            spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert pipeline.processed_logs(spark).count() == 160
    with pytest.raises(FileExistsError):
        pipeline.ledger(spark).commit("one", 0, {})


def test_windows_from_flush_to_flush(spark, tmp_path):
    clock = iter([datetime(2024, 1, 1, 0, 0, s, tzinfo=timezone.utc) for s in (10, 30, 45, 50)])

    def store(batch, rows):  # a new object each time, as after a restart
        pipeline = Pipeline(str(tmp_path / "out"), flush_windows=True, clock=lambda: next(clock))
        pipeline.process(spark.createDataFrame(rows, schemas.KAFKA_RECORD), batch)
        return pipeline

    good = [record(i, random.Random(i)) for i in (1, 2, 4, 5)]
    store(0, good)
    store(1, good[:2])
    store(1, good[:2])  # repeated: no flush of its own
    store(2, [])
    pipeline = store(3, good[:1])
    got = {(r["window_start"].second, r["window_end"].second): r["n"] for r in
           pipeline.counts(spark).groupBy("window_start", "window_end").agg(F.sum("total_messages").alias("n")).collect()}
    assert got == {(10, 10): 4, (10, 30): 2, (45, 50): 1}
    pipeline.fold(spark)
    assert pipeline.snapshot(spark).note("by-hand")["window_end"].startswith("2024-01-01T00:00:50")


def test_services_added_between_batches_are_known(spark, tmp_path):
    known = str(tmp_path / "services")
    spark.createDataFrame([("a",), ("a",)], "service string").write.parquet(known)
    pipeline = Pipeline(str(tmp_path / "out"), services=lambda s: s.read.schema("service string").parquet(known))
    rows = [record(i, random.Random(i)) for i in range(0, 200, 2) if i % 10 not in (3, 7)]
    n = {s: sum(json.loads(r[1])["service"] == s for r in rows) for s in "ab"}
    pipeline.process(spark.createDataFrame(rows, schemas.KAFKA_RECORD), 0)
    assert pipeline.processed_logs(spark).count() == n["a"]
    assert [tuple(r) for r in pipeline.dlq_log(spark).groupBy("failure_reason").count().collect()] == [
        ("JSON schema validation failed: service is not a known service", n["b"])]
    spark.createDataFrame([("b",)], "service string").write.mode("append").parquet(known)
    pipeline.process(spark.createDataFrame(rows, schemas.KAFKA_RECORD), 1)
    assert pipeline.processed_logs(spark).count() == 2 * n["a"] + n["b"]


def test_a_stopped_pipeline_has_all_windows_in_its_metric_tables(spark, tmp_path):
    source, pipeline = str(tmp_path / "in"), Pipeline(str(tmp_path / "out"))
    write_records(spark, source, 0, 100)
    stopper = Lifecycle(pipeline, file_stream(spark, source), str(tmp_path / "c"), "1 second", poll_seconds=0.2)

    def later():
        while not pipeline.snapshot(spark).commits:
            time.sleep(0.2)
        write_records(spark, source, 100, 100)
        stopper.request_stop()

    thread = threading.Thread(target=later)
    thread.start()
    assert stopper.run() == ["2024-01-01", "2024-01-02"]
    thread.join()
    seen = pipeline.snapshot(spark)
    assert not seen.commits
    total = seen.folded("metrics_throughput", schemas.METRICS_THROUGHPUT).agg(F.sum("message_count")).first()[0]
    assert total == pipeline.processed_logs(spark).count() == 160


def test_losses_and_doubles_over_batches(spark, tmp_path):
    rng, lost, twice = random.Random(3), {5, 6, 7, 9, 400}, {11, 12, 300}
    made = [record(i, rng)[:3] + (i % 2, 32_700 + i // 2, T0) for i in range(600)]
    pipeline = Pipeline(str(tmp_path))
    for batch in range(2):
        rows = [r for i, r in enumerate(made) if i not in lost and (i // 300 == batch or batch and i in twice)]
        pipeline.process(spark.createDataFrame(rows, schemas.KAFKA_RECORD), batch)
    produced = spark.createDataFrame(made, schemas.KAFKA_RECORD)
    stored = stored_records(pipeline, spark).withColumn("topic", F.lit("logs"))
    got = offsets.reconcile_offsets(produced.withColumn("topic", F.lit("logs")), stored)
    assert sorted((r["kind"], r["partition"], r["first_offset"], r["last_offset"], r["messages"]) for r in got.collect()) == sorted([
        ("lost", 1, 32_702, 32_704, 3), ("lost", 0, 32_703, 32_703, 1), ("lost", 0, 32_900, 32_900, 1),
        ("double", 1, 32_705, 32_705, 1), ("double", 0, 32_706, 32_706, 1)])
    parts = [offsets.offset_sets(produced.filter(F.col("offset") % 3 == k)) for k in range(3)]
    whole = offsets.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert tuple(offsets.set_counts(whole).first()) == (600, 600)
    assert offsets.lost_offsets(whole, offsets.offset_sets(produced)).count() == 0


def test_runs_go_on_across_stretches(spark):
    df = spark.range(100_000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset")).filter(
        "offset between 10 and 99990 and offset <> 70000")
    runs = offsets.offset_runs(df, ["topic", "partition"]).orderBy("first_offset").collect()
    assert [tuple(r)[2:] for r in runs] == [(10, 69_999, 69_990), (70_001, 99_990, 29_990)]
    gone = offsets.lost_offsets(offsets.offset_sets(df), offsets.offset_sets(df.filter("offset < 40000")))
    assert gone.count() == 99_980 - 39_990


def test_empty_batch_writes_nothing(spark, tmp_path):
    pipeline = Pipeline(str(tmp_path / "out"))
    pipeline.process(spark.createDataFrame([], schemas.KAFKA_RECORD), 0)
    assert not (tmp_path / "out").exists()


def test_published_dead_letters_are_not_stored_directly(spark, tmp_path):
    write_records(spark, str(tmp_path / "in"), 0, 100)
    sent = []
    pipeline = Pipeline(str(tmp_path / "out"), publish=lambda df: sent.append(df.count()))
    pipeline.process(spark.read.parquet(str(tmp_path / "in")), 0)
    assert sent == [10]
    assert {r[0] for r in pipeline.dlq_log(spark).select("failure_reason").collect()} == {"timeout"}


def test_stateful_windows_update_to_the_batch_result(spark, tmp_path):
    source = str(tmp_path / "in")
    for start in (0, 200):
        write_records(spark, source, start, 200)
    logs = file_stream(spark, source, max_files=1).filter("topic = 'logs'").drop("timestamp")
    out = str(tmp_path / "updates")

    def keep(df, batch_id):
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    (streaming_counts(valid_only(validate_logs(logs)), "1 hour").writeStream.outputMode("update")
     .foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
     .start().awaitTermination())
    batch = valid_only(validate_logs(spark.read.parquet(source).filter("topic = 'logs'").drop("timestamp")))
    assert sorted_rows(latest_version(spark.read.parquet(out)), *WINDOW) == sorted_rows(
        window_counts(batch), *WINDOW)


def test_backpressure_across_batches(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), T0 + timedelta(seconds=i), rng.randrange(1500)) for i in range(600)]
    ddl = "event_id long, partition_id int, ts timestamp, depth long"
    for k in range(0, 600, 200):
        spark.createDataFrame(rows[k:k + 200], ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        # File streams take files in order of modification time.
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    tracker = BackpressureTracker(str(tmp_path / "out"))
    tracker.start(stream, str(tmp_path / "c")).awaitTermination()
    got = sorted_rows(spark.read.parquet(str(tmp_path / "out/pause_resume_events")), "event_id", "action")
    want = sorted_rows(bp.pause_resume_events(spark.createDataFrame(rows, ddl)), "event_id", "action")
    assert got == want
    tracker.process(spark.createDataFrame(rows[400:], ddl), 2)
    assert sorted_rows(spark.read.parquet(str(tmp_path / "out/pause_resume_events")), "event_id", "action") == want


def test_live_feed_keeps_the_newest(spark, tmp_path):
    feed = LiveFeed(str(tmp_path), rows=3)
    ddl = "id long, log_ts timestamp, service string, severity string, message string, trace_id string"
    for batch in range(2):
        rows = [(i, T0 + timedelta(seconds=i), "a", "INFO", "m", "t") for i in (batch, batch + 10)]
        feed.process(spark.createDataFrame(rows, ddl), batch)
    shown = spark.read.parquet(feed.path(1))
    assert sorted(r["id"] for r in shown.collect()) == [1, 10, 11]


def test_progress_reports_give_lag(spark):
    report = json.dumps({"timestamp": "2024-01-01T00:00:00.000Z", "sources": [{
        "endOffset": {"logs": {"0": 70, "1": 40}}, "latestOffset": {"logs": {"0": 100, "1": 40}}}]})
    offsets = offsets_from_progress(spark, [report])
    keys = ["topic", "partition_id", "recorded_at"]
    lags = consumer_lag(offsets.select(*keys, "committed"), offsets.select(*keys, "high"), keys)
    assert sorted_rows(lags, "partition_id", "lag") == [(0, 30), (1, 0)]
    rows = tables.lag_snapshot(lags, datetime(2024, 1, 1), None)
    assert rows.schema.names == schemas.METRICS_CONSUMER_LAG.names
    assert rows.filter("consumer_id is null").count() == 2
    assert tables.lag_snapshot(lags.limit(0)).count() == 0


def test_delivery_is_observed(spark, tmp_path):
    from pyspark.sql import Observation
    seen = Observation("delivery")
    df = observe_delivery(spark.range(10), F.col("id") < 3, seen)
    df.write.parquet(str(tmp_path / "x"))
    assert seen.get == {"attempted": 10, "delivered": 7, "failed": 3}


def test_lag_samples_reach_their_table(spark, tmp_path):
    path = str(tmp_path / "metrics_consumer_lag")

    def report(second, ends):
        return json.dumps({"timestamp": f"2024-01-01T00:00:{second:02d}.000Z", "sources": [{
            "endOffset": {"logs": {"0": ends}}, "latestOffset": {"logs": {"0": 100}}}]})

    sampler = LagSampler(spark, path)
    for batch, (second, ends) in enumerate([(0, 10), (10, 20), (30, 40), (59, 50)]):
        sampler.store("q", batch, report(second, ends))
    again = LagSampler(spark, path)  # after a restart the last batch reports once more
    again.store("q", 2, report(30, 40))
    LagSampler(spark, path).store("another", 2, report(30, 99))
    stored = tables.read_table(spark, path, schemas.METRICS_CONSUMER_LAG)
    assert sorted(r["lag"] for r in stored.collect()) == [1, 60, 90]


def test_no_dead_letter_is_lost(spark, tmp_path):
    good = {"original_message": "x", "failure_reason": "late", "retry_count": 3, "failed_at": "2024-01-01T00:00:00Z"}
    texts = [json.dumps(good), json.dumps({**good, "original_message": {"a": 1}}), json.dumps({**good, "retry_count": 11}),
             json.dumps({**good, "note": 1}), json.dumps({**good, "failure_reason": ""}), "letter"]
    rows = [(None, t.encode(), "logs-dlq", 0, n, T0) for n, t in enumerate(texts)] + [(None, b"\xff", "logs-dlq", 1, 0, T0)]
    pipeline = Pipeline(str(tmp_path))
    pipeline.process(spark.createDataFrame(rows, schemas.KAFKA_RECORD), 0)
    assert pipeline.dlq_log(spark).count() == len(rows)


def test_days_do_not_depend_on_the_session_zone(spark, tmp_path):
    path, zone = str(tmp_path / "t"), spark.conf.get("spark.sql.session.timeZone")
    ddl = "log_ts timestamp, n int"
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.sql("SELECT timestamp_micros(1704164400000000) AS log_ts, 1 AS n")  # 2024-01-02T03:00Z
        tables.write_batch(df, path, "log_ts", "r", 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    stored = tables.read_table(spark, path, spark.createDataFrame([], ddl).schema)
    assert [str(r["day"]) for r in stored.collect()] == ["2024-01-02"]
    assert tables.since(stored, "log_ts", F.timestamp_micros(F.lit(1704153600000000))).count() == 1


def test_pivot_and_change_take_what_comes(spark):
    from decimal import Decimal

    from logweir.operators.trends import series_by_service, throughput_change
    rows = [(T0, "billing", 1), (T0 + timedelta(hours=1), "billing", 2_000_000_000), (T0, "db-proxy", 5)]
    df = spark.createDataFrame(rows, "window_start timestamp, service string, message_count long")
    assert series_by_service(df, "message_count").columns == ["window_start", "billing", "db-proxy", "label"]
    with pytest.raises(Exception, match="service without a column: billing"):
        series_by_service(df, "message_count", ["db-proxy"]).collect()
    changes = {r["change_pct"] for r in throughput_change(df).collect()}
    assert changes == {None, Decimal("199999999900.0")}


def test_keyed_backpressure_equals_the_scan_over_batches_and_restarts(spark, tmp_path):
    keyed_backpressure.use_rocksdb(spark)
    rng, ddl = random.Random(6), "event_id long, partition_id int, ts timestamp, depth long"
    rows = [(i, rng.randrange(3), T0 + timedelta(seconds=i // 5), rng.choice([0, 150, 500, 1100])) for i in range(600)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def go(until, silent=3600):
        """Run until the turns are there: a query with timers has no last batch of its own."""
        stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(source)
        query = (keyed_backpressure.KeyedBackpressure(silent_seconds=silent).turns(stream).writeStream.outputMode("append")
                 .option("checkpointLocation", str(tmp_path / "c")).format("parquet").option("path", out).trigger(processingTime="1 second").start())
        end = time.time() + 60
        while query.isActive and time.time() < end and not (
                query.lastProgress and (Path(out) / "_spark_metadata").exists() and until(spark.read.schema(keyed_backpressure.TURNS).parquet(out))):
            time.sleep(0.5)
        query.stop()

    def turns_of(rows):
        return sorted_rows(bp.pause_resume_events(spark.createDataFrame(rows, ddl)), "event_id", "action")

    for k in (0, 200):
        spark.createDataFrame(rows[k:k + 200], ddl).repartition(3).coalesce(1).write.mode("append").parquet(source)
    n = len(turns_of(rows[:400]))
    go(lambda found: found.count() >= n)
    spark.createDataFrame(rows[400:], ddl).coalesce(1).write.mode("append").parquet(source)
    want = turns_of(rows)
    go(lambda found: found.count() >= len(want))
    assert sorted_rows(spark.read.parquet(out), "event_id", "action") == want
    spark.createDataFrame([(1000 + p, p, T0 + timedelta(hours=1), 500) for p in range(3)], ddl).coalesce(1).write.mode("append").parquet(source)
    go(lambda found: found.filter("action = 'SILENT'").count() >= 3, silent=1)
    silent = spark.read.parquet(out).filter("action = 'SILENT'").collect()
    assert {r["partition_id"] for r in silent} == {0, 1, 2} and all(r["ts"] == T0 + timedelta(hours=1) for r in silent)


@given(st.lists(st.sampled_from([-1, 0, 1]), max_size=30), st.booleans())
def test_turns_of_marks(marks, paused):
    at, after = keyed_backpressure.turns_of(np.array(marks, np.int64), paused)
    want = []
    for i, m in enumerate(marks):
        if m == 1 and not paused or m == 0 and paused:
            want.append(i)
            paused = m == 1
    assert at.tolist() == want and after == paused
