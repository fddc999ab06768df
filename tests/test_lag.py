"""Lag and backpressure against row-by-row loops."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logweir.operators import backpressure as bp
from logweir.operators import lag
from logweir.operators import scan

T0 = datetime(2024, 1, 1)
SAMPLES = "event_id long, partition_id int, ts timestamp, depth long"


def make_samples(seed, n=1500):
    """A third of all samples share one second of one partition, half of these one instant."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        crowded = i % 3 == 0
        at = timedelta(microseconds=0 if i % 2 else rng.randrange(1_000_000)) if crowded else timedelta(
            seconds=rng.randrange(40_000))
        rows.append((i, 0 if crowded else rng.randrange(4), T0 + at,
                     rng.choice([rng.randrange(250), rng.randrange(200, 1000), rng.randrange(900, 1500)])))
    return rows


def loop(rows, paused=()):
    paused, states, turns = set(paused), {}, []
    for i, p, ts, depth in sorted(rows, key=lambda r: (r[2], r[0])):
        if depth >= 1000:
            states[i] = "high_water"
            if p not in paused:
                turns.append((i, "PAUSE"))
            paused.add(p)
        elif p in paused and depth <= 200:
            states[i] = "low_water"
            turns.append((i, "RESUME"))
            paused.discard(p)
        else:
            states[i] = "normal"
    return states, sorted(turns), paused


@pytest.mark.parametrize("max_rows", [10**6, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_states_equal_the_loop(spark, seed, max_rows):
    rows = make_samples(seed)
    df = spark.createDataFrame(rows, SAMPLES)
    states, turns, paused = loop(rows)
    got = {r["event_id"]: r["state"] for r in bp.backpressure_states(df, slice_max_rows=max_rows).collect()}
    assert got == states
    events = bp.pause_resume_events(df, slice_max_rows=max_rows).collect()
    assert sorted((r["event_id"], r["action"]) for r in events) == turns
    assert {r[0] for r in bp.paused_partitions(df).collect()} == paused


def test_flags_carry_over(spark):
    rows = make_samples(3, 600)
    first, second = rows[:300], [(i, p, ts + timedelta(days=1), d) for i, p, ts, d in rows[300:]]
    _, _, paused = loop(first)
    flags = bp.partition_flags(spark.createDataFrame(first, SAMPLES))
    assert {r["partition_id"] for r in flags.collect() if r["paused"]} == paused
    states, turns, after = loop(second, paused)
    df = spark.createDataFrame(second, SAMPLES)
    got = {r["event_id"]: r["state"] for r in bp.backpressure_states(df, seeds=flags).collect()}
    assert got == states
    events = bp.pause_resume_events(df, seeds=flags).collect()
    assert sorted((r["event_id"], r["action"]) for r in events) == turns
    left = bp.partition_flags(df, seeds=flags).collect()
    assert {r["partition_id"] for r in left if r["paused"]} == after


def test_blocks_of_one_instant(spark, monkeypatch):
    monkeypatch.setattr(scan, "BLOCK_BITS", 3)
    rows = [(i * 5 - 2000, i % 2, T0, (0, 500, 1200)[i * i % 3]) for i in range(800)]
    states, turns, _ = loop(rows)
    df = spark.createDataFrame(rows, SAMPLES).repartition(4)
    assert {r["event_id"]: r["state"] for r in bp.backpressure_states(df, slice_max_rows=50).collect()} == states
    assert sorted((r["event_id"], r["action"]) for r in bp.pause_resume_events(df, slice_max_rows=50).collect()) == turns


def test_an_instant_of_a_million_samples(spark):
    """Every sample in one instant of one partition: the turns are those of the loop, found by blocks."""
    n = 1_000_000
    depth = F.when(F.pmod(F.xxhash64("id"), F.lit(5)) == 0, 1100).when(F.pmod(F.xxhash64("id"), F.lit(7)) == 1, 100).otherwise(500)
    df = spark.range(n).select(F.col("id").alias("event_id"), F.lit(0).alias("partition_id"), F.lit(T0).alias("ts"),
                               depth.cast("bigint").alias("depth"))
    paused, turns = False, 0
    for depths in df.orderBy("event_id").select("depth").toPandas()["depth"].to_numpy():
        if depths >= 1000 and not paused or depths <= 200 and paused:
            paused, turns = not paused, turns + 1
    got = bp.pause_resume_events(df, slice_max_rows=100_000)
    assert got.count() == turns > 100_000
    assert got.filter("action = 'PAUSE'").count() == (turns + 1) // 2


def test_building_the_scan_runs_no_job(spark):
    df = spark.createDataFrame(make_samples(4), SAMPLES)
    spark.sparkContext.setJobGroup("building", "")
    bp.backpressure_states(df, slice_max_rows=2)
    made = bp.pause_resume_events(df, slice_max_rows=2)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("done", "")
    assert "ResolvedHint" not in made._jdf.queryExecution().analyzed().toString()


def test_lag_at(spark):
    readings_ = readings(spark, [(0, 0, 10), (30, 0, 20), (30, 1, 5), (300, 0, 90)])
    events = spark.createDataFrame([(i, p, T0 + timedelta(seconds=s)) for i, (p, s) in enumerate(
        [(0, 0), (0, 29), (0, 31), (0, 119), (0, 121), (1, 10), (0, 299), (2, 40)])], "event_id long, partition_id int, ts timestamp")
    got = {r["event_id"]: r["lag"] for r in lag.lag_at(events, readings_, 60).collect()}
    assert got == {0: 10, 1: 10, 2: 20, 3: 20, 4: None, 5: None, 6: None, 7: None}


def test_lag_bound_counts_as_high(spark):
    df = spark.createDataFrame([(1, 0, T0, 5, 9000), (2, 0, T0 + timedelta(seconds=1), 5, 10)],
                               SAMPLES + ", lag long")
    assert bp.pause_resume_events(df).count() == 0
    events = bp.pause_resume_events(df, lag_high=5000).orderBy("event_id").collect()
    assert [(r["action"], r["lag"], r["depth"]) for r in events] == [("PAUSE", 9000, 5), ("RESUME", 10, 5)]


def test_marks_must_not_cross():
    with pytest.raises(ValueError):
        bp.mark(100, 100)


def test_lag_skips_partitions_without_commit(spark):
    committed = spark.createDataFrame([("logs", 0, 5), ("logs", 1, -1), ("logs", 2, 30)],
                                      "topic string, partition_id int, committed long")
    high = spark.createDataFrame([("logs", p, 20) for p in range(4)], "topic string, partition_id int, high long")
    got = {r["partition_id"]: r["lag"] for r in lag.consumer_lag(committed, high).collect()}
    assert got == {0: 15, 2: 0}


def readings(spark, rows):
    return spark.createDataFrame(
        [(i, T0 + timedelta(seconds=s), p, v, None) for i, (s, p, v) in enumerate(rows)],
        "id long, recorded_at timestamp, partition_id int, lag long, consumer_id string")


def test_latest_lag_and_ties(spark):
    df = readings(spark, [(0, 0, 10), (30, 0, 20), (30, 0, 21), (0, 1, 7)])
    assert {r["partition_id"]: r["lag"] for r in lag.latest_lag(df).collect()} == {0: 21, 1: 7}
    assert [r["lag"] for r in lag.latest_lag(df, partition=0).collect()] == [21]
    assert lag.total_lag(df).first()[0] == 28
    assert lag.total_lag(df.limit(0)).first()[0] == 0


def test_recovery(spark):
    df = readings(spark, [(0, 0, 10), (30, 0, 900), (60, 0, 100), (80, 0, 40), (90, 0, 5),
                          (0, 1, 3000), (500, 1, 10), (0, 2, 80)])
    got = {r["partition_id"]: (r["recovery_seconds"], r["recovered_in_time"], r["bounded"])
           for r in lag.lag_recovery(df).collect()}
    assert got == {0: (50, True, True), 1: (500, False, False), 2: (None, False, True)}


def test_bands(spark):
    df = readings(spark, [(0, 0, v) for v in (0, 499, 500, 2000, 2001)])
    assert [r["band"] for r in lag.lag_bands(df).orderBy("lag").collect()] == [
        "green", "green", "yellow", "yellow", "red"]
