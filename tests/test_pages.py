"""Pages of dead letters by the directory of counts."""

import pytest
from pyspark.sql import functions as F

from logweir import schemas
from logweir.operators.dead_letters import page
from logweir.streaming.pipeline import BY_HAND, Pipeline


def letters(spark, n, every_ms, first=0):
    """``n`` letters, an equal time apart; ties of two, and ids that do not follow the time."""
    number = F.col("id") + first
    return spark.range(n).select(
        (number * 7919 % 1_000_003 + number * 1_000_003).alias("id"),
        F.timestamp_millis(1_704_067_200_000 + F.floor(number / 2) * 2 * every_ms).alias("failed_at"),
        F.lit("m").alias("original_message"), F.lit("r").alias("failure_reason"), F.lit(0).alias("retry_count"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), number.alias("offset"))


def store(spark, pipeline, rows, batch):
    rows = rows.to(schemas.STORED_LETTERS)
    ledger = pipeline.ledger(spark)
    ledger.commit(BY_HAND, batch, {"dlq_log": ledger.write("dlq_log", rows, "failed_at", f"{BY_HAND}-{batch}")})


def test_an_offset_of_a_million_reads_one_day(spark, tmp_path):
    pipeline = Pipeline(str(tmp_path / "deep"))
    store(spark, pipeline, letters(spark, 1_500_000, 1000), 0)  # 17 days and a part of one
    pipeline.fold(spark)
    got = pipeline.dead_letter_page(spark, 50, 1_000_000)
    days = {part for f in got.inputFiles() for part in f.split("/") if part.startswith("day=")}
    assert days == {"day=2024-01-06"}
    assert got.collect() == page(pipeline.dlq_log(spark), 50, 1_000_000).collect()
    counted = pipeline.letter_counts(pipeline.snapshot(spark))
    assert not [f for f in counted.inputFiles() if "dlq_log" in f]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_pages_over_folds_and_batches(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        pipeline = Pipeline(str(tmp_path / "pages"))
        assert pipeline.dead_letter_page(spark, 5, 0).collect() == []
        for batch, (n, first) in enumerate([(300, 0), (200, 250), (100, 0)]):
            store(spark, pipeline, letters(spark, n, 600_000, first), batch)
            if batch < 2:
                pipeline.fold(spark)  # the second touches days of the first; the third stays unfolded
        whole = page(pipeline.dlq_log(spark), 500, 0).collect() + page(pipeline.dlq_log(spark), 500, 500).collect()
        assert len(whole) == 600
        for limit, offset in ((7, 0), (50, 93), (500, 150), (5, 598), (5, 600), (1, 10**12)):
            got = pipeline.dead_letter_page(spark, limit, offset).collect()
            assert [(r.id, r.failed_at) for r in got] == [(r.id, r.failed_at) for r in whole[offset:offset + limit]]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    with pytest.raises(ValueError):
        pipeline.dead_letter_page(spark, 0, 0)
