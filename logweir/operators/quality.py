"""Completeness checks: gaps, delays, delivery statistics and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from logweir.functions.rates import ratio
from logweir.settings import LOG_GAP_SECONDS

DAY_MICROS = 86_400_000_000


def log_gaps(logs: DataFrame, seconds: int = LOG_GAP_SECONDS, time_col: str = "log_ts") -> DataFrame:
    """Stretches of more than ``seconds`` between consecutive timestamps of the whole table.

    Two timestamps in one cell of ``seconds`` width are never that far apart, so a gap always
    lies between the last timestamp of one cell and the first of the next non-empty cell. The
    logs are reduced to one row per cell (combined on the map side), the cells to one row per
    day; gaps inside a day are found among its cells, gaps between days among the days. Both
    read the same shuffle of cells, so the logs are scanned once.
    """
    width = F.lit(seconds * 1_000_000).cast("bigint")
    micros = F.unix_micros(time_col)
    cells = (
        logs.groupBy((micros - F.pmod(micros, width)).alias("cell"))
        .agg(F.min(micros).alias("first"), F.max(micros).alias("last"))
        .withColumn("day", F.col("cell") - F.pmod(F.col("cell"), F.lit(DAY_MICROS)))
    )
    days = cells.groupBy("day").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    gap = F.col("first") - F.col("before")

    def gaps(stretches: DataFrame, in_order: WindowSpec) -> DataFrame:
        return (
            stretches.withColumn("before", F.lag("last").over(in_order)).filter(gap > width)
            .select(F.timestamp_micros("before").alias("gap_start"),
                    F.timestamp_micros("first").alias("gap_end"), gap.alias("gap_micros"))
        )

    within = gaps(cells, W.partitionBy("day").orderBy("cell"))
    return within.unionByName(gaps(days, W.orderBy("day")))


QUANTILES = (50, 95, 99)


def delay_bucket(delay: Column, bits: int = 10) -> Column:
    """An order-preserving bucket of a delay: its ``bits`` leading bits and how many follow.

    There are at most 2 * 64 * 2 ** bits buckets, however far delays spread; those of up to
    ``bits`` bits (below 1024 ms with ten) have one each.
    """
    size = F.abs(delay)
    behind = F.greatest(F.lit(0), F.length(F.bin(size)) - bits)
    bucket = behind * (1 << bits) + F.call_function("shiftright", size, behind)
    return F.when(delay < 0, -bucket).otherwise(bucket)


def bucket_reaching(percent: int) -> Column:
    """From sorted ``buckets`` (bucket, n): the first whose running count reaches the quantile."""
    start = F.struct(F.lit(0).cast("bigint").alias("below"), F.lit(None).cast("bigint").alias("bucket"))
    return F.aggregate("buckets", start, lambda at, x: F.when(at["bucket"].isNotNull(), at).when(
        (at["below"] + x["n"]) * 100 >= F.col("messages") * percent,
        F.struct(at["below"].alias("below"), x["bucket"].alias("bucket"))).otherwise(
        F.struct((at["below"] + x["n"]).alias("below"), at["bucket"].alias("bucket"))))


def ingest_delay(
    logs: DataFrame, event_time: str = "log_ts", arrival_time: str = "ingested_at",
    by: str = "service",
) -> DataFrame:
    """Delay between log time and ingestion in milliseconds per service: exact quantiles.

    Messages are counted per service and delay, and these counts per bucket of delays. A bounded
    list of buckets tells which of them holds a quantile; only that bucket's delays are ranked.
    """
    delay = F.call_function("div", F.unix_micros(arrival_time) - F.unix_micros(event_time),
                            F.lit(1000).cast("bigint"))
    histogram = (logs.groupBy(by, delay.alias("delay_ms")).agg(F.count(F.lit(1)).alias("n"))
                 .withColumn("bucket", delay_bucket(F.col("delay_ms")).cast("bigint")))
    counted = histogram.groupBy(by, "bucket").agg(
        F.sum("n").alias("n"), F.min("delay_ms").alias("low"), F.max("delay_ms").alias("high"))
    whole = counted.groupBy(by).agg(
        F.sum("n").alias("messages"), F.min("low").alias("min_ms"), F.max("high").alias("max_ms"),
        F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("buckets"))
    places = whole.select(by, "messages", F.explode(F.array(*(
        F.struct(F.lit(p).alias("percent"), bucket_reaching(p).alias("at")) for p in QUANTILES))).alias("q")).select(
        by, "messages", "q.percent", "q.at.below", "q.at.bucket")
    upto = W.partitionBy(by, "bucket", "percent").orderBy("delay_ms").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = histogram.join(places, [by, "bucket"]).withColumn("rank", F.col("below") + F.sum("n").over(upto))
    reached = F.col("rank") * 100 >= F.col("messages") * F.col("percent")
    quantiles = ranked.groupBy(by).agg(*(
        F.min(F.when(reached & (F.col("percent") == p), F.col("delay_ms"))).alias(f"p{p}_ms") for p in QUANTILES))
    return whole.drop("buckets").join(quantiles, by).select(
        by, "messages", "min_ms", *(f"p{p}_ms" for p in QUANTILES), "max_ms")


def delivery_stats(reports: DataFrame, sent_at: str = "ts", status: str = "status") -> DataFrame:
    """Attempted, delivered, failed, elapsed seconds and delivered per hour, in one row."""
    totals = reports.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col(status) == "delivered").alias("delivered"),
        F.count_if(F.col(status) == "failed").alias("failed"),
        F.coalesce(F.unix_micros(F.max(sent_at)) - F.unix_micros(F.min(sent_at)),
                   F.lit(0)).alias("_micros"),
    )
    per_hour = F.col("delivered").cast("decimal(20,0)") * F.lit(3_600_000_000).cast("decimal(10,0)")
    return totals.select(
        "attempted", "delivered", "failed",
        F.call_function("div", F.col("_micros"), F.lit(1_000_000).cast("bigint"))
        .alias("elapsed_seconds"),
        ratio(per_hour, F.col("_micros"), 2, "decimal(14,2)").alias("delivered_per_hour"))


def _tagged(parts: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Union of the inputs reduced to their names: no column of them is read for counting."""
    tagged = [df.select(F.lit(part).alias(name)) for part, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged)


def stage_counts(stages: Mapping[str, DataFrame], seconds: int) -> DataFrame:
    """Messages at each pipeline stage and their mean rate over ``seconds``, given what each holds."""
    counts = _tagged(stages, "stage").groupBy("stage").agg(F.count(F.lit(1)).alias("messages"))
    rate = ratio(F.col("messages"), F.lit(seconds), 4, "decimal(14,4)")
    return counts.withColumn("messages_per_sec", rate)


def reconcile_counts(produced: DataFrame, processed: DataFrame, letters: DataFrame) -> DataFrame:
    """Produced, processed, dead-lettered and missing message counts, in one row."""
    parts = {"produced": produced, "processed": processed, "dead_lettered": letters}
    counts = _tagged(parts, "part").agg(*[F.count_if(F.col("part") == n).alias(n) for n in parts])
    return counts.withColumn(
        "missing", F.col("produced") - F.col("processed") - F.col("dead_lettered"))


def lost_messages(
    produced: DataFrame, processed: DataFrame, letters: DataFrame, message_id: str = "event_id"
) -> DataFrame:
    """Produced messages found neither among the processed nor among the dead letters.

    Message ids are unique, so the joins spread evenly whatever the services look like. Only ids
    are compared; what the few lost messages hold is fetched afterwards.
    """
    kept = processed.select(message_id).unionByName(letters.select(message_id))
    lost = produced.select(message_id).join(kept, message_id, "left_anti")
    return produced.join(lost, message_id, "left_semi")
