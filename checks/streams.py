"""Streaming queries: each runs its stream to the end of the input and gives what was stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from checks import feeds
from checks.feeds import TABLES, epoch_ms, money, table
from checks.queries import EVENT_MEASURES, _lifecycle_columns, _money_sum, query
from parcelflow.operators.changes import decode_changes
from parcelflow.operators.daily import latest_published
from parcelflow.plans import facts
from parcelflow.plans.marts import ALL_MARTS
from parcelflow.session import STATE_STORE_CONF, conf_scope, work_dir, written
from parcelflow.sources.readers import RAW, read_folder
from parcelflow.sources.sinks import append_mart, read_dimension, read_mart, stream_to_folder
from parcelflow.sources.store import publish_batch
from parcelflow.streaming import jobs
from parcelflow.streaming.operators import daily_totals_stream, running_snapshots_stream
from parcelflow.streaming.snapshots import snapshot_job

#: The whole input in one micro-batch: nothing can be late, so the outcome equals the batch form.
EVERYTHING = {"maxFilesPerTrigger": "1000000"}

#: Micro-batches that a feed in steps comes in.
STEPS = 8


def run_to_end(spark: SparkSession, writer: DataStreamWriter, extra: dict[str, str] | None = None) -> None:
    settings = {
        **STATE_STORE_CONF,
        "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
        **(extra or {}),
    }
    with conf_scope(spark, settings):
        writer.trigger(availableNow=True).start().awaitTermination()


def streamed_feed(spark: SparkSession, folder: str, feed: DataFrame) -> DataFrame:
    """A derived feed, written out and read back as a stream of envelope text."""
    feed.write.parquet(f"{folder}/feed")
    return read_folder(spark, f"{folder}/feed", RAW, **EVERYTHING)


def in_steps(spark: SparkSession, folder: str, rows: DataFrame, step: Column) -> DataFrame:
    """Rows as a stream of micro-batches, one for each value of ``step`` from 0 to ``STEPS`` - 1."""
    files = spark.sparkContext.defaultParallelism
    rows.withColumn("_step", step).repartition(files).write.partitionBy("_step").parquet(f"{folder}/steps")
    for k in range(STEPS):
        part = spark.read.schema(rows.schema).option("recursiveFileLookup", "true")
        part.parquet(f"{folder}/steps/_step={k}").repartition(files).write.mode("append").parquet(f"{folder}/feed")
    return read_folder(spark, f"{folder}/feed", rows.schema, maxFilesPerTrigger=str(files))


def feed_in_steps(spark: SparkSession, folder: str, feed: DataFrame) -> DataFrame:
    """All rows of a feed, in order of arrival, as one micro-batch per step."""
    whole = written(feed, "feed")
    first, last = whole.agg(F.min("seq"), F.max("seq")).first()
    return in_steps(spark, folder, whole, F.least(F.floor((F.col("seq") - first) * STEPS / F.lit(max(last - first, 1))), F.lit(STEPS - 1)))


def streamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_folder(spark, sf_dir, TABLES["events"], pathGlobFilter="events.parquet", **EVERYTHING)


@query
def stream_order_cargo(spark, sf_dir):
    folder = work_dir(spark, "stream-order-cargo")
    raw = streamed_feed(spark, folder, feeds.order_feed(table(spark, sf_dir, "events")))
    changes = facts.decode_order_changes(raw)
    run_to_end(spark, jobs.order_fact_job(changes, f"{folder}/facts", f"{folder}/checkpoint", wait_ms=feeds.FEED_WAIT_MS))
    return _lifecycle_columns(spark.read.parquet(f"{folder}/facts"))


@query
def stream_order_cargo_steps(spark, sf_dir):
    """The pairing with what it holds carried over many micro-batches, every key of a batch cut into slices."""
    folder = work_dir(spark, "stream-order-steps")
    raw = feed_in_steps(spark, folder, feeds.order_feed(table(spark, sf_dir, "events")))
    job = jobs.order_fact_job(facts.decode_order_changes(raw), f"{folder}/facts", f"{folder}/checkpoint", feeds.FEED_WAIT_MS, hot_rows=20, buckets=8)
    run_to_end(spark, job)
    return _lifecycle_columns(spark.read.parquet(f"{folder}/facts"))


@query
def stream_fanout(spark, sf_dir):
    folder = work_dir(spark, "stream-fanout")
    raw = feed_in_steps(spark, folder, feeds.bound_feed(table(spark, sf_dir, "events")))
    changes = facts.decode_bound_changes(raw)
    run_to_end(spark, jobs.bound_fact_job(changes, f"{folder}/facts", f"{folder}/checkpoint"))
    stored = spark.read.parquet(f"{folder}/facts")
    return stored.select("fact_type", "id", "order_id", "org_id", "event_time", "emp_id", "ts")


@query
def stream_dim_upsert(spark, sf_dir):
    folder = work_dir(spark, "stream-dim-upsert")
    changes = decode_changes(feed_in_steps(spark, folder, feeds.change_feed(table(spark, sf_dir, "events"))))
    job = jobs.dimension_job(changes, lambda: feeds.buyer_config(spark), f"{folder}/dims", f"{folder}/checkpoint", buckets=4)
    run_to_end(spark, job)
    buyers = read_dimension(spark, f"{folder}/dims", "dim_buyer", "user_id", ["user_id", "event_id", "value"])
    return buyers.withColumn("value", F.col("value").cast("decimal(16,2)"))


@query
def stream_mart_update_final(spark, sf_dir):
    """Sort facts through the running mart; the newest version of each day and key."""
    folder, name = work_dir(spark, "stream-mart"), "dws_bound_org_sort_day_base"
    raw = streamed_feed(spark, folder, feeds.bound_feed(table(spark, sf_dir, "events")))
    changes = facts.decode_bound_changes(raw)
    sorted_facts = facts.bound_fact(facts.bound_facts(changes), "dwd_bound_sort")
    dims = feeds.Dimensions(spark, sf_dir)
    job = jobs.mart_job(sorted_facts, ALL_MARTS[name], lambda: dims, append_mart(f"{folder}/mart"), f"{folder}/checkpoint")
    run_to_end(spark, job)
    return latest_published(read_mart(spark, f"{folder}/mart", name), ["org_id"]).drop("ts")


@query
def stream_mart_keyed_final(spark, sf_dir):
    """Orders through both hops of a mart whose key is looked up, in several batches each."""
    folder, mart = work_dir(spark, "stream-keyed-mart"), ALL_MARTS["dws_trade_org_order_day_base"]
    needed = [*mart.grain.values(), "amount", "ts"]
    placed = written(feeds.placed_orders(spark, sf_dir).select(*needed), "orders")
    first, last = placed.agg(F.min("ts"), F.max("ts")).first()
    step = F.least(F.floor((F.col("ts") - first) * STEPS / F.lit(max(last - first, 1))), F.lit(STEPS - 1))
    orders = in_steps(spark, folder, placed, step)
    dims = feeds.Dimensions(spark, sf_dir)
    first = jobs.mart_key_job(orders, mart, lambda: dims, f"{folder}/keyed", f"{folder}/checkpoint-key")
    run_to_end(spark, first)
    layout = spark.read.parquet(f"{folder}/keyed").drop("batch_id").schema
    keyed = read_folder(spark, f"{folder}/keyed", layout, recursiveFileLookup="true", maxFilesPerTrigger="1")
    sink = append_mart(f"{folder}/mart", by_day=False)
    job = jobs.mart_job(keyed, mart, lambda: dims, sink, f"{folder}/checkpoint-mart")
    run_to_end(spark, job)
    return latest_published(read_mart(spark, f"{folder}/mart", mart.table), ["org_id"]).drop("ts")


@query
def stream_snapshot_timer(spark, sf_dir):
    """Every refresh the watermark allows by the end of the input."""
    folder = work_dir(spark, "stream-snapshots")
    rows = streamed_events(spark, sf_dir).select("event_type", money("value").alias("value"), epoch_ms("ts").alias("ts"))
    snapshots = _money_sum(running_snapshots_stream(rows, ["event_type"], EVENT_MEASURES), "total_value")
    run_to_end(spark, stream_to_folder(snapshots, f"{folder}/rows", f"{folder}/checkpoint"))
    return spark.read.schema(snapshots.schema).parquet(f"{folder}/rows")


@query
def stream_snapshot_steps(spark, sf_dir):
    """The refreshes as a job over many micro-batches."""
    folder = work_dir(spark, "stream-snapshot-steps")
    events = written(table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "event_type", money("value").alias("value"), epoch_ms("ts").alias("ts")), "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step = F.least(F.floor((F.col("ts") - first) * STEPS / F.lit(max(last - first, 1))), F.lit(STEPS - 1))
    rows = in_steps(spark, folder, events.drop("seq"), step)
    layout = "day INT, event_type STRING, tick_ms BIGINT, n_events BIGINT, total_value DECIMAL(26,2)"

    def sink(batch, batch_id):
        publish_batch(batch.select("day", "event_type", "tick_ms", "n_events", "total_value"), batch_id, f"{folder}/rows")

    run_to_end(spark, snapshot_job(rows, ["event_type"], EVENT_MEASURES, sink, f"{folder}/held", f"{folder}/checkpoint"))
    return _money_sum(spark.read.schema(layout).parquet(f"{folder}/rows").drop("batch_id"), "total_value")


def _late_totals(spark: SparkSession, sf_dir: str, delay: str) -> DataFrame:
    """Daily totals of a feed of which every 13th event comes three steps late: some of them after their day."""
    folder = work_dir(spark, "stream-late")
    events = written(table(spark, sf_dir, "events").select("event_id", "event_type", money("value").alias("value"), epoch_ms("ts").alias("ts")), "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    on_time = F.least(F.floor((F.col("ts") - first) * STEPS / F.lit(max(last - first, 1))), F.lit(STEPS - 1))
    step = F.least(on_time + F.when(F.col("event_id") % 13 == 0, 3).otherwise(0), F.lit(STEPS - 1))
    rows = in_steps(spark, folder, events, step)
    totals = daily_totals_stream(rows, ["event_type"], EVENT_MEASURES, delay=delay)

    def write(batch, batch_id):
        publish_batch(batch, batch_id, f"{folder}/totals")

    run_to_end(spark, jobs.each_batch(totals, write, f"{folder}/checkpoint", "update"))
    stored = spark.read.parquet(f"{folder}/totals")
    newest = stored.groupBy("day", "event_type").agg(F.max("n_events").alias("n_events"), F.max_by("total_value", "batch_id").alias("total_value"))
    return _money_sum(newest, "total_value")


@query
def stream_mart_late(spark, sf_dir):
    return _late_totals(spark, sf_dir, "5 seconds")


@query
def stream_mart_late_10s(spark, sf_dir):
    return _late_totals(spark, sf_dir, "10 seconds")
