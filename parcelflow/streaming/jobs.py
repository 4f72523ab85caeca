"""The running jobs: capture, dimensions, facts, marts.

Layers are separate queries joined by topics or folders, since an aggregation in
``update`` mode cannot feed another stateful operator.  Dimensions are handed over as
a function and read anew for every micro-batch.  What a layer hands on is visible once:
through the log of Spark's file sink, or as a batch that is published in one move.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from parcelflow.operators.changes import decode_changes, drop_unusable, encode_changes, set_malformed_aside
from parcelflow.operators.carry import HOT_ROWS
from parcelflow.operators.daily import latest_published
from parcelflow.operators.order_cargo import ORDER_WAIT_MS, pair_batch, relevant_events
from parcelflow.operators.transitions import ORDER_LIFECYCLE
from parcelflow.plans import facts as fact_plans
from parcelflow.plans.dimensions import changed_keys, route_dimensions
from parcelflow.plans.marts import ALL_MARTS, Dimensions, Mart, at_grain, finish
from parcelflow.plans.refresh import changed_ids, renamed
from parcelflow.session import written
from parcelflow.sources.sinks import DIMENSION_BUCKETS, BatchWriter, append_mart, fan_out_to_folders, read_mart, stream_to_folder, stream_to_topic, upsert_dimensions
from parcelflow.sources.store import BucketStore, publish_batch
from parcelflow.streaming.metrics import CAPTURE
from parcelflow.streaming.operators import daily_totals_stream

DimensionReader = Callable[[], Dimensions]

#: Default pace of the marts (fixed value).
REFRESH = "10 seconds"


def capture_job(raw: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Raw envelopes -> cleaned changes, stored by table so that readers prune to theirs.

    Malformed texts go to a table of their own (``DEAD_LETTERS``); ``metrics.StreamCounts``
    counts them.
    """
    return stream_to_folder(set_malformed_aside(raw, CAPTURE), path, checkpoint, "table")


def capture_topic_job(raw: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """The same into one topic, keyed by row id; malformed texts are counted and dropped."""
    return stream_to_topic(encode_changes(drop_unusable(decode_changes(raw), CAPTURE)), servers, topic, checkpoint)


def ordered_capture_job(raw: DataFrame, path: str, checkpoint: str, key: str = "id") -> DataStreamWriter:
    """Captured changes by table, the history of each row in order from file to file of a batch.

    Batches follow one another, and within one the files of a table are ranges of (key, ts,
    seq) in the order of their names.  A hot key may fill many of them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        changes = drop_unusable(decode_changes(batch), None).withColumn("_key", F.get_json_object("after", f"$.{key}"))
        by = ["table", "_key", "ts", "seq"]
        laid = changes.repartitionByRange(*by).sortWithinPartitions(*by).drop("_key")
        publish_batch(laid, batch_id, path, "table", as_laid=True)

    return each_batch(raw, write, checkpoint)


def each_batch(df: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    return df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)


def dimension_job(
    changes: DataFrame, config: Callable[[], DataFrame], path: str, checkpoint: str, apply_deletes: bool = False, buckets: int = DIMENSION_BUCKETS
) -> DataStreamWriter:
    """Dimension changes -> upserts, under the routing config in force at each batch."""
    upsert = upsert_dimensions(path, buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(route_dimensions(batch, config(), apply_deletes=apply_deletes), batch_id)

    return each_batch(changes, write, checkpoint)


#: Buckets of what the pairing holds from batch to batch.
HELD_BUCKETS = 32


def held_orders(spark: SparkSession, path: str, events: DataFrame, buckets: int = HELD_BUCKETS) -> BucketStore:
    """What the pairing below ``path`` holds: per order the latest cargo, and an order that waits for cargo."""
    order, cargo = (events.schema[c].dataType.simpleString() for c in ("order", "cargo"))
    schema = f"part STRING, key STRING, cargo {cargo}, waiting STRUCT<order: {order}, ts: BIGINT>"
    return BucketStore(spark, f"{path}/_held", schema, "part", "key", ["key"], buckets)


def order_fact_job(
    changes: DataFrame, path: str, checkpoint: str, wait_ms: int = ORDER_WAIT_MS, hot_rows: int | None = HOT_ROWS, buckets: int = HELD_BUCKETS
) -> DataStreamWriter:
    """Order and cargo changes -> eight fact folders.

    Each batch is paired in the batch form, over its events and what its keys' buckets hold
    from before, so keys of any size are split as there.  The facts are published first and
    what is held moves on after; a batch that is tried again finds either done or does it anew.
    """
    lifecycle = ORDER_LIFECYCLE
    publish = fan_out_to_folders(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        events = written(relevant_events(fact_plans.order_events(batch), lifecycle).withColumn("part", F.lit("held")), "order-events")
        store = held_orders(batch.sparkSession, path, events, buckets)
        version = store.version()
        places = store.touched(events, version)
        if version.batch_id >= batch_id or not places:
            return
        paired, left = pair_batch(events.drop("part"), store.held_for(events, version).drop("part"), lifecycle, wait_ms, hot_rows)
        publish(fact_plans.finish_order_facts(paired), batch_id)
        store.replace(left.withColumn("part", F.lit("held")), places, batch_id)

    return each_batch(changes, write, checkpoint)


def bound_fact_job(changes: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Sorting-centre changes -> three fact folders, which other streams read through the sink's log."""
    return stream_to_folder(fact_plans.bound_facts(changes), path, checkpoint, "fact_type")


def trip_fact_job(changes: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Truck task changes -> one fact per finished trip."""
    return stream_to_folder(fact_plans.trip_facts(changes), path, checkpoint)


def mart_key_job(facts: DataFrame, mart: Mart, dims: DimensionReader, path: str, checkpoint: str) -> DataStreamWriter:
    """First hop of a mart whose key comes from a dimension: facts with their key filled in."""
    if mart.before is None:
        raise ValueError(f"{mart.table} has its key in the fact; start mart_job on the facts")

    def write(batch: DataFrame, batch_id: int) -> None:
        publish_batch(mart.before(batch, dims()), batch_id, path, in_time="ts")

    return each_batch(at_grain(facts, mart), write, checkpoint)


def mart_job(
    rows: DataFrame,
    mart: Mart,
    dims: DimensionReader,
    sink: BatchWriter,
    checkpoint: str,
    version: Column | None = None,
) -> DataStreamWriter:
    """Facts at the mart's grain, keys filled in -> running totals with names, appended.

    Trigger it with ``processingTime=REFRESH``, or ``availableNow`` to catch up and stop.
    """
    totals = daily_totals_stream(rows, list(mart.keys), mart.measures, list(mart.carried), mart.delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(finish(batch, mart, dims(), version), batch_id)

    return each_batch(totals, write, checkpoint, "update")


def rename_job(
    changes: DataFrame, config: Callable[[], DataFrame], dims: DimensionReader, marts: dict[str, str], checkpoint: str, version: Column | None = None
) -> DataStreamWriter:
    """Dimension updates -> new versions of the mart rows that name a changed row.

    ``marts`` maps mart tables to their folders.  Run it behind :func:`dimension_job`, so that
    ``dims`` has the new names.  Its batches have ids of their own below zero.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = written(changed_keys(route_dimensions(batch, config())), "changed-keys")
        if changed.isEmpty():
            return
        now = dims()
        ids = written(changed_ids(changed, now), "changed-ids")
        for table, path in marts.items():
            mart = ALL_MARTS[table]
            current = latest_published(read_mart(spark, path, table), list(mart.keys))
            append_mart(path)(renamed(current, mart, now, ids, version), -1 - batch_id)

    return each_batch(changes, write, checkpoint)
