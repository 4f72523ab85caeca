"""The refresh of running totals as a job, in built-in operators.

Each micro-batch is summed per key, day and refresh interval.  What is held from batch to
batch are the sums of intervals that the watermark has not passed and the totals published so
far, both at most a row per key and interval; the batch's sums are merged into them, and every
interval that the watermark passes is published as a running total.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from parcelflow.functions import times
from parcelflow.operators.daily import DAY, REFRESH_MS, Measures, accumulate_ticks, tick_totals
from parcelflow.plans.marts import Dimensions, Mart, at_grain, finish
from parcelflow.session import written
from parcelflow.sources.sinks import BatchWriter, append_mart
from parcelflow.sources.store import BucketStore

#: Buckets of what is held.
HELD_BUCKETS = 8

NEWEST = "newest"


def _held(spark: SparkSession, path: str, ticks: DataFrame) -> BucketStore:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ticks.schema.fields)
    return BucketStore(spark, path, f"part STRING, key STRING, {columns}", "part", "key", ["key"], HELD_BUCKETS)


def snapshot_job(
    rows: DataFrame,
    keys: list[str],
    measures: Measures,
    sink: BatchWriter,
    held: str,
    checkpoint: str,
    delay_ms: int = 5_000,
    offset_hours: int = times.BUSINESS_OFFSET_HOURS,
    refresh_ms: int = REFRESH_MS,
    shape: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> DataStreamWriter:
    """Running totals of each key and day, published when the watermark passes a refresh.

    ``sink`` gets day, keys, ``tick_ms`` and the measures so far, as
    :func:`parcelflow.operators.daily.running_snapshots` gives them; a total is null until a
    value came.  The watermark is ``delay_ms`` behind the newest row.  A row that comes after
    its interval was published joins the next one; one that comes after its day is over is
    dropped.  ``held`` is a folder of the job's own.  A batch that is tried again publishes the
    same rows under the same batch id, and what is held moves on only after that.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = F.max("ts").cast("bigint").alias(NEWEST)
        ticks = written(tick_totals(shape(batch), keys, measures, "ts", offset_hours, refresh_ms, (newest,)), "ticks")
        store = _held(spark, held, ticks)
        version = store.version()
        if version.batch_id >= batch_id:
            return
        kinds = {f.name: f.dataType for f in ticks.schema.fields}
        before = store.rows(version=version)
        earlier = store.rows("clock", version).agg(F.max(NEWEST)).first()[0]
        clock = [t for t in (earlier, ticks.agg(F.max(NEWEST)).first()[0]) if t is not None]
        if not clock:
            return
        passed = None if earlier is None else earlier - delay_ms
        now = max(clock) - delay_ms
        last = times.day_end_ms(DAY, offset_hours) - 1
        fresh = ticks
        if passed is not None:
            upcoming = (passed // refresh_ms + 1) * refresh_ms
            fresh = ticks.where(last > passed).withColumn("tick_ms", F.greatest("tick_ms", F.least(F.lit(upcoming), last)).cast("bigint"))
        columns = [DAY, *keys, "tick_ms", *measures]

        def summed(parts: DataFrame, by: list[str]) -> DataFrame:
            return parts.groupBy(*by).agg(*[F.sum(name).cast(kinds[name]).alias(name) for name in measures])

        opened = written(summed(before.where("part = 'open'").select(*columns).unionByName(fresh.select(*columns)), [DAY, *keys, "tick_ms"]), "open-ticks")
        # totals so far stand before the first interval that is due
        totals = before.where("part = 'total'").select(*columns)
        due = totals.unionByName(opened.where(F.col("tick_ms") <= now).select(*columns))
        published = accumulate_ticks(due, keys, measures, offset_hours, refresh_ms).where("tick_ms >= 0")
        sink(published, batch_id)
        left = summed(due, [DAY, *keys]).where(last > now).withColumn("tick_ms", F.lit(-1).cast("bigint"))
        rows_left = opened.where(F.col("tick_ms") > now).select(F.lit("open").alias("part"), *columns)
        rows_left = rows_left.unionByName(left.select(F.lit("total").alias("part"), *columns))
        rows_left = rows_left.withColumn(NEWEST, F.lit(None).cast("bigint"))
        at = spark.range(1).select(F.lit("clock").alias("part"), F.lit(max(clock)).cast("bigint").alias(NEWEST))
        rows_left = rows_left.unionByName(at, allowMissingColumns=True)
        store.replace(rows_left.withColumn("key", F.to_json(F.struct(DAY, *keys))), list(version.folders), batch_id)

    return rows.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)


def mart_snapshot_job(facts: DataFrame, mart: Mart, dims: Callable[[], Dimensions], path: str, held: str, checkpoint: str) -> DataStreamWriter:
    """Facts -> every running total of a mart, with names; the version of a total is its refresh."""
    publish = append_mart(path)

    def sink(published: DataFrame, batch_id: int) -> None:
        ticks = published.withColumn("_version", F.col("tick_ms")).drop("tick_ms")
        for name in mart.carried:  # what is carried is looked up again with the key
            ticks = ticks if name in ticks.columns else ticks.withColumn(name, F.lit(None).cast("string"))
        publish(finish(ticks, mart, dims(), F.col("_version")), batch_id)

    def shape(batch: DataFrame) -> DataFrame:
        return batch if mart.before is None else mart.before(batch, dims())

    seconds = int(mart.delay.split()[0])
    grain = [*mart.keys, *mart.carried]
    return snapshot_job(at_grain(facts, mart), grain, mart.measures, sink, held, checkpoint, 1000 * seconds, shape=shape)
