"""Streaming forms of the daily totals and their refreshes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, StructField, StructType

from parcelflow.functions import times
from parcelflow.operators.daily import DAY, FIRST, REFRESH_MS, Measures, tick
from parcelflow.sources.schemas import MONEY_SUM
from parcelflow.streaming.metrics import observe_days
from parcelflow.streaming.processors import DayRefreshProcessor, combine_ticks


def with_event_time(facts: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """Add ``event_time`` with a watermark ``delay`` behind its maximum.

    The maximum is taken over all of the input, so an idle partition holds nothing back.
    """
    return facts.withColumn("event_time", F.timestamp_millis(ts)).withWatermark("event_time", delay)


def daily_totals_stream(
    facts: DataFrame,
    keys: list[str],
    measures: Measures,
    carried: list[str] = [],
    delay: str = "5 seconds",
    offset_hours: int = times.BUSINESS_OFFSET_HOURS,
) -> DataFrame:
    """Running totals per day and key with built-in streaming aggregation.

    For ``update`` mode: each trigger gives the new totals of the groups that changed.
    Rows of a day the watermark has passed are dropped; ``metrics.StreamCounts`` counts them.
    """
    sums = [(F.count(F.lit(1)) if c is None else F.sum(c)).alias(name) for name, c in measures.items()]
    first = [F.min_by(F.struct(*carried), F.struct(FIRST, *carried)).alias("_first")] if carried else []
    timed = with_event_time(observe_days(facts, "ts", offset_hours).withColumn(FIRST, F.col("ts")), delay)
    totals = timed.groupBy(times.day_window("event_time", offset_hours).alias("_window"), *keys).agg(*sums, *first)
    day = F.datediff(times.window_date(F.col("_window"), offset_hours), F.lit("1970-01-01").cast("date"))
    return totals.select(day.alias(DAY), *keys, *[F.col(f"_first.{c}").alias(c) for c in carried], *measures)


def _state_kind(facts: DataFrame, source: str | None) -> str:
    """Fractions are summed as doubles; counts, whole numbers and decimals (in their last place) as longs."""
    return "DOUBLE" if source is not None and isinstance(facts.schema[source].dataType, (DoubleType, FloatType)) else "BIGINT"


def _state_value(facts: DataFrame, source: str | None) -> Column:
    """What a row adds to a measure's state; nulls add nothing."""
    if source is None:
        return F.lit(1).cast("bigint")
    kind = facts.schema[source].dataType
    scale = 10**kind.scale if isinstance(kind, DecimalType) else 1
    value = F.col(source) * scale if scale > 1 else F.col(source)
    return F.coalesce(value.cast(_state_kind(facts, source)), F.lit(0).cast(_state_kind(facts, source)))


def _from_state(facts: DataFrame, name: str, source: str | None) -> Column:
    """The published total: null, as in the batch form, until a value that is not null came."""
    if source is None:
        return F.col(name)
    kind, total = facts.schema[source].dataType, F.col(name)
    if isinstance(kind, DecimalType):
        total = (total.cast(MONEY_SUM) / 10**kind.scale).cast(MONEY_SUM)
    return F.when(F.col(_seen(name)) > 0, total).alias(name)


def _seen(name: str) -> str:
    """State column that counts a measure's values; frames of stateful operators rename leading underscores."""
    return f"{name}__seen"


def running_snapshots_stream(
    facts: DataFrame,
    keys: list[str],
    measures: Measures,
    delay: str = "5 seconds",
    offset_hours: int = times.BUSINESS_OFFSET_HOURS,
    refresh_ms: int = REFRESH_MS,
) -> DataFrame:
    """Streaming form of :func:`parcelflow.operators.daily.running_snapshots`, sparse.

    A total is published once the watermark has passed its tick.  Rows are summed per tick
    inside their task first, so a mart without a key does not funnel its rows into one.
    """
    timed = with_event_time(facts, delay)
    summed = {name: source for name, source in measures.items() if source is not None}
    values = [_state_value(facts, source).alias(name) for name, source in measures.items()]
    values += [F.col(source).isNotNull().cast("bigint").alias(_seen(name)) for name, source in summed.items()]
    kinds = {name: _state_kind(facts, source) for name, source in measures.items()} | {_seen(name): "BIGINT" for name in summed}
    day = times.day_number("ts", offset_hours).alias(DAY)
    ticked = timed.select(*keys, day, tick(F.col("ts"), offset_hours, refresh_ms).cast("bigint").alias("tick_ms"), *values)
    columns, names = [*keys, DAY], list(kinds)
    layout = StructType([StructField(f.name, f.dataType) for f in ticked.schema.fields])
    combined = ticked.mapInPandas(combine_ticks(columns, names), layout)
    processor = DayRefreshProcessor(columns, kinds, refresh_ms, offset_hours * times.HOUR_MS)
    published = combined.groupBy(*columns).transformWithStateInPandas(processor, layout, "Append", "EventTime")
    return published.select(DAY, *keys, "tick_ms", *[_from_state(facts, n, s) for n, s in measures.items()])
