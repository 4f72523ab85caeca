"""Per-day running aggregates.

A measure is ``name -> column to sum``, or ``name -> None`` for a row count.  Measures
are additive, so a day total can be built from partial totals at any finer grain:
rows are first reduced at the grain of their own columns, and lookups and re-keying
work on the reduced rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.functions import times
from parcelflow.operators.latest import latest_by

Measures = Mapping[str, str | None]

#: Business day (days since 1970-01-01) and instant of a group's first row.
DAY = "day"
FIRST = "first_ms"

# Fixed value: how often a running total is published.
REFRESH_MS = 10_000


def _additive(df: DataFrame, name: str) -> Column:
    """Sum of an already reduced measure, kept in a type that cannot overflow."""
    kind = df.schema[name].dataType.simpleString()
    total = F.sum(name)
    return (total.cast("decimal(38,2)") if kind.startswith("decimal") else total).alias(name)


def partial_totals(
    facts: DataFrame,
    by: list[str],
    measures: Measures,
    ts: str = "ts",
    offset_hours: int = times.BUSINESS_OFFSET_HOURS,
) -> DataFrame:
    """Totals per business day and ``by``; only fixed-width buffers, so it hashes map-side."""
    sums = [(F.count(F.lit(1)) if c is None else F.sum(c)).alias(name) for name, c in measures.items()]
    days = facts.withColumn(DAY, times.day_number(ts, offset_hours))
    return days.groupBy(DAY, *by).agg(*sums, F.min(ts).alias(FIRST))


def merge_totals(partials: DataFrame, keys: list[str], measures: Measures, carried: list[str] = []) -> DataFrame:
    """Partial totals -> totals per day and ``keys``.

    ``carried`` columns do not split a group; they keep the value of its first row.
    """
    sums = [_additive(partials, name) for name in measures]
    first = []
    if carried:
        row = F.struct(*carried)
        first = [F.min_by(row, F.struct(FIRST, *carried)).alias("_first")]
    merged = partials.groupBy(DAY, *keys).agg(*sums, *first)
    return merged.select(DAY, *keys, *[F.col(f"_first.{c}").alias(c) for c in carried], *measures)


def daily_totals(
    facts: DataFrame,
    keys: list[str],
    measures: Measures,
    carried: list[str] = [],
    ts: str = "ts",
    offset_hours: int = times.BUSINESS_OFFSET_HOURS,
) -> DataFrame:
    """Totals per business day and key; no keys gives one row per day."""
    return merge_totals(partial_totals(facts, [*keys, *carried], measures, ts, offset_hours), keys, measures, carried)


def with_day_columns(totals: DataFrame, version: Column | None = None) -> DataFrame:
    """Add the business date and the version stamp of a published total."""
    version = times.now_ms() if version is None else version
    return totals.withColumns({"cur_date": times.day_date(DAY), "ts": version}).drop(DAY)


def tick(ts: Column, offset_hours: int = times.BUSINESS_OFFSET_HOURS, refresh_ms: int = REFRESH_MS) -> Column:
    """Instant at which a row is first part of a published total.

    The end of its refresh interval; the day's last total comes one millisecond
    before the day ends.
    """
    day_end = times.day_end_ms(times.day_number(ts, offset_hours), offset_hours)
    bucket_end = (F.floor(ts / F.lit(refresh_ms)) + 1) * F.lit(refresh_ms)
    return F.least(bucket_end, day_end - 1)


def tick_totals(
    facts: DataFrame,
    by: list[str],
    measures: Measures,
    ts: str = "ts",
    offset_hours: int = times.BUSINESS_OFFSET_HOURS,
    refresh_ms: int = REFRESH_MS,
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """Totals of single refresh intervals per business day and ``by``, with ``extra`` aggregates."""
    sums = [(F.count(F.lit(1)) if c is None else F.sum(c)).alias(name) for name, c in measures.items()]
    ticked = facts.withColumns(
        {DAY: times.day_number(ts, offset_hours), "tick_ms": tick(F.col(ts), offset_hours, refresh_ms).cast("bigint")}
    )
    return ticked.groupBy(DAY, *by, "tick_ms").agg(*sums, *extra)


def accumulate_ticks(
    ticks: DataFrame,
    keys: list[str],
    measures: Measures,
    offset_hours: int = times.BUSINESS_OFFSET_HOURS,
    refresh_ms: int = REFRESH_MS,
    dense: bool = False,
) -> DataFrame:
    """Totals of single intervals -> running totals of the day."""
    order = Window.partitionBy(DAY, *keys).orderBy("tick_ms")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    kinds = {f.name: f.dataType for f in ticks.schema.fields}
    running = ticks.withColumns({name: F.sum(name).over(so_far).cast(kinds[name]) for name in measures})
    if dense:
        # Each total is repeated until the tick before the next change, or to the day's end.
        none = F.array().cast("array<bigint>")
        running = running.withColumn("_next", F.lead("tick_ms").over(order))
        closing = times.day_end_ms(DAY, offset_hours) - 1
        until = F.coalesce(F.col("_next"), closing) - 1
        step = F.lit(refresh_ms).cast("bigint")
        regular = F.when(F.col("tick_ms") <= until, F.sequence(F.col("tick_ms"), until, step)).otherwise(none)
        last = F.when(F.col("_next").isNull(), F.array(closing)).otherwise(none)
        running = running.withColumn("tick_ms", F.explode(F.concat(regular, last)))
    return running.select(DAY, *keys, "tick_ms", *measures)


def running_snapshots(
    facts: DataFrame,
    keys: list[str],
    measures: Measures,
    ts: str = "ts",
    offset_hours: int = times.BUSINESS_OFFSET_HOURS,
    refresh_ms: int = REFRESH_MS,
    dense: bool = False,
) -> DataFrame:
    """Running day totals as published every ``refresh_ms`` of event time.

    Rows: day, keys, ``tick_ms``, measures so far.  Sparse by default - a tick appears
    when the total changed.  ``dense`` repeats the total at every tick until the day ends.
    Rows are reduced to one per tick before the running sum, which bounds a group at one
    row per refresh interval of a day however many facts it has.
    """
    ticks = tick_totals(facts, keys, measures, ts, offset_hours, refresh_ms)
    return accumulate_ticks(ticks, keys, measures, offset_hours, refresh_ms, dense)


def latest_published(mart: DataFrame, keys: list[str]) -> DataFrame:
    """Appended mart rows -> the newest version of each day and key."""
    return latest_by(mart, ["cur_date", *keys], ["ts"])
