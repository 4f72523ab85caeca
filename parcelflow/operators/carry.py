"""Values carried forward along a key's history, safe against hot keys.

A plain window over a key puts the whole key into one task.  So the rows per key are
counted first (one long per key and task travels).  If no key exceeds ``hot_rows``, the
plain window is used.  Otherwise the rows of hot keys are dealt into ranges of (key, order)
and numbered there, and every ``hot_rows`` of them make a slice: windows run inside a slice,
and what a slice inherits is the last value of the key's slices before it, taken from one
summary row per slice and put in front of its rows.  Slices follow the rows, not the clock,
so a burst is cut as finely as any other stretch, ties included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.session import written

SLICE = "_slice"
HOT_ROWS = 1_000_000


def slice_hot_keys(df: DataFrame, key: str, order: str | list[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Number the slices of hot keys 1, 2, ... along their history; other keys have slice 0.

    Without a hot key (or with ``hot_rows=None``, for keys known to be short) ``df`` comes
    back as it is.  No slice has more than ``hot_rows`` rows.  A null key is a key like any
    other.  At most ``rows / hot_rows`` keys can be hot, which bounds
    what is broadcast.  The sliced rows are written out once, as several branches read them.
    ``df`` itself is read for the count and, with a hot key, several times more: hand in rows
    that are stored, or made of stored ones by narrow steps.
    """
    if hot_rows is None:
        return df
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    total = hot.agg(F.sum("_n")).first()[0]
    if total is None:
        return df
    by = [order] if isinstance(order, str) else order
    hot = F.broadcast(written(hot.select(F.col(key).alias("_hot")), "hot-keys"))
    same = F.col(key).eqNullSafe(F.col("_hot"))
    parts = min(-(-total // hot_rows), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.join(hot, same, "left_semi").repartitionByRange(parts, key, *by).sortWithinPartitions(key, *by)
    # the number of the partition, and from bit 33 down that of the row in it
    place = F.monotonically_increasing_id()
    within = F.floor(place.bitwiseAND(F.lit((1 << 33) - 1)) / hot_rows)
    sliced = dealt.withColumn(SLICE, F.shiftleft(F.shiftright(place, 33), 32) + within + 1)
    others = df.join(hot, same, "left_anti").withColumn(SLICE, F.lit(0).cast("bigint"))
    return written(sliced, "sliced").unionByName(others)


def carry_last(history: DataFrame, key: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` among strictly earlier rows of the key.

    ``history`` comes from :func:`slice_hot_keys` with the same order.
    """
    history = history.withColumn("_value", value)
    sliced = SLICE in history.columns
    part = [key, SLICE] if sliced else [key]
    window = Window.partitionBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last("_value", ignorenulls=True)
    if not sliced:
        return history.withColumn(name, last.over(window.orderBy(*order))).drop("_value")
    tails = (
        history.where(F.col(SLICE) > 0)
        .groupBy(key, SLICE)
        .agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))).alias("_value"))
    )
    # what a slice inherits stands in front of its rows, so rows are dealt out once and joined with nothing
    earlier = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    inherited = tails.withColumn("_value", last.over(earlier)).where(F.col("_value").isNotNull()).withColumn("_own", F.lit(False))
    rows = history.withColumn("_own", F.lit(True)).unionByName(inherited, allowMissingColumns=True)
    return rows.withColumn(name, last.over(window.orderBy("_own", *order))).where("_own").drop("_value", "_own")


def previous(df: DataFrame, key: str, order: list[str], value: Column, name: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The last non-null ``value`` among earlier rows; ``lag`` if ``value`` is never null."""
    return carry_last(slice_hot_keys(df, key, order, hot_rows), key, order, value, name).drop(SLICE)
