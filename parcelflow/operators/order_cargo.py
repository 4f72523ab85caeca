"""Pairing the changes of orders with those of their cargo.

Per order two things are remembered: the latest cargo (until the order is signed or
cancelled) and an order that arrived before its cargo (for a limited wait).  Both are
carried forward with windows over one partitioning by order id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.carry import HOT_ROWS, carry_last, slice_hot_keys
from parcelflow.operators.transitions import Lifecycle
from parcelflow.session import written

# Fixed value: how long an order waits for its cargo.
ORDER_WAIT_MS = 5_000


def relevant_events(events: DataFrame, lifecycle: Lifecycle) -> DataFrame:
    """Keep what can matter - inserts, and updates that are a status change of interest.

    Adds ``_change``, the fact of such a status change.  Narrow, so the rest is gone
    before anything is shuffled.
    """
    change = F.when(
        F.col("order").isNotNull() & (F.col("op") == "u"),
        lifecycle.fact_type(F.col("old_status"), F.col("new_status")),
    )
    marked = events.where(F.col("key").isNotNull()).withColumn("_change", change)
    return marked.where((F.col("op") == "c") | F.col("_change").isNotNull())


#: Order of a key's history; what earlier batches left comes before anything new.
HISTORY = ["_place", "ts", "seq"]


def _history(events: DataFrame, held: DataFrame | None, lifecycle: Lifecycle, hot_rows: int | None) -> DataFrame:
    """Events, and what is held from before as the first row of its key, with ``_cargo`` and ``_waiting`` known to each.

    ``_remembered`` and ``_waits`` are what a row leaves to later ones.  A closing change
    overwrites the remembered cargo with nothing.
    """
    kept = "struct<cargo: {cargo}, waiting: struct<order: {order}, ts: bigint>>"
    kept = kept.format(**{c: events.schema[c].dataType.simpleString() for c in ("cargo", "order")})
    rows = events.withColumns({"_place": F.lit(1), "_held": F.lit(None).cast(kept)})
    if held is not None:
        before = held.select("key", F.lit(0).alias("_place"), F.struct("cargo", "waiting").cast(kept).alias("_held"))
        rows = rows.unionByName(before, allowMissingColumns=True)
    created = F.col("op") == "c"
    remembered = (
        F.when(F.col("_held.cargo").isNotNull(), F.struct(F.col("_held.cargo").alias("cargo")))
        .when(F.col("cargo").isNotNull() & created, F.struct(F.col("cargo")))
        .when(F.col("_change").isin(*lifecycle.closing_facts), F.struct(F.col("cargo")))
    )
    rows = slice_hot_keys(rows, "key", HISTORY, hot_rows).withColumn("_remembered", remembered)
    rows = carry_last(rows, "key", HISTORY, F.col("_remembered"), "_cargo")
    unpaired = F.col("order").isNotNull() & created & F.col("_cargo.cargo").isNull()
    waits = F.when(F.col("_held.waiting").isNotNull(), F.col("_held.waiting")).when(unpaired, F.struct("order", "ts"))
    return carry_last(rows.withColumn("_waits", waits), "key", HISTORY, F.col("_waits"), "_waiting")


def _paired(history: DataFrame, lifecycle: Lifecycle, wait_ms: int) -> DataFrame:
    is_order, created = F.col("order").isNotNull(), F.col("op") == "c"
    known = F.col("_cargo.cargo")
    still_waiting = F.col("ts") - F.col("_waiting.ts") < wait_ms
    cargo_completes = F.col("cargo").isNotNull() & created & still_waiting
    fact = (
        F.when(cargo_completes, F.lit(lifecycle.created_fact))
        .when(is_order & created & known.isNotNull(), F.lit(lifecycle.created_fact))
        .when(known.isNotNull(), F.col("_change"))
    )
    paired = history.select(
        "key",
        "ts",
        "seq",
        fact.alias("fact_type"),
        F.when(is_order, F.col("order")).otherwise(F.col("_waiting.order")).alias("order"),
        F.when(is_order, known).otherwise(F.col("cargo")).alias("cargo"),
    )
    return paired.where(F.col("fact_type").isNotNull())


def pair_orders_with_cargo(
    events: DataFrame,
    lifecycle: Lifecycle,
    wait_ms: int = ORDER_WAIT_MS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Facts with the order and cargo images they are made of.

    ``events`` has ``key``, ``ts`` (ms), ``seq`` (arrival order within a ts), ``op``,
    ``old_status``, ``new_status``, and the structs ``order`` and ``cargo``, exactly one
    of which is set.  Events without a key cannot be paired and are dropped.

    An order's *creation* gives the created fact if cargo is known; else it waits, and
    cargo arriving within ``wait_ms`` gives the fact (each cargo anew).  A *status
    change* gives its fact if cargo is known.  A closing fact forgets the cargo.

    With ``hot_rows`` the events that matter are written out once, so that counting and slicing
    them does not parse them anew.
    """
    relevant = relevant_events(events, lifecycle)
    relevant = relevant if hot_rows is None else written(relevant, "order-events")
    return _paired(_history(relevant, None, lifecycle, hot_rows), lifecycle, wait_ms)


def pair_batch(
    events: DataFrame,
    held: DataFrame,
    lifecycle: Lifecycle,
    wait_ms: int = ORDER_WAIT_MS,
    hot_rows: int | None = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """One batch of a stream: its facts, and what is held for the batches to come.

    ``events`` comes from :func:`relevant_events`.  ``held`` has a row (key, cargo, waiting)
    per key that something is known of; keys without an event in the batch stay as they are.
    A waiting order is forgotten when a closing change shows that its wait is over, or when
    another creation takes its place, never by the clock.
    """
    history = _history(events, held, lifecycle, hot_rows)
    at = F.struct(*HISTORY)
    closed = F.max(F.when(F.col("_change").isin(*lifecycle.closing_facts), F.col("ts")))
    left = history.groupBy("key").agg(
        F.max_by("_remembered", F.when(F.col("_remembered").isNotNull(), at)).alias("_kept"),
        F.max_by("_waits", F.when(F.col("_waits").isNotNull(), at)).alias("_wait"),
        closed.alias("_closed"),
    )
    over = F.coalesce(F.col("_closed") - F.col("_wait.ts") >= wait_ms, F.lit(False))
    left = left.select("key", F.col("_kept.cargo").alias("cargo"), F.when(~over, F.col("_wait")).alias("waiting"))
    return _paired(history, lifecycle, wait_ms), left.where(F.coalesce(F.col("cargo").isNotNull() | F.col("waiting").isNotNull(), F.lit(False)))
