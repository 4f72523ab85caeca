"""The twelve lifecycle facts, from typed source changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from parcelflow.functions import masking, times
from parcelflow.operators.carry import HOT_ROWS
from parcelflow.operators.changes import decode_changes, drop_unusable, for_tables, parse_images
from parcelflow.operators.order_cargo import ORDER_WAIT_MS, pair_orders_with_cargo
from parcelflow.operators.transitions import ORDER_LIFECYCLE, became_set, emit_facts
from parcelflow.sources.schemas import (
    FACTS,
    ORDER_CARGO,
    ORDER_FACT_TIMES,
    ORDER_INFO,
    ORDER_ORG_BOUND,
    TRANSPORT_TASK,
    conform,
)

# --- orders and cargo ----------------------------------------------------------------------

#: Both source tables in one image; a field both have appears once.
ORDER_OR_CARGO = StructType(
    list(ORDER_INFO.fields) + [f for f in ORDER_CARGO.fields if f.name not in ORDER_INFO.fieldNames()]
)

#: Fields of the order that reach a fact unchanged.
ORDER_FIELDS = [
    f.name for f in ORDER_INFO.fields if f.name not in ("id", "estimate_arrive_time", "create_time", "update_time", "is_deleted")
]


def _compared(*names: str) -> StructType:
    """Layout of a ``before`` image of which only a few fields are compared."""
    layout = StructType()
    for name in names:
        layout = layout.add(name, StringType())
    return layout


def decode_order_changes(raw: DataFrame) -> DataFrame:
    """Envelope text -> typed changes for :func:`order_facts`, in a single parse."""
    return decode_changes(raw, image=ORDER_OR_CARGO, before=_compared("status"))


def masked_order(image: Column) -> Column:
    """Order image as a struct, the two names masked."""
    masked = {"sender_name", "receiver_name"}
    fields = [
        (masking.star_mask(image[f.name]) if f.name in masked else image[f.name]).alias(f.name) for f in ORDER_INFO.fields
    ]
    return F.struct(*fields)


def order_events(changes: DataFrame) -> DataFrame:
    """Changes of ``order_info`` and ``order_cargo`` -> keyed events for the pairing."""
    wanted = drop_unusable(for_tables(changes, "order_info", "order_cargo"))
    typed = parse_images(wanted, ORDER_OR_CARGO)
    is_order = F.col("table") == "order_info"
    after = F.col("after")
    cargo = F.struct(*[after[f.name].alias(f.name) for f in ORDER_CARGO.fields])
    return typed.select(
        F.when(is_order, after["id"]).otherwise(after["order_id"]).alias("key"),
        "ts",
        "seq",
        "op",
        F.when(is_order, F.col("before")["status"]).alias("old_status"),
        F.when(is_order, after["status"]).alias("new_status"),
        F.when(is_order, masked_order(after)).alias("order"),
        F.when(~is_order, cargo).alias("cargo"),
    )


def finish_order_facts(paired: DataFrame) -> DataFrame:
    """Paired images -> the columns all eight facts share, plus ``fact_type``.

    The event time is named ``event_time``.  It is the cargo's creation for the order
    fact and the order's update for every other.
    """
    created = F.col("fact_type") == ORDER_LIFECYCLE.created_fact
    event_iso = F.when(created, F.col("cargo.create_time")).otherwise(F.col("order.update_time"))
    instant = times.iso_to_instant_ms(event_iso)
    arrive = times.to_datetime_text(times.wall_to_instant_ms("order.estimate_arrive_time"))
    return paired.select(
        "fact_type",
        F.col("cargo.id").alias("id"),
        F.col("cargo.order_id").alias("order_id"),
        F.col("cargo.cargo_type").alias("cargo_type"),
        F.col("cargo.volumn_length").alias("volume_length"),
        F.col("cargo.volumn_width").alias("volume_width"),
        F.col("cargo.volumn_height").alias("volume_height"),
        F.col("cargo.weight").alias("weight"),
        times.to_datetime_text(instant).alias("event_time"),
        *[F.col(f"order.{name}").alias(name) for name in ORDER_FIELDS],
        arrive.alias("estimate_arrive_time"),
        instant.alias("ts"),
    )


def order_facts(changes: DataFrame, wait_ms: int = ORDER_WAIT_MS, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All eight order facts in one DataFrame with ``fact_type``."""
    return finish_order_facts(pair_orders_with_cargo(order_events(changes), ORDER_LIFECYCLE, wait_ms, hot_rows))


def order_fact(facts: DataFrame, name: str) -> DataFrame:
    """One of the eight, with its own event-time column and column order."""
    own = facts.where(F.col("fact_type") == name).withColumnRenamed("event_time", ORDER_FACT_TIMES[name])
    return conform(own, FACTS[name])


# --- sorting centres -----------------------------------------------------------------------

BOUND_FACTS = ("dwd_bound_inbound", "dwd_bound_sort", "dwd_bound_outbound")


def decode_bound_changes(raw: DataFrame) -> DataFrame:
    """Envelope text -> typed changes for :func:`bound_facts`, in a single parse."""
    return decode_changes(raw, image=ORDER_ORG_BOUND, before=_compared("sort_time", "outbound_time"))


def bound_facts(changes: DataFrame) -> DataFrame:
    """Inbound, sort and outbound facts with ``fact_type``; one update may give two.

    A change without a ``before`` image shows no transition.
    """
    typed = parse_images(drop_unusable(for_tables(changes, "order_org_bound")), ORDER_ORG_BOUND)
    inserted = F.col("op") == "c"
    updated = ~inserted & F.col("before").isNotNull()
    hits = emit_facts(
        typed,
        {
            "dwd_bound_inbound": inserted,
            "dwd_bound_sort": updated & became_set(F.col("before.sort_time"), F.col("after.sort_time")),
            "dwd_bound_outbound": updated & became_set(F.col("before.outbound_time"), F.col("after.outbound_time")),
        },
    )

    def by_fact(inbound: str, sort: str, outbound: str) -> Column:
        return (
            F.when(F.col("fact_type") == "dwd_bound_inbound", F.col(f"after.{inbound}"))
            .when(F.col("fact_type") == "dwd_bound_sort", F.col(f"after.{sort}"))
            .otherwise(F.col(f"after.{outbound}"))
        )

    instant = times.wall_to_instant_ms(by_fact("inbound_time", "sort_time", "outbound_time"))
    return hits.select(
        "fact_type",
        *[F.col(f"after.{name}").alias(name) for name in ("id", "order_id", "org_id")],
        times.to_datetime_text(instant).alias("event_time"),
        by_fact("inbound_emp_id", "sorter_emp_id", "outbound_emp_id").alias("emp_id"),
        instant.alias("ts"),
    )


def bound_fact(facts: DataFrame, name: str) -> DataFrame:
    time, employee = FACTS[name].fieldNames()[3:5]
    own = facts.where(F.col("fact_type") == name).withColumnsRenamed({"event_time": time, "emp_id": employee})
    return conform(own, FACTS[name])


# --- trips ---------------------------------------------------------------------------------


def decode_trip_changes(raw: DataFrame) -> DataFrame:
    """Envelope text -> typed changes for :func:`trip_facts`, in a single parse."""
    return decode_changes(raw, image=TRANSPORT_TASK, before=_compared("actual_end_time"))


def trip_facts(changes: DataFrame) -> DataFrame:
    """One fact per trip whose arrival time was just filled in."""
    typed = parse_images(drop_unusable(for_tables(changes, "transport_task")), TRANSPORT_TASK)
    finished = (
        (F.col("op") == "u")
        & F.col("before").isNotNull()
        & became_set(F.col("before.actual_end_time"), F.col("after.actual_end_time"))
    )
    trip = typed.where(finished).select("after.*")
    start = times.wall_to_instant_ms("actual_start_time")
    end = times.wall_to_instant_ms("actual_end_time")
    return conform(
        trip.withColumns(
            {
                "actual_start_time": times.to_datetime_text(start),
                "actual_end_time": times.to_datetime_text(end),
                "transport_time": times.duration_ms("actual_start_time", "actual_end_time"),
                "driver1_name": masking.star_mask("driver1_name"),
                "driver2_name": masking.star_mask("driver2_name"),
                "truck_no": masking.md5_hex("truck_no"),
                "ts": end,
            }
        ),
        FACTS["dwd_trans_trans_finish"],
    )
