"""One query per operator, mart and stream, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks import feeds
from checks.feeds import epoch_ms, money, table, text
from parcelflow.functions import masking, times
from parcelflow.operators.changes import decode_changes, drop_unusable, encode_changes, for_tables, parse_images
from parcelflow.operators.daily import daily_totals, running_snapshots, with_day_columns
from parcelflow.operators.latest import current_state, first_by
from parcelflow.operators.lookup import lookup, org_city, region_chain
from parcelflow.operators.transitions import ORDER_LIFECYCLE, became_set
from parcelflow.plans import dimensions, facts, marts
from parcelflow.session import pin_session
from parcelflow.sources.readers import config_changes, facts_from_topic
from parcelflow.sources.schemas import FACTS, ORDER_FACT_TIMES, from_wire_json, to_wire_json
from parcelflow.sources.sinks import as_messages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(pin_session(spark), sf_dir)

    QUERIES[make.__name__] = run
    return run


EVENT_IMAGE = "event_id STRING, user_id STRING, event_type STRING, value DECIMAL(16,2), sort_time STRING"


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_changes(feeds.change_feed(table(spark, sf_dir, "events")))


def order_changes(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return facts.decode_order_changes(feeds.order_feed(table(spark, sf_dir, "events"), **options))


# --- decoding, cleaning, routing -------------------------------------------------------------


@query
def cdc_decode_filter(spark, sf_dir):
    typed = parse_images(drop_unusable(event_changes(spark, sf_dir)), EVENT_IMAGE)
    return typed.select(
        F.col("after.event_id").cast("bigint").alias("event_id"),
        F.col("table").alias("source_table"),
        "op",
        F.col("ts").alias("ts_ms"),
        F.col("after.value").alias("value"),
        F.col("before.event_id").cast("bigint").alias("before_event_id"),
    )


@query
def cdc_rename_route(spark, sf_dir):
    published = encode_changes(drop_unusable(event_changes(spark, sf_dir)))
    routed = parse_images(for_tables(decode_changes(published), "click", "purchase"), EVENT_IMAGE)
    return routed.select(
        F.col("after.event_id").cast("bigint").alias("event_id"), F.col("table").alias("source_table"), "op", F.col("ts").alias("ts_ms")
    )


@query
def cdc_project_config_columns(spark, sf_dir):
    routed = dimensions.route_dimensions(event_changes(spark, sf_dir), feeds.routing_config(spark))
    return routed.select(
        "sink_table",
        "sink_pk",
        "pk",
        "op",
        F.col("row")["user_id"].alias("user_id"),
        F.col("row")["value"].cast("decimal(16,2)").alias("value"),
        F.size("row").alias("n_columns"),
    )


@query
def cdc_json_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    number = F.get_json_object("props", "$.k").cast("int")
    named = events.select("event_id", "user_id", "event_type", number.alias("k_value"))
    wire = named.select("event_id", to_wire_json(["event_id", "user_id", "k_value"]).alias("wire"))
    layout = StructType([named.schema["user_id"], named.schema["k_value"]])
    return wire.select("event_id", "wire", *from_wire_json("wire", layout))


# --- transitions -----------------------------------------------------------------------------


@query
def transition_null_to_value(spark, sf_dir):
    typed = parse_images(drop_unusable(event_changes(spark, sf_dir)), EVENT_IMAGE)
    before, after = F.col("before"), F.col("after")
    hit = (F.col("op") == "u") & before.isNotNull() & became_set(before["sort_time"], after["sort_time"])
    return typed.where(hit).select(
        after["event_id"].cast("bigint").alias("event_id"), after["sort_time"].cast("bigint").alias("sort_ms")
    )


def all_bound_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.bound_facts(facts.decode_bound_changes(feeds.bound_feed(table(spark, sf_dir, "events"))))


@query
def transition_two_outputs(spark, sf_dir):
    return all_bound_facts(spark, sf_dir).select("fact_type", "id", "ts")


@query
def transition_status_switch(spark, sf_dir):
    events = facts.order_events(order_changes(spark, sf_dir))
    fact = ORDER_LIFECYCLE.fact_type(F.col("old_status"), F.col("new_status"))
    switched = events.where(F.col("op") == "u").select(F.col("seq").alias("event_id"), fact.alias("fact_type"))
    return switched.where(F.col("fact_type").isNotNull())


def all_order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.order_facts(order_changes(spark, sf_dir), wait_ms=feeds.FEED_WAIT_MS)


@query
def split_fact_counts(spark, sf_dir):
    return all_order_facts(spark, sf_dir).groupBy("fact_type").agg(F.count(F.lit(1)).alias("n_facts"))


# --- current state and changed keys ------------------------------------------------------------


def _user_state(spark: SparkSession, sf_dir: str, apply_deletes: bool) -> DataFrame:
    typed = parse_images(event_changes(spark, sf_dir), EVENT_IMAGE).select("op", "ts", "seq", "after.*")
    if not apply_deletes:
        typed = typed.where(F.col("op") != "d")
    state = current_state(typed, ["user_id"], ["ts", "seq"], apply_deletes)
    return state.select("user_id", "event_id", "event_type", "value", F.col("ts").alias("ts_ms"))


@query
def latest_image(spark, sf_dir):
    return _user_state(spark, sf_dir, apply_deletes=False)


@query
def latest_image_with_deletes(spark, sf_dir):
    return _user_state(spark, sf_dir, apply_deletes=True)


@query
def changed_keys(spark, sf_dir):
    routed = dimensions.route_dimensions(event_changes(spark, sf_dir), feeds.routing_config(spark))
    return dimensions.changed_keys(routed)


@query
def dimension_build(spark, sf_dir):
    policy = {"purchase": {"user_id": masking.md5_hex}}
    routed = dimensions.route_dimensions(event_changes(spark, sf_dir), feeds.routing_config(spark), policy)
    return dimensions.dimension_table(routed, "dim_purchase", "event_id", ["event_id", "user_id", "value"]).select(
        "event_id", "user_id", F.col("value").cast("decimal(16,2)").alias("value")
    )


@query
def config_in_force(spark, sf_dir):
    changes = config_changes(feeds.config_feed(table(spark, sf_dir, "events")))
    current = dimensions.current_config(changes)
    return current.withColumn("sink_family", dimensions.sink_family("sink_family"))


# --- facts -------------------------------------------------------------------------------------


@query
def order_cargo_detail(spark, sf_dir):
    return feeds.order_details(spark, sf_dir)


def _lifecycle_columns(df: DataFrame) -> DataFrame:
    return df.select("fact_type", "id", "order_id", "status", "cargo_type", "weight", "amount", "event_time", "ts")


@query
def order_cargo_lifecycle(spark, sf_dir):
    return _lifecycle_columns(all_order_facts(spark, sf_dir))


@query
def order_cargo_lifecycle_hot_keys(spark, sf_dir):
    """The same with a limit low enough that every key is cut into slices."""
    changes = order_changes(spark, sf_dir, hot_rows=20)
    return _lifecycle_columns(facts.order_facts(changes, wait_ms=feeds.FEED_WAIT_MS, hot_rows=20))


def _order_fact_query(name: str) -> None:
    def run(spark, sf_dir):
        return facts.order_fact(all_order_facts(spark, sf_dir), name)

    run.__name__ = name.replace("dwd_", "fact_")
    query(run)


for _name in ORDER_FACT_TIMES:
    _order_fact_query(_name)


@query
def bound_inbound(spark, sf_dir):
    return facts.bound_fact(all_bound_facts(spark, sf_dir), "dwd_bound_inbound")


@query
def bound_sort(spark, sf_dir):
    return facts.bound_fact(all_bound_facts(spark, sf_dir), "dwd_bound_sort")


@query
def bound_outbound(spark, sf_dir):
    return facts.bound_fact(all_bound_facts(spark, sf_dir), "dwd_bound_outbound")


@query
def fact_wire_roundtrip(spark, sf_dir):
    """Sort facts as topic messages and back."""
    messages = as_messages(facts.bound_fact(all_bound_facts(spark, sf_dir), "dwd_bound_sort"), "order_id")
    return facts_from_topic(messages, FACTS["dwd_bound_sort"], keep=["key"])


@query
def trans_finish(spark, sf_dir):
    return facts.trip_facts(facts.decode_trip_changes(feeds.trip_feed(spark, sf_dir)))


# --- lookups -----------------------------------------------------------------------------------


@query
def lookup_pk(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text("l_suppkey").alias("org_id"))
    return lookup(lines, feeds.organs(spark, sf_dir), "org_id", {"org_name": "org_name", "region_id": "region_id"})


@query
def lookup_fk_first(spark, sf_dir):
    return first_by(feeds.organs(spark, sf_dir).select("region_id", "id", "org_name"), "region_id")


@query
def lookup_miss_keeps_row(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", text("user_id").alias("org_id"))
    return lookup(events, feeds.organs(spark, sf_dir), "org_id", {"org_name": "org_name"})


@query
def org_parent_city(spark, sf_dir):
    return org_city(feeds.organs(spark, sf_dir))


@query
def region_names(spark, sf_dir):
    return region_chain(feeds.regions(spark, sf_dir))


@query
def truck_model_chain(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(text("l_partkey").alias("truck_id"), money("l_quantity").alias("distance"))
    totals = lines.groupBy("truck_id").agg(F.sum("distance").cast("decimal(38,2)").alias("distance"))
    modelled = lookup(totals, feeds.trucks(spark, sf_dir), "truck_id", {"truck_model_id": "truck_model_id"})
    return lookup(modelled, feeds.truck_models(spark, sf_dir), "truck_model_id", {"truck_model_name": "model_name"})


@query
def dict_name(spark, sf_dir):
    cargo = feeds.order_details(spark, sf_dir).groupBy("cargo_type").agg(F.count(F.lit(1)).alias("n_orders"))
    return lookup(cargo, feeds.dictionary(spark, sf_dir), "cargo_type", {"cargo_type_name": "name"})


# --- marts -------------------------------------------------------------------------------------


def _mart(spark: SparkSession, sf_dir: str, table_name: str, rows: DataFrame) -> DataFrame:
    """The mart without its version stamp, which differs from run to run."""
    return marts.daily_mart(rows, marts.ALL_MARTS[table_name], feeds.Dimensions(spark, sf_dir)).drop("ts")


@query
def mart_cargo_type_day(spark, sf_dir):
    return _mart(spark, sf_dir, "dws_trade_cargo_type_order_day_base", feeds.order_details(spark, sf_dir))


@query
def mart_org_order_day(spark, sf_dir):
    return _mart(spark, sf_dir, "dws_trade_org_order_day_base", feeds.placed_orders(spark, sf_dir))


@query
def mart_org_sort_day(spark, sf_dir):
    return _mart(spark, sf_dir, "dws_bound_org_sort_day_base", bound_sort(spark, sf_dir))


@query
def mart_org_receive_day(spark, sf_dir):
    collected = feeds.placed_orders(spark, sf_dir).where(F.col("o_orderstatus") != "O")
    return _mart(spark, sf_dir, "dws_trans_org_receive_day_base", collected)


@query
def mart_org_deliver_day(spark, sf_dir):
    return _mart(spark, sf_dir, "dws_trans_org_deliver_suc_day_base", feeds.deliveries(spark, sf_dir))


@query
def mart_dispatch_day(spark, sf_dir):
    shipped = table(spark, sf_dir, "lineitem").select(epoch_ms("l_shipdate").alias("ts"))
    return _mart(spark, sf_dir, "dws_trans_dispatch_day_base", shipped)


@query
def mart_bound_finish_day(spark, sf_dir):
    arrived = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "F").select(epoch_ms("l_shipdate").alias("ts"))
    return _mart(spark, sf_dir, "dws_trans_bound_finish_day_base", arrived)


@query
def mart_truck_model_day(spark, sf_dir):
    return _mart(spark, sf_dir, "dws_trans_org_truck_model_trans_finish_day_base", feeds.trips(spark, sf_dir))


# --- running totals and day windows -------------------------------------------------------------

EVENT_MEASURES = {"n_events": None, "total_value": "value"}


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "event_type", money("value").alias("value"), epoch_ms("ts").alias("ts"))


def _money_sum(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("decimal(38,2)") for name in names})


@query
def running_snapshots_10s(spark, sf_dir):
    snapshots = running_snapshots(timed_events(spark, sf_dir), ["event_type"], EVENT_MEASURES)
    return _money_sum(snapshots, "total_value")


@query
def mart_sort_snapshots(spark, sf_dir):
    """Every total the sort mart publishes in the course of its days."""
    mart = marts.ALL_MARTS["dws_bound_org_sort_day_base"]
    return marts.mart_snapshots(QUERIES["bound_sort"](spark, sf_dir), mart, feeds.Dimensions(spark, sf_dir))


@query
def mart_order_snapshots(spark, sf_dir):
    """The same for the order mart, whose organisation is looked up."""
    mart = marts.ALL_MARTS["dws_trade_org_order_day_base"]
    snapshots = marts.mart_snapshots(feeds.placed_orders(spark, sf_dir), mart, feeds.Dimensions(spark, sf_dir))
    return _money_sum(snapshots, "order_amount_base")


@query
def snapshot_final_equals_day(spark, sf_dir):
    """Last snapshot of each day next to the day total made without snapshots."""
    rows = timed_events(spark, sf_dir)
    snapshots = running_snapshots(rows, ["event_type"], EVENT_MEASURES)
    final = snapshots.groupBy("day", "event_type").agg(
        F.max_by("n_events", "tick_ms").alias("last_n"), F.max_by("total_value", "tick_ms").alias("last_value")
    )
    totals = daily_totals(rows, ["event_type"], EVENT_MEASURES)
    joined = totals.join(final, ["day", "event_type"])
    return _money_sum(joined, "total_value", "last_value")


@query
def running_snapshots_dense(spark, sf_dir):
    """Every tick of every day of the mart without a key."""
    return running_snapshots(timed_events(spark, sf_dir), [], {"n_events": None}, dense=True)


@query
def day_window_shifted(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("at"), "event_type")
    grouped = events.groupBy(times.day_window("at").alias("window"), "event_type").agg(F.count(F.lit(1)).alias("n_events"))
    return grouped.select(times.window_date(F.col("window")).alias("cur_date"), "event_type", "n_events")


@query
def first_row_carried(spark, sf_dir):
    """A column outside the key keeps the value of the day's first row."""
    rows = table(spark, sf_dir, "events").select("event_type", text("user_id").alias("user_id"), epoch_ms("ts").alias("ts"))
    totals = daily_totals(rows, ["event_type"], {"n_events": None}, carried=["user_id"])
    return with_day_columns(totals).select("cur_date", "event_type", F.col("user_id").alias("first_user_id"), "n_events")


# --- scalar functions ----------------------------------------------------------------------------


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a phone and a mail address; those of odd keys are invalid."""
    key = F.col("c_custkey")
    even = key % 2 == 0
    name = F.concat_ws("_", F.lower("c_mktsegment"), text(key))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.when(even, F.concat(F.lit("13"), F.lpad(text(key), 9, "0"))).otherwise(F.concat(F.lit("0"), text(key))).alias("phone"),
        F.when(even, F.concat(name, F.lit("@example.com"))).otherwise(name).alias("email"),
        (key % 20000).cast("int").alias("birth_days"),
    )


@query
def mask_md5(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", masking.md5_hex("c_name").alias("name_md5"))


@query
def mask_star(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", masking.star_mask("c_name").alias("name_masked"))


@query
def mask_phone(spark, sf_dir):
    return contacts(spark, sf_dir).select("c_custkey", masking.phone_hash("phone").alias("phone_md5"))


@query
def mask_email(spark, sf_dir):
    return contacts(spark, sf_dir).select("c_custkey", masking.email_hash("email").alias("email_md5"))


@query
def mask_policy_customer(spark, sf_dir):
    columns = {
        "id": text("c_custkey"),
        "passwd": F.col("c_name"),
        "real_name": F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name")),
        "phone_num": F.col("phone"),
        "email": F.col("email"),
        "birthday": text("birth_days"),
    }
    return contacts(spark, sf_dir).select(*masking.mask_columns(columns, "user_info"))


@query
def time_formats(spark, sf_dir):
    ms = epoch_ms("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.to_date_text(ms).alias("date_text"),
        times.to_partition_date_text(ms).alias("partition_date"),
        times.to_datetime_text(ms).alias("datetime_text"),
        times.text_to_instant_ms(times.to_datetime_text(ms)).alias("datetime_ms"),
        times.text_to_instant_ms(times.to_date_text(ms)).alias("date_ms"),
        times.cur_date(ms).alias("cur_date"),
    )


@query
def epoch_days_to_date(spark, sf_dir):
    return contacts(spark, sf_dir).select("c_custkey", times.epoch_days_to_date_text("birth_days").alias("birthday"))


@query
def iso_to_local(spark, sf_dir):
    iso = feeds.iso("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", times.iso_to_instant_ms(iso).alias("instant_ms"), times.iso_to_datetime_text(iso).alias("local_text")
    )


@query
def duration_ms(spark, sf_dir):
    return feeds.trips(spark, sf_dir).groupBy("truck_id").agg(
        F.sum("transport_time").alias("total_ms"), F.max("transport_time").alias("longest_ms")
    )


