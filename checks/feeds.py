"""The given tables in the roles of the logistics tables.

Change feeds are derived by Spark from the whole of ``events`` and ``lineitem`` as
envelope text, then decoded like any captured feed.  ``checks.oracle`` states the same
derivations in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions import times
from parcelflow.operators.carry import HOT_ROWS, previous

# How long an order waits for its cargo in the feed below, whose events are minutes apart.
FEED_WAIT_MS = 6 * times.HOUR_MS

# Order states an update event can move to, picked by the event's own number.
FEED_STATES = ("60010", "60020", "60030", "60040", "60050", "60060", "60070", "60080", "60999")


# Layout of the given tables, stated so that reading one starts no job to infer it.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def epoch_ms(c: Column | str) -> Column:
    return F.unix_millis((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(16,2)")


def iso(c: Column | str) -> Column:
    return F.date_format((F.col(c) if isinstance(c, str) else c).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def envelope(op: Column, table_name: Column, ts_ms: Column, before: Column, after: Column) -> Column:
    source = F.struct(table_name.alias("table"))
    return F.to_json(
        F.struct(op.alias("op"), ts_ms.alias("ts_ms"), source.alias("source"), before.alias("before"), after.alias("after"))
    )


# --- change feeds --------------------------------------------------------------------------


def feed_op() -> Column:
    """Operation of an event in the feed, spread over its number."""
    digit = F.col("event_id") % 10
    return F.when(digit == 0, "d").when(digit <= 3, "c").when(digit == 4, "r").otherwise("u")


def change_feed(events: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One change per event: the row of a user, changed by its events one after the other."""
    base = events.select(
        text("user_id").alias("user"),
        epoch_ms("ts").alias("at"),
        "event_id",
        F.struct(
            text("event_id").alias("event_id"),
            text("user_id").alias("user_id"),
            "event_type",
            money("value").alias("value"),
            F.when(F.col("event_type").isin("click", "purchase"), text(epoch_ms("ts"))).alias("sort_time"),
        ).alias("after"),
    )
    paired = previous(base, "user", ["at", "event_id"], F.col("after"), "before", hot_rows)
    op = feed_op()
    before = F.when(op.isin("u", "d"), F.col("before"))
    return paired.select(
        envelope(op, F.col("after.event_type"), F.col("at"), before, F.col("after")).alias("value"),
        F.col("event_id").alias("seq"),
    )


def order_feed(events: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Order lifecycles: the user is the order.

    A signup adds a cargo, a view creates the order, any other event updates it to the
    state its number picks.  An update's old state is that of the order event before.
    """
    number = F.get_json_object("props", "$.k").cast("int")
    states = F.array(*[F.lit(s) for s in FEED_STATES])
    user = text("user_id")
    common = events.select(
        "event_id",
        "event_type",
        "value",
        user.alias("user"),
        epoch_ms("ts").alias("at"),
        iso("ts").alias("iso_time"),
        number.alias("number"),
        F.when(F.col("event_type") == "view", F.lit("60010"))
        .when(F.col("event_type") != "signup", states[number % len(FEED_STATES)])
        .alias("status"),
    )
    # Only order events have a state, so this is the state before the event.
    paired = previous(common, "user", ["at", "event_id"], F.col("status"), "old_status", hot_rows)
    is_cargo = F.col("event_type") == "signup"
    op = F.when(F.col("event_type").isin("signup", "view"), "c").otherwise("u")
    region = F.col("number") % 25
    after = F.struct(
        F.when(is_cargo, F.concat(F.lit("g"), text("event_id"))).otherwise(F.col("user")).alias("id"),
        # cargo
        F.when(is_cargo, F.col("user")).alias("order_id"),
        F.when(is_cargo, text(region)).alias("cargo_type"),
        F.when(is_cargo, F.col("number")).alias("volumn_length"),
        F.when(is_cargo, F.col("number") + 1).alias("volumn_width"),
        F.when(is_cargo, F.col("number") + 2).alias("volumn_height"),
        F.when(is_cargo, money("value")).alias("weight"),
        F.when(is_cargo, F.col("iso_time")).alias("create_time"),
        # order
        F.when(~is_cargo, F.concat(F.lit("no-"), F.col("user"))).alias("order_no"),
        F.col("status"),
        F.when(~is_cargo, F.col("user")).alias("user_id"),
        F.when(~is_cargo, text(region)).alias("receiver_district_id"),
        F.when(~is_cargo, text(region)).alias("receiver_city_id"),
        F.when(~is_cargo, F.concat(F.lit("Rec"), text("number"))).alias("receiver_name"),
        F.when(~is_cargo, text(24 - region)).alias("sender_district_id"),
        F.when(~is_cargo, text(24 - region)).alias("sender_city_id"),
        F.when(~is_cargo, F.concat(F.lit("Snd"), text("number"))).alias("sender_name"),
        F.when(~is_cargo, F.col("number")).alias("cargo_num"),
        F.when(~is_cargo, money("value")).alias("amount"),
        F.when(~is_cargo, F.col("at") + times.DAY_MS).alias("estimate_arrive_time"),
        F.when(~is_cargo, F.col("iso_time")).alias("update_time"),
    )
    before = F.when(op == "u", F.struct(F.col("old_status").alias("status")))
    name = F.when(is_cargo, "order_cargo").otherwise("order_info")
    return paired.select(envelope(op, name, F.col("at"), before, after).alias("value"), F.col("event_id").alias("seq"))


def bound_feed(events: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Sorting-centre rows: the user is the centre, its row changed by each of its events."""
    wall = text(epoch_ms("ts") + times.BUSINESS_OFFSET_HOURS * times.HOUR_MS)
    base = events.select(
        "event_id",
        text("user_id").alias("user"),
        epoch_ms("ts").alias("at"),
        F.struct(
            text("event_id").alias("id"),
            F.concat(F.lit("o"), text("user_id")).alias("order_id"),
            text("user_id").alias("org_id"),
            wall.alias("inbound_time"),
            F.concat(F.lit("in"), text("user_id")).alias("inbound_emp_id"),
            F.when(F.col("event_type").isin("click", "purchase"), wall).alias("sort_time"),
            F.concat(F.lit("so"), text("user_id")).alias("sorter_emp_id"),
            F.when(F.col("event_type").isin("purchase", "error"), wall).alias("outbound_time"),
            F.concat(F.lit("out"), text("user_id")).alias("outbound_emp_id"),
        ).alias("after"),
    )
    paired = previous(base, "user", ["at", "event_id"], F.col("after"), "before", hot_rows)
    op = feed_op()
    before = F.when(op.isin("u", "d"), F.col("before"))
    return paired.select(
        envelope(op, F.lit("order_org_bound"), F.col("at"), before, F.col("after")).alias("value"),
        F.col("event_id").alias("seq"),
    )


def config_feed(events: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Routing rows: the user is the source table, its row rewritten by each of its events."""
    base = events.select(
        "event_id",
        text("user_id").alias("user"),
        epoch_ms("ts").alias("at"),
        F.struct(
            text("user_id").alias("source_table"),
            F.concat(F.lit("dim_"), F.col("event_type")).alias("sink_table"),
            F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("sink_family"),
            F.concat(F.lit("id,"), F.col("event_type")).alias("sink_columns"),
            F.lit("id").alias("sink_pk"),
            text("event_id").alias("foreign_keys"),
        ).alias("image"),
    )
    paired = previous(base, "user", ["at", "event_id"], F.col("image"), "before", hot_rows)
    op = feed_op()
    # A deleted row is only named by its ``before``; the first event of a user has none.
    gone = op == "d"
    before = F.when(gone, F.coalesce("before", "image")).when(op == "u", F.col("before"))
    return paired.select(
        envelope(op, F.lit("config_dim"), F.col("at"), before, F.when(~gone, F.col("image"))).alias("value"),
        F.col("event_id").alias("seq"),
    )


def trip_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips: every line was updated once; lines of status F were just finished by that update."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    offset = times.BUSINESS_OFFSET_HOURS * times.HOUR_MS
    row = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    end = text(epoch_ms("l_shipdate") + offset)
    image = {
        "id": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"),
        "shift_id": text("l_linenumber"),
        "line_id": text("l_suppkey"),
        "start_org_id": text("l_suppkey"),
        "start_org_name": F.concat(F.lit("org "), text("l_suppkey")),
        "end_org_id": text("l_partkey"),
        "end_org_name": F.concat(F.lit("org "), text("l_partkey")),
        "order_num": F.col("l_linenumber"),
        "driver1_emp_id": text("l_linenumber"),
        "driver1_name": F.concat(F.lit("Driver "), text("l_linenumber")),
        "driver2_name": F.when(F.col("l_returnflag") != "N", F.concat(F.col("l_returnflag"), text("l_linenumber"))),
        "truck_id": text("l_partkey"),
        "truck_no": F.concat(F.lit("T"), text("l_partkey")),
        "actual_start_time": text(epoch_ms("o_orderdate") + offset),
        "actual_end_time": end,
        "actual_distance": money("l_quantity"),
    }
    after = F.struct(*[c.alias(name) for name, c in image.items()])
    before = F.struct(
        image["id"].alias("id"), F.when(F.col("l_linestatus") != "F", end).alias("actual_end_time")
    )
    text_value = envelope(F.lit("u"), F.lit("transport_task"), epoch_ms("l_shipdate"), before, after)
    return row.select(text_value.alias("value"), F.col("l_orderkey").alias("seq"))


# --- dimensions ----------------------------------------------------------------------------


def organs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        text(key).alias("id"),
        F.col("s_name").alias("org_name"),
        F.when(key % 3 != 0, text(key % 10)).alias("org_parent_id"),
        text("s_nationkey").alias("region_id"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as cities below regions as provinces."""
    city = table(spark, sf_dir, "nation").select(
        text("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("P"), text("n_regionkey")).alias("parent_id"),
    )
    province = table(spark, sf_dir, "region").select(
        F.concat(F.lit("P"), text("r_regionkey")).alias("id"),
        F.col("r_name").alias("name"),
        F.lit(None).cast("string").alias("parent_id"),
    )
    return city.unionByName(province)


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(text("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def trucks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(text("p_partkey").alias("id"), F.col("p_brand").alias("truck_model_id"))


def truck_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.groupBy(F.col("p_brand").alias("id")).agg(F.min("p_type").alias("model_name"))


class Dimensions(Mapping[str, DataFrame]):
    """All dimensions by name, each put together when asked for."""

    MAKERS = {
        "base_organ": organs,
        "base_region_info": regions,
        "base_dic": dictionary,
        "truck_info": trucks,
        "truck_model": truck_models,
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._source = (spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        return self.MAKERS[name](*self._source)

    def __iter__(self) -> Iterator[str]:
        return iter(self.MAKERS)

    def __len__(self) -> int:
        return len(self.MAKERS)


CONFIG = "source_table STRING, sink_table STRING, sink_family STRING, sink_columns STRING, sink_pk STRING, foreign_keys STRING"


def buyer_config(spark: SparkSession) -> DataFrame:
    """Purchases as a dimension with one row per user."""
    return spark.createDataFrame([("purchase", "dim_buyer", None, "user_id,event_id,value", "user_id", None)], CONFIG)


def routing_config(spark: SparkSession) -> DataFrame:
    """Which kinds of event are dimensions, and which of their columns are kept."""
    rows = [
        ("click", "dim_click", "", "event_id,user_id", "event_id", "user_id"),
        ("purchase", "dim_purchase", "wide", "event_id,user_id,value", "event_id", "user_id,sort_time"),
    ]
    return spark.createDataFrame(rows, CONFIG)


# --- facts taken straight from the tables -----------------------------------------------------


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the sender's district, city and province."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            text("o_orderkey").alias("order_id"),
            F.col("o_orderkey"),
            "o_orderstatus",
            text("c_nationkey").alias("sender_district_id"),
            text("c_nationkey").alias("sender_city_id"),
            F.concat(F.lit("P"), text("n_regionkey")).alias("sender_province_id"),
            money("o_totalprice").alias("amount"),
            epoch_ms("o_orderdate").alias("ts"),
        )
    )


def last_cargo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last line of each order; the sort order is total, so the result is unique."""
    lines = table(spark, sf_dir, "lineitem")
    order = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return lines.groupBy("l_orderkey").agg(F.max(F.struct(*order)).alias("cargo"))


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placed orders with their last cargo."""
    orders = table(spark, sf_dir, "orders")
    cargo = last_cargo(spark, sf_dir)
    return orders.join(cargo, F.col("o_orderkey") == F.col("l_orderkey")).select(
        text("o_orderkey").alias("order_id"),
        F.concat_ws("-", "o_orderkey", "cargo.l_linenumber").alias("id"),
        text(F.col("cargo.l_partkey") % 25).alias("cargo_type"),
        money("cargo.l_quantity").alias("weight"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("amount"),
        epoch_ms("o_orderdate").alias("ts"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered lines with the district, city and province of the customer."""
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "F").select("l_orderkey", "l_shipdate")
    placed = placed_orders(spark, sf_dir).drop("ts")
    return lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("sender_district_id").alias("receiver_district_id"),
        F.col("sender_city_id").alias("receiver_city_id"),
        F.col("sender_province_id").alias("receiver_province_id"),
        epoch_ms("l_shipdate").alias("ts"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a trip from its order's date to its ship date."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    start, end = epoch_ms("o_orderdate"), epoch_ms("l_shipdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        text("l_suppkey").alias("start_org_id"),
        F.concat(F.lit("org "), text("l_suppkey")).alias("start_org_name"),
        text("l_partkey").alias("truck_id"),
        money("l_quantity").alias("actual_distance"),
        times.duration_ms(start, end).alias("transport_time"),
        end.alias("ts"),
    )
