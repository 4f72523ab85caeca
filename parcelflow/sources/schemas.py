"""Table layouts: source images, routing config, facts and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(16, 2)
MONEY_SUM = DecimalType(38, 2)
ANY_IMAGE = MapType(StringType(), StringType())


def _fields(kind, names: str, metadata: dict | None = None) -> list[StructField]:
    return [StructField(name, kind, True, metadata) for name in names.split()]


def _text(names: str) -> list[StructField]:
    return _fields(StringType(), names)


# --- fixed values: source tables, grouped by the capture job that reads them ---------------

FACT_TABLES = ("order_info", "order_cargo", "transport_task", "order_org_bound")
DIMENSION_TABLES = (
    "user_info",
    "user_address",
    "base_complex",
    "base_dic",
    "base_region_info",
    "base_organ",
    "express_courier",
    "express_courier_complex",
    "employee_info",
    "line_base_shift",
    "line_base_info",
    "truck_driver",
    "truck_info",
    "truck_model",
    "truck_team",
)

ORDER_INFO = StructType(
    _text(
        "id order_no status collect_type user_id "
        "receiver_complex_id receiver_province_id receiver_city_id receiver_district_id receiver_name "
        "sender_complex_id sender_province_id sender_city_id sender_district_id sender_name payment_type"
    )
    + _fields(IntegerType(), "cargo_num")
    + _fields(MONEY, "amount")
    + _fields(LongType(), "estimate_arrive_time")
    + _fields(MONEY, "distance")
    + _text("create_time update_time is_deleted")
)

ORDER_CARGO = StructType(
    _text("id order_id cargo_type")
    + _fields(IntegerType(), "volumn_length volumn_width volumn_height")
    + _fields(MONEY, "weight")
    + _text("create_time update_time is_deleted")
)

ORDER_ORG_BOUND = StructType(
    _text(
        "id order_id org_id status inbound_time inbound_emp_id sort_time sorter_emp_id "
        "outbound_time outbound_emp_id create_time update_time is_deleted"
    )
)

TRANSPORT_TASK = StructType(
    _text("id shift_id line_id start_org_id start_org_name end_org_id end_org_name")
    + _fields(IntegerType(), "order_num")
    + _text("driver1_emp_id driver1_name driver2_emp_id driver2_name truck_id truck_no actual_start_time actual_end_time")
    + _fields(MONEY, "actual_distance")
)

DIM_CONFIG = StructType(_text("source_table sink_table sink_family sink_columns sink_pk foreign_keys"))

# --- facts -------------------------------------------------------------------------------

#: Fact name -> name of its event-time column (fixed values).
ORDER_FACT_TIMES = {
    "dwd_trade_order_detail": "order_time",
    "dwd_trade_pay_suc_detail": "pay_time",
    "dwd_trade_cancel_detail": "cancel_time",
    "dwd_trans_receive_detail": "receive_time",
    "dwd_trans_dispatch_detail": "dispatch_time",
    "dwd_trans_bound_finish_detail": "bound_finish_time",
    "dwd_trans_deliver_detail": "deliver_time",
    "dwd_trans_sign_detail": "sign_time",
}


def order_fact(time_column: str) -> StructType:
    """28 columns: 7 of the cargo, the event time, 19 of the order, the instant."""
    return StructType(
        _text("id order_id cargo_type")
        + _fields(IntegerType(), "volume_length volume_width volume_height")
        + _fields(MONEY, "weight")
        + _text(time_column)
        + _text(
            "order_no status collect_type user_id "
            "receiver_complex_id receiver_province_id receiver_city_id receiver_district_id receiver_name "
            "sender_complex_id sender_province_id sender_city_id sender_district_id sender_name payment_type"
        )
        + _fields(IntegerType(), "cargo_num")
        + _fields(MONEY, "amount")
        + _text("estimate_arrive_time")
        + _fields(MONEY, "distance")
        + _fields(LongType(), "ts")
    )


def _bound_fact(time_column: str, employee: str) -> StructType:
    return StructType(_text(f"id order_id org_id {time_column} {employee}") + _fields(LongType(), "ts"))


FACTS: dict[str, StructType] = {name: order_fact(time) for name, time in ORDER_FACT_TIMES.items()}
FACTS["dwd_bound_inbound"] = _bound_fact("inbound_time", "inbound_emp_id")
FACTS["dwd_bound_sort"] = _bound_fact("sort_time", "sorter_emp_id")
FACTS["dwd_bound_outbound"] = _bound_fact("outbound_time", "outbound_emp_id")
FACTS["dwd_trans_trans_finish"] = StructType(
    _text("id shift_id line_id start_org_id start_org_name end_org_id end_org_name")
    + _fields(IntegerType(), "order_num")
    + _text("driver1_emp_id driver1_name driver2_emp_id driver2_name truck_id truck_no actual_start_time actual_end_time")
    + _fields(LongType(), "transport_time")
    + _fields(MONEY, "actual_distance")
    + _fields(LongType(), "ts")
)

# --- marts, in the column order of their sink tables --------------------------------------

#: Marks a field that a mart carries but never writes.
TRANSIENT = {"transient": True}
_DAY = [StructField("cur_date", DateType())]
_COUNT = LongType()

MARTS: dict[str, StructType] = {
    "dws_trade_cargo_type_order_day_base": StructType(
        _DAY
        + _text("cargo_type cargo_type_name")
        + _fields(MONEY_SUM, "order_amount_base")
        + _fields(_COUNT, "order_count_base ts")
    ),
    "dws_trade_org_order_day_base": StructType(
        _DAY
        + _text("org_id org_name city_id city_name")
        + _fields(StringType(), "sender_district_id", TRANSIENT)
        + _fields(MONEY_SUM, "order_amount_base")
        + _fields(_COUNT, "order_count_base ts")
    ),
    "dws_bound_org_sort_day_base": StructType(
        _DAY
        + _text("org_id org_name")
        + _fields(StringType(), "join_org_id", TRANSIENT)
        + _text("city_id city_name province_id province_name")
        + _fields(_COUNT, "sort_count_base ts")
    ),
    "dws_trans_org_receive_day_base": StructType(
        _DAY
        + _text("org_id org_name")
        + _fields(StringType(), "district_id", TRANSIENT)
        + _text("city_id city_name province_id province_name")
        + _fields(_COUNT, "receive_order_count_base ts")
    ),
    "dws_trans_org_deliver_suc_day_base": StructType(
        _DAY
        + _text("org_id org_name")
        + _fields(StringType(), "district_id", TRANSIENT)
        + _text("city_id city_name province_id province_name")
        + _fields(_COUNT, "deliver_suc_count_base ts")
    ),
    "dws_trans_dispatch_day_base": StructType(_DAY + _fields(_COUNT, "dispatch_order_count_base ts")),
    "dws_trans_bound_finish_day_base": StructType(_DAY + _fields(_COUNT, "bound_finish_order_count_base ts")),
    "dws_trans_org_truck_model_trans_finish_day_base": StructType(
        _DAY
        + _text("org_id org_name")
        + _fields(StringType(), "truck_id", TRANSIENT)
        + _text("truck_model_id truck_model_name")
        + _fields(StringType(), "join_org_id", TRANSIENT)
        + _text("city_id city_name")
        + _fields(_COUNT, "trans_finish_count_base")
        + _fields(MONEY_SUM, "trans_finish_distance_base")
        + _fields(_COUNT, "trans_finish_dur_time_base ts")
    ),
}


def written_fields(schema: StructType) -> list[StructField]:
    """Fields that reach the sink: declared order, transient ones left out."""
    return [field for field in schema.fields if not field.metadata.get("transient")]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` to the written columns and types of a declared table."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in written_fields(schema)])


# --- wire format of the topics between the layers ------------------------------------------


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in rest)


def to_wire_json(columns: list[str]) -> Column:
    """One JSON text per row, camelCase keys, nulls left out."""
    return F.to_json(F.struct(*[F.col(c).alias(camel(c)) for c in columns]))


def from_wire_json(value: Column | str, schema: StructType) -> list[Column]:
    """Select list that turns :func:`to_wire_json` text back into typed columns.

    The optimizer parses once per column; for wide rows keep :func:`wire_struct` behind
    ``computed_once``, as the topic reader does.
    """
    return wire_fields(wire_struct(value, schema), schema)


def wire_struct(value: Column | str, schema: StructType) -> Column:
    """The text parsed, with the keys it has on the wire."""
    wire = StructType([StructField(camel(f.name), f.dataType) for f in schema.fields])
    return F.from_json(F.col(value) if isinstance(value, str) else value, wire)


def wire_fields(parsed: Column, schema: StructType) -> list[Column]:
    return [parsed[camel(f.name)].alias(f.name) for f in schema.fields]
