import hashlib

import pytest
from pyspark.sql import functions as F

from parcelflow.functions import masking, times


def one(spark, column, **values):
    kinds = {str: "string", int: "bigint", type(None): "string"}
    row = [F.lit(v).cast(kinds[type(v)]).alias(k) for k, v in values.items()]
    return spark.range(1).select(*row).select(column.alias("out")).collect()[0].out


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("name, masked", [("张", "张"), ("张三", "张*"), ("张三丰", "张**"), ("", ""), (None, None)])
def test_star_mask(spark, name, masked):
    assert one(spark, masking.star_mask("c"), c=name) == masked


@pytest.mark.parametrize("phone, valid", [("13812345678", True), ("15412345678", False), ("1381234567", False), ("138123456789", False), (" 13812345678", False), ("13812345678\n", False), (None, False)])
def test_phone(spark, phone, valid):
    assert one(spark, masking.phone_hash("c"), c=phone) == (md5(phone) if valid else None)


@pytest.mark.parametrize("mail, valid", [("a_b-1@x.cn", True), ("a@x.y.z", True), ("a@x", False), ("a.b@x.cn", False), (None, False)])
def test_email(spark, mail, valid):
    assert one(spark, masking.email_hash("c"), c=mail) == (md5(mail) if valid else None)


def test_policy_leaves_other_columns_alone(spark):
    assert {t: sorted(c) for t, c in masking.MASKING_POLICY.items()}["employee_info"] == ["password", "phone", "real_name"]
    row = F.map_from_arrays(F.array(F.lit("password"), F.lit("id_card")), F.array(F.lit("p"), F.lit("77")))
    assert one(spark, masking.mask_map(F.col("t"), row), t="employee_info") == {"password": md5("p"), "id_card": "77"}
    assert one(spark, masking.mask_map(F.col("t"), row), t="truck_team") == {"password": "p", "id_card": "77"}


def test_times(spark):
    assert one(spark, times.iso_to_instant_ms("c"), c="2023-11-06T02:07:00Z") == 1_699_236_420_000
    assert one(spark, times.iso_to_instant_ms("c"), c="2023-11-06 02:07:00") == 1_699_236_420_000
    assert one(spark, times.iso_to_instant_ms("c"), c="soon") is None
    assert one(spark, times.text_to_instant_ms("c"), c="1970-01-02") == 57_600_000
    assert one(spark, times.text_to_instant_ms("c"), c="1970-01-01 08:00:01") == 1000
    assert one(spark, times.to_partition_date_text("c"), c=0) == "19700101"
    assert one(spark, times.wall_to_instant_ms("c"), c="28800000") == 0
    assert one(spark, times.wall_to_instant_ms("c"), c="x") is None
    assert one(spark, times.epoch_days_to_date_text("c"), c="10957") == "2000-01-01"


def test_day_edge(spark):
    """16:00 UTC is midnight of the business day."""
    before, after = 1_699_286_399_999, 1_699_286_400_000
    assert str(one(spark, times.cur_date("c"), c=before)) == "2023-11-06"
    assert str(one(spark, times.cur_date("c"), c=after)) == "2023-11-07"
    edge = spark.range(1).select(F.timestamp_millis(F.lit(before)).alias("a"), F.timestamp_millis(F.lit(after)).alias("b"))
    dates = [
        str(edge.groupBy(times.day_window(c).alias("w")).count().select(times.window_date(F.col("w"))).collect()[0][0])
        for c in ("a", "b")
    ]
    assert dates == ["2023-11-06", "2023-11-07"]
