import functools
import random

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import carry, scan
from parcelflow.operators.changes import order_within_key, route
from parcelflow.operators.daily import daily_totals, running_snapshots
from parcelflow.operators.latest import first_by, latest_by
from parcelflow.operators.lookup import lookup
from parcelflow.operators.transitions import emit_facts, split_by


@pytest.mark.parametrize("hot_rows", [None, 1, 7, 50, 10_000])
def test_carry_matches_brute_force(spark, hot_rows):
    """One key holds a third of the rows, with bursts and ties in time."""
    rng = random.Random(3)
    rows = []
    for seq in range(600):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}"
        ts = rng.choice([rng.randrange(100_000), 50_000, 50_001])
        rows.append((key, ts, seq, rng.choice([None, f"v{seq}"])))
    expected, last = {}, {}
    for key, ts, seq, value in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        expected[seq] = last.get(key)
        last[key] = value if value is not None else last.get(key)
    df = spark.createDataFrame(rows, "key STRING, ts BIGINT, seq BIGINT, value STRING")
    got = carry.previous(df, "key", ["ts", "seq"], F.col("value"), "carried", hot_rows)
    assert {r.seq: r.carried for r in got.collect()} == expected


def test_slices_split_only_hot_keys(spark):
    rows = [("hot", t) for t in range(100)] + [("cold", t) for t in range(5)]
    sliced = carry.slice_hot_keys(spark.createDataFrame(rows, "key STRING, ts BIGINT"), "key", "ts", 10)
    sizes = {(r.key, r[carry.SLICE]): r["count"] for r in sliced.groupBy("key", carry.SLICE).count().collect()}
    assert sizes.pop(("cold", 0)) == 5
    assert all(key == "hot" and number > 0 for key, number in sizes) and max(sizes.values()) <= 10


def test_a_burst_is_cut_like_any_other_stretch(spark):
    rows = [(key, 1000 if i < 300 else i, i % 100, f"v{i}" if i % 7 == 0 else None) for key in ("hot", None) for i in range(400)]
    df = spark.createDataFrame(rows, "key STRING, ts BIGINT, seq BIGINT, value STRING").repartition(3)
    sliced = carry.slice_hot_keys(df, "key", ["ts", "seq"], 16)
    assert max(r["count"] for r in sliced.groupBy("key", carry.SLICE).count().collect()) <= 16 and sliced.count() == 800
    unique = df.groupBy("key", "ts", "seq").agg(F.max("value").alias("value"))
    got = {(r.key, r.ts, r.seq): r.carried for r in carry.previous(unique, "key", ["ts", "seq"], F.col("value"), "carried", 16).collect()}
    last = {}
    for r in sorted(unique.collect(), key=lambda r: (r.ts, r.seq)):
        assert got[r.key, r.ts, r.seq] == last.get(r.key)
        last[r.key] = r.value or last.get(r.key)


def test_no_hot_key_leaves_the_plan_alone(spark):
    df = spark.createDataFrame([("a", 1)], "key STRING, ts BIGINT")
    assert carry.slice_hot_keys(df, "key", "ts", 10) is df


def snapshot_rows(spark, **options):
    facts = spark.createDataFrame([("a", t) for t in (0, 4_000, 12_000)], "key STRING, ts BIGINT")
    got = running_snapshots(facts, ["key"], {"n": None}, **options)
    return sorted((r.tick_ms, r.n) for r in got.collect())


def test_snapshots(spark):
    assert snapshot_rows(spark) == [(10_000, 2), (20_000, 3)]
    dense = snapshot_rows(spark, dense=True)
    end = 16 * 3_600_000
    assert dense[:3] == [(10_000, 2), (20_000, 3), (30_000, 3)] and dense[-2:] == [(end - 10_000, 3), (end - 1, 3)]
    assert len(dense) == end // 10_000


def test_snapshot_of_the_last_interval(spark):
    end = 16 * 3_600_000
    facts = spark.createDataFrame([("a", end - 15_000), ("a", end - 1), ("a", end)], "key STRING, ts BIGINT")
    for dense in (False, True):
        got = running_snapshots(facts.where(F.col("ts") < end), ["key"], {"n": None}, dense=dense)
        assert sorted((r.tick_ms, r.n) for r in got.collect()) == [(end - 10_000, 1), (end - 1, 2)]
    days = {r.day for r in running_snapshots(facts, ["key"], {"n": None}).collect()}
    assert days == {0, 1}


def test_null_key_is_counted(spark):
    facts = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "org STRING, ts BIGINT")
    got = {r.org: r.n for r in daily_totals(facts, ["org"], {"n": None}).collect()}
    assert got == {None: 2, "a": 1}


def test_first_row_is_carried(spark):
    facts = spark.createDataFrame([("a", 5, "late"), ("a", 2, "first"), ("a", 9, None)], "key STRING, ts BIGINT, city STRING")
    row = daily_totals(facts, ["key"], {"n": None}, carried=["city"]).collect()[0]
    assert (row.city, row.n) == ("first", 3)


def test_lookup(spark):
    dim = spark.createDataFrame([("10", "r", "ten"), ("9", "r", "nine"), ("1", None, "one")], "id STRING, region STRING, name STRING")
    facts = spark.createDataFrame([("r",), ("x",), (None,)], "region STRING")
    got = {r.region: r.org for r in lookup(facts, dim, "region", {"org": "id"}, key="region", unique=False).collect()}
    assert got == {"r": "10", "x": None, None: None}  # text order: "10" < "9"
    assert first_by(dim.select("region", "id"), "region").count() == 1


def test_latest(spark):
    rows = spark.createDataFrame([("a", 1, 0, "x"), ("a", 2, 1, None), ("a", 2, 0, "y")], "k STRING, ts BIGINT, seq BIGINT, v STRING")
    assert [r.v for r in latest_by(rows, ["k"], ["ts", "seq"]).collect()] == [None]


def test_order_within_key_keeps_histories_in_order(spark, tmp_path):
    rows = [("u", t, f'{{"id":"{"hot" if t % 3 else t % 5}"}}') for t in range(300)]
    random.Random(1).shuffle(rows)
    changes = spark.createDataFrame(rows, "op STRING, ts BIGINT, after STRING")
    laid = order_within_key(changes, F.get_json_object("after", "$.id"), 4)
    seen = {}
    partitions = laid.select("ts", F.get_json_object("after", "$.id").alias("id"), F.spark_partition_id().alias("p")).collect()
    for r in sorted(partitions, key=lambda r: r.p):
        seen.setdefault(r.id, []).append(r.ts)
    assert all(ts == sorted(ts) for ts in seen.values()) and sum(map(len, seen.values())) == 300
    assert len({r.p for r in partitions if r.id == "hot"}) > 1


@pytest.mark.parametrize("tables", [0, 2, 20_000])
def test_routing_has_one_plan_and_no_shuffle_of_changes(spark, tables):
    rows = spark.createDataFrame([("a", 1), ("t1", 2), ("x", 3), (None, 4), ("a", 5)], "table STRING, n BIGINT")
    more = spark.range(tables).select(F.concat(F.lit("t"), "id").alias("source_table"), F.concat(F.lit("dim_"), "id").alias("sink_table"))
    config = spark.createDataFrame([("a", "dim_a"), (None, "none")], "source_table STRING, sink_table STRING").unionByName(more)
    routed = route(rows, config)
    plan = routed._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in plan and "Join" not in plan
    expected = [("dim_a", 1), ("dim_a", 5)] + ([("dim_1", 2)] if tables else [])
    assert sorted((r.sink_table, r.n) for r in routed.collect()) == sorted(expected)


def test_one_change_may_give_several_facts(spark):
    rows = spark.range(4)
    even, big = F.col("id") % 2 == 0, F.col("id") > 1
    parts = split_by(emit_facts(rows, {"even": even, "big": big}), ["even", "big"])
    assert {name: sorted(r.id for r in df.collect()) for name, df in parts.items()} == {"even": [0, 2], "big": [2, 3]}


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_running_values_cross_ranges(spark, ranges):
    rng = random.Random(ranges)
    keys = ["hot"] * 200 + ["a", "b", None, None, "c"] * 6
    rng.shuffle(keys)
    rows = [(key, i, rng.choice([None, rng.randrange(-9, 9)])) for i, key in enumerate(keys)]
    df = scan.in_ranges(spark.createDataFrame(rows, "key STRING, at BIGINT, value BIGINT").repartition(3), "key", ["at"], ranges)
    assert df.groupBy(scan.RANGE).count().agg({"count": "max"}).first()[0] < 2.5 * len(rows) / ranges + 5
    got = {(r.key, r.at): (r.total, r.parity) for r in scan.running(df, "key", ["at"], total=(scan.SUM, F.col("value")), parity=(scan.XOR, F.col("value"))).collect()}
    for key, at, _ in rows:
        seen = [v for k, a, v in rows if k == key and a <= at and v is not None]
        assert got[key, at] == ((sum(seen), functools.reduce(int.__xor__, seen)) if seen else (None, None))
