"""Hand-written change sequences with their known outcome, batch and stream."""

import json

import pytest

from checks.streams import EVERYTHING, run_to_end
from parcelflow.operators.changes import decode_changes, drop_unusable, encode_changes
from parcelflow.plans import dimensions, facts
from parcelflow.session import work_dir
from parcelflow.sources.readers import RAW, read_folder
from parcelflow.sources.sinks import stream_to_folder
from parcelflow.streaming import jobs
from tests.conftest import cargo, change, order

ORDERED, PAID, RECEIVED = "dwd_trade_order_detail", "dwd_trade_pay_suc_detail", "dwd_trans_receive_detail"
DISPATCHED, BOUND, DELIVERED = "dwd_trans_dispatch_detail", "dwd_trans_bound_finish_detail", "dwd_trans_deliver_detail"
SIGNED, CANCELLED = "dwd_trans_sign_detail", "dwd_trade_cancel_detail"

PATH = ["60010", "60020", "60030", "60040", "60050", "60060", "60070", "60080"]

CASES = {
    "cargo first": ([cargo("c", 1000), order("c", 2000)], [(ORDERED, "g1")]),
    "order first, in time": ([order("c", 1000), cargo("c", 5999)], [(ORDERED, "g1")]),
    "order first, too late": ([order("c", 1000), cargo("c", 6000), order("u", 7000, "60020", "60010")], [(PAID, "g1")]),
    "last cargo wins": ([cargo("c", 1000, "g1"), cargo("c", 2000, "g2"), order("c", 3000)], [(ORDERED, "g2")]),
    "two cargos in time give two": (
        [order("c", 1000), cargo("c", 2000, "g1"), cargo("c", 3000, "g2")],
        [(ORDERED, "g1"), (ORDERED, "g2")],
    ),
    "update before cargo": ([order("u", 1000, "60020", "60010"), cargo("c", 2000)], []),
    "full lifecycle": (
        [cargo("c", 0), order("c", 1)] + [order("u", 2 + i, new, old) for i, (old, new) in enumerate(zip(PATH, PATH[1:]))],
        [(f, "g1") for f in (ORDERED, PAID, RECEIVED, DISPATCHED, BOUND, DELIVERED, SIGNED)],
    ),
    "nothing after cancel": (
        [cargo("c", 0), order("c", 1), order("u", 2, "60999", "60010"), order("u", 3, "60020", "60010"), order("u", 4, "60999", "60020")],
        [(ORDERED, "g1"), (CANCELLED, "g1")],
    ),
    "new cargo after cancel": (
        [cargo("c", 0), order("u", 1, "60999", "60010"), cargo("c", 2, "g2"), order("u", 3, "60020", "60010")],
        [(CANCELLED, "g1"), (PAID, "g2")],
    ),
    "same status": ([cargo("c", 0), order("u", 1, "60020", "60020")], []),
    "cargo update is ignored": ([cargo("c", 0), cargo("u", 1, "g9"), order("c", 2)], [(ORDERED, "g1")]),
    "arrival order breaks ties": ([cargo("c", 5), order("c", 5)], [(ORDERED, "g1")]),
    "snapshot rows are ignored": ([cargo("c", 0), order("r", 1)], []),
    "orders do not mix": ([cargo("c", 0, order_id="2"), order("c", 1)], []),
}


def outcome(df):
    return sorted((r.order_id, r.fact_type, r.id) for r in df.select("order_id", "fact_type", "id").collect())


def all_cases():
    """Every case with an order id of its own: their sequences, and all expected facts."""
    sequences, expected = [], []
    for i, (sequence, made) in enumerate(CASES.values()):
        renamed = json.dumps(sequence)
        for name in ("id", "order_id"):
            renamed = renamed.replace(f'"{name}": "1"', f'"{name}": "k{i}"').replace(f'"{name}": "2"', f'"{name}": "x{i}"')
        sequences.append(json.loads(renamed))
        expected += [(f"k{i}", fact, cargo_id) for fact, cargo_id in made]
    return sequences, sorted(expected)


@pytest.mark.parametrize("hot_rows", [None, 1, 3, 1000])
def test_order_cargo_batch(spark, hot_rows):
    """With a limit of a few rows per key the orders are cut into slices."""
    sequences, expected = all_cases()
    rows = [(json.dumps(e), i) for s in sequences for i, e in enumerate(s)]
    changes = facts.decode_order_changes(spark.createDataFrame(rows, RAW))
    assert outcome(facts.order_facts(changes, hot_rows=hot_rows)) == expected


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_order_cargo_stream(spark, hot_rows):
    """In several runs from one checkpoint, so that state is carried from batch to batch."""
    sequences, expected = all_cases()
    folder = work_dir(spark, "replay")
    longest = max(map(len, sequences))
    for step in range(longest):
        rows = [(json.dumps(s[step]), step) for s in sequences if step < len(s)]
        spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(f"{folder}/feed")
        if step in (0, 1, 2, longest - 1):
            raw = read_folder(spark, f"{folder}/feed", RAW, **EVERYTHING)
            run_to_end(spark, jobs.order_fact_job(facts.decode_order_changes(raw), f"{folder}/out", f"{folder}/checkpoint", hot_rows=hot_rows))
    assert outcome(spark.read.parquet(f"{folder}/out")) == expected


def test_order_fact_columns(feed):
    changes = facts.decode_order_changes(feed(cargo("c", 0), order("c", 1), order("u", 2, "60020", "60010")))
    made = facts.order_facts(changes)
    ordered = facts.order_fact(made, ORDERED).collect()[0].asDict()
    assert len(ordered) == 28
    assert ordered["order_time"] == "2023-11-06 10:07:00"  # the cargo's creation, local
    assert ordered["ts"] == 1_699_236_420_000
    assert ordered["sender_name"] == "A***" and ordered["receiver_name"] == "L*"
    assert ordered["estimate_arrive_time"] == "2023-11-06 10:00:00"
    assert str(ordered["amount"]) == "12.50" and ordered["volume_length"] == 10
    paid = facts.order_fact(made, PAID).collect()[0]
    assert paid.pay_time == "2023-11-06 11:00:00" and paid.status == "60020"


def bound(op, ts, sort=None, out=None, before=None):
    after = {"id": "b1", "order_id": "1", "org_id": "7", "inbound_time": 28_800_000, "sort_time": sort, "outbound_time": out}
    return change("order_org_bound", op, ts, after, before)


def test_sorting_centre(feed):
    unset = {"sort_time": None, "outbound_time": None}
    raw = feed(
        bound("c", 0),
        bound("u", 1, sort=28_801_000, before=unset),
        bound("u", 2, out=28_802_000, before=unset),
        bound("u", 3, sort=28_803_000, out=28_803_000, before=unset),
        bound("u", 4, sort=28_809_000, before={"sort_time": 28_803_000, "outbound_time": None}),
        bound("r", 5, sort=28_801_000),
        bound("u", 6, sort=28_801_000),
    )
    for decode in (facts.decode_bound_changes, decode_changes):
        got = sorted((r.fact_type, r.ts, r.event_time) for r in facts.bound_facts(decode(raw)).collect())
        assert got == [
            ("dwd_bound_inbound", 0, "1970-01-01 08:00:00"),
            ("dwd_bound_outbound", 2000, "1970-01-01 08:00:02"),
            ("dwd_bound_outbound", 3000, "1970-01-01 08:00:03"),
            ("dwd_bound_sort", 1000, "1970-01-01 08:00:01"),
            ("dwd_bound_sort", 3000, "1970-01-01 08:00:03"),
        ]


def test_trip(feed):
    start = {"id": "t", "actual_start_time": 28_800_000, "driver1_name": "Zoe", "driver2_name": None, "truck_no": "A1"}
    ended = {**start, "actual_end_time": 28_860_000}
    later = {**start, "actual_end_time": 28_900_000}
    got = facts.trip_facts(
        facts.decode_trip_changes(
            feed(
                change("transport_task", "c", 0, start),
                change("transport_task", "u", 1, start, start),
                change("transport_task", "u", 2, ended, start),
                change("transport_task", "u", 3, later, ended),
            )
        )
    ).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.transport_time, row.ts, row.actual_start_time) == (60_000, 60_000, "1970-01-01 08:00:00")
    assert row.driver1_name == "Z**" and row.driver2_name is None and len(row.truck_no) == 32


def test_clean_and_encode(spark, feed):
    from pyspark.sql import Observation

    raw = feed(
        change("t", "d", 1, {"id": "1"}),
        change("t", "u", 2, None),
        "{not json",
        change("t", "r", 3, {"id": "2", "price": 12.50}),
        change("t", "c", 4, {"id": "3"}),
    )
    seen = Observation("capture")
    kept = drop_unusable(decode_changes(raw), seen).select("op", "ts", "table", "after", "before", "seq")
    assert sorted((r.op, r.ts) for r in kept.collect()) == [("c", 4), ("r", 3)]
    assert seen.get == {"rows": 5, "malformed": 1}
    published = {m["op"]: m for m in (json.loads(r.value) for r in encode_changes(kept).collect())}
    assert published["r"] == {"op": "r", "ts": 3, "source": {"table": "t"}, "before": None, "after": {"id": "2", "price": 12.5}}
    again = decode_changes(encode_changes(kept)).select("op", "ts", "table", "after").collect()
    assert sorted((r.op, r.ts) for r in again) == [("c", 4), ("r", 3)]


CONFIG = "source_table STRING, sink_table STRING, sink_family STRING, sink_columns STRING, sink_pk STRING, foreign_keys STRING"


def test_dimension_routing_masks_and_prunes(spark, feed):
    config = spark.createDataFrame([("user_info", "dim_user", "", "id,phone_num,email,birthday", "id", None)], CONFIG)
    person = {"id": "1", "passwd": "p", "real_name": None, "phone_num": "13812345678", "email": "a@b.cn", "birthday": 10957}
    raw = feed(change("user_info", "c", 1, person), change("user_info", "c", 2, {**person, "id": "2", "phone_num": "1", "email": None}), change("other", "c", 3, {"id": "9"}))
    rows = dimensions.route_dimensions(decode_changes(raw), config)
    table = {r.id: r for r in dimensions.dimension_table(rows, "dim_user", "id", ["id", "phone_num", "email", "birthday"]).collect()}
    assert set(table) == {"1", "2"}
    assert len(table["1"].phone_num) == 32 and len(table["1"].email) == 32 and table["1"].birthday == "2000-01-01"
    assert table["2"].phone_num is None and table["2"].email is None
    assert set(rows.where("pk = '1'").collect()[0].row) == {"phone_num", "email", "birthday"}


def test_foreign_keys_of_updates(spark, feed):
    config = spark.createDataFrame([("base_organ", "dim_organ", None, "id,org_name", "id", "region_id,org_parent_id")], CONFIG)
    before = {"id": "1", "region_id": "5", "org_parent_id": "3"}
    raw = feed(
        change("base_organ", "c", 1, before),
        change("base_organ", "u", 2, {**before, "region_id": "6"}, before),
        change("base_organ", "u", 3, before, before),
    )
    touched = dimensions.changed_keys(dimensions.route_dimensions(decode_changes(raw), config))
    got = sorted((r.key_name, r.key_value) for r in touched.collect())
    # The key is not a stored column, yet its old value is known.
    assert got == sorted([("id", "1"), ("region_id", "5"), ("org_parent_id", "3")] * 2)


def test_config_changes(spark, feed):
    row = {"source_table": "a", "sink_table": "dim_a", "sink_columns": "id", "sink_pk": "id"}
    other = {**row, "source_table": "b", "sink_table": "dim_b"}
    steps = [
        change("config_dim", "r", 1, row),
        change("config_dim", "c", 2, other),
        change("config_dim", "u", 3, {**row, "sink_table": "dim_a2"}, row),
        change("config_dim", "d", 4, None, other),
    ]
    expected = [{"a": "dim_a"}, {"a": "dim_a", "b": "dim_b"}, {"a": "dim_a2", "b": "dim_b"}, {"a": "dim_a2"}]
    for n, want in enumerate(expected, 1):
        now = dimensions.current_config(decode_changes(feed(*steps[:n])))
        assert {r.source_table: r.sink_table for r in now.collect()} == want


def test_deletes_reach_dimensions_only_on_request(spark, feed):
    config = spark.createDataFrame([("base_dic", "dim_dic", None, "id,name", "id", None)], CONFIG)
    row = {"id": "1", "name": "x"}
    changes = decode_changes(feed(change("base_dic", "c", 1, row), change("base_dic", "d", 2, None, row)))
    for wanted, left in ((False, 1), (True, 0)):
        routed = dimensions.route_dimensions(changes, config, apply_deletes=wanted)
        assert dimensions.dimension_table(routed, "dim_dic", "id", ["id", "name"]).count() == left
