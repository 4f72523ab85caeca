"""Streams in several runs from one checkpoint, against their batch forms."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.streams import run_to_end
from parcelflow.operators.daily import latest_published, running_snapshots
from parcelflow.plans.marts import ALL_MARTS, daily_mart
from parcelflow.session import STATE_STORE_CONF, conf_scope, work_dir
from parcelflow.sources.readers import RAW, read_folder
from parcelflow.sources.sinks import append_mart, read_mart, stream_to_folder
from parcelflow.streaming import jobs
from parcelflow.streaming.metrics import count_streams
from parcelflow.streaming.operators import daily_totals_stream, running_snapshots_stream
from tests.conftest import cargo, change

FACT = "org STRING, value DECIMAL(16,2), ts BIGINT"
DAY_END = 16 * 3_600_000


def exact(rows):
    """Floats as decimals, money columns being exact."""
    return [tuple(Decimal(str(v)) if isinstance(v, float) else v for v in row) for row in rows]


def feed_in_steps(spark, steps, schema, folder, start):
    """Write one file per step and run the stream to its end after each."""
    for rows in steps:
        spark.createDataFrame(exact(rows), schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        start(read_folder(spark, f"{folder}/in", schema))


def snapshots(spark, steps, keys):
    folder = work_dir(spark, "snapshots")
    result = {}

    def start(facts):
        out = running_snapshots_stream(facts, keys, {"n": None, "total": "value"})
        result["schema"] = out.schema
        run_to_end(spark, stream_to_folder(out, f"{folder}/out", f"{folder}/checkpoint"))

    feed_in_steps(spark, steps, FACT, folder, start)
    rows = spark.read.schema(result["schema"]).parquet(f"{folder}/out").collect()
    return sorted((r.day, *[r[k] for k in keys], r.tick_ms, r.n, str(r.total)) for r in rows)


def test_snapshot_stream(spark):
    steps = [
        [("a", 1.5, 0), ("a", 1.0, 4_000), ("b", 1.0, 1_000)],
        [("a", 2.0, 12_000), ("a", 1.0, 38_000)],
        [("b", 4.0, 14_000)],  # its tick is over: part of b's next total
        [("a", 1.0, DAY_END + 20_000)],  # closes the day
    ]
    assert snapshots(spark, steps, ["org"]) == [
        (0, "a", 10_000, 2, "2.50"),
        (0, "a", 20_000, 3, "4.50"),
        (0, "a", 40_000, 4, "5.50"),
        (0, "b", 10_000, 1, "1.00"),
        (0, "b", 40_000, 2, "5.00"),
    ]


@pytest.mark.parametrize("kind", ["DOUBLE", "DECIMAL(16,2)", "BIGINT", "FLOAT"])
def test_snapshot_stream_keeps_the_type_and_nulls_of_a_measure(spark, kind):
    folder = work_dir(spark, "typed")
    values = [("a", None, 1_000), ("a", "1.75", 12_000), ("a", "2.5", 23_000), ("b", None, 2_000), ("b", None, DAY_END + 90_000)]
    rows = spark.createDataFrame(values, "org STRING, v STRING, ts BIGINT").withColumn("value", F.col("v").cast("double").cast(kind)).drop("v")
    rows.write.parquet(f"{folder}/in")
    out = running_snapshots_stream(read_folder(spark, f"{folder}/in", rows.schema), ["org"], {"n": None, "total": "value"})
    run_to_end(spark, stream_to_folder(out, f"{folder}/out", f"{folder}/checkpoint"))
    got = spark.read.schema(out.schema).parquet(f"{folder}/out")
    batch = running_snapshots(rows, ["org"], {"n": None, "total": "value"}).where(F.col("tick_ms") < DAY_END)
    assert sorted((r.org, r.tick_ms, r.n, r.total) for r in got.collect()) == sorted((r.org, r.tick_ms, r.n, r.total) for r in batch.collect())


def test_snapshot_stream_equals_batch_without_a_key(spark):
    steps = [[("a", float(i), 700 * i + 40 * j) for j in range(5)] for i in range(0, 60, 15)]
    ending = [("a", 1.0, DAY_END - 2), ("a", 1.0, DAY_END + 100_000)]
    got = snapshots(spark, [*steps, ending], [])
    facts = spark.createDataFrame(exact([r for s in steps for r in s] + ending), FACT)
    batch = running_snapshots(facts, [], {"n": None, "total": "value"}).where(F.col("tick_ms") < DAY_END)
    assert [r[:3] for r in got] == sorted((r.day, r.tick_ms, r.n) for r in batch.collect())
    assert got[-1][1] == DAY_END - 1


def settled(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)


def test_late_rows_of_a_closed_day_are_dropped_and_counted(spark):
    """Seven late rows of one key count as seven, though they are summed to one before they are dropped."""
    folder = work_dir(spark, "late")
    counts, seen = count_streams(spark), []

    def start(facts):
        totals = daily_totals_stream(facts, ["org"], {"n": None})

        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")

        run_to_end(spark, jobs.each_batch(totals, write, f"{folder}/checkpoint", "update"))
        settled(spark)
        seen.append(sum(counts.late.values()))

    late = [("a", 1.0, 3_000 + i) for i in range(7)]
    steps = [[("a", 1.0, 1_000)], [("a", 1.0, 2_000), ("a", 1.0, DAY_END + 60_000)], [*late, ("a", 1.0, DAY_END + 61_000)], [("b", 1.0, 5_000)]]
    try:
        feed_in_steps(spark, steps, FACT, folder, start)
    finally:
        spark.streams.removeListener(counts)
    assert seen == [0, 0, 7, 8] and counts.exact
    final = spark.read.parquet(f"{folder}/out").groupBy("day", "org").agg(F.max("n").alias("n")).collect()
    assert sorted((r.day, r.n) for r in final) == [(0, 2), (1, 2)]


def test_late_rows_within_one_run_are_those_that_are_dropped(spark):
    """Over many batches of one run, what is counted and what is stored add up to the input."""
    folder = work_dir(spark, "late-run")
    rng = random.Random(4)
    total = 0
    for step in range(10):
        newest = step * DAY_END // 2
        rows = [(rng.choice("abc"), 1.0, max(0, newest - rng.choice([0, 1_000, 3 * DAY_END]) - rng.randrange(1000))) for _ in range(30)]
        spark.createDataFrame(exact(rows), FACT).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        total += len(rows)
    counts = count_streams(spark)
    try:
        totals = daily_totals_stream(read_folder(spark, f"{folder}/in", FACT, maxFilesPerTrigger="1"), ["org"], {"n": None})

        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")

        run_to_end(spark, jobs.each_batch(totals, write, f"{folder}/checkpoint", "update"))
        settled(spark)
    finally:
        spark.streams.removeListener(counts)
    stored = spark.read.parquet(f"{folder}/out").groupBy("day", "org").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0]
    assert 0 < sum(counts.late.values()) == total - stored


def test_mart_snapshots_as_a_job_stopped_midway(spark, dims, monkeypatch):
    """Refreshes of a mart over several batches, one of them tried twice, against the batch form."""
    import parcelflow.streaming.snapshots as snapshots_module
    from parcelflow.plans.marts import mart_snapshots
    from parcelflow.sources.store import BucketStore

    mart = ALL_MARTS["dws_bound_org_sort_day_base"]
    layout = "org_id STRING, ts BIGINT"
    rows = [(random.Random(i).choice(["1", "2", None]), 1_700 * i) for i in range(40)] + [("1", DAY_END - 2), ("2", DAY_END + 100_000)]
    folder = work_dir(spark, "mart-snapshots")
    for k in range(4):
        part = rows[k * 12 : (k + 1) * 12]
        spark.createDataFrame(part, layout).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    make = lambda: snapshots_module.mart_snapshot_job(read_folder(spark, f"{folder}/in", layout, maxFilesPerTrigger="1"), mart, lambda: dims, f"{folder}/mart", f"{folder}/held", f"{folder}/c")
    stopped_once(monkeypatch, BucketStore, "replace", 2)
    run_through_a_stop(spark, make)
    got = read_mart(spark, f"{folder}/mart", mart.table)
    want = mart_snapshots(spark.createDataFrame(rows, layout), mart, dims).where(F.col("tick_ms") < DAY_END)
    assert sorted((str(r.org_id), r.ts, r.sort_count_base) for r in got.collect()) == sorted((str(r.org_id), r.tick_ms, r.sort_count_base) for r in want.collect())
    assert {r.org_name for r in got.where("org_id = '1'").collect()} == {"one"}


def test_a_renamed_organisation_changes_its_rows_only(spark, dims):
    import json

    table = "dws_bound_org_sort_day_base"
    mart, folder = ALL_MARTS[table], work_dir(spark, "renamed")
    facts = spark.createDataFrame([(org, ts) for org in ("1", "2", "3", None) for ts in (0, DAY_END + 5)], "org_id STRING, ts BIGINT")
    append_mart(f"{folder}/mart")(daily_mart(facts, mart, dims, version=F.lit(10).cast("bigint")), 0)
    newest = lambda: {(str(r.cur_date), r.org_id): r for r in latest_published(read_mart(spark, f"{folder}/mart", table), ["org_id"]).collect()}
    before = newest()
    organ = {"id": "3", "org_name": "three", "org_parent_id": "1", "region_id": "d3"}
    rows = [(json.dumps(change("base_organ", "u", 5, {**organ, "org_name": "THREE"}, organ)), 1), (json.dumps(change("base_organ", "u", 6, {"id": "77"}, {"id": "77"})), 2)]
    spark.createDataFrame(rows, RAW).coalesce(1).write.parquet(f"{folder}/raw")
    now = {**dims, "base_organ": dims["base_organ"].withColumn("org_name", F.when(F.col("id") == "3", "THREE").otherwise(F.col("org_name")))}
    config = spark.createDataFrame(
        [("base_organ", "dim_base_organ", None, "id,org_name", "id", "region_id")],
        "source_table STRING, sink_table STRING, sink_family STRING, sink_columns STRING, sink_pk STRING, foreign_keys STRING",
    )
    from parcelflow.operators.changes import decode_changes

    changes = decode_changes(read_folder(spark, f"{folder}/raw", RAW))
    run_to_end(spark, jobs.rename_job(changes, lambda: config, lambda: now, {table: f"{folder}/mart"}, f"{folder}/c", F.lit(20).cast("bigint")))
    after = newest()
    assert len(before) == len(after) == 8 and read_mart(spark, f"{folder}/mart", table).count() == 10
    for key, row in after.items():
        if key[1] == "3":
            assert (row.org_name, row.ts) == ("THREE", 20)
            assert {**row.asDict(), "org_name": "three", "ts": 10} == before[key].asDict()
        else:
            assert row == before[key]


def test_malformed_text_is_set_aside_and_counted(spark):
    import json

    folder = work_dir(spark, "dead")
    good = json.dumps(change("base_dic", "r", 4, {"id": "7", "name": "x"}))
    spark.createDataFrame([(good, 0), ("{broken", 1), ("[1,2]", 2), (None, 3), (good, 4)], RAW).write.parquet(f"{folder}/raw")
    counts = count_streams(spark)
    try:
        run_to_end(spark, jobs.capture_job(read_folder(spark, f"{folder}/raw"), f"{folder}/ods", f"{folder}/c"))
        settled(spark)
    finally:
        spark.streams.removeListener(counts)
    assert sum(counts.captured.values()) == 5 and sum(counts.malformed.values()) == 2
    stored = spark.read.parquet(f"{folder}/ods")
    assert sorted(r.after for r in stored.where("table = '__malformed'").collect()) == ["[1,2]", "{broken"]
    assert stored.where("table = 'base_dic'").count() == 2


def test_captured_histories_are_in_order_from_file_to_file(spark):
    import json

    folder = work_dir(spark, "ordered")
    rng = random.Random(2)
    expected = []
    for batch in range(2):
        rows = []
        for i in range(400):
            key = "hot" if rng.random() < 0.5 else str(rng.randrange(20))
            rows.append((json.dumps(change(rng.choice(["base_dic", "base_organ"]), "u", 1000 * batch + rng.randrange(50), {"id": key}, {"id": key})), 1000 * batch + i))
        rng.shuffle(rows)
        spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
        expected.append(len(rows))
    job = jobs.ordered_capture_job(read_folder(spark, f"{folder}/raw", maxFilesPerTrigger="1"), f"{folder}/ods", f"{folder}/c")
    run_to_end(spark, job, {"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    stored = spark.read.parquet(f"{folder}/ods").select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("place")).collect()
    assert len(stored) == sum(expected)
    histories, files = {}, set()
    for r in sorted(stored, key=lambda r: (r.batch_id, r.file.rsplit("/", 1)[1].split("-")[1], r.place)):
        key = (r.table, json.loads(r.after)["id"])
        histories.setdefault(key, []).append((r.ts, r.seq))
        files.add((r.batch_id, key, r.file))
    assert all(h == sorted(h) for h in histories.values())
    assert sum(key == ("base_dic", "hot") and batch == 0 for batch, key, _ in files) > 1


@pytest.fixture
def dims(spark):
    organ = spark.createDataFrame(
        [("1", "one", None, "d1"), ("2", "two", "1", "d1"), ("3", "three", "1", "d3")],
        "id STRING, org_name STRING, org_parent_id STRING, region_id STRING",
    )
    region = spark.createDataFrame(
        [("d1", "City", "p"), ("c", "Town", "p"), ("p", "Province", None)], "id STRING, name STRING, parent_id STRING"
    )
    truck = spark.createDataFrame([("t", "m")], "id STRING, truck_model_id STRING")
    model = spark.createDataFrame([("m", "Model")], "id STRING, model_name STRING")
    dic = spark.createDataFrame([("82001", "Parcel")], "id STRING, name STRING")
    return {"base_organ": organ, "base_region_info": region, "truck_info": truck, "truck_model": model, "base_dic": dic}


FACT_ROWS = (
    "cargo_type STRING, amount DECIMAL(16,2), sender_district_id STRING, sender_city_id STRING, sender_province_id STRING, "
    "receiver_district_id STRING, receiver_city_id STRING, receiver_province_id STRING, org_id STRING, start_org_id STRING, "
    "start_org_name STRING, truck_id STRING, actual_distance DECIMAL(16,2), transport_time BIGINT, ts BIGINT"
)


@pytest.mark.parametrize("name", ALL_MARTS)
def test_mart_stream_equals_batch(spark, dims, name):
    mart = ALL_MARTS[name]
    # One district, city or organisation dominates; one has no match, one is missing.
    rows = [
        ("82001", 1.25, d, "c", "p", d, "c", "p", o, o, f"org {o}", "t", 2.5, 60, 1000 * i)
        for i, (d, o) in enumerate([("d1", "1"), ("d1", "2"), ("d3", "3"), ("zz", "9"), (None, None), ("d1", "1"), ("d1", "1")])
    ]
    steps = [rows[:4], rows[4:]]
    folder = work_dir(spark, "mart")

    def start(facts):
        source = facts
        if mart.before is not None:
            first = jobs.mart_key_job(facts, mart, lambda: dims, f"{folder}/keyed", f"{folder}/checkpoint-key")
            run_to_end(spark, first)
            layout = spark.read.parquet(f"{folder}/keyed").drop("batch_id").schema
            source = read_folder(spark, f"{folder}/keyed", layout, recursiveFileLookup="true")
        job = jobs.mart_job(source, mart, lambda: dims, append_mart(f"{folder}/mart"), f"{folder}/checkpoint")
        run_to_end(spark, job)

    feed_in_steps(spark, steps, FACT_ROWS, folder, start)
    stored = read_mart(spark, f"{folder}/mart", name)
    got = latest_published(stored, list(mart.keys)).drop("ts")
    want = daily_mart(spark.createDataFrame(exact(rows), FACT_ROWS), mart, dims).drop("ts")
    columns = want.columns
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.collect()))
    assert stored.count() > 0


class Stopped(Exception):
    pass


def stopped_once(monkeypatch, target, name, after):
    """Make the function fail once, at its call number ``after``, when its work is done."""
    real, calls = getattr(target, name), []

    def run(*args, **kwargs):
        result = real(*args, **kwargs)
        calls.append(1)
        if len(calls) == after:
            raise Stopped("between write and commit")
        return result

    monkeypatch.setattr(target, name, run)


def run_through_a_stop(spark, make):
    """Run the job until it fails, run ``make()`` anew from its checkpoint to the end."""
    with pytest.raises(Exception, match="between write and commit"):
        run_to_end(spark, make())
    run_to_end(spark, make())


def test_a_stop_between_write_and_commit_changes_no_total(spark, dims, monkeypatch):
    """First hop stopped after its second batch was published; the second hop has read that batch by then."""
    mart = ALL_MARTS["dws_trade_org_order_day_base"]
    rows = [("82001", 1.25, d, "c", "p", d, "c", "p", o, o, "org", "t", 2.5, 60, 1000 * i) for i, (d, o) in enumerate([("d1", "1"), ("d3", "3"), ("zz", "9"), ("d1", "1"), ("d1", "2"), ("d3", "3")])]
    folder = work_dir(spark, "stopped")
    for k in range(3):
        spark.createDataFrame(exact(rows[2 * k : 2 * k + 2]), FACT_ROWS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    first = lambda: jobs.mart_key_job(read_folder(spark, f"{folder}/in", FACT_ROWS, maxFilesPerTrigger="1"), mart, lambda: dims, f"{folder}/keyed", f"{folder}/c1")

    def second():
        layout = spark.read.parquet(f"{folder}/keyed").drop("batch_id").schema
        keyed = read_folder(spark, f"{folder}/keyed", layout, recursiveFileLookup="true", maxFilesPerTrigger="1")
        run_to_end(spark, jobs.mart_job(keyed, mart, lambda: dims, append_mart(f"{folder}/mart"), f"{folder}/c2"))

    stopped_once(monkeypatch, jobs, "publish_batch", 2)
    with pytest.raises(Exception, match="between write and commit"):
        run_to_end(spark, first())
    second()
    run_to_end(spark, first())
    second()
    got = latest_published(read_mart(spark, f"{folder}/mart", mart.table), list(mart.keys)).drop("ts")
    want = daily_mart(spark.createDataFrame(exact(rows), FACT_ROWS), mart, dims).drop("ts")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("where", ["published", "held"])
def test_a_stopped_pairing_goes_on_where_it_was(spark, monkeypatch, where):
    import json

    from parcelflow.plans import facts
    from parcelflow.sources.store import BucketStore

    folder = work_dir(spark, "stopped-pairs")
    steps = [
        [cargo("c", 1), change("order_info", "c", 1, {"id": "2", "status": "60010"})],
        [change("order_info", "c", 2, {"id": "1", "status": "60010"}), cargo("c", 3, "g2", "2")],
        [change("order_info", "u", 4, {"id": "1", "status": "60020"}, {"id": "1", "status": "60010"})],
    ]
    for step in steps:
        spark.createDataFrame([(json.dumps(r), i) for i, r in enumerate(step)], RAW).coalesce(1).write.mode("append").parquet(f"{folder}/raw")

    def make():
        raw = read_folder(spark, f"{folder}/raw", RAW, maxFilesPerTrigger="1")
        return jobs.order_fact_job(facts.decode_order_changes(raw), f"{folder}/facts", f"{folder}/c", buckets=2)

    if where == "published":
        import parcelflow.sources.sinks as sinks

        stopped_once(monkeypatch, sinks, "publish_batch", 2)
    else:
        stopped_once(monkeypatch, BucketStore, "replace", 2)
    run_through_a_stop(spark, make)
    got = sorted((r.fact_type, r.order_id, r.id) for r in spark.read.parquet(f"{folder}/facts").collect())
    assert got == [("dwd_trade_order_detail", "1", "g1"), ("dwd_trade_order_detail", "2", "g2"), ("dwd_trade_pay_suc_detail", "1", "g1")]


def test_a_stopped_dimension_job_merges_a_batch_once(spark, monkeypatch):
    import json

    from parcelflow.operators.changes import decode_changes
    from parcelflow.sources.sinks import dimension_store, read_dimension
    from parcelflow.sources.store import BucketStore

    folder = work_dir(spark, "stopped-dims")
    for step in ([("c", 1, "a")], [("u", 5, "b")], [("u", 3, "late")]):
        rows = [(json.dumps(change("base_dic", op, ts, {"id": "7", "name": name})), ts) for op, ts, name in step]
        spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
    config = spark.createDataFrame(
        [("base_dic", "dim_base_dic", None, "id,name", "id", None)],
        "source_table STRING, sink_table STRING, sink_family STRING, sink_columns STRING, sink_pk STRING, foreign_keys STRING",
    )
    make = lambda: jobs.dimension_job(decode_changes(read_folder(spark, f"{folder}/raw", RAW, maxFilesPerTrigger="1")), lambda: config, f"{folder}/dims", f"{folder}/c")
    stopped_once(monkeypatch, BucketStore, "upsert", 2)
    run_through_a_stop(spark, make)
    assert dimension_store(spark, f"{folder}/dims").version().number == 2
    assert [tuple(r) for r in read_dimension(spark, f"{folder}/dims", "dim_base_dic", "id", ["id", "name"]).collect()] == [("7", "b")]


def test_capture_to_facts_to_dimension(spark):
    """The jobs one after the other, over folders."""
    import json

    folder = work_dir(spark, "jobs")
    rows = [
        cargo("c", 1),
        change("order_info", "c", 2, {"id": "1", "status": "60010", "sender_name": "A", "receiver_name": "B"}),
        change("order_info", "u", 3, {"id": "1", "status": "60020", "sender_name": "A", "receiver_name": "B", "update_time": "2023-11-06T03:00:00Z"}, {"id": "1", "status": "60010"}),
        change("base_dic", "r", 4, {"id": "7", "name": "x"}),
        change("base_dic", "d", 5, None, {"id": "7"}),
    ]
    raw_rows = [(json.dumps(r), i) for i, r in enumerate(rows)]
    spark.createDataFrame(raw_rows, RAW).write.parquet(f"{folder}/raw")
    run_to_end(spark, jobs.capture_job(read_folder(spark, f"{folder}/raw"), f"{folder}/ods", f"{folder}/c1"))
    layout = "seq BIGINT, op STRING, ts BIGINT, before STRING, after STRING, table STRING"
    changes = read_folder(spark, f"{folder}/ods", layout)

    run_to_end(spark, jobs.order_fact_job(changes, f"{folder}/facts", f"{folder}/c2"))
    got = spark.read.parquet(f"{folder}/facts")
    assert sorted(r.fact_type for r in got.collect()) == ["dwd_trade_order_detail", "dwd_trade_pay_suc_detail"]
    config = spark.createDataFrame(
        [("base_dic", "dim_base_dic", None, "id,name", "id", None)],
        "source_table STRING, sink_table STRING, sink_family STRING, sink_columns STRING, sink_pk STRING, foreign_keys STRING",
    )
    run_to_end(spark, jobs.dimension_job(changes, lambda: config, f"{folder}/dims", f"{folder}/c3"))
    from parcelflow.sources.sinks import read_dimension

    assert [tuple(r) for r in read_dimension(spark, f"{folder}/dims", "dim_base_dic", "id", ["id", "name"]).collect()] == [("7", "x")]
