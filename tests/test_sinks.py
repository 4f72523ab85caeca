import json

from pyspark.sql import functions as F

from parcelflow.plans import dimensions
from parcelflow.plans.marts import ALL_MARTS
from parcelflow.session import conf_scope, work_dir
from parcelflow.sources import sinks
from parcelflow.sources.readers import facts_from_topic
from parcelflow.sources.schemas import DIMENSION_TABLES, FACT_TABLES, FACTS, MARTS, camel, written_fields
from parcelflow.sources.store import BucketStore, Files, publish_batch

ROUTED = "sink_table STRING, pk STRING, op STRING, ts BIGINT, seq BIGINT, row MAP<STRING, STRING>"


def routed(spark, *rows):
    return spark.createDataFrame([("dim_x", pk, op, ts, 0, {"name": name}) for pk, op, ts, name in rows], ROUTED)


def current(spark, path):
    return {r.id: r.name for r in sinks.read_dimension(spark, path, "dim_x", "id", ["id", "name"]).collect()}


def test_upserts_keep_current_rows(spark):
    path = f"{work_dir(spark, 'dims')}/store"
    upsert = sinks.upsert_dimensions(path, buckets=4)
    upsert(routed(spark, ("1", "c", 1, "a"), ("1", "u", 2, "b"), ("2", "c", 1, "x")), 0)
    second = routed(spark, ("1", "u", 3, "c"), ("3", "c", 1, None))
    upsert(second, 1)
    upsert(second, 1)  # replayed after a failure
    store = sinks.dimension_store(spark, path)
    assert store.version().number == 1 and store.rows().count() == 3
    assert current(spark, path) == {"1": "c", "2": "x", "3": None}
    upsert(routed(spark, ("2", "d", 9, None), ("1", "u", 9, "z")), 2)
    assert current(spark, path) == {"1": "z", "3": None}
    store.rebucket(7)
    upsert(routed(spark, ("2", "u", 5, "late"), ("1", "u", 2, "late")), 3)  # older than the delete
    assert current(spark, path) == {"1": "z", "3": None} and store.rows().count() == 3


def test_reads_follow_the_dimension_not_its_history(spark):
    path = f"{work_dir(spark, 'dims')}/store"
    upsert, store = sinks.upsert_dimensions(path, buckets=8), sinks.dimension_store(spark, path)
    upsert(routed(spark, *[(str(i), "c", 1, "first") for i in range(100)]), 0)
    sizes = set()
    for batch in range(1, 6):
        upsert(routed(spark, ("7", "u", 1 + batch, f"v{batch}")), batch)
        sizes.add(len(store.rows("dim_x").inputFiles()))
        changed = [p for p, v in store.version().folders.items() if v == batch]
        assert len(changed) == 1  # the bucket of the key alone is written anew
    assert len(sizes) == 1 and store.rows("dim_x").count() == 100 and current(spark, path)["7"] == "v5"
    old = store.version()
    before = store.rows(version=old)
    assert store.vacuum(keep=1) == 5
    assert store.rows().count() == 100 and before.count() == 100
    assert store.rows("dim_y").count() == 0


def test_a_broken_upsert_leaves_the_version_in_force(spark, monkeypatch):
    path = f"{work_dir(spark, 'dims')}/store"
    upsert, store = sinks.upsert_dimensions(path, buckets=2), sinks.dimension_store(spark, path)
    upsert(routed(spark, ("1", "c", 1, "a"), ("2", "c", 1, "b")), 0)

    def broken(self, version):
        raise RuntimeError("stopped before the pointer moved")

    with monkeypatch.context() as patch:
        patch.setattr(BucketStore, "_commit", broken)
        try:
            upsert(routed(spark, ("1", "u", 2, "c"), ("3", "c", 1, "d")), 1)
        except RuntimeError:
            pass
    assert current(spark, path) == {"1": "a", "2": "b"}
    upsert(routed(spark, ("1", "u", 2, "c"), ("3", "c", 1, "d")), 1)
    assert current(spark, path) == {"1": "c", "2": "b", "3": "d"} and store.version().batch_id == 1


def test_store_keeps_odd_names_apart(spark):
    path = f"{work_dir(spark, 'dims')}/store"
    rows = [(t, "k", "c", 1, 0, 0, {"name": t or "none"}) for t in ("a/b", "a=b", "a b", "ü", "%41", None)]
    store = sinks.dimension_store(spark, path, 3)
    store.upsert(spark.createDataFrame(rows, sinks.DIMENSION_ROW), 0)
    store.upsert(spark.createDataFrame([("a=b", "k", "u", 2, 0, 1, {"name": "new"})], sinks.DIMENSION_ROW), 1)
    assert {r.sink_table: r.row["name"] for r in store.rows().collect()} == {"a/b": "a/b", "a=b": "new", "a b": "a b", "ü": "ü", "%41": "%41", None: "none"}
    assert [r.row["name"] for r in store.rows("a=b").collect()] == ["new"]


def test_published_batches_stay_as_they_are(spark):
    path = f"{work_dir(spark, 'published')}/rows"
    assert publish_batch(spark.range(5).toDF("id"), 0, path)
    first = spark.read.parquet(path).inputFiles()
    assert not publish_batch(spark.range(9).toDF("id"), 0, path)
    assert spark.read.parquet(path).inputFiles() == first and spark.read.parquet(path).count() == 5
    assert Files(spark, path).names(f"{path}/_staging") == []


def test_files_of_a_batch_follow_one_another_in_time(spark, tmp_path):
    rows = spark.range(600).select((F.col("id") * 7919 % 600).alias("ts"), (F.col("id") % 2).alias("kind"), F.lit("x" * 20).alias("more"))
    burst = spark.range(300).select(F.lit(600).alias("ts"), F.lit(0).alias("kind"), F.col("id").cast("string").alias("more"))
    with conf_scope(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}):
        for batch, more in enumerate((rows, rows.withColumn("ts", F.col("ts") + 600).unionByName(burst))):
            assert publish_batch(more.repartition(5), batch, f"{tmp_path}/t", "kind", in_time="ts")
    files = sorted((tmp_path / "t").rglob("kind=0/*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    assert len({f.stat().st_mtime_ns // 1_000_000 for f in files}) == len(files) > 6
    spans = [spark.read.parquet(str(f)).agg(F.min("ts"), F.max("ts")).first() for f in files]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and spark.read.parquet(f"{tmp_path}/t").count() == 1500


def test_create_dimensions(spark):
    config = spark.createDataFrame(
        [("a", "dim_made_a", None, "id,name", "id", None), ("b", "dim_made_b", "wide", "name,code", "code", None)],
        "source_table STRING, sink_table STRING, sink_family STRING, sink_columns STRING, sink_pk STRING, foreign_keys STRING",
    )
    assert sinks.create_dimensions(spark, config) == ["dim_made_a", "dim_made_b"]
    assert sinks.create_dimensions(spark, config) == []
    assert spark.table("dim_made_b").dtypes == [("code", "string"), ("name", "string")]
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES dim_made_a").collect()}
    assert properties["family"] == dimensions.DEFAULT_FAMILY


CONFIG = "source_table STRING, sink_table STRING, sink_family STRING, sink_columns STRING, sink_pk STRING, foreign_keys STRING"


def test_config_that_grows_adds_columns(spark):
    path = f"{work_dir(spark, 'bound')}/store"
    config = lambda columns: spark.createDataFrame([("x", "dim_x", None, columns, "id", None)], CONFIG)
    assert sinks.bind_dimensions(spark, path, config("id,name")) == ["dim_x_current"]
    assert spark.table("dim_x_current").count() == 0
    sinks.upsert_dimensions(path)(routed(spark, ("1", "c", 1, "a"), ("2", "c", 1, "b")), 0)
    sinks.bind_dimensions(spark, path, config("id,name"))
    assert sorted(map(tuple, spark.table("dim_x_current").collect())) == [("1", "a"), ("2", "b")]
    wider = spark.createDataFrame([("dim_x", "2", "u", 2, 0, {"name": "b", "odd`'col": "new"}), ("dim_x", "1", "d", 3, 0, None)], ROUTED)
    sinks.upsert_dimensions(path)(wider, 1)
    sinks.bind_dimensions(spark, path, config("id,name,odd`'col"))
    assert [r.asDict() for r in spark.sql("SELECT * FROM dim_x_current").collect()] == [{"id": "2", "name": "b", "odd`'col": "new"}]
    sinks.create_dimensions(spark, config("id,name"))
    assert sinks.create_dimensions(spark, config("id,name,phone")) == []
    spark.sql("INSERT INTO dim_x VALUES ('1', 'a', NULL)")
    assert [tuple(r) for r in spark.table("dim_x").select("id", "name", "phone").collect()] == [("1", "a", None)]


def test_fan_out_replay_does_not_repeat(spark):
    path = f"{work_dir(spark, 'fan')}/facts"
    write = sinks.fan_out_to_folders(path)
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "fact_type STRING, id BIGINT")
    write(batch, 0)
    write(batch, 0)
    write(spark.createDataFrame([("a", 4)], "fact_type STRING, id BIGINT"), 1)
    stored = spark.read.parquet(path)
    assert sorted(r.id for r in stored.where("fact_type = 'a'").collect()) == [1, 3, 4]
    assert stored.count() == 4


def test_wire_format_round_trip(spark):
    schema = FACTS["dwd_bound_sort"]
    fact = spark.createDataFrame([("1", "2", "3", "2023-11-06 10:00:00", None, 5)], schema)
    message = sinks.as_messages(fact, "order_id").collect()[0]
    assert message.key == "2"
    assert json.loads(message.value) == {"id": "1", "orderId": "2", "orgId": "3", "sortTime": "2023-11-06 10:00:00", "ts": 5}
    again = facts_from_topic(sinks.as_messages(fact), schema)
    assert again.collect() == fact.collect()
    wide = facts_from_topic(spark.createDataFrame([("{}",)], "value STRING"), FACTS["dwd_trade_order_detail"])
    assert str(wide._jdf.queryExecution().optimizedPlan()).count("from_json") == 1


def test_append_mart_versions(spark):
    name = "dws_trans_dispatch_day_base"
    path = f"{work_dir(spark, 'mart')}/rows"
    rows = spark.sql("SELECT DATE '2024-01-01' AS cur_date, 3L AS dispatch_order_count_base, 10L AS ts")
    sinks.append_mart(path)(rows, 0)
    sinks.append_mart(path)(rows.withColumns({"dispatch_order_count_base": F.lit(7).cast("bigint"), "ts": F.lit(20).cast("bigint")}), 1)
    stored = sinks.read_mart(spark, path, name)
    assert stored.count() == 2
    from parcelflow.operators.daily import latest_published

    assert latest_published(stored, []).collect()[0].dispatch_order_count_base == 7


def test_layouts():
    assert len(FACT_TABLES) == 4 and len(DIMENSION_TABLES) == 15 and len(FACTS) == 12 and len(MARTS) == 8
    assert set(ALL_MARTS) == set(MARTS) and {m.fact for m in ALL_MARTS.values()} <= set(FACTS)
    # Columns per insert of the sink tables.
    assert [len(written_fields(MARTS[m])) for m in MARTS] == [6, 8, 9, 9, 9, 3, 3, 11]
    assert all(len(FACTS[f].fields) == 28 for f in list(FACTS)[:8])
    assert camel("driver1_emp_id") == "driver1EmpId"
