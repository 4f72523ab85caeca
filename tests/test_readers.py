"""Feeds by kind of table, the preloaded config, and the trip job over several batches."""

import json

from checks.streams import run_to_end
from parcelflow.operators.changes import decode_changes
from parcelflow.session import work_dir
from parcelflow.sources.readers import RAW, config_changes, dimension_changes, fact_changes, read_config, read_folder
from parcelflow.streaming import jobs
from tests.conftest import cargo, change, order


def test_feeds_hold_the_tables_of_their_kind(feed):
    raw = feed(order("c", 1), cargo("c", 2), change("transport_task", "u", 3, {"id": "t"}), change("order_org_bound", "c", 4, {"id": "b"}), change("base_dic", "r", 5, {"id": "7"}), change("user_info", "u", 6, {"id": "8"}), change("config_dim", "c", 7, {"source_table": "x"}), change("other", "c", 8, {"id": "9"}), "{broken")
    tables = lambda df: sorted(r.table for r in df.collect())
    assert tables(fact_changes(raw)) == ["order_cargo", "order_info", "order_org_bound", "transport_task"]
    assert [(r.table, r.op) for r in dimension_changes(raw).orderBy("table").collect()] == [("base_dic", "r"), ("user_info", "u")]
    assert tables(config_changes(raw)) == ["config_dim"]


def test_config_is_preloaded_from_files(spark):
    folder = work_dir(spark, "config")
    config = spark.createDataFrame([("base_dic", "dim_base_dic", "id,name")], "source_table STRING, sink_table STRING, sink_columns STRING")
    config.write.parquet(f"{folder}/config")
    assert read_config(spark, f"{folder}/config").collect() == config.collect()


def test_trip_facts_as_a_job(spark):
    """A fact when the end time appears, and not again when it changes later."""
    folder = work_dir(spark, "trips")

    def task(ts, end, before):
        times = {"actual_start_time": 1_699_264_800_000, "actual_end_time": end}
        row = {"id": "t1", "truck_id": "k", "truck_no": "ABC", "driver1_name": "Anna", "actual_distance": 12.5, **times}
        return change("transport_task", "u", ts, row, {**row, "actual_end_time": before})

    for k, envelope in enumerate([task(1, None, None), task(2, 1_699_268_400_000, None), task(3, 1_699_272_000_000, 1_699_268_400_000)]):
        spark.createDataFrame([(json.dumps(envelope), k)], RAW).coalesce(1).write.mode("append").parquet(f"{folder}/raw")
    changes = decode_changes(read_folder(spark, f"{folder}/raw", RAW, maxFilesPerTrigger="1"))
    run_to_end(spark, jobs.trip_fact_job(changes, f"{folder}/facts", f"{folder}/c"))
    got = spark.read.parquet(f"{folder}/facts").collect()
    assert [(r.id, r.transport_time, str(r.actual_distance), r.driver1_name) for r in got] == [("t1", 3_600_000, "12.50", "A***")]
