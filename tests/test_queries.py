"""Every registered query against its SQL, and properties of the plans."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import feeds
from checks.compare import TABLES, compare
from checks.oracle import ORACLE
from checks.queries import QUERIES
from parcelflow.operators.daily import partial_totals
from parcelflow.session import conf_scope, work_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    good, note = compare(spark, con, SF, name)
    assert good, note


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = [name for name in QUERIES if not name.startswith("stream_")]


def test_no_plan_pairs_rows_freely_or_runs_python(spark):
    for name in BATCH:
        plan = plan_of(entry.queries()[name](spark, SF))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition", "Python", "Pandas"):
            assert operator not in plan, (name, operator)


def test_lookups_survive_without_broadcast(spark, con):
    """Beyond the broadcast limit the same lookups shuffle and give the same rows."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with conf_scope(spark, off):
        for name in ("mart_org_sort_day", "mart_org_receive_day", "mart_truck_model_day", "lookup_miss_keeps_row"):
            assert "BroadcastHashJoin" not in plan_of(entry.queries()[name](spark, SF))
            good, note = compare(spark, con, SF, name)
            assert good, note


def test_batches_handed_on_in_several_files_lose_nothing(spark, con):
    """Files read one by one, as on larger tables: no file of a batch makes the rows of another late."""
    with conf_scope(spark, {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}):
        good, note = compare(spark, con, SF, "stream_mart_keyed_final")
    assert good, note


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["mart_bound_finish_day"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_linestatus,F)" in plan
    assert re.search(r"ReadSchema: struct<l_linestatus:string,l_shipdate:timestamp_ntz>", plan)


def test_pairing_shuffles_once(spark):
    from parcelflow.plans import facts

    raw = feeds.order_feed(feeds.table(spark, SF, "events"))
    path = f"{work_dir(spark, 'plan')}/feed"
    raw.write.parquet(path)
    made = facts.order_facts(facts.decode_order_changes(spark.read.schema(raw.schema).parquet(path)))
    plan = plan_of(made)
    assert plan.count("Exchange hashpartitioning(key") == 1 and plan.count("Exchange") == 1


def test_hot_keys_are_decoded_once(spark):
    from parcelflow.plans import facts

    raw = feeds.order_feed(feeds.table(spark, SF, "events"))
    path = f"{work_dir(spark, 'hot')}/feed"
    raw.write.parquet(path)
    stored, seen = spark.read.schema(raw.schema).parquet(path), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    made = facts.order_facts(facts.decode_order_changes(stored.withColumn("value", counted("value"))), hot_rows=20)
    assert len(made.collect()) > 0 and seen.value == stored.count()
    assert "Join" not in plan_of(made).replace("BroadcastHashJoin", "")  # no join deals the rows out again


def test_totals_are_reduced_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = plan_of(partial_totals(rows, ["k"], {"n": None}))
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "partial_count(1)" in below and "SortAggregate" not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["cur_date", "org_id", "org_name"] and df.count() > 0
