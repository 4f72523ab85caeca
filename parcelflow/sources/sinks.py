"""Writing facts, dimensions and marts.

Batch functions take the micro-batch and its id, so they serve as ``foreachBatch``
bodies.  What other jobs read as a stream is published once per batch, and a replayed batch
leaves it as it is (``store``); marts, which are read as tables, replace the folder of the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from parcelflow.plans.dimensions import newest_rows, sink_family
from parcelflow.sources.schemas import MARTS, to_wire_json, written_fields
from parcelflow.sources.store import BucketStore, publish_batch

BatchWriter = Callable[[DataFrame, int], None]

# Fixed value: rows per insert statement of a database sink.
JDBC_BATCH_ROWS = 5_000


# --- topics --------------------------------------------------------------------------------


def as_messages(facts: DataFrame, key: str | None = None) -> DataFrame:
    """Facts -> wire text, with the key that keeps one row's changes in one partition."""
    value = to_wire_json(facts.columns).alias("value")
    return facts.select(value) if key is None else facts.select(F.col(key).cast("string").alias("key"), value)


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch write to a topic, at least once."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def stream_to_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    writer = messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("topic", topic).option("checkpointLocation", checkpoint)


def stream_to_folder(df: DataFrame, path: str, checkpoint: str, *partition_by: str) -> DataStreamWriter:
    """Append to a folder, exactly once."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partition_by) if partition_by else writer


def stream_to_console(df: DataFrame, rows: int = 20) -> DataStreamWriter:
    """Print a stream, for debugging."""
    return df.writeStream.format("console").option("numRows", rows).option("truncate", False)


# --- folders kept by batch -------------------------------------------------------------------


def _replace_batch(rows: DataFrame, batch_id: int, path: str, *columns: str) -> None:
    """Write a batch below ``<columns>/batch_id=...``, replacing what an earlier try left there.

    The rebalance gives each folder few files of moderate size: small ones are merged,
    and a folder with most of the rows is split over several tasks.
    """
    target = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).hint("rebalance", *[F.col(c) for c in columns])
    writer = target.write.partitionBy(*columns, "batch_id").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


# --- fan-out ---------------------------------------------------------------------------------


def fan_out_to_folders(path: str, column: str = "fact_type") -> BatchWriter:
    """Mixed facts -> one folder per fact and batch, all published in a single move.

    The files of a fact follow one another in its time ``ts``, for the marts behind.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        publish_batch(batch, batch_id, path, column, in_time="ts" if "ts" in batch.columns else None)

    return write


def fan_out_to_topics(
    servers: str, shape: Callable[[DataFrame, str], DataFrame], names: Iterable[str], key: str = "order_id", prefix: str = ""
) -> BatchWriter:
    """Mixed facts -> one topic per fact, in a single write that names the topic per row.

    ``shape`` gives one fact its own columns, e.g. :func:`parcelflow.plans.facts.order_fact`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            messages = [as_messages(shape(batch, name), key).withColumn("topic", F.lit(prefix + name)) for name in names]
            union = messages[0]
            for more in messages[1:]:
                union = union.unionByName(more)
            union.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
        finally:
            batch.unpersist()

    return write


# --- marts -----------------------------------------------------------------------------------


def append_mart(path: str, by_day: bool = True) -> BatchWriter:
    """Append finished mart rows; the versions of a day's total differ in ``ts``.

    A folder per day suits live marts, whose batches touch a day or two.  A catch-up over
    years in one batch is better off without (``by_day=False``).
    """
    columns = ["cur_date"] if by_day else []

    def write(batch: DataFrame, batch_id: int) -> None:
        _replace_batch(batch, batch_id, path, *columns)

    return write


def append_mart_jdbc(url: str, table: str, driver: str, **options: str) -> BatchWriter:
    """Append to a database table, columns in the declared order.

    At least once: a replayed batch repeats rows with the same keys and version.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        columns = [f.name for f in written_fields(MARTS[table])]
        writer = batch.select(*columns).write.format("jdbc").mode("append")
        writer.options(url=url, dbtable=table, driver=driver, batchsize=str(JDBC_BATCH_ROWS), **options).save()

    return write


def read_mart(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All appended versions of a mart; with folders by day a filter on ``cur_date`` prunes."""
    return spark.read.schema(StructType(written_fields(MARTS[table]))).parquet(path).drop("batch_id")


# --- dimensions --------------------------------------------------------------------------------

DIMENSION_ROW = "sink_table STRING, pk STRING, op STRING, ts BIGINT, seq BIGINT, batch_id BIGINT, row MAP<STRING, STRING>"

#: Buckets of each dimension: a batch rewrites those that its keys lie in.
DIMENSION_BUCKETS = 32


def dimension_store(spark: SparkSession, path: str, buckets: int = DIMENSION_BUCKETS) -> BucketStore:
    """Current rows of all dimensions.  Deletes stay as rows, so that an older change that comes later does not bring its key back."""
    return BucketStore(spark, path, DIMENSION_ROW, "sink_table", "pk", ["ts", "seq", "batch_id"], buckets)


def upsert_dimensions(path: str, buckets: int = DIMENSION_BUCKETS) -> BatchWriter:
    """Routed dimension rows -> the current row of each key, in the buckets that the batch touches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = newest_rows(batch.select("sink_table", "pk", "op", "ts", "seq", "row"))
        dimension_store(batch.sparkSession, path, buckets).upsert(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), batch_id)

    return write


def read_dimension(spark: SparkSession, path: str, sink_table: str, sink_pk: str, columns: list[str]) -> DataFrame:
    """Current rows of one dimension, all columns texts; reads that dimension's buckets and nothing older."""
    kept = dimension_store(spark, path).rows(sink_table).where(F.col("op") != "d")
    others = [c for c in columns if c != sink_pk]
    return kept.select(F.col("pk").alias(sink_pk), *[F.col("row")[c].alias(c) for c in others])


def _quoted(*names: str | None) -> str:
    """An identifier from config text."""
    return ".".join("`" + n.replace("`", "``") + "`" for n in names if n)


def _config_columns(row) -> list[str]:
    """The key first, then the other configured columns, each once."""
    return list(dict.fromkeys([row.sink_pk, *[c for c in (row.sink_columns or "").split(",") if c]]))


def create_dimensions(spark: SparkSession, config: DataFrame, database: str | None = None) -> list[str]:
    """Create the configured dimension tables that do not exist, every column a text.

    One row of the config is one table, so the config is small by nature.  The column
    family becomes a table property.  A table that exists gets the columns that the config
    has added since; its rows have nulls there.
    """
    created = []
    for row in config.select("sink_table", "sink_pk", "sink_columns", sink_family("sink_family").alias("family")).collect():
        name, columns = _quoted(database, row.sink_table), _config_columns(row)
        if spark.catalog.tableExists(name):
            known = {c.name.lower() for c in spark.catalog.listColumns(name)}
            added = [c for c in columns if c.lower() not in known]
            if added:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{_quoted(c)} STRING' for c in added)})")
            continue
        layout = ", ".join(f"{_quoted(c)} STRING" for c in columns)
        family = row.family.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({layout}) USING parquet TBLPROPERTIES ('family' = '{family}')")
        created.append(f"{database}.{row.sink_table}" if database else row.sink_table)
    return created


def bind_dimensions(spark: SparkSession, path: str, config: DataFrame, database: str | None = None) -> list[str]:
    """Catalog views ``<sink_table>_current`` over the version of the dimension store in force.

    A view has the configured columns, those added since included; rows stored before are null
    there.  It lists the folders of that version, at most one per bucket, and is replaced in
    one step when it is bound again, after an upsert or a change of the config.  Vacuum the
    store with as many versions kept as views may lag behind.
    """
    store = dimension_store(spark, path)
    version, bound = store.version(), []
    for row in config.select("sink_table", "sink_pk", "sink_columns").collect():
        columns = _config_columns(row)
        parts = [f"SELECT pk, op, row FROM parquet.{_quoted(folder)}" for folder in store.folders(row.sink_table, version)]
        parts = parts or ["SELECT CAST(NULL AS STRING) AS pk, 'd' AS op, CAST(NULL AS MAP<STRING, STRING>) AS row"]
        others = [f"row['{c.replace(chr(92), chr(92) * 2).replace(chr(39), chr(92) + chr(39))}'] AS {_quoted(c)}" for c in columns[1:]]
        chosen = ", ".join([f"pk AS {_quoted(columns[0])}", *others])
        name = _quoted(database, f"{row.sink_table}_current")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {chosen} FROM ({' UNION ALL '.join(parts)}) WHERE op <> 'd'")
        bound.append(f"{row.sink_table}_current")
    return bound
