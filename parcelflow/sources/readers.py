"""Reading change feeds and fact topics, as a batch or as a stream."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelflow.operators.changes import computed_once, decode_changes, for_tables
from parcelflow.sources.schemas import DIMENSION_TABLES, FACT_TABLES, wire_fields, wire_struct

#: Columns every raw feed has: the text and its position among texts of the same time.
RAW = "value STRING, seq BIGINT"

#: What a micro-batch may take in unless an option says otherwise.  It also bounds the
#: rows of a hot key that one task of a stateful operator sees at a time.
MAX_OFFSETS = 2_000_000
MAX_FILES = 200


def read_topic(
    spark: SparkSession, servers: str, topic: str, stream: bool = True, starting: str = "latest", **options: str
) -> DataFrame:
    """A topic's values as text, tombstones as null.

    A restarted stream goes on from its checkpoint; ``starting`` counts on the first
    start only.  ``seq`` is the offset, which orders the messages of one key.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting if stream else "earliest")
    if stream:
        reader = reader.option("maxOffsetsPerTrigger", MAX_OFFSETS)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"))


def read_folder(
    spark: SparkSession, path: str, schema: StructType | str = RAW, stream: bool = True, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Files of a folder; a stream also takes up those that arrive later."""
    reader = spark.readStream.option("maxFilesPerTrigger", MAX_FILES) if stream else spark.read
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.format(fmt).schema(schema).load(path)


def fact_changes(raw: DataFrame) -> DataFrame:
    """Changes of the four fact source tables."""
    return for_tables(decode_changes(raw), *FACT_TABLES)


def dimension_changes(raw: DataFrame) -> DataFrame:
    """Changes, and rows of the initial snapshot, of the dimension source tables."""
    return for_tables(decode_changes(raw), *DIMENSION_TABLES)


def config_changes(raw: DataFrame, table: str = "config_dim") -> DataFrame:
    """Changes of the routing config table."""
    return for_tables(decode_changes(raw), table)


def read_config(spark: SparkSession, path: str | None = None, **jdbc: str) -> DataFrame:
    """Preload the routing config from files or, with ``url`` and ``dbtable``, from a database."""
    return spark.read.parquet(path) if path else spark.read.format("jdbc").options(**jdbc).load()


def facts_from_topic(raw: DataFrame, schema: StructType, keep: Iterable[str] = ()) -> DataFrame:
    """Fact texts of a topic -> typed rows, each text parsed once."""
    kept = list(keep)
    parsed = computed_once(raw.select("value", *kept), "_wire", wire_struct("value", schema))
    return parsed.select(*wire_fields(F.col("_wire"), schema), *kept)
