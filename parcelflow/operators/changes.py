"""Decoding, cleaning and routing of change envelopes.

A decoded change has ``table``, ``op`` (c insert, u update, d delete, r snapshot),
``ts`` (capture time, ms), and the row images ``before`` / ``after``, as JSON text until
someone who knows the table parses them with just the fields it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType



def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add an expensive column behind a generator.

    The optimizer merges adjacent projections, which would repeat a parse for every
    field read from its result.  It never merges across a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def envelope(after: DataType, before: DataType) -> StructType:
    """Layout of an envelope.  ``ts_ms`` is the time's name at the source, ``ts`` after the first layer."""
    source = StructType([StructField("table", StringType())])
    fields = {"op": StringType(), "ts_ms": LongType(), "ts": LongType(), "before": before, "after": after, "source": source}
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def decode_changes(
    raw: DataFrame, value: str = "value", image: DataType = StringType(), before: DataType | None = None
) -> DataFrame:
    """Parse envelope text; other columns of ``raw`` pass through.

    A malformed text gives a row of nulls, which :func:`drop_unusable` removes.  Images
    stay JSON text by default.  A job that wants the tables of one layout only names it
    (and, in ``before``, the few fields it compares), which saves the second parse.
    """
    kept = [c for c in raw.columns if c != value]
    parsed = F.from_json(F.col(value), envelope(image, before or image))
    return computed_once(raw.select(*kept, value), "_envelope", parsed).select(
        *kept,
        F.col("_envelope.source.table").alias("table"),
        F.col("_envelope.op").alias("op"),
        F.coalesce("_envelope.ts_ms", "_envelope.ts").alias("ts"),
        F.col("_envelope.before").alias("before"),
        F.col("_envelope.after").alias("after"),
    )


def is_usable() -> Column:
    return F.col("after").isNotNull() & (F.col("op") != "d")


def drop_unusable(changes: DataFrame, metrics: Observation | str | None = None) -> DataFrame:
    """Drop deletes, rows without an ``after`` image and malformed text.

    ``metrics``, an observation or the name of one, collects ``rows`` and ``malformed`` on
    the way, without another pass.
    """
    if metrics is not None:
        changes = changes.observe(
            metrics, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("op").isNull(), 1)).alias("malformed")
        )
    return changes.where(is_usable())


#: Where captured text that is no change is kept, as if it were a table.
DEAD_LETTERS = "__malformed"


def set_malformed_aside(raw: DataFrame, metrics: str, value: str = "value") -> DataFrame:
    """Usable changes, and malformed texts as rows of the table ``DEAD_LETTERS`` with the text in ``after``.

    A missing text (a tombstone) is no malformed one.  ``metrics`` names an observation of
    ``rows`` and ``malformed``.
    """
    changes = decode_changes(raw.withColumn("_raw", F.col(value)))
    bad = F.col("_raw").isNotNull() & F.col("op").isNull()
    changes = changes.observe(metrics, F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("malformed"))
    kept = changes.where(bad | is_usable())
    aside = {"table": F.when(bad, F.lit(DEAD_LETTERS)).otherwise(F.col("table")), "after": F.when(bad, F.col("_raw")).otherwise(F.col("after"))}
    return kept.withColumns(aside).drop("_raw")


def encode_changes(changes: DataFrame) -> DataFrame:
    """Decoded change (images as text) -> ``key``, the row's id, and ``value``, the envelope text.

    The images are spliced in untouched.  With the id as message key all changes of a
    row go to one partition of a topic.
    """
    head = F.to_json(F.struct("op", "ts", F.struct("table").alias("source")))
    nested = [
        F.coalesce(F.concat(F.lit(f',"{name}":'), F.col(name)), F.lit(f',"{name}":null')) for name in ("before", "after")
    ]
    text = F.concat(F.expr("substring(_head, 1, length(_head) - 1)"), *nested, F.lit("}"))
    return changes.withColumn("_head", head).select(F.get_json_object("after", "$.id").alias("key"), text.alias("value"))


def for_tables(changes: DataFrame, *tables: str) -> DataFrame:
    """Keep changes of the named tables (partition pruning when stored by table)."""
    return changes.where(F.col("table").isin(*tables))


def parse_images(changes: DataFrame, image: DataType | str) -> DataFrame:
    """JSON images -> typed ones (a struct, or a map for an unknown table); typed ones stay."""
    if not isinstance(changes.schema["after"].dataType, StringType):
        return changes
    kept = [c for c in changes.columns if c not in ("before", "after")]
    images = F.struct(*[F.from_json(F.col(name), image).alias(name) for name in ("before", "after")])
    return computed_once(changes, "_images", images).select(*kept, "_images.before", "_images.after")


def order_within_key(changes: DataFrame, key: Column, partitions: int | None = None) -> DataFrame:
    """Lay the changes of each primary key out side by side, oldest first.

    Ranges over (key, time) rather than a hash of the key: a hot key spreads over
    several tasks and its history stays in order from one output file to the next.
    With a topic sink the key becomes the message key instead.
    """
    keyed = changes.withColumn("_key", key)
    parts = (partitions, "_key", "ts") if partitions else ("_key", "ts")
    return keyed.repartitionByRange(*parts).sortWithinPartitions("_key", "ts").drop("_key")


def route(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Attach the routing row of each change; unrouted changes are dropped.

    The config becomes one map, a scalar subquery that every task looks tables up in.  So no
    change is shuffled, least of all by table name, of which a few have most of the rows; and
    the plan is the same, with no job to count anything, whatever the config.  A config has a
    row per source table, which bounds the map.  Of several rows of a table each routes it.
    """
    columns = [c for c in config.columns if c != "source_table"]
    own = config.where(F.col("source_table").isNotNull()).groupBy("source_table").agg(F.collect_list(F.struct(*columns)).alias("rows"))
    routes = own.agg(F.map_from_entries(F.collect_list(F.struct("source_table", "rows")))).scalar()
    found = changes.select("*", F.explode(F.try_element_at(routes, F.col("table"))).alias("_route"))
    return found.select(*changes.columns, *[F.col(f"_route.{c}").alias(c) for c in columns])


def split_list(c: Column | str) -> Column:
    """Comma list -> array; null and empty text give an empty array."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(c, ","))


def keep_columns(row: Column, columns: Column) -> Column:
    """Entries of a map row whose key is in a column list."""
    return F.map_filter(row, lambda key, _: F.array_contains(columns, key))
