"""Exact duplicates by radix partitioning from the first byte on.

Documents are split by successive stretches of their bytes until a group has one member
or its texts have ended.  The bytes themselves are the shuffle key, so equality is never
left to a digest.  A stretch grows with depth, which bounds the passes by the logarithm
of the longest text; only documents that still share all bytes read so far go on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.session import work_dir

FIRST_BYTES = 64
GROWTH = 8
MOST_BYTES = 1 << 20


def exact_duplicates(docs: DataFrame, first_bytes: int = FIRST_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and empty texts are equal to each other.  Of equal texts
    the largest doc_id stays; a null doc_id stays only if no member has an id.  Rows that
    repeat both id and text are counted each and share the verdict.  Other columns are
    not read.  Equal texts may be any share of the table: groups are counted inside each
    task before the shuffle, and the join back to them is an equi-join whose large
    partitions Spark splits.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "radix")
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    state = docs.select("doc_id", F.sha2(text, 256).alias("text_sha256"), F.lit(0).cast("long").alias("part"), text.alias("rest"))
    width, level, done = first_bytes, 0, []
    while True:
        keyed = state.select(
            "doc_id", "text_sha256", "part", "rest",
            F.substring("rest", 1, width).alias("digit"),
            (F.length("rest") > width).alias("more"),
        )
        groups = keyed.groupBy("part", "digit", "more").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
        groups.withColumn("next", F.monotonically_increasing_id()).write.parquet(f"{folder}/groups-{level}")
        groups = spark.read.parquet(f"{folder}/groups-{level}")
        going_on = F.col("more") & (F.col("group_size") > 1)
        split = keyed.join(groups, ["part", "digit", "more"]).select(
            "doc_id", "text_sha256", "keep_id", "group_size",
            F.col("next").alias("part"),
            F.when(going_on, F.substring("rest", width + 1, 2**31 - 1)).alias("rest"),
        )
        split.write.parquet(f"{folder}/split-{level}")
        split = spark.read.parquet(f"{folder}/split-{level}")
        done.append(split.where(F.col("rest").isNull()))
        if groups.where(going_on).isEmpty():
            break
        state = split.where(F.col("rest").isNotNull()).select("doc_id", "text_sha256", "part", "rest")
        width, level = min(width * GROWTH, MOST_BYTES), level + 1
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    return rows.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents of which no equal text with a larger doc_id exists, all columns."""
    kept = exact_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")
