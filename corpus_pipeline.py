"""The corpus pipeline: documents in, packed token sequences out.

Each stage works on all that the stage before kept; its rows are written as Parquet and
read again, so a stage can be repeated after a failure without the ones before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import language, lines, minhash, mixing, packing
from parcelflow.session import work_dir

#: Code length from which a text is no better described by any learned language than byte by byte.
MOST_BITS_PER_BYTE = 8.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts that no learned language describes.

    A null id is judged like any other; rows that repeat an id go together.
    """
    model = language.train(docs.where(~language.held_out()))
    found = language.identify(docs, model)
    bad = (F.col("lang_pred") == language.UNDETERMINED) | (F.col("bits_per_byte") >= MOST_BITS_PER_BYTE)
    rejected = found.where(bad).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(rejected, docs["doc_id"].eqNullSafe(rejected["_id"]), "left_anti")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated lines; a document all of whose lines go stays with an empty text."""
    return lines.drop_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources", mix),
    ("packing", pack),
]

#: Trained statistics, signatures and a tokenizer are beyond SQL; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
