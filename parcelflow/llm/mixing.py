"""Mix sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies each of its documents should
get.  The whole part is given to every document; the fractional part is rounded so that
the source's words are kept: two documents with fractional shares meet, words move from
one to the other in a random direction until one of them has none or all of its text,
and the other goes on.  Groups of bounded size do this side by side and hand one
unfinished document each to the next level of a reduction tree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.columns import given_back, set_aside
from parcelflow.session import work_dir

#: Weights given to the sources in their order, over and over.
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
#: Documents that one group rounds, and groups that meet at the next level.
GROUP_DOCS = 2048
FAN_IN = 64
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: source, source_size, docs, target.

    Targets share the size of all sources by weight and stop at ``MAX_COPIES`` times a
    source's size; what is cut there is shared by weight among the others.  A source is
    full when its capacity over weight lies below the level that the rest share, so one
    pass in the order of that ratio finds them all.  Null is a source of its own, last.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    ranked = sources.withColumn("weight", F.element_at(weights, (F.row_number().over(order) - 1) % len(WEIGHTS) + 1))
    capacity = MAX_COPIES * F.col("source_size")
    ratio = Window.orderBy(capacity / F.col("weight"), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.select(
        "*",
        F.sum("source_size").over(Window.partitionBy()).alias("_all"),
        F.coalesce(F.sum(capacity).over(before), F.lit(0)).alias("_given"),
        F.sum("weight").over(ratio.rowsBetween(0, Window.unboundedFollowing)).alias("_weights"),
    )
    level = (F.col("_all") - F.col("_given")) / F.col("_weights")
    full = capacity <= level * F.col("weight")
    # in this order all full sources come first; the level of the first that is not full, the highest, holds for the rest
    ranked = ranked.withColumn("_level", F.max(F.when(~full, level)).over(Window.partitionBy()))
    target = F.when(full, capacity.cast("double")).otherwise(F.col("_level") * F.col("weight"))
    return ranked.select("source", "source_size", "docs", F.coalesce(target, F.lit(0.0)).alias("target"))


def _meet(rows: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Round one group; at most one row stays open."""
    rows = rows.sort_values(["size", "doc_id"], ascending=[False, True], na_position="last", kind="stable")
    size, share = rows["size"].to_numpy(float), rows["share"].to_numpy(float).copy()
    draw = np.random.default_rng(seed & (2**63 - 1)).random(len(rows))
    still = np.zeros(len(rows), bool)
    one = -1
    for two in np.flatnonzero((share > 0) & (share < size)).tolist():
        if one < 0:
            one = two
            continue
        words = share[one] + share[two]
        most, least = min(size[one], words), words - min(size[two], words)
        to_one = most > least and draw[two] * (most - least) < share[one] - least
        share[one] = most if to_one else least
        share[two] = words - share[one]
        open_ones = [i for i in (one, two) if 1e-6 < share[i] < size[i] - 1e-6]
        one = open_ones[0] if open_ones else -1
    if one >= 0:
        still[one] = True
    return rows.assign(share=np.where(still, share, np.rint(share)), open=still)


def _round_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    source_no, group, level = key
    seed = (int(source_no) * 1_000_003 + int(group)) * 101 + int(level)
    return _meet(rows, seed)


def mix_sources(docs: DataFrame, group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    ``size`` counts words (null text: 0), ``target`` is the source's share, ``taken`` the
    words the mix takes of the document, repeats counted: at least the whole copies that
    all documents of the source get, at most one copy more.  The words taken of a source
    differ from its target by rounding to whole words only, because the last open
    document of a source is taken in part.  Draws are seeded by group, and groups are
    made by a hash of the id and sorted, so reruns agree.  Documents without words take
    none.  Repeated rows are documents of their own.  Other columns are not read.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "mix")
    count = F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long")
    docs.select("doc_id", "source", count.alias("size")).write.parquet(f"{folder}/sizes")
    sizes = spark.read.parquet(f"{folder}/sizes")
    numbered = source_targets(sizes).withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    numbered.write.parquet(f"{folder}/sources")
    sources = spark.read.parquet(f"{folder}/sources")
    groups = F.ceil(F.col("docs") / group_docs)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(copies + 1e-12)
    sizes = sizes.withColumnRenamed("source", "_source")
    rows = sizes.join(sources, sizes["_source"].eqNullSafe(sources["source"])).select(
        "doc_id", "source", "size", "source_size", "target", "source_no",
        (whole * F.col("size")).alias("whole"),
        (F.greatest(copies - whole, F.lit(0.0)) * F.col("size")).alias("share"),
        F.pmod(F.xxhash64("doc_id"), groups).alias("group"),
    )
    top = sources.agg(F.max(groups)).first()[0] or 1
    schema = "doc_id long, source string, size long, source_size long, target double, source_no long, whole long, share double, group long, level long, open boolean"
    rows = rows.withColumns({"source_no": F.col("source_no").cast("long"), "open": F.lit(True)})
    settled, level = [], 0
    while True:
        keyed = rows.withColumn("level", F.lit(level).cast("long")).select(*[c.split()[0] for c in schema.split(", ")])
        keyed.groupBy("source_no", "group", "level").applyInPandas(_round_group, schema).write.parquet(f"{folder}/level-{level}")
        made = spark.read.parquet(f"{folder}/level-{level}")
        if top == 1:
            settled.append(made)  # what is still open is the last document of its source
            break
        settled.append(made.where(~F.col("open")))
        rows = made.where("open").withColumn("group", F.floor(F.col("group") / FAN_IN).cast("long"))
        top, level = -(-top // FAN_IN), level + 1
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    taken = (F.col("whole") + F.round("share").cast("long")).alias("taken")
    return out.select("doc_id", "source", "size", "source_size", "target", taken)


def take_mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: documents repeated as often as taken, columns as in ``docs``.

    The one document of a source that is taken in part has its text cut after as many
    words (and ``n_chars`` set, if there is one); documents not taken are left out.  Rows
    equal in id, source and size share their number.
    """
    shares = mix_sources(docs).groupBy("doc_id", "source", "size").agg(F.max("taken").alias("taken"))
    rows = set_aside(docs)
    rows = rows.withColumn("words", F.coalesce(F.regexp_count("_in_text", F.lit(WORD)), F.lit(0)).cast("long"))
    same = F.col("_in_doc_id").eqNullSafe(F.col("doc_id")) & F.col("_in_source").eqNullSafe(F.col("source")) & (F.col("words") == F.col("size"))
    joined = rows.join(shares.where("taken > 0"), same)
    times = F.floor(F.col("taken") / F.col("size")).cast("int")
    part = (F.col("taken") % F.col("size")).cast("int")
    repeats = F.concat(F.array_repeat(F.lit(0), times), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    copies = joined.withColumn("part", F.explode(repeats))
    head = F.array_join(F.slice(F.regexp_extract_all("_in_text", F.lit(f"({WORD})"), 1), 1, F.greatest(F.col("part"), F.lit(1))), " ")
    cut = F.col("part") > 0
    new = {"text": F.when(cut, head).otherwise(F.col("_in_text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.length(head).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_in_n_chars"))
    return copies.select(*given_back(docs.columns, **new))
