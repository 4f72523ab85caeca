"""Which mart rows a dimension change touches, and those rows again with current names.

A mart row names its organisation, city, province, cargo type or truck model by id, so the
changed keys of a dimension feed find the rows to make again by a semi-join; totals are not
computed anew.  A change that moves facts from one key to another (an organisation that gets
another district) needs the facts and is a batch run of the mart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import times
from parcelflow.plans.marts import Dimensions, Mart
from parcelflow.sources.schemas import MARTS, conform

#: Mart columns that are ids of a dimension row, and that dimension.
REFERENCES = {
    "org_id": "base_organ",
    "city_id": "base_region_info",
    "province_id": "base_region_info",
    "cargo_type": "base_dic",
    "truck_model_id": "truck_model",
}


def changed_ids(changed: DataFrame, dims: Dimensions, prefix: str = "dim_") -> DataFrame:
    """Changed keys of dimension rows -> (dimension, id), one row each.

    ``changed`` is what :func:`parcelflow.plans.dimensions.changed_keys` gives; sink tables are
    called ``prefix`` and the source's name.  An organisation takes its city from its parent,
    so the children of a changed one count as changed.
    """
    own = changed.where(F.col("key_name") == "id").select(F.expr(f"substring(sink_table, {len(prefix) + 1})").alias("dimension"), F.col("key_value").alias("id"))
    own = own.where(F.col("id").isNotNull()).distinct()
    organs = own.where(F.col("dimension") == "base_organ").select(F.col("id").alias("org_parent_id"))
    children = dims["base_organ"].join(organs, "org_parent_id").select(F.lit("base_organ").alias("dimension"), "id")
    return own.unionByName(children).distinct()


def touched_rows(rows: DataFrame, mart: Mart, ids: DataFrame) -> DataFrame:
    """The rows of a mart that name a changed dimension row."""
    named = [c for c in REFERENCES if c in rows.columns]
    if not named:
        return rows.limit(0)
    by = ["cur_date", *mart.keys]
    references = F.array(*[F.struct(F.lit(REFERENCES[c]).alias("dimension"), F.col(c).alias("id")) for c in named])
    found = rows.select(*by, F.explode(references).alias("r")).select(*by, "r.*").join(ids, ["dimension", "id"], "left_semi")
    found = found.select(*[F.col(c).alias(f"_{c}") for c in by]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    return rows.join(found, same, "left_semi")


def renamed(current: DataFrame, mart: Mart, dims: Dimensions, ids: DataFrame, version: Column | None = None) -> DataFrame:
    """New versions of the newest mart rows (``current``) that ``ids`` touch, and of no others."""
    rows = touched_rows(current, mart, ids).withColumn("ts", times.now_ms() if version is None else version)
    return conform(mart.after(rows, dims), MARTS[mart.table])
