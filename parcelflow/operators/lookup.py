"""Left lookups against current dimension tables.

No lookup carries a broadcast hint.  The optimizer (and at run time the adaptive
planner) checks the dimension's size against ``spark.sql.autoBroadcastJoinThreshold``
and otherwise shuffles, splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.latest import first_by


def lookup(df: DataFrame, dim: DataFrame, on: str, take: dict[str, str], key: str = "id", unique: bool = True) -> DataFrame:
    """Fill ``take`` (new column -> dimension column) from the row whose ``key`` equals ``on``.

    A row without a match passes with nulls.  ``unique=False`` looks up by an attribute
    several dimension rows may share and takes the one with the smallest id.
    """
    needed = list(dict.fromkeys([key, *take.values()]))
    if unique:
        source = dim.select(*needed)
    else:
        source = first_by(dim.select(*dict.fromkeys([*needed, "id"])), key)
    right = source.select(F.col(key).alias("_key"), *[F.col(c).alias(new) for new, c in take.items()])
    kept = [c for c in df.columns if c not in take]
    return df.select(*kept).join(right, F.col(on) == F.col("_key"), "left").drop("_key")


def org_city(organs: DataFrame) -> DataFrame:
    """Organisation -> name, the organisation that decides its city, and that city.

    That is the parent, or the organisation itself when it has none.
    """
    own = organs.select("id", "org_name", F.coalesce("org_parent_id", "id").alias("join_org_id"))
    return lookup(own, organs, "join_org_id", {"city_id": "region_id"})


def region_chain(regions: DataFrame) -> DataFrame:
    """Region -> name, parent and the parent's name."""
    own = regions.select("id", F.col("name").alias("city_name"), F.col("parent_id").alias("province_id"))
    return lookup(own, regions, "province_id", {"province_name": "name"})
