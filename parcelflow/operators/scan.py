"""Running values along ordered histories, with no history in one task.

Rows are dealt into ranges of (key, order) of about equal size, so a key of any length
lies in as many ranges as it needs.  Windows run inside a range; what a range inherits
from the earlier ranges of its key comes from one total per range and key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.session import written

RANGE = "_range"


@dataclass(frozen=True)
class Scan:
    """An aggregate that can be taken over totals of itself, and joins two of them by ``put``."""

    total: Callable[[Column], Column]
    put: Callable[[Column, Column], Column]


SUM = Scan(F.sum, lambda a, b: a + b)
XOR = Scan(F.bit_xor, lambda a, b: a.bitwiseXOR(b))


def in_ranges(rows: DataFrame, key: str, order: list[str], ranges: int | None = None) -> DataFrame:
    """``rows`` with the number of their range, written out.

    Ranges follow (key, order); rows equal in both lie in one range, so ``order`` should tell
    the rows of a key apart.
    """
    count = ranges or max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return written(rows.repartitionByRange(count, key, *order).withColumn(RANGE, F.spark_partition_id()), "ranges")


def running(ranged: DataFrame, key: str, order: list[str], **values: tuple[Scan, Column]) -> DataFrame:
    """Add running values, own row included, along each key's history; nulls count for nothing.

    ``ranged`` comes from :func:`in_ranges` (columns may have been added).  A null key is a
    key like any other.  A running value is null until a value came.
    """
    local = Window.partitionBy(RANGE, key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(key).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(RANGE, key).agg(*[scan.total(value).alias(name) for name, (scan, value) in values.items()])
    inherited = totals.select(
        F.col(RANGE).alias("_r"), F.col(key).alias("_k"), F.count(F.lit(1)).over(earlier).alias("_n"),
        *[scan.total(F.col(name)).over(earlier).alias(f"_before_{name}") for name, (scan, _) in values.items()],
    )
    # a range begins with at most one key that other ranges began: no more rows than ranges
    inherited = F.broadcast(inherited.where("_n > 0").drop("_n"))
    within = ranged.select("*", *[scan.total(value).over(local).alias(name) for name, (scan, value) in values.items()])
    joined = within.join(inherited, (F.col(RANGE) == F.col("_r")) & F.col(key).eqNullSafe(F.col("_k")), "left").drop("_r", "_k")
    for name, (scan, _) in values.items():
        before = F.col(f"_before_{name}")
        joined = joined.withColumn(name, F.coalesce(scan.put(before, F.col(name)), before, F.col(name))).drop(f"_before_{name}")
    return joined
