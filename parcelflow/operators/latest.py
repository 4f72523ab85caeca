"""Current state of keys from their changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The newest row of each key.

    An aggregate rather than a ranking window: every task first reduces its own rows
    to one per key, so a hot key ships one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def current_state(changes: DataFrame, keys: list[str], order: list[str | Column], apply_deletes: bool = False) -> DataFrame:
    """Latest image per key.  With ``apply_deletes`` a key whose last change is a delete is gone."""
    state = latest_by(changes, keys, order)
    return state.where(F.col("op") != "d") if apply_deletes else state


def first_by(df: DataFrame, attribute: str, id_column: str = "id") -> DataFrame:
    """One row per attribute value: the one with the smallest id, compared as text.

    Rows without the attribute never match and are left out.
    """
    rest = [c for c in df.columns if c != attribute]
    first = F.min_by(F.struct(*rest), F.col(id_column).cast("string"))
    return (
        df.where(F.col(attribute).isNotNull())
        .groupBy(attribute)
        .agg(first.alias("_row"))
        .select(attribute, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )
