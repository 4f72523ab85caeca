"""Keep the columns of a caller apart from those that an operator adds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = "_in_"


def set_aside(rows: DataFrame) -> DataFrame:
    """All columns under a prefix that operators use for nothing else."""
    return rows.toDF(*[PREFIX + c for c in rows.columns])


def given_back(columns: list[str], **new: Column) -> list[Column]:
    """The columns by their own names again, some of them with new values."""
    return [new.get(c, F.col(f"`{PREFIX}{c}`")).alias(c) for c in columns]
