"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: All instants are kept in UTC; business days are shifted by an explicit offset.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: transformWithStateInPandas only runs on this state store.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "parcelflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **STATE_STORE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the expressions rely on to a session made elsewhere."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def conf_scope(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set SQL configuration for the duration of a block."""
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for checkpoints and written tables.

    It lies below the shared folder named by ``spark.checkpoint.dir``.  Only a
    local session may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/{name}-{os.urandom(6).hex()}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"parcelflow-{name}-")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage where several branches need the same rows; the copy survives the
    loss of executors and keeps column pruning.
    """
    path = f"{work_dir(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
