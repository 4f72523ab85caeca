"""Tables that streaming jobs hand on: batches published once, and current rows in buckets.

A micro-batch may be tried again after a failure.  What a first try made visible may have been
read by another job already, so a second try must not add to it or change it:

* :func:`publish_batch` writes beside the table and moves the whole batch into place in one
  rename; a batch that is already there stays as it is.  A job behind may take up the files of a
  batch a few at a time, so with ``in_time`` they follow one another in event time.
* :class:`BucketStore` keeps one current row per key.  A version lists the folder of every
  bucket; a batch writes the buckets that it touches anew and then names the new version, which
  readers see at once.  The version remembers the batch, so a second try changes nothing.

Renames of a folder have to be atomic, as on HDFS and local disks.
"""

from __future__ import annotations

import json
import os
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.operators.latest import latest_by
from parcelflow.session import written

STAGING = "_staging"
BATCH = "batch_id"


class Files:
    """The few file operations that publishing needs, in whatever file system a path names."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(folder)))

    def move(self, source: str, target: str) -> bool:
        """Rename ``source``; False if ``target`` is there already."""
        if self.exists(target):
            return False
        parent = self.path(target).getParent()
        if not self._fs.exists(parent):
            self._fs.mkdirs(parent)
        return bool(self._fs.rename(self.path(source), self.path(target)))

    def put_in_turn(self, folder: str) -> None:
        """Give the data files below ``folder`` times of modification in the order of their names, a millisecond apart.

        Returns when the clock has passed the last of them, so files of a later call come after.
        """
        listed, found = self._fs.listFiles(self.path(folder), True), []
        while listed.hasNext():
            found.append(listed.next().getPath())
        found = sorted((p for p in found if p.getName().startswith("part-")), key=lambda p: p.getName())
        start = int(time.time() * 1000)
        for i, path in enumerate(found):
            self._fs.setTimes(path, start + i, -1)
        time.sleep(max(0, start + len(found) + 1 - time.time() * 1000) / 1000)

    def drop(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str) -> None:
        stream = self._fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()


def publish_batch(rows: DataFrame, batch_id: int, path: str, *columns: str, as_laid: bool = False, in_time: str | None = None) -> bool:
    """Make a batch visible below ``path`` as ``batch_id=.../<columns>``, all of it at once.

    Returns False, and leaves the table alone, if the batch has been published before.  The
    rebalance gives each folder few files of moderate size: small ones are merged, and a folder
    with most of the rows is split over several tasks.  ``as_laid`` leaves the rows where
    and in which order they are; they have to be sorted by ``columns`` first.

    ``in_time`` names the event time of rows that a stream with a watermark reads.  Spark's file
    source takes files up in order of modification and may cut a batch between any two.  Were
    each file a mix of the batch, the first ones would move the watermark past rows of the rest.
    So the files are ranges of event time, modified in that order: wherever the batch is cut, no
    row is later than it was in the batch as a whole.
    """
    files = Files(rows.sparkSession, path)
    target, staged = f"{path}/{BATCH}={batch_id}", f"{path}/{STAGING}/{batch_id}-{os.urandom(6).hex()}"
    if files.exists(target):
        return False
    kept = rows.drop(BATCH)
    if in_time is not None:
        # dealing into ranges reads the rows twice; the hash spreads a burst of one instant
        by = [*columns, in_time]
        kept = written(kept, "batch").repartitionByRange(*by, F.xxhash64(*kept.columns)).sortWithinPartitions(*by)
    elif not as_laid:
        kept = kept.hint("rebalance", *[F.col(c) for c in columns])
    kept.write.partitionBy(*columns).parquet(staged)
    if in_time is not None:
        files.put_in_turn(staged)
    if files.move(staged, target):
        return True
    files.drop(staged)
    return False


@dataclass(frozen=True)
class Version:
    """``folders`` maps a table and bucket, as ``table/bucket``, to the version that wrote it."""

    number: int
    batch_id: int
    buckets: int
    folders: dict[str, int]


class BucketStore:
    """One current row per key, for several tables, all of one layout.

    ``schema`` is the layout of rows: ``table``, ``key``, the columns of ``order`` by which the
    newest row of a key is known, and others.  A version lists as many folders as there are
    tables times buckets, which bounds what the driver holds.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, table: str, key: str, order: list[str], buckets: int = 32):
        self.spark, self.root, self.schema = spark, path.rstrip("/"), schema
        self.table, self.key, self.order, self.buckets = table, key, order, buckets
        self.files = Files(spark, path)

    def version(self) -> Version:
        """The newest version; number -1 before the first."""
        names = [n for n in self.files.names(f"{self.root}/versions") if n.endswith(".json")]
        if not names:
            return Version(-1, -1, self.buckets, {})
        return Version(**json.loads(self.files.read_text(f"{self.root}/versions/{names[-1]}")))

    def _commit(self, version: Version) -> None:
        staged = f"{self.root}/{STAGING}/{os.urandom(6).hex()}.json"
        self.files.write_text(staged, json.dumps(version.__dict__))
        if not self.files.move(staged, f"{self.root}/versions/{version.number:012d}.json"):
            self.files.drop(staged)
            raise RuntimeError(f"version {version.number} of {self.root} was written by another job")

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(buckets)).cast("int")

    def _folder(self, version: int, place: str) -> str:
        table, bucket = place.rsplit("/", 1)
        return f"{self.root}/data/v{version:012d}/_t={table}/_b={bucket}"

    def _read(self, version: Version, places: list[str]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._folder(version.folders[p], p) for p in places])

    def folders(self, table: str, version: Version | None = None) -> list[str]:
        """Where the current rows of a table are stored."""
        version = version or self.version()
        return [self._folder(v, p) for p, v in sorted(version.folders.items()) if p.rsplit("/", 1)[0] == _escaped(table)]

    def rows(self, table: str | None = None, version: Version | None = None) -> DataFrame:
        """Current rows, deletes included, of one table or of all; reads just their folders."""
        version = version or self.version()
        return self._read(version, [p for p in version.folders if table is None or p.rsplit("/", 1)[0] == _escaped(table)])

    def touched(self, rows: DataFrame, version: Version) -> list[str]:
        """Which ``table/bucket`` places the keys of ``rows`` lie in."""
        found = rows.select(F.col(self.table).alias("t"), self._bucket(version.buckets).alias("b")).distinct().collect()
        return sorted(f"{_escaped(r.t)}/{r.b}" for r in found)

    def held_for(self, rows: DataFrame, version: Version) -> DataFrame:
        """Current rows of the buckets that the keys of ``rows`` lie in."""
        return self._read(version, [p for p in self.touched(rows, version) if p in version.folders])

    def upsert(self, rows: DataFrame, batch_id: int) -> bool:
        """Merge a batch: of each key the newest row stays, however old what the batch brings.

        Returns False, and does nothing, if the batch has been merged before.
        """
        version = self.version()
        if batch_id <= version.batch_id:
            return False
        news = latest_by(rows.select(*self._names()), [self.table, self.key], self.order)
        places = self.touched(news, version)
        old = self._read(version, [p for p in places if p in version.folders])
        merged = latest_by(old.unionByName(news), [self.table, self.key], self.order)
        self._replace(merged, places, version, batch_id, version.buckets)
        return True

    def replace(self, rows: DataFrame, places: list[str], batch_id: int) -> bool:
        """Put ``rows`` in place of all that ``places`` held."""
        version = self.version()
        if batch_id <= version.batch_id:
            return False
        self._replace(rows.select(*self._names()), places, version, batch_id, version.buckets)
        return True

    def rebucket(self, buckets: int) -> None:
        """Deal all rows into another number of buckets; the pointer moves once they are written."""
        version = self.version()
        rows = self.rows(version=version)
        tables = [r[0] for r in rows.select(self.table).distinct().collect()]
        places = [f"{_escaped(t)}/{b}" for t in tables for b in range(buckets)]
        self._replace(rows, places, Version(version.number, version.batch_id, buckets, {}), version.batch_id, buckets)

    def _names(self) -> list[str]:
        return self.spark.createDataFrame([], self.schema).columns

    def _replace(self, rows: DataFrame, places: list[str], version: Version, batch_id: int, buckets: int) -> None:
        number = version.number + 1
        target = f"{self.root}/data/v{number:012d}"
        dealt = rows.withColumn("_t", F.col(self.table)).withColumn("_b", self._bucket(buckets)).hint("rebalance", "_t", "_b")
        # a try that was broken off may have left files of this number, which no version names
        dealt.write.mode("overwrite").partitionBy("_t", "_b").parquet(target)
        left = {f"{t[3:]}/{b[3:]}" for t in self.files.names(target) if t.startswith("_t=") for b in self.files.names(f"{target}/{t}") if b.startswith("_b=")}
        folders = {p: v for p, v in version.folders.items() if p not in set(places)} | {p: number for p in left}
        self._commit(Version(number, batch_id, buckets, folders))

    def vacuum(self, keep: int = 2) -> int:
        """Remove old versions but the last ``keep`` and the folders that only they name; returns how many folders went."""
        names = [n for n in self.files.names(f"{self.root}/versions") if n.endswith(".json")]
        if not names:
            return 0
        kept = [Version(**json.loads(self.files.read_text(f"{self.root}/versions/{n}"))) for n in names[-keep:]]
        used = {self._folder(v, p) for version in kept for p, v in version.folders.items()}
        newest, gone = kept[-1].number, 0
        for name in names[:-keep]:
            self.files.drop(f"{self.root}/versions/{name}")
        for v in self.files.names(f"{self.root}/data"):
            if int(v[1:]) > newest:
                continue  # a version in the making
            base = f"{self.root}/data/{v}"
            for t in (n for n in self.files.names(base) if n.startswith("_t=")):
                for b in self.files.names(f"{base}/{t}"):
                    if f"{base}/{t}/{b}" not in used:
                        self.files.drop(f"{base}/{t}/{b}")
                        gone += 1
        return gone


def _escaped(table: str) -> str:
    """A table's name as Spark writes it in folder names."""
    special = set("\"#%'*/:=?\\\x7f{[]^") | {chr(c) for c in range(1, 0x20)}
    return "".join(f"%{ord(c):02X}" if c in special else c for c in table) if table else "__HIVE_DEFAULT_PARTITION__"
