"""Near-duplicate documents by an LSH forest over MinHash signatures.

A signature of 63 minima is read in 21 rotated orders, each of which sorts the documents
into a prefix tree.  Documents with a common prefix of three minima form a region.  The
depth adapts: a region of more than a few documents is descended along further minima,
only where it is dense, until its parts are small; documents of a small part are
neighbours by their longest common prefix and become candidates.  In every dense region
on the way each document also meets two centres, the one found in most dense regions and
the one with the least id, which ties the many copies of one text together without
pairing them.  What the centres leave apart in a dense region is compared by an exact join
on the rarest shingles of each set.  Links are confirmed on the full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.arrays import gram_rows, grams, mix, row_of, slices, words
from parcelflow.llm.filters import maybe_seen, seen_keys
from parcelflow.llm.graph import components
from parcelflow.session import work_dir

SHINGLE = 5
SIMILAR_PERCENT = 75
TREES = 21
LEAST_DEPTH = 3
SIZE = TREES * LEAST_DEPTH
#: Depths at which dense regions are looked at anew.
DEPTHS = (3, 6, 12, 30, SIZE)
#: Documents of a region that are all neighbours of each other.
NEIGHBOURS = 10
#: Sets with a shingle that one row of the exact join meets; more are dealt over several groups.
SALT_SETS = 512

_RANDOM = np.random.default_rng(75)
_TIMES = _RANDOM.integers(1, 2**63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RANDOM.integers(1, 2**63, SIZE, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 2**63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle values, sorted within each row, and where each row's begin."""
    found = words(texts, lower=True)
    hashes, rows = found.hashes(), found.rows
    at, bounds = gram_rows(rows, SHINGLE)
    values = grams(hashes, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64)
    owner = row_of(bounds)
    few = np.flatnonzero((np.diff(rows) > 0) & (np.diff(rows) < SHINGLE))
    if len(few):  # the whole sequence is the one shingle
        short = [int(grams(hashes[rows[r] : rows[r + 1]], int(rows[r + 1] - rows[r]))[0]) ^ int(rows[r + 1] - rows[r]) for r in few]
        values = np.concatenate([values, np.array(short, np.uint64)])
        owner = np.concatenate([owner, few])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(rows)))


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minima of the sets that are not empty, one row each."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(full), SIZE), np.uint32)
    starts = bounds[full]
    for k in range(SIZE if len(full) else 0):
        out[:, k] = np.minimum.reduceat((((values ^ _FLIP[k]) * _TIMES[k]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            values, bounds = shingle_sets(part.column("text"))
            count = np.diff(bounds)
            signed = iter(signatures(values, bounds))
            sets, minima = [], []
            for row in range(part.num_rows):
                full = count[row] > 0
                sets.append(_set_name(values[bounds[row] : bounds[row + 1]]) if full else None)
                minima.append(next(signed).tobytes() if full else None)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_shingles": count, "same": pa.array(sets, pa.binary()), "minima": pa.array(minima, pa.binary())})


def _regions(depths: tuple[int, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc_id, pop, tree, region, above) for the trees that each row takes part in, at each depth.

    ``above`` is the region at the depth before, null at the first one.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                minima = np.frombuffer(b"".join(part.column("minima").to_pylist()), np.uint32).reshape(part.num_rows, SIZE).astype(np.uint64)
                doc, pop = part.column("doc_id").to_numpy(), part.column("pop").to_numpy()
                trees = part.column("trees").to_pylist()
                active = np.zeros((part.num_rows, TREES), bool)
                for row, own in enumerate(trees):
                    active[row, own if own is not None else slice(None)] = True
                for tree in range(TREES):
                    rows = np.flatnonzero(active[:, tree])
                    if not len(rows):
                        continue
                    above = pa.nulls(len(rows), pa.int64())
                    for depth in depths:
                        order = (tree * LEAST_DEPTH + np.arange(depth)) % SIZE
                        key = mix((minima[np.ix_(rows, order)] * _PLACE[:depth]).sum(1, dtype=np.uint64) + np.uint64(tree * 7919 + depth * 104729 + 1))
                        region = pa.array(key.view(np.int64))
                        yield pa.RecordBatch.from_pydict(
                            {"doc_id": doc[rows], "pop": pop[rows], "tree": np.full(len(rows), tree, np.int32), "region": region, "above": above}
                        )
                        above = region

    return make


def _of_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, same) whose text has the set named ``same``."""
    for batch in batches:
        for part in slices(batch):
            values, bounds = shingle_sets(part.column("text"))
            good = [_set_name(values[bounds[row] : bounds[row + 1]]) == same for row, same in enumerate(part.column("same").to_pylist())]
            yield part.select(["doc_id", "text"]).filter(pa.array(good, pa.bool_()))


def _set_name(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            values, bounds = shingle_sets(part.column("text"))
            shingles = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(values.view(np.int64))).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "component": part.column("component"), "shingles": shingles})


def _confirm(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a"):
                left, lefts = shingle_sets(part.column("text_a"))
                right, rights = shingle_sets(part.column("text_b"))
                good = np.zeros(part.num_rows, bool)
                for row in range(part.num_rows):
                    a, b = left[lefts[row] : lefts[row + 1]], right[rights[row] : rights[row + 1]]
                    small, large = min(len(a), len(b)), max(len(a), len(b))
                    if small == 0 or 100 * small < percent * large:
                        continue
                    both = np.intersect1d(a, b, assume_unique=True).size
                    good[row] = 100 * both >= percent * (len(a) + len(b) - both)
                yield pa.RecordBatch.from_arrays([part.column("a").filter(pa.array(good)), part.column("b").filter(pa.array(good))], ["a", "b"])

    return make


class _Forest:
    """The steps of one run, each written below one folder."""

    def __init__(self, docs: DataFrame, percent: int, neighbours: int):
        self.spark, self.percent, self.neighbours = docs.sparkSession, percent, neighbours
        self.folder = work_dir(self.spark, "forest")
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def candidates(self, first: DataFrame) -> DataFrame:
        """Pairs of documents with their centres, and pairs of neighbours; ``first`` has one row per set.

        Dense regions are looked at anew at all depths in one pass.  A region within one that is
        not dense tells nothing more and is left out.
        """
        start = first.select("doc_id", "minima", F.lit(0).cast("long").alias("pop"), F.lit(None).cast("array<int>").alias("trees"))
        members = self.first_members = self._members(start, DEPTHS[:1], "first")
        pairs = [self._near(members), self._pairs(members.where(F.col("n") <= self.neighbours), "least")]
        trees = members.where(F.col("n") > self.neighbours).groupBy("doc_id").agg(F.sum("n").alias("pop"), F.collect_set("tree").alias("trees"))
        state = self.stored(first.select("doc_id", "minima").join(trees, "doc_id").select("doc_id", "minima", "pop", "trees"), "dense")
        if not state.isEmpty():
            members = self._members(state, DEPTHS, "dense")
            pairs += [self._near(members), self._pairs(members, "least"), self._pairs(members, "centre")]
        return self._union(pairs)

    def _members(self, state: DataFrame, depths: tuple[int, ...], name: str) -> DataFrame:
        rows = state.mapInArrow(_regions(depths), "doc_id long, pop long, tree int, region long, above long")
        regions = rows.groupBy("region").agg(
            F.count("*").alias("n"), F.min("doc_id").alias("least"), F.max(F.struct("pop", -F.col("doc_id"))).alias("top"), F.min("above").alias("above")
        )
        regions = regions.where("n > 1").select("region", "n", "least", (-F.col("top.col2")).alias("centre"), "above")
        regions = self.stored(regions, f"{name}-regions")
        if len(depths) > 1:
            dense = regions.where(F.col("n") > self.neighbours).select(F.col("region").alias("above"))
            regions = regions.where("above IS NULL").unionByName(regions.join(dense, "above", "left_semi"))
        return self.stored(rows.drop("above").join(regions.drop("above"), "region"), f"{name}-members")

    def _near(self, members: DataFrame) -> DataFrame:
        small = members.where(F.col("n") <= self.neighbours).groupBy("region").agg(F.array_sort(F.collect_set("doc_id")).alias("ids"))
        pairs = F.expr("flatten(transform(ids, (x, i) -> transform(slice(ids, i + 2, size(ids)), y -> struct(x AS a, y AS b))))")
        return small.select(F.explode(pairs).alias("p")).select("p.a", "p.b")

    def _pairs(self, members: DataFrame, centre: str) -> DataFrame:
        ends = members.where(F.col("doc_id") != F.col(centre))
        return ends.select(F.least("doc_id", centre).alias("a"), F.greatest("doc_id", centre).alias("b")).distinct()

    @staticmethod
    def _union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out.distinct()

    def confirmed(self, pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
        """The pairs whose whole sets are similar enough."""
        # neither side is sent whole, at any size
        left = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
        both = left.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
        return self.stored(both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(self.percent), "a long, b long"), name)

    def apart(self, groups: DataFrame) -> DataFrame:
        """Documents of dense regions that hold more than one component, with their component."""
        dense = self.first_members.where(F.col("n") > self.neighbours).select("doc_id", "region")
        found = dense.join(groups.toDF("doc_id", "component"), "doc_id", "left")
        found = self.stored(found.select("doc_id", "region", F.coalesce("component", "doc_id").alias("component")), "dense-groups")
        mixed = found.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        return self.stored(found.join(mixed, "region", "left_semi").select("doc_id", "component").distinct(), "apart")

    def rest(self, apart: DataFrame, texts: DataFrame) -> DataFrame:
        """All pairs of two components among ``apart`` that may be similar enough, by prefix filters.

        Sets are sorted by how many hold a shingle, the rarest first.  Similar sets share one of
        the first shingles of both: of the larger set by the share that it must have in common,
        of the smaller one by what two sets of its size must.  Where they share the first one,
        what follows in each must be enough.
        """
        percent = self.percent
        sets = texts.join(apart, "doc_id").select("doc_id", "component", "text")
        sets = self.stored(sets.mapInArrow(_sets, "doc_id long, component long, shingles array<long>").withColumn("n", F.size("shingles").cast("long")), "sets-apart")
        rows = sets.select("doc_id", "component", "n", F.explode("shingles").alias("shingle"))
        common = rows.groupBy("shingle").agg(F.count("*").alias("f"), F.min("component").alias("low"), F.max("component").alias("high"))
        common = self.stored(common.where("low < high").select("shingle", "f"), "common")  # no other shingle is in two components
        ranked = rows.join(common.hint("merge"), "shingle").groupBy("doc_id", "component", "n").agg(F.array_sort(F.collect_list(F.struct("f", "shingle"))).alias("own"))
        # shingles that are not common come first in the order and take up places of the prefix
        alone = F.col("n") - F.size("own")
        prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - alone
        ranked = ranked.withColumn("alone", alone).withColumn("prefix", prefix.cast("int")).where("prefix > 0")
        ranked = ranked.select("doc_id", "component", "n", "alone", F.posexplode(F.slice("own", F.lit(1), F.col("prefix"))).alias("at", "s"))
        salts = F.ceil(F.col("f") / SALT_SETS).cast("long")
        ranked = self.stored(
            ranked.select("doc_id", "component", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("left"), F.col("s.shingle").alias("shingle"), F.col("s.f").alias("f")),
            "prefixes",
        ).withColumn("salts", salts)
        large = ranked.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).alias("x")
        # left: the shingles from this one on, which hold all that two sets share if this is the first they share
        small = ranked.where(F.col("left") * (100 + percent) >= 2 * percent * F.col("n")).withColumn("salt", F.pmod(F.xxhash64("doc_id"), "salts")).alias("y")
        pairs = large.join(
            small.hint("merge"),
            F.expr(
                f"x.shingle = y.shingle AND x.salt = y.salt AND x.component <> y.component AND 100 * y.n >= {percent} * x.n"
                " AND (x.n > y.n OR x.n = y.n AND x.doc_id > y.doc_id)"
                f" AND {100 + percent} * least(x.left, y.left) >= {percent} * (x.n + y.n)"
            ),
        )
        return pairs.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()

    def run(self) -> DataFrame:
        signed = self.docs.mapInArrow(_sign, "doc_id long, n_shingles long, same binary, minima binary")
        signed = self.stored(signed, "signed")
        usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        sets = self.stored(usable.groupBy("same").agg(F.min("doc_id").alias("lead")), "sets")
        first = self.stored(
            usable.select("doc_id", "minima", "same").join(sets.select("same", F.col("lead").alias("doc_id")), ["same", "doc_id"], "left_semi").groupBy("doc_id").agg(F.min(F.struct("same", "minima")).alias("s")).select("doc_id", "s.same", "s.minima"),
            "first",
        )
        pairs = self.stored(self.candidates(first), "pairs")
        ids = self.stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
        seen = self.stored(seen_keys(ids, "doc_id"), "seen")
        # of a repeated id the text whose set stands for it
        ids = ids.join(first.select("doc_id", "same"), "doc_id")
        texts = maybe_seen(self.docs, "doc_id", seen).join(ids.hint("merge"), "doc_id")
        texts = self.stored(texts.mapInArrow(_of_set, "doc_id long, text string").dropDuplicates(["doc_id"]), "texts")
        groups = self.stored(components(self.confirmed(pairs, texts, "links")), "groups")
        # what the forest has not compared where it is dense
        apart = self.apart(groups)
        if not apart.isEmpty():
            rest = self.confirmed(self.stored(self.rest(apart, texts), "rest-pairs"), texts, "rest")
            if not rest.isEmpty():
                groups = self.stored(components(groups.toDF("a", "b").unionByName(rest)), "groups-whole")
        leads = sets.join(groups.select(F.col("node").alias("lead"), "component"), "lead", "left")
        leads = self.stored(leads.select("same", F.coalesce("component", "lead").alias("component")), "leads")
        out = signed.select("doc_id", "n_shingles", "same").join(leads, "same", "left")
        component = F.coalesce("component", "doc_id")
        return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, percent: int = SIMILAR_PERCENT, neighbours: int = NEIGHBOURS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are lower-cased (A-Z) runs of non-space; a set holds the distinct five-word
    shingles, or the whole sequence of a shorter text.  Null, empty and blank texts have
    an empty set and are their own components.  Documents with equal sets are one class,
    named by its least id, and only classes are compared; links need at least ``percent``
    similarity of whole sets.  The forest compares no pair without a common region: two
    documents at the threshold have none with probability (1 - 0.75^3)^21, about one in
    100,000.  Pairs with one are compared, or tied together already.  Rows with a null id are counted and kept, and
    linked with nothing beyond their equals.  Rows that repeat an id with different texts
    are one document to the links, with the text whose set has the least digest.  Other columns are not read.
    """
    return _Forest(docs, percent, neighbours).run()


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the least id; columns as in ``docs``.

    Documents with a null id stay.
    """
    gone = near_duplicates(docs).where("doc_id IS NOT NULL AND NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
