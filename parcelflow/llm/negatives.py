"""Hard negatives by exact window search in an inverted multi-index.

Vectors are cut into halves, and each half has a codebook.  A pair of codes is a cell.  The
inner product of an anchor with any row of a cell is at most the sum of two half bounds,
``anchor half . code + |anchor half| * radius of the code``, so a heap over the two sorted
lists of half bounds (the multi-sequence algorithm) gives the cells by falling bound.  An
anchor visits cells in that order, some at first and several times as many in each further
wave, and stops once its windows are certified: each holds enough rows above the bound of the
next cell, or lies above what that bound can reach wholly.

Rows are dealt into blocks of a cell and anchors into groups, both of bounded size; a task
scores a group against a block as one matrix product and passes on the first few rows of each
window.  Codebooks are fitted on a bounded sample; radii are those of all rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.session import work_dir

#: Codes of each half; cells are pairs of codes.
CODES = 16
#: Rows that codebooks are fitted on (those of the smallest hash of the id), and passes over them.
SAMPLE_ROWS = 8192
FIT_PASSES = 8
#: Rows of a block and anchors of a group, on average.
BLOCK_ROWS = 8192
GROUP_ANCHORS = 4096
#: Cells of the first wave; each further wave sees so many times as many.
FIRST_CELLS = 16
WAVE_GROWTH = 16
#: Components that all scores fit a long with.
MOST_NORM = 2.0**31
SCALE = 256

LOWEST, HIGHEST = -(2**63), 2**63 - 1
FOUND = "anchor_id long, window int, vec_id long, score long"


def quantised(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, label, q) that take part: q is floor(256 * x) of each component, as longs.

    Rows with a null id, label, vector or component, a component that is not finite, or a
    vector longer than ``MOST_NORM`` (whose scores would not fit a long) take no part.  Of rows
    that repeat an id the one with the smallest label and vector counts.
    """
    x = F.col("embedding").cast("array<double>")
    norm = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v * float(SCALE * SCALE))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", x.alias("x"))
    # a null or NaN component makes the norm null or NaN, and NaN is greater than any number
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (norm <= MOST_NORM**2 / 4))
    q = F.transform("x", lambda v: F.floor(v * F.lit(float(SCALE))).cast("long"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", q.alias("q"))).alias("r")).select("vec_id", "r.label", "r.q")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.asarray(column.offsets)
    flat = np.asarray(column.values)
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return flat[offsets[0] : offsets[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    for i, (at, n) in enumerate(zip(offsets[:-1], sizes, strict=True)):
        out[i, :n] = flat[at : at + n]
    return out


def _fit(points: np.ndarray) -> np.ndarray:
    """``CODES`` centres by Lloyd's passes from points far apart (at least one centre)."""
    centres = [points.mean(0)] if len(points) else [np.zeros(points.shape[1])]
    away = ((points - centres[0]) ** 2).sum(1)
    while len(centres) < CODES and len(points) and away.max() > 0:
        centres.append(points[int(away.argmax())])
        away = np.minimum(away, ((points - centres[-1]) ** 2).sum(1))
    codes = np.array(centres)
    for _ in range(FIT_PASSES if len(points) else 0):
        near = _nearest(points, codes)[0]
        for k in np.unique(near):
            codes[k] = points[near == k].mean(0)
    return codes


def _nearest(points: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest code of each point and how far it is."""
    square = (codes**2).sum(1) - 2 * points @ codes.T
    near = square.argmin(1)
    return near, np.sqrt(((points - codes[near]) ** 2).sum(1))


class _Index:
    """Codebooks of both halves, the radius of each code, and which cells have rows."""

    def __init__(self, width: int, books: list[np.ndarray]):
        self.width, self.cut, self.books = width, width // 2, books
        self.radii: list[np.ndarray] = []
        self.filled: frozenset[int] = frozenset()

    def halves(self, rows: np.ndarray) -> list[np.ndarray]:
        return [rows[:, : self.cut].astype(float), rows[:, self.cut :].astype(float)]

    def bounds(self, anchors: np.ndarray) -> list[np.ndarray]:
        """Per half and anchor, what the inner product with a row of each code is at most."""
        out = []
        for half, codes, radii in zip(self.halves(anchors), self.books, self.radii, strict=True):
            length = np.sqrt((half**2).sum(1))[:, None]
            slack = 1 + 1e-9 * length * (np.sqrt((codes**2).sum(1)) + radii)  # above rounding
            out.append(half @ codes.T + length * radii + slack)
        return out

    def cells(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, float]]:
        """Cells that have rows, by falling sum of half bounds."""
        a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
        heap, seen = [(-(left[a[0]] + right[b[0]]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = int(a[i]) * CODES + int(b[j])
            if cell in self.filled:
                yield cell, -bound
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(a) and y < len(b) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (-(left[a[x]] + right[b[y]]), x, y))


def _products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    most = math.sqrt(float((anchors.astype(float) ** 2).sum(1).max()) * float((rows.astype(float) ** 2).sum(1).max()))
    if most < 2**52:  # no partial sum leaves the whole numbers that a double holds
        return (anchors.astype(float) @ rows.T.astype(float)).astype(np.int64)
    return anchors @ rows.T


def _first(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores, ties by smaller id."""
    if len(scores) > 4 * count:
        edge = np.partition(scores, len(scores) - count)[len(scores) - count]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:count]


def _searcher(index: _Index, count: int, same_label: bool):
    """Scores the anchors of a group against the rows of a block."""

    def search(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            ids = rows.column("vec_id").to_numpy()
            labels = np.array(rows.column("label").to_pylist(), object)
            scores = _products(_matrix(anchors.column("q"), index.width), _matrix(rows.column("q"), index.width))
            names, own = anchors.column("vec_id").to_pylist(), anchors.column("label").to_pylist()
            windows = anchors.column("windows").to_pylist()
            fits = {label: (labels == label) if same_label else (labels != label) for label in set(own)}
            for i, name in enumerate(names):
                fit = fits[own[i]] & (ids != name)
                for w in windows[i]:
                    inside = np.flatnonzero(fit & (scores[i] >= w["low"]) & (scores[i] <= w["high"]))
                    found = inside[_first(scores[i][inside], ids[inside], count)]
                    out += [(name, w["window"], int(ids[k]), int(scores[i][k])) for k in found]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor_id", "window", "vec_id", "score"])

    return search


def _visits(index: _Index, begin: int, end: int):
    """Anchors with the cells at places ``begin`` to ``end`` of their order and the bound of the next one."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = index.bounds(_matrix(batch.column("q"), index.width))
            cells, after = [], []
            for i in range(batch.num_rows):
                mine, rest = [], float(LOWEST)
                for place, (cell, bound) in enumerate(index.cells(left[i], right[i])):
                    if place == end:
                        rest = bound
                        break
                    if place >= begin:
                        mine.append(cell)
                cells.append(mine)
                after.append(rest)
            made = [pa.array(cells, pa.list_(pa.int32())), pa.array(after, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "cells", "after"])

    return visit


class MultiIndex:
    """All of ``rows`` (vec_id, label, q of ``quantised``) in cells, dealt into blocks, and searches over it."""

    def __init__(self, rows: DataFrame):
        self.spark = rows.sparkSession
        self.folder = work_dir(self.spark, "multi-index")
        rows = self.stored(rows, "rows")
        width = rows.agg(F.max(F.size("q"))).first()[0] or 0
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("q").toArrow()
        self.index = index = _Index(width, [])
        index.books = [_fit(half) for half in index.halves(_matrix(sample.column("q"), width))] if sample.num_rows else []
        self.empty = not index.books
        if self.empty:
            return

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                near = [_nearest(half, codes) for half, codes in zip(index.halves(_matrix(batch.column("q"), width)), index.books, strict=True)]
                made = [pa.array(near[0][0] * CODES + near[1][0], pa.int32()), pa.array(near[0][1]), pa.array(near[1][1])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "cell", "far0", "far1"])

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        placed_rows = self.stored(rows.mapInArrow(placed, f"{kinds}, cell int, far0 double, far1 double"), "placed")
        # one row per cell, of which there are CODES * CODES
        stats = placed_rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("far0").alias("far0"), F.max("far1").alias("far1")).collect()
        index.radii = [np.zeros(len(codes)) for codes in index.books]
        for s in stats:
            for half, code in enumerate(divmod(s.cell, CODES)):
                index.radii[half][code] = max(index.radii[half][code], s[f"far{half}"])
        index.filled = frozenset(s.cell for s in stats)
        blocks = F.create_map(*[F.lit(v) for s in stats for v in (s.cell, math.ceil(s.n / BLOCK_ROWS))])
        self.blocks = blocks
        self.rows = placed_rows.select("vec_id", "label", "q", "cell", F.pmod(F.xxhash64("vec_id"), blocks[F.col("cell")]).cast("int").alias("block"))

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def first_in_windows(self, anchors: DataFrame, count: int, same_label: bool, name: str) -> DataFrame:
        """The first ``count`` rows, by falling score and rising id, of each window of each anchor.

        ``anchors`` has vec_id, label, q and windows, an array of (window, low, high): the rows
        whose score lies from low to high, ends included, whose id differs from the anchor's
        and whose label equals its or (``same_label`` false) differs.
        """
        spark, total = self.spark, len(self.index.filled)
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema)
        anchors = self.stored(anchors, f"{name}-anchors")
        groups = max(1, math.ceil(anchors.count() / GROUP_ANCHORS))
        group = F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(groups)).cast("int")
        dealt = self.rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))) if groups > 1 else self.rows.withColumn("part", F.lit(0))
        best = spark.createDataFrame([], FOUND)
        done: list[DataFrame] = []
        begin, end, wave = 0, min(FIRST_CELLS, total), 0
        while True:
            visits = self.stored(anchors.mapInArrow(_visits(self.index, begin, end), f"{kinds}, cells array<int>, after double"), f"{name}-visits-{wave}")
            each = visits.select("vec_id", "label", "q", "windows", group.alias("part"), F.explode("cells").alias("cell"))
            each = each.withColumn("block", F.explode(F.sequence(F.lit(0), self.blocks[F.col("cell")] - 1)))
            by = ["cell", "block", "part"]
            met = each.groupBy(*by).cogroup(dealt.groupBy(*by)).applyInArrow(_searcher(self.index, count, same_label), FOUND)
            order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
            best = best.unionByName(met).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
            best = self.stored(best, f"{name}-best-{wave}")
            if end >= total:
                done.append(best)
                break
            # a window is certified if it is full above the next bound, or lies above that bound wholly
            worst = best.groupBy(F.col("anchor_id").alias("vec_id"), "window").agg(F.count("*").alias("n"), F.min("score").alias("worst"))
            open_ = visits.select("vec_id", "after", F.explode("windows").alias("w")).select("vec_id", "after", "w.window", "w.low")
            open_ = open_.join(worst, ["vec_id", "window"], "left")
            full = (F.coalesce("n", F.lit(0)) >= count) & (F.col("worst") > F.col("after"))
            open_ = open_.where(~(F.coalesce(full, F.lit(False)) | (F.col("low") > F.col("after")))).select("vec_id").distinct()
            open_ = self.stored(open_, f"{name}-open-{wave}")
            done.append(best.join(open_.withColumnRenamed("vec_id", "anchor_id"), "anchor_id", "left_anti"))
            best = best.join(open_.withColumnRenamed("vec_id", "anchor_id"), "anchor_id", "left_semi").drop("rank")
            anchors = self.stored(anchors.join(open_, "vec_id", "left_semi"), f"{name}-anchors-{wave}")
            if anchors.isEmpty():
                break
            begin, end, wave = end, min(end * WAVE_GROWTH, total), wave + 1
        return reduce(lambda a, b: a.unionByName(b), done)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has vec_id, embedding, label; other columns are not read.  ``quantised`` says
    which rows take part and as what; a shorter vector counts as filled up with zeros.  An
    anchor is a row that ``is_anchor`` (of vec_id) holds for.  Its positives are its first
    ``positives`` other rows of the same label, its negatives for a positive the first
    ``negatives`` rows of other labels whose score is from ``low`` to ``high`` hundredths of the
    positive's, all by falling inner product, ties by smaller id.  A positive of negative
    score has no negatives: the window is empty.  No rows, or no anchors: no result.
    """
    spark = vectors.sparkSession
    index = MultiIndex(quantised(vectors))
    if index.empty:
        return spark.createDataFrame([], RESULT)
    anchors = index.stored(index.rows.where(is_anchor).select("vec_id", "label", "q"), "anchors")

    def window(number: Column, least: Column, most: Column) -> Column:
        return F.struct(number.cast("int").alias("window"), least.cast("long").alias("low"), most.cast("long").alias("high"))

    everything = F.array(window(F.lit(0), F.lit(LOWEST), F.lit(HIGHEST)))
    found = index.first_in_windows(anchors.withColumn("windows", everything), positives, True, "positives")
    found = index.stored(found.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("window")), "positives")
    # scores are below 2**60, so these products stay within decimals
    least = F.ceil(F.col("positive_score").cast("decimal(24,0)") * low / 100)
    most = F.floor(F.col("positive_score").cast("decimal(24,0)") * high / 100)
    bounds = found.withColumn("w", window(F.col("window"), least, most)).where("w.low <= w.high")
    bounds = bounds.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list("w")).alias("windows"))
    near = index.first_in_windows(anchors.join(bounds, "vec_id"), negatives, False, "negatives")
    near = near.select("anchor_id", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(near, ["anchor_id", "window"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
