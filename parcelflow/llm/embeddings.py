"""Near-duplicate embeddings by dual traversal of nested covers.

Vectors become points of the unit sphere, where a cosine threshold is a distance.  The
upper levels of the tree are tables: a cell that is too large is covered by centres drawn
from it, each point joins its nearest centre, and a cell's radius is the distance of its
farthest point.  Pairs of cells are followed level by level and dropped once their centres
are farther apart than both radii and the threshold allow.  The pairs of leaf cells that
remain are tasks: inside one, both cells get a cover tree of halving radii and the two
are traversed together, with the same bound, down to blocks that are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.arrays import mix
from parcelflow.llm.graph import components
from parcelflow.session import conf_scope, work_dir

COSINE = 0.93
#: Points of a leaf cell at most, and centres that cover a larger one.
CELL_POINTS = 1024
CENTRES = 16
#: Levels after which a cell that is still too large (points without spread) is cut evenly.
LEVELS = 12
#: Points of a tree node that are compared as a block.
BLOCK = 48
#: Slack of the bounds for rounding.
SLACK = 1e-6
#: Rows hold up to a cell of points each, so few of them go to Python at a time.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "32"}
PIECE = "ids binary, weights binary, data binary"


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


@dataclass
class Node:
    points: np.ndarray
    centre: np.ndarray
    radius: float
    children: list[Node]


def cover_tree(points: np.ndarray, rows: np.ndarray, scale: float = 1.0) -> Node:
    """A node over ``rows``; children lie within ``scale`` of their centres, theirs within half of it."""
    centre = points[rows[0]]
    radius = float(np.sqrt(((points[rows] - centre) ** 2).sum(1).max()))
    node = Node(rows, centre, radius, [])
    if len(rows) <= BLOCK or radius == 0:
        return node
    while scale >= radius:
        scale /= 2
    left = rows
    while len(left):
        near = ((points[left] - points[left[0]]) ** 2).sum(1) <= scale * scale
        near[0] = True
        node.children.append(cover_tree(points, left[near], scale / 2))
        left = left[~near]
        if len(node.children) > BLOCK and len(left) > len(rows) // 2:  # points too far apart to be covered
            node.children += [cover_tree(points, left[i : i + BLOCK], scale / 2) for i in range(0, len(left), BLOCK)]
            break
    return node


def traverse(a: Node, b: Node, reach: float) -> Iterator[tuple[Node, Node]]:
    """Pairs of childless nodes that may hold points within ``reach``; with itself a node is met once."""
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if x is y:
            if x.children:
                stack += [(p, q) for i, p in enumerate(x.children) for q in x.children[i:]]
            else:
                yield x, y
            continue
        apart = float(np.sqrt(((x.centre - y.centre) ** 2).sum()))
        if apart > x.radius + y.radius + reach + SLACK:
            continue
        if x.children and (not y.children or x.radius >= y.radius):
            stack += [(p, y) for p in x.children]
        elif y.children:
            stack += [(x, q) for q in y.children]
        else:
            yield x, y


def _cell_pairs(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """For each pair of cells: links of every point, by weight, and a spanning forest of the links."""
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    for batch in batches:
        for row in batch.to_pylist():
            ids = [np.frombuffer(row[f"ids_{k}"], np.int64) for k in "ab"]
            weights = [np.frombuffer(row[f"weights_{k}"], np.int64) for k in "ab"]
            raw = [np.frombuffer(row[f"data_{k}"], np.float32).astype(np.float64).reshape(len(i), -1) for k, i in zip("ab", ids, strict=True)]
            alone = row["cell_a"] == row["cell_b"]
            norms = [np.sqrt((x * x).sum(1)) for x in raw]
            trees = [cover_tree(unit(raw[0]), np.arange(len(ids[0])))]
            trees.append(trees[0] if alone else cover_tree(unit(raw[1]), np.arange(len(ids[1]))))
            counts = [np.zeros(len(ids[0]), np.int64), np.zeros(len(ids[1]), np.int64)]
            parent: dict[int, int] = {}

            def top(x: int, parent: dict[int, int] = parent) -> int:
                while parent.setdefault(x, x) != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for x, y in traverse(trees[0], trees[1], reach):
                cos = raw[0][x.points] @ raw[1][y.points].T / np.outer(norms[0][x.points], norms[1][y.points])
                linked = cos >= cosine
                if x is y:
                    np.fill_diagonal(linked, False)
                i, j = np.nonzero(linked)
                if not len(i):
                    continue
                np.add.at(counts[0], x.points[i], weights[1][y.points[j]])
                if x is not y:
                    np.add.at(counts[1], y.points[j], weights[0][x.points[i]])
                for p, q in zip(ids[0][x.points[i]].tolist(), ids[1][y.points[j]].tolist(), strict=True):
                    p, q = top(p), top(q)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
            node = np.concatenate([ids[0], ids[1]])
            count = np.concatenate(counts)
            found = np.flatnonzero(count)
            tops = [top(int(x)) for x in node[found]]
            yield pa.RecordBatch.from_pydict({"node": node[found], "links": count[found], "other": pa.array(tops, pa.int64())})


def _first_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points of one cell side by side, as bytes: rows (cell, n, ids, weights, data)."""
    for batch in batches:
        groups: dict[int, list[tuple]] = {}
        for cell, *point in zip(*(batch.column(c).to_pylist() for c in ("cell", "node", "weight", "embedding")), strict=True):
            groups.setdefault(cell, []).append(tuple(point))
        yield _pieces(
            (cell, np.array([p[0] for p in ps], np.int64), np.array([p[1] for p in ps], np.int64), np.array([p[2] for p in ps], np.float32))
            for cell, ps in groups.items()
        )


def _pieces(parts: Iterator[tuple]) -> pa.RecordBatch:
    out = [
        (cell, len(ids[i : i + CELL_POINTS]), ids[i : i + CELL_POINTS].tobytes(), weights[i : i + CELL_POINTS].tobytes(), data[i : i + CELL_POINTS].tobytes())
        for cell, ids, weights, data in parts
        for i in range(0, len(ids), CELL_POINTS)
    ]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True) if out else [()] * 5, kinds, strict=True)], ["cell", "n", "ids", "weights", "data"])


def _points(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["weights"], np.int64), np.frombuffer(row["data"], np.float32).reshape(len(ids), -1)


def _draw(ids: np.ndarray, level: int) -> np.ndarray:
    return mix(ids.astype(np.uint64) + np.uint64(0x51_7CC1_B727_2202 * (level + 1)))


def _sample(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """About twice as many candidates for centres as a cell needs, by a hash of the point."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            ids, _, data = _points(row)
            draw = _draw(ids, level)
            for i in np.flatnonzero(draw < np.uint64(min(1.0, 2 * CENTRES / row["total"]) * (2**64 - 1025))).tolist():
                out.append((row["cell"], int(draw[i] >> np.uint64(1)), data[i].tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True) if out else [()] * 3, kinds, strict=True)], ["cell", "draw", "data"])


def _assign(batches: Iterator[pa.RecordBatch], level: int, nearest: bool) -> Iterator[pa.RecordBatch]:
    """Each point to its nearest centre, or evenly by a hash; rows carry the child's centre and how far its points reach."""
    names = ["parent", "cell", "n", "ids", "weights", "data", "centre", "radius"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.float64())
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            ids, weights, data = _points(row)
            points = unit(data.astype(np.float64))
            centres = unit(np.stack([np.frombuffer(c["data"], np.float32) for c in row["centres"]]).astype(np.float64))
            if nearest:
                at = (points @ centres.T).argmax(1)
            else:
                at = (_draw(ids, level) % np.uint64(CENTRES)).astype(np.int64)
            for k in np.unique(at).tolist():
                own = at == k
                centre = centres[min(k, len(centres) - 1)]
                child = int(mix(np.array([row["cell"]], np.int64).view(np.uint64) * np.uint64(31) + np.uint64(k + 1)).view(np.int64)[0])
                radius = float(np.sqrt(((points[own] - centre) ** 2).sum(1).max()))
                out.append((row["cell"], child, int(own.sum()), ids[own].tobytes(), weights[own].tobytes(), data[own].tobytes(), centre.tolist(), radius))
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True) if out else [()] * 8, kinds, strict=True)], names)


def _descend(pairs: DataFrame, cells: DataFrame, children: DataFrame, reach: float) -> DataFrame:
    """Pairs of cells with the split ones replaced by their children, where the bound allows."""
    side = children.select("parent", "cell")
    for end in ("cell_a", "cell_b"):
        pairs = pairs.join(side.select(F.col("parent").alias(end), F.col("cell").alias("child")), end, "left")
        pairs = pairs.withColumn(end + "_new", F.coalesce("child", end)).drop("child")
    pairs = pairs.where((F.col("cell_a") != F.col("cell_b")) | (F.col("cell_a_new") <= F.col("cell_b_new")))
    pairs = pairs.select(F.col("cell_a_new").alias("cell_a"), F.col("cell_b_new").alias("cell_b"))
    for end in "ab":
        pairs = pairs.join(cells.select(F.col("cell").alias(f"cell_{end}"), F.col("centre").alias(f"centre_{end}"), F.col("radius").alias(f"radius_{end}")), f"cell_{end}", "left")
    apart = F.sqrt(F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    near = apart <= F.col("radius_a") + F.col("radius_b") + reach + SLACK
    return pairs.where((F.col("cell_a") == F.col("cell_b")) | F.coalesce(near, F.lit(True))).select("cell_a", "cell_b")


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE, cell_points: int = CELL_POINTS, levels: int = LEVELS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors are compared when their labels are equal and not null and they have as many
    components; those that are null, empty, all zero or hold a null or non-finite
    component link with nothing.  A link has a cosine of at least ``cosine`` in double
    precision.  Equal vectors of a label are one point with a weight, so that copies cost
    no pairs; they are links of each other.  Rows with a null id take part and count as
    links, but no component is named by them.  Rows that repeat an id and vector count as
    links of each other.  Other columns are not read.
    """
    spark = vectors.sparkSession
    folder = work_dir(spark, "cover")

    def stored(df: DataFrame, name: str) -> DataFrame:
        with conf_scope(spark, BATCH):
            df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    own = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<float>").alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0)
    rows = own.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # plus zero turns a negative zero into zero, so that equal vectors have equal keys
    rows = rows.withColumn("embedding", F.when(F.col("usable"), F.transform("embedding", lambda x: x + F.lit(0.0).cast("float"))))
    points = rows.where("usable").groupBy("label", "embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    points = stored(points.withColumn("node", F.monotonically_increasing_id()), "points")

    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    first = points.select("node", "weight", "embedding", F.xxhash64("label", F.size("embedding")).alias("cell"))
    pieces = first.mapInArrow(_first_pieces, f"cell long, n long, {PIECE}")
    pieces.write.parquet(f"{folder}/pieces")
    pieces = spark.read.parquet(f"{folder}/pieces")
    pairs = pieces.select(F.col("cell").alias("cell_a"), F.col("cell").alias("cell_b")).distinct()
    cells = pieces.select("cell", F.lit(None).cast("array<double>").alias("centre"), F.lit(None).cast("double").alias("radius")).distinct()
    leaves, level = [], 0
    while True:
        large = stored(pieces.groupBy("cell").agg(F.sum("n").alias("total")).where(F.col("total") > cell_points), f"large-{level}")
        if large.isEmpty():
            leaves.append(pieces)
            break
        leaves.append(pieces.join(large, "cell", "left_anti"))
        drawn = pieces.join(large, "cell").mapInArrow(lambda it, at=level: _sample(it, at), "cell long, draw long, data binary")
        centres = drawn.groupBy("cell").agg(F.slice(F.array_sort(F.collect_list(F.struct("draw", "data"))), 1, CENTRES).alias("centres"))
        centres = stored(centres, f"centres-{level}")
        made = pieces.join(centres, "cell").mapInArrow(
            lambda it, at=level: _assign(it, at, at < levels), f"parent long, cell long, n long, {PIECE}, centre array<double>, radius double"
        )
        made = stored(made, f"made-{level}")
        children = made.groupBy("parent", "cell", "centre").agg(F.max("radius").alias("radius"))
        children = stored(children, f"children-{level}")
        cells = cells.join(large, "cell", "left_anti").unionByName(children.select("cell", "centre", "radius"))
        cells = stored(cells, f"cells-{level}")
        pairs = stored(_descend(pairs, cells, children, reach), f"pairs-{level}")
        pieces, level = made.select("cell", "n", "ids", "weights", "data"), level + 1
    whole = leaves[0]
    for more in leaves[1:]:
        whole = whole.unionByName(more)
    # a leaf has at most ``cell_points`` points, whatever number of pieces
    whole = whole.groupBy("cell").agg(F.collect_list(F.struct("ids", "weights", "data")).alias("all"))
    joined = [F.expr(f"aggregate(all, X'', (s, p) -> concat(s, p.{c}))").alias(c) for c in ("ids", "weights", "data")]
    whole = stored(whole.select("cell", *joined), "leaves")
    for end in "ab":
        pairs = pairs.join(whole.select(*[F.col(c).alias(f"{c}_{end}") for c in ("cell", "ids", "weights", "data")]), f"cell_{end}")
    met = stored(pairs.mapInArrow(lambda it: _cell_pairs(it, cosine), "node long, links long, other long"), "met")

    counted = met.groupBy("node").agg(F.sum("links").alias("links"))
    groups = stored(components(met.select(F.col("node").alias("a"), F.col("other").alias("b"))), "groups")
    known = points.join(counted, "node", "left").join(groups, "node", "left")
    known = known.select("label", "embedding", "weight", "links", "least", F.coalesce("component", "node").alias("component"))
    known = stored(known, "known")
    named = stored(known.groupBy("component").agg(F.min("least").alias("name")), "named")
    known = stored(known.join(named, "component").select("label", "embedding", "weight", "links", "name"), "classes")
    out = rows.where("usable").join(known, ["label", "embedding"]).select(
        "vec_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("name", "vec_id").alias("component_id")
    )
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
