"""The trie of shared conversation beginnings, by peeling turns off from the deep end.

Conversations of equal turns are merged first.  From the greatest depth down, those that
end at a depth are merged with the nodes that survive from below; then every node loses
its last turn and what is left is grouped again, which finds the parents and adds up their
subtrees in the same step.  A node is named by 128 bits, the exclusive or of one value per
turn and place, so a turn is stripped by taking its value out again.

Nothing holds a whole conversation: turns are rows, positions come from a scan over ranges
of (conversation, turn), and a node carries the turns of its band of ``BAND`` depths.
Where a conversation has the beginning up to a multiple of ``BAND`` to itself, its tail from
there on strips turn by turn with nothing to regroup: these nodes are made in one step, and
the number of steps follows the deepest shared beginning, not the longest conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.operators.scan import RANGE, SUM, XOR, in_ranges, running
from parcelflow.session import work_dir, written

#: Depths whose turns a node carries.
BAND = 8
#: Turns of the donor that a rebuilt conversation takes at most, and the donors' ids.
MOST_SHARED = 5
DONOR_EVERY = 100
#: Characters of a member list that are handed on as one row.
LIST_CHARS = 1 << 16


def _turn_value(lane: int, depth: Column, role: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(lane), depth, role, text)


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, position, a, b, chars, _range, turn) of every turn, positions from 1.

    Turns are ordered by ``turn``, null first; equal ones by 128 bits of their role and text.
    a and b are those 128 bits, chars the code points of the text; null role or text is empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"), F.length(text).cast("long").alias("chars"),
    )
    order = ["turn", "a", "b"]  # ascending order puts nulls first
    return written(running(in_ranges(turns, "conv_id", order), "conv_id", order, position=(SUM, F.lit(1).cast("long"))), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of a donor: their turns, and (conv_id, length) of each.

    Conversation c takes the first h turns of c - c % 100 (all if fewer, none if there is no
    such conversation), then its own after its first h; h is crc32 of c in decimal, modulo 6.
    Turn rows get depth (from 1), p and q (the name of the beginning that they end), and
    ``sum_chars`` up to and including them.
    """
    conv = F.col("conv_id")
    convs = turns.groupBy("conv_id").agg(F.max("position").alias("own"))
    convs = convs.select("conv_id", "own", (conv - conv % DONOR_EVERY).alias("donor"), (F.crc32(conv.cast("string")) % (MOST_SHARED + 1)).alias("h"))
    first = F.struct("position", "a", "b", "chars")
    # at most MOST_SHARED turns of a conversation
    donors = turns.where((conv % DONOR_EVERY == 0) & (F.col("position") <= MOST_SHARED)).groupBy(conv.alias("donor")).agg(F.sort_array(F.collect_list(first)).alias("given"))
    none = F.array().cast("array<struct<position:long,a:long,b:long,chars:long>>")
    given = F.filter(F.coalesce("given", none), lambda t: t["position"] <= F.col("h"))
    convs = convs.join(donors, "donor", "left").withColumn("given", given).withColumn("taken", F.size("given").cast("long"))
    own_length = F.greatest(F.lit(0).cast("long"), F.col("own") - F.col("h"))
    zero = F.lit(0).cast("long")

    def lanes(depth: Column, a: Column, b: Column) -> list[Column]:
        return [_turn_value(lane, depth, a, b).alias(name) for lane, name in ((3, "p"), (4, "q"))]

    def folded(t: Column, name: str, put) -> Column:
        """Over the donor's turns up to ``t``: at most MOST_SHARED of them."""
        return F.aggregate(F.slice("values", F.lit(1), t["position"].cast("int")), zero, lambda s, x: put(s, x[name]))

    xor = lambda s, x: s.bitwiseXOR(x)
    values = F.transform("given", lambda t: F.struct(t["position"].alias("position"), t["chars"].alias("chars"), *lanes(t["position"], t["a"], t["b"])))
    convs = convs.select("conv_id", "h", "taken", (F.col("taken") + own_length).alias("length"), values.alias("values"))
    lent = F.transform("values", lambda t: F.struct(
        t["position"].alias("depth"), t["chars"].alias("chars"), t["p"].alias("last_p"), t["q"].alias("last_q"),
        folded(t, "p", xor).alias("p"), folded(t, "q", xor).alias("q"), folded(t, "chars", lambda s, x: s + x).alias("sum_chars"),
    ))
    convs = written(convs.select("conv_id", "h", "taken", "length", lent.alias("lent")), "rebuilt")
    begun = F.try_element_at("lent", F.lit(-1))
    facts = convs.select("conv_id", "h", "taken", "length", begun.alias("begun"))
    own = turns.join(facts, "conv_id").where(F.col("position") > F.col("h"))
    depth = (F.col("position") - F.col("h") + F.col("taken")).cast("long")
    own = own.select("conv_id", RANGE, "a", "b", "position", "length", "begun", "chars", depth.alias("depth"))
    own = own.select("*", *lanes(F.col("depth"), F.col("a"), F.col("b"))).withColumnsRenamed({"p": "last_p", "q": "last_q"})
    own = running(own, "conv_id", ["position"], p=(XOR, F.col("last_p")), q=(XOR, F.col("last_q")), sum_chars=(SUM, F.col("chars")))
    own = own.select(
        "conv_id", "length", "depth", "chars", "last_p", "last_q",
        F.col("p").bitwiseXOR(F.coalesce("begun.p", zero)).alias("p"), F.col("q").bitwiseXOR(F.coalesce("begun.q", zero)).alias("q"),
        (F.col("sum_chars") + F.coalesce("begun.sum_chars", zero)).alias("sum_chars"),
    )
    lent_rows = convs.select("conv_id", "length", F.explode("lent").alias("t")).select("conv_id", "length", "t.*")
    return own.unionByName(lent_rows), convs.select("conv_id", "length")


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same of conversations as they are."""
    depth = F.col("position")
    own = turns.select("*", _turn_value(3, depth, F.col("a"), F.col("b")).alias("last_p"), _turn_value(4, depth, F.col("a"), F.col("b")).alias("last_q"))
    own = running(own, "conv_id", ["position"], p=(XOR, F.col("last_p")), q=(XOR, F.col("last_q")), sum_chars=(SUM, F.col("chars")))
    convs = turns.groupBy("conv_id").agg(F.max("position").alias("length"))
    own = own.join(convs, "conv_id")
    return own.select("conv_id", "length", depth.alias("depth"), "chars", "last_p", "last_q", "p", "q", "sum_chars"), convs


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))


_NAME = {"p": pa.int64(), "q": pa.int64(), "depth": pa.int64()}
_PIECE = {**_NAME, "first": pa.int64(), "n": pa.int64(), "all_chars": pa.int64(), "ids": pa.string()}
_END = {**_NAME, "conv_id": pa.int64(), "n_convs": pa.int64(), "all_chars": pa.int64(), "ends_sha256": pa.string()}


def _pieces(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[pa.RecordBatch]:
    """Sorted (p, q, depth, conv_id, sum_chars) to rows that hold up to about ``chars`` characters of a node's list."""
    node, ids, out = None, [], []

    def piece() -> tuple:
        return (*node[:3], ids[0], len(ids), node[3], ",".join(map(str, ids)))

    for part in batches:
        for p, q, depth, conv, total in zip(*[part.column(c).to_pylist() for c in ("p", "q", "depth", "conv_id", "sum_chars")], strict=True):
            if ids and (node[:3] != (p, q, depth) or len(ids) * 21 > chars):
                out.append(piece())
                ids = []
            node = (p, q, depth, total)
            ids.append(conv)
        yield _batch(out, _PIECE)
        out = []
    if ids:
        yield _batch([piece()], _PIECE)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of member lists to one row per node; a list of any length passes through piecewise."""
    node, digest, first, count, total, out = None, None, 0, 0, 0, []
    for part in batches:
        for p, q, depth, least, n, chars, ids in zip(*[part.column(c).to_pylist() for c in _PIECE], strict=True):
            if node != (p, q, depth):
                if node is not None:
                    out.append((*node, first, count, total, digest.hexdigest()))
                node, digest, first, count, total = (p, q, depth), hashlib.sha256(), least, 0, chars
            else:
                digest.update(b",")
            digest.update(ids.encode())
            count += n
        yield _batch(out, _END)
        out = []
    if node is not None:
        yield _batch([(*node, first, count, total, digest.hexdigest())], _END)


def endings(members: DataFrame, chars: int = LIST_CHARS) -> DataFrame:
    """One row per node that conversations (p, q, depth, conv_id, sum_chars) end at.

    Columns: the node, conv_id (smallest), n_convs, all_chars (of all its turns), ends_sha256
    (of the comma-joined ascending ids).
    """
    parts = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = ["p", "q", "depth"]
    pieces = members.repartitionByRange(parts, *by, "conv_id").sortWithinPartitions(*by, "conv_id")
    pieces = pieces.mapInArrow(partial(_pieces, chars=chars), "p long, q long, depth long, first long, n long, all_chars long, ids string")
    pieces = pieces.repartition(*by).sortWithinPartitions(*by, "first")
    return pieces.mapInArrow(_digests, "p long, q long, depth long, conv_id long, n_convs long, all_chars long, ends_sha256 string")


EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of conversation beginnings.

    ``turns`` and ``convs`` come from ``rebuilt`` or ``plain``.  Columns: conv_id (smallest
    member), depth, parent_conv_id (null for the root), n_convs (conversations that begin so),
    n_children, n_leaves (childless nodes of the subtree, itself included), saved_tokens (over
    the subtree, members beyond the first times the code points of the node's last text),
    ends_sha256 (of the ids that end here).  The root has depth 0 and no text; a conversation
    without turns ends there.  No conversations, no nodes.
    """
    spark = turns.sparkSession
    folder = work_dir(spark, "prefix-trie")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    zero = F.lit(0).cast("long")
    turns = stored(turns, "turns")
    last = turns.where(F.col("depth") == F.col("length")).select("conv_id", F.col("depth"), "p", "q", "sum_chars")
    none = convs.where("length = 0").select("conv_id", zero.alias("depth"), zero.alias("p"), zero.alias("q"), zero.alias("sum_chars"))
    ends = stored(endings(last.unionByName(none)), "ends")

    # one conversation stands for its copies; where does its beginning belong to it alone?
    whole = ends.select("conv_id", "n_convs", "all_chars", "ends_sha256")
    kept = stored(turns.join(whole, "conv_id"), "distinct")
    at_bounds = kept.where(F.col("depth") % BAND == 0).select("conv_id", "depth", "p", "q")
    alone = at_bounds.groupBy("depth", "p", "q").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).where("n = 1")
    alone = alone.groupBy("conv_id").agg(F.min("depth").alias("alone"))
    kept = stored(kept.join(alone, "conv_id", "left"), "kept")
    tail_chars = F.col("all_chars") - F.col("sum_chars")
    tails = kept.where(F.col("depth") > F.col("alone")).select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), "n_convs",
        F.when(F.col("depth") < F.col("length"), 1).otherwise(0).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * (tail_chars + F.col("chars"))).alias("saved_tokens"),
        F.when(F.col("depth") == F.col("length"), F.col("ends_sha256")).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )

    # where each conversation comes in: at its end, or at the foot of its own tail
    foot = F.least("length", F.coalesce("alone", "length"))
    entering = kept.where(F.col("depth") == foot).select(
        "conv_id", "depth", "p", "q", "n_convs", (F.col("depth") < F.col("length")).cast("long").alias("below"),
        ((F.col("n_convs") - 1) * tail_chars).alias("saved"), F.when(F.col("depth") == F.col("length"), F.col("ends_sha256")).alias("ends_sha256"),
    )
    turnless = ends.where("depth = 0").select("conv_id", "depth", "p", "q", "n_convs", zero.alias("below"), zero.alias("saved"), "ends_sha256")
    # the turns of a band, never more than BAND of them
    turn = F.struct("depth", "last_p", "last_q", "chars")
    held = kept.where(F.col("depth") <= foot).groupBy("conv_id", F.floor((F.col("depth") - 1) / BAND).alias("band"))
    held = stored(held.agg(F.sort_array(F.collect_list(turn)).alias("band_turns")), "bands")
    entering = entering.unionByName(turnless).withColumn("band", F.floor((F.col("depth") - 1) / BAND))
    entering = stored(entering.join(held, ["conv_id", "band"], "left").drop("band"), "entering")
    no_turns = F.array().cast(held.schema["band_turns"].dataType)

    deepest = entering.agg(F.max("depth")).first()[0]
    levels: list[DataFrame] = []
    nodes = None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        here = entering.where(F.col("depth") == depth).select("conv_id", "p", "q", "n_convs", "below", "saved", "ends_sha256", F.lit(1).cast("long").alias("leaves"), F.coalesce("band_turns", no_turns).alias("band_turns"))
        if nodes is not None:
            # strip the last turn of every node of the depth below
            gone = F.try_element_at("band_turns", F.lit(-1))
            peeled = nodes.select(
                "conv_id", F.col("p").bitwiseXOR(gone["last_p"]).alias("p"), F.col("q").bitwiseXOR(gone["last_q"]).alias("q"), "n_convs",
                F.lit(1).cast("long").alias("below"), F.col("saved_tokens").alias("saved"), F.lit(None).cast("string").alias("ends_sha256"),
                F.col("n_leaves").alias("leaves"), F.slice("band_turns", F.lit(1), F.size("band_turns") - 1).alias("band_turns"),
            )
            if depth and depth % BAND == 0:  # the turns of the next band, of the conversation that names the node
                above = held.where(F.col("band") == depth // BAND - 1).select("conv_id", "band_turns")
                peeled = peeled.drop("band_turns").join(above, "conv_id")
            here = here.unionByName(peeled)
        made = here.groupBy("p", "q").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("below").alias("n_children"),
            F.sum(F.when(F.col("below") > 0, F.col("leaves"))).alias("leaves"), F.sum("saved").alias("saved"),
            F.max("ends_sha256").alias("ends_sha256"), F.first("band_turns").alias("band_turns"),
        )
        gone = F.try_element_at("band_turns", F.lit(-1))
        own = (F.col("n_convs") - 1) * (gone["chars"] if depth else zero)
        made = made.select(
            "p", "q", "conv_id", "n_convs", "n_children", F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"),
            (F.col("saved") + own).alias("saved_tokens"), "ends_sha256", "band_turns", F.lit(depth).cast("long").alias("depth"),
            *[F.col(c).bitwiseXOR(gone[f"last_{c}"]).alias(f"parent_{c}") if depth else F.lit(None).cast("long").alias(f"parent_{c}") for c in "pq"],
        )
        nodes = stored(made, f"nodes-{depth}")
        levels.append(nodes.drop("band_turns"))
    if not levels:
        return tails.select(*NODE)
    names = [f"{folder}/nodes-{d}" for d in range(len(levels))]
    every = spark.read.schema(nodes.schema).parquet(*names).drop("band_turns")
    parents = every.select((F.col("depth") + 1).alias("depth"), F.col("p").alias("parent_p"), F.col("q").alias("parent_q"), F.col("conv_id").alias("parent_conv_id"))
    shared = every.join(parents, ["depth", "parent_p", "parent_q"], "left")
    shared = shared.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))
    return shared.select(*NODE).unionByName(tails.select(*NODE))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """``prefix_trie`` of the ``rebuilt`` conversations.

    ``conversations`` has conv_id, turn, role, text; other columns are not read.  Rows with a
    null conv_id take no part; null role or text is empty; repeated rows are turns like others.
    """
    return prefix_trie(*rebuilt(conversation_turns(conversations)))


def shared_beginnings(conversations: DataFrame) -> DataFrame:
    """``prefix_trie`` of the conversations as they are."""
    return prefix_trie(*plain(conversation_turns(conversations)))
