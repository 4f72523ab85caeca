"""Drop lines that an earlier line repeats, exactly or up to a few edits.

Two lines within k edits agree exactly on one of the k + 1 segments of the shorter one, at
a place that its length and the edits left over confine to a few shifts.  Each line
therefore has keys of its own segments and keys of the substrings that may equal a
segment of a line as long or a little shorter.  Keys met by one line only are dropped;
lines that meet in a key are compared by a banded, bit-parallel edit distance.  A key that
many lines share is split again by segments of what the key leaves of the line, as often
as needed.  Everything is a DataFrame expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.columns import given_back, set_aside
from parcelflow.llm.filters import maybe_seen, seen_keys
from parcelflow.session import work_dir

MAX_EDITS = 1
#: Shorter lines stay; lines below the second length are only compared for equality.
EXACT_CHARS = 16
NEAR_CHARS = 30
#: Lines that are compared with each other for one key, and their number times the longest
#: remainder; larger groups are split again.
GROUP_LINES = 32
GROUP_CHARS = 2048


def _shifts(delta: int, segment: int, edits: int) -> range:
    """Where a segment may lie in a line that is ``delta`` longer, relative to its own place."""
    low = max(-segment, delta - (edits - segment))
    high = min(segment, delta + (edits - segment))
    return range(low, high + 1)


def _segment(length: Column, segment: Column, edits: int) -> tuple[Column, Column]:
    """Where a segment of a line of ``length`` begins, from 0, and how long it is."""
    parts = edits + 1
    extra = length % parts
    base = ((length - extra) / parts).cast("int")
    return base * segment + F.greatest(F.lit(0), segment - (parts - extra)), base + (segment >= parts - extra).cast("int")


def _keyed(rows: DataFrame, text: str, parent: Column, edits: int) -> DataFrame:
    """Rows (h, g, line, key, own, delta, segment, shift, length, rest) for each key of ``text``; ``rest`` is what the key leaves of it.

    A line has keys of its own segments (own) and of the probes, which are segments that a
    line ``delta`` shorter would have, a few places to either side.  Every row makes one
    key from numbers, which keeps the compiled code small.  A row that a key has led to keeps
    its part there: one that probes for a line ``delta`` shorter goes on doing only that.
    """
    parts = edits + 1
    kinds = [(d, k, s) for d in range(edits + 1) for k in range(parts) for s in _shifts(d, k, edits)]
    probes = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("delta", "segment", "shift"), kind, strict=True)]) for kind in kinds])
    again = "own" in rows.columns
    if again:
        probes = F.filter(probes, lambda p: p["delta"] == F.col("delta"))
    part = [F.col("own").alias("was_own")] if again else [F.lit(True).alias("was_own")]
    each = rows.select("h", "g", "line", F.col(text).alias("text"), parent.alias("parent"), *part, F.length(text).alias("chars"), F.explode(probes).alias("p"))
    each = each.select("h", "g", "line", "text", "parent", "was_own", "chars", "p.*").withColumn("length", F.col("chars") - F.col("delta"))
    begin, size = _segment(F.col("length"), F.col("segment"), edits)
    each = each.withColumns({"size": size, "at": (begin + 1 + F.col("shift")).cast("int")})
    each = each.where((F.col("at") >= 1) & (F.col("at") + F.col("size") - 1 <= F.col("chars")) & (F.col("size") > 0))
    key = F.xxhash64("parent", "length", "segment", F.substring(F.col("text"), F.col("at"), F.col("size")))
    before = F.substring(F.col("text"), F.lit(1), F.col("at") - 1)
    after = F.substring(F.col("text"), F.col("at") + F.col("size"), F.lit(2**31 - 1))
    own = F.col("was_own") & (F.col("delta") == 0) & (F.col("shift") == 0)
    rest = F.concat(before, F.lit("\n"), after).alias("rest")
    return each.select("h", "g", "line", key.alias("key"), own.alias("own"), "delta", "segment", "shift", "length", rest)


def _met(rows: DataFrame) -> DataFrame:
    """Keys that a line has as its own and another line has too."""
    found = rows.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.max("own").alias("owned"))
    return found.where("owned AND low <> high")


def _told_already(rows: DataFrame, edits: int) -> DataFrame:
    """Keys of crowded groups all of whose rows agree on an earlier segment, too.

    Whoever meets there meets under the earlier segment's key as well, so lines that share a
    template are split again under one key and not under each of its segments.  An earlier
    segment lies in what is before the key, at the same shift.
    """
    agreed = None
    for k in range(edits):
        begin, size = _segment(F.col("length"), F.lit(k), edits)
        low = F.greatest(F.lit(-k), F.col("delta") - (edits - k))
        high = F.least(F.lit(k), F.col("delta") + (edits - k))
        probed = (F.col("segment") > k) & (F.col("shift") >= low) & (F.col("shift") <= high) & (size > 0)
        part = F.when(probed, F.xxhash64(F.substring(F.col("rest"), (begin + 1 + F.col("shift")).cast("int"), size)))
        same = (F.count(part) == F.count("*")) & (F.min(part) == F.max(part))
        agreed = same if agreed is None else agreed | same
    if agreed is None:
        return rows.select("key").limit(0)
    return rows.groupBy("key").agg(F.coalesce(agreed, F.lit(False)).alias("agreed")).where("agreed").select("key")


def within_edits(left: Column, right: Column, edits: int) -> Column:
    """Whether two lines are at most ``edits`` insertions, deletions and substitutions apart.

    For each number of errors a bit set holds the diagonals, in the band of ``edits`` to
    either side, on which the characters of ``right`` read so far can have been matched.
    The sets of all error counts lie side by side in one long.
    """
    width = 2 * edits + 1
    if width * (edits + 1) > 63:
        raise ValueError("too many edits for one long")
    mask = (1 << width) - 1

    def field(state: Column, e: int) -> Column:
        return F.shiftrightunsigned(state, e * width).bitwiseAND(F.lit(mask))

    def closed(fields: list[Column]) -> Column:
        """What fewer errors reach more do, and deletions read nothing, so they follow within a step."""
        for e in range(1, edits + 1):
            fields[e] = fields[e].bitwiseOR(fields[e - 1]).bitwiseOR(F.shiftleft(fields[e - 1], 1).bitwiseAND(F.lit(mask)))
        return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(f, e * width) for e, f in enumerate(fields)])

    def step(x: Column, y: Column, state: Column, j: Column) -> Column:
        # bit d + edits: character j + d of the left line equals character j of the right one
        bits = [F.when(F.get(x, j + (d - 1)) == F.get(y, j - 1), F.lit(1 << (d + edits))).otherwise(F.lit(0)).cast("long") for d in range(-edits, edits + 1)]
        same = reduce(lambda a, b: a.bitwiseOR(b), bits)
        fields = []
        for e in range(edits + 1):
            now = field(state, e).bitwiseAND(same)
            if e:
                before = field(state, e - 1)
                now = now.bitwiseOR(before).bitwiseOR(F.shiftrightunsigned(before, 1))
            fields.append(now)
        return F.when(state == 0, state).otherwise(closed(fields))

    start = closed([F.lit(1 << edits).cast("long"), *[F.lit(0).cast("long")] * edits])
    # the characters are bound to a variable, as the step would otherwise split the lines again each time
    chars = F.array(F.struct(F.split(left, "").alias("x"), F.split(right, "").alias("y")))
    read = F.transform(chars, lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c["y"])), start, lambda s, j: step(c["x"], c["y"], s, j)))
    end = F.when(F.length(right) == 0, start).otherwise(read[0])
    diagonal = F.length(left) - F.length(right)
    last = F.shiftrightunsigned(end, edits * width).bitwiseAND(F.lit(mask))
    return (F.abs(diagonal) <= edits) & (F.call_function("getbit", last, F.greatest(F.least(diagonal + edits, F.lit(63)), F.lit(0)).cast("int")) == 1)


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line that takes part: its text, where it stands, and its name (h, g)."""
    text = F.col("text")
    whole = docs.where(F.col("doc_id").isNotNull() & text.isNotNull())
    # the version is made below the generator, or it would be made again for every line
    whole = whole.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), F.split(text, "\n").alias("lines"))
    rows = whole.select("doc_id", "version", F.posexplode("lines").alias("pos", "line")).where(F.length("line") >= EXACT_CHARS)
    return rows.select("*", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"))


def near_lines(docs: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """Pairs of different lines within ``edits`` edits, named by their two hashes (h, g, h2, g2)."""
    spark = docs.sparkSession
    folder = work_dir(spark, "lines")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    lines = _lines(docs).where(F.length("line") >= NEAR_CHARS).select("h", "g", "line")
    keyed = _keyed(lines, "line", F.lit(0), edits)
    columns = ["key", "own", "delta", "segment", "shift", "length", "h", "g", "line", "rest"]
    seen = stored(seen_keys(_met(keyed).select("key"), "key"), "shared-keys")
    rows = stored(maybe_seen(keyed, "key", seen).select(*columns).distinct(), "rows-0")
    found, level = [], 0
    while True:
        longest, lines_met = F.max(F.length("rest")).alias("longest"), F.count("*").alias("n")
        groups = rows.groupBy("key").agg(lines_met, longest, F.max("own").alias("owned"), F.min("h").alias("low"), F.max("h").alias("high"))
        groups = groups.where("owned AND low <> high")
        # below this length segments get so short that what they leave would not shrink
        crowded = (F.col("n") > GROUP_LINES) | (F.col("n") * F.col("longest") > GROUP_CHARS)
        groups = stored(groups.select("key", (crowded & (F.col("longest") > 3 * edits + 2)).alias("split")), f"groups-{level}")
        last = groups.where("split").isEmpty()
        small = rows.join(groups.where("NOT split").select("key"), "key")
        own = small.where("own").select("key", "h", "g", "line", "rest")
        other = small.select("key", F.col("h").alias("h2"), F.col("g").alias("g2"), F.col("line").alias("line2"), F.col("rest").alias("rest2"))
        pairs = own.join(other, "key").where((F.col("h") != F.col("h2")) | (F.col("g") != F.col("g2")))
        # what the key leaves is shorter and turns most pairs away
        pairs = pairs.where(within_edits(F.col("rest"), F.col("rest2"), edits))
        pairs = pairs.where(within_edits(F.col("line"), F.col("line2"), edits)).select("h", "g", "h2", "g2")
        found.append(stored(pairs.distinct(), f"pairs-{level}"))
        if last:
            break
        large = rows.join(groups.where("split").select("key"), "key")
        large = large.join(_told_already(large, edits), "key", "left_anti")
        again = _keyed(large, "rest", F.col("key"), edits).select(*columns).distinct()
        level += 1
        rows = stored(again, f"rows-{level}")
    out = reduce(lambda a, b: a.unionByName(b), found)
    return out.unionByName(out.select(F.col("h2").alias("h"), F.col("g2").alias("g"), F.col("h").alias("h2"), F.col("g").alias("g2"))).distinct()


def _cut_lines(docs: DataFrame, edits: int) -> tuple[DataFrame, Column, Column, Column]:
    """``docs`` set aside with the lines that go; the text left, the number of lines, and of those gone."""
    spark = docs.sparkSession
    folder = work_dir(spark, "line-dedup")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    near = near_lines(docs, edits)
    lines = stored(_lines(docs).select("doc_id", "version", "pos", "h", "g"), "lines").withColumn("place", F.struct("doc_id", "pos"))
    firsts = stored(lines.groupBy("h", "g").agg(F.min("place").alias("first"), F.count("*").alias("n")), "firsts")
    others = near.join(firsts.select(F.col("h").alias("h2"), F.col("g").alias("g2"), "first"), ["h2", "g2"])
    others = stored(others.groupBy("h", "g").agg(F.min("first").alias("near")), "near")
    known = firsts.join(others, ["h", "g"], "left").where("n > 1 OR near < first")
    known = stored(known.select("h", "g", F.least("first", "near").alias("first")), "known")
    gone = lines.join(known, ["h", "g"]).where("place > first")
    gone = stored(gone.groupBy("doc_id", "version").agg(F.collect_set("pos").alias("gone")), "gone")
    same = (F.col("_in_doc_id") == F.col("doc_id")) & (F.xxhash64("_in_text") == F.col("version"))
    joined = set_aside(docs).join(gone, same, "left")
    every = F.split("_in_text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("_in_text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(every, i)), "\n"))
    n_lines = F.when(F.col("_in_text").isNull(), 0).otherwise(F.size(every)).cast("long")
    return joined, text, n_lines, F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")


def line_report(docs: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """One row per document: doc_id, text (the lines left), n_lines, n_removed.

    Lines end at newlines and are ordered by doc_id and position.  A line of at least
    ``EXACT_CHARS`` characters goes if an equal line comes earlier, anywhere; one of at
    least ``NEAR_CHARS`` also if an earlier such line is within ``edits`` edits of it.
    Earlier lines count whether or not they go themselves.  Null texts stay null and have
    no lines, an empty text has one empty line.  Documents with a null id are neither cut
    nor compared.  Rows that repeat an id are not earlier than each other.  Lines are
    named by 128 bits of hash.  Other columns are not read.
    """
    joined, text, n_lines, n_removed = _cut_lines(docs.select("doc_id", "text"), edits)
    return joined.select(F.col("_in_doc_id").alias("doc_id"), text.alias("text"), n_lines.alias("n_lines"), n_removed.alias("n_removed"))


def drop_repeated_lines(docs: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """``docs`` without the lines that ``line_report`` removes, columns as given.

    ``n_chars``, if there is one, follows the text of documents that lost lines.
    """
    joined, text, _, _ = _cut_lines(docs, edits)
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("gone").isNull(), F.col("_in_n_chars")).otherwise(F.length(text).cast(docs.schema["n_chars"].dataType))
    return joined.select(*given_back(docs.columns, **new))
