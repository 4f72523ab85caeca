"""Remove passages that an earlier document already has, by suffix automata.

A passage is found by its windows of 13 words.  The reference is the corpus itself, too
large for one automaton or for sending all automata to all documents, so both sides are
routed: each window has an anchor, the least value among its five-word runs, and equal
windows have equal anchors.  Windows whose anchor occurs in one document only cannot
repeat.  The others are cut out as segments, runs of windows with one anchor, and a
reference shard is the distinct segments of a range of anchors.  A task builds the shard's
suffix automaton, with the least document on every state, and streams the segments
through it: matching statistics, then the suffix link path to the state that holds the
window.  No anchor, copy group or passage is bounded or cut off for being frequent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.arrays import IS_SPACE, gram_rows, grams, row_of, slices, words
from parcelflow.session import work_dir

WINDOW = 13
ANCHOR = 5
#: Windows of one segment at most; longer runs of one anchor are cut into several.
SEGMENT_WINDOWS = 64
#: Words after which a shard's automaton is closed at the next anchor.
SHARD_WORDS = 100_000
#: Distinct segments of an anchor beyond which its windows are matched one by one.
ANCHOR_SEGMENTS = 2_000


class SuffixAutomaton:
    """All substrings of the added word sequences; ``first[state]`` is their least document."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [None]

    def _state(self, length: int, moves: dict, link: int, first: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.first.append(first)
        return len(self.length) - 1

    def add(self, sequence: list, document: int) -> None:
        last = 0
        for word in sequence:
            last = self._extend(last, word, document)

    def _split(self, state: int, word: object, target: int) -> int:
        """The state of the longest suffix of ``state`` plus ``word`` that ``target`` holds too."""
        nxt, link, length = self.next, self.link, self.length
        if length[target] == length[state] + 1:
            return target
        clone = self._state(length[state] + 1, dict(nxt[target]), link[target], self.first[target])
        link[target] = clone
        while state >= 0 and nxt[state].get(word) == target:
            nxt[state][word] = clone
            state = link[state]
        return clone

    def _extend(self, last: int, word: object, document: int) -> int:
        nxt, link = self.next, self.link
        known = nxt[last].get(word)
        if known is not None:  # the sequence so far is in the automaton already
            state = self._split(last, word, known)
            self.first[state] = min(self.first[state], document)
            return state
        state = self._state(self.length[last] + 1, {}, 0, document)
        at = last
        while at >= 0 and word not in nxt[at]:
            nxt[at][word] = state
            at = link[at]
        if at >= 0:
            link[state] = self._split(at, word, nxt[at][word])
        return state

    def close(self) -> None:
        """Hand the least documents down to the suffixes."""
        length, link, first = self.length, self.link, self.first
        for state in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
            up = link[state]
            if up > 0 and first[state] < first[up]:
                first[up] = first[state]

    def firsts(self, sequence: list, window: int) -> list[int | None]:
        """For each window of the sequence the least document that has it, None if none has."""
        out, state, matched = [], 0, 0
        nxt, link, length = self.next, self.link, self.length
        for i, word in enumerate(sequence):
            while state > 0 and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            if word in nxt[state]:
                state, matched = nxt[state][word], matched + 1
            if i >= window - 1:
                if matched < window:
                    out.append(None)
                    continue
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                out.append(self.first[state])
        return out


def _window_anchors(hashes: np.ndarray, rows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows within rows, the windows' word positions, and where each row's begin."""
    at, bounds = gram_rows(rows, window)
    if not len(at):
        return np.zeros(0, np.uint64), at, bounds
    low, size = grams(hashes, ANCHOR), 1
    span = window - ANCHOR + 1
    while size < span:
        step = min(size, span - size)
        low = np.minimum(low[:-step], low[step:])
        size += step
    return low[at], at, bounds


def _anchor_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Distinct (anchor, doc_id), combined over a batch.

    An anchor of several documents of the batch is known to repeat: one row of it is routed
    by the anchor, marked, and the others need not meet anybody and are routed at random.
    """
    for batch in batches:
        anchors, docs = [], []
        for part in slices(batch):
            found = words(part.column("text"))
            own, _, bounds = _window_anchors(found.hashes(), found.rows, window)
            owner = row_of(bounds)
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])
            anchors.append(own[new])
            docs.append(part.column("doc_id").to_numpy()[owner[new]])
        if not anchors:
            continue
        anchor, doc = np.concatenate(anchors), np.concatenate(docs)
        order = np.lexsort((doc, anchor))
        anchor, doc = anchor[order], doc[order]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        anchor, doc = anchor[new], doc[new]
        lead = np.ones(len(anchor), bool)
        lead[1:] = anchor[1:] != anchor[:-1]
        run = np.cumsum(lead) - 1
        many = np.bincount(run, minlength=1)[run] > 1 if len(run) else lead
        route = np.where(lead, anchor, anchor ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)))
        yield pa.RecordBatch.from_pydict({"route": route.view(np.int64), "anchor": anchor.view(np.int64), "doc_id": doc, "known": many, "lead": lead})


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (lead, anchor): those known to repeat, and leads next to an equal anchor."""
    held: pa.RecordBatch | None = None

    def chosen(batch: pa.RecordBatch, before: int | None, after: int | None) -> pa.RecordBatch:
        anchor, lead = batch.column("anchor").to_numpy(), batch.column("lead").to_numpy(zero_copy_only=False)
        known = batch.column("known").to_numpy(zero_copy_only=False).copy()
        same = (anchor[1:] == anchor[:-1]) & lead[1:] & lead[:-1]
        known[1:] |= same
        known[:-1] |= same
        if before is not None and lead[0] and anchor[0] == before:
            known[0] = True
        if after is not None and lead[-1] and anchor[-1] == after:
            known[-1] = True
        return batch.select(["doc_id", "anchor"]).filter(pa.array(known))

    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            leads = held.column("lead")[-1].as_py() and batch.column("lead")[0].as_py()
            yield chosen(held, before, batch.column("anchor")[0].as_py() if leads else None)
            before = held.column("anchor")[-1].as_py() if leads else None
        held = batch
    if held is not None:
        yield chosen(held, before, None)


def _normal(data: np.ndarray, start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows' words joined by one space, as bytes, and each kept byte's place by ``place[old]``."""
    keep = ~IS_SPACE[data]
    inner = np.ones(len(start), bool)
    inner[rows[:-1][np.diff(rows) > 0]] = False
    gaps = start[inner] - 1
    keep[gaps] = True
    out = data.copy()
    out[gaps] = 0x20
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    return out[keep], place


CUT = pa.schema(
    [("doc_id", pa.int64()), ("version", pa.int64()), ("anchor", pa.int64()), ("key", pa.int64()), ("start", pa.int32())]
    + [("words", pa.string()), ("first", pa.int64()), ("n", pa.int64())]
)
CUT_COLUMNS = "doc_id long, version long, anchor long, key long, start int, words string, first long, n long"


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The segments of each document whose anchors are among its repeated ones.

    Where each lies is one kind of row (doc_id, version, anchor, key, start).  What it says is
    the other (anchor, key, words, first, n), once for all documents of a batch, with the least
    document and how often it occurs.
    """
    for batch in batches:
        said: dict[tuple[int, int], list] = {}
        for part in slices(batch):
            found = words(part.column("text"))
            rows = found.rows
            normal, place = _normal(found.data, found.start, rows)
            from_, to = place[found.start], place[found.end]
            own, _, bounds = _window_anchors(found.hashes(), rows, window)
            out: list[tuple] = []
            known = zip(*(part.column(c).to_pylist() for c in ("doc_id", "version", "anchors")), strict=True)
            for row, (doc_id, version, mine) in enumerate(known):
                first = int(rows[row])
                anchors = own[bounds[row] : bounds[row + 1]]
                if not len(anchors):
                    continue
                flagged = np.isin(anchors, np.array(mine, np.int64).view(np.uint64))
                turn = np.ones(len(anchors), bool)
                turn[1:] = (anchors[1:] != anchors[:-1]) | (flagged[1:] != flagged[:-1])
                begins = np.flatnonzero(turn)
                ends = np.append(begins[1:], len(anchors))
                for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
                    if not flagged[begin]:
                        continue
                    anchor = int(anchors[begin : begin + 1].view(np.int64)[0])
                    for s in range(begin, end, SEGMENT_WINDOWS):
                        e = min(end, s + SEGMENT_WINDOWS)
                        text = normal[from_[first + s] : to[first + e + window - 2]].tobytes()
                        key = int.from_bytes(xxhash.xxh64_digest(text), "little", signed=True)
                        out.append((doc_id, version, anchor, key, s, None, None, None))
                        known_as = said.setdefault((anchor, key), [text, doc_id, 0])
                        known_as[1] = min(known_as[1], doc_id)
                        known_as[2] += 1
            yield _rows(out, CUT)
        yield _rows([(None, None, anchor, key, None, text.decode(), first, n) for (anchor, key), (text, first, n) in said.items()], CUT)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)


MATCHED = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("firsts", pa.list_(pa.int64()))])


def _match(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Shards of rows (anchor, key, words, first, n) sorted by anchor and key, each matched by its automaton.

    Rows of one segment come from several batches and are put together.  An anchor with one
    segment has nothing to be matched with: all its windows are the segment's own.
    """

    def matched(shard: list[list]) -> pa.RecordBatch:
        several = {a[0] for a, b in zip(shard, shard[1:], strict=False) if a[0] == b[0]}
        automaton, out, sequences = SuffixAutomaton(), [], []
        for anchor, key, text, first, n in shard:
            if anchor in several:
                sequences.append(text.split(" "))
                automaton.add(sequences[-1], first)
            elif n > 1:
                out.append((anchor, key, [first] * (text.count(" ") + 2 - window)))
        automaton.close()
        rest = (row for row in shard if row[0] in several)
        for sequence, (anchor, key, _, first, n) in zip(sequences, rest, strict=True):
            firsts = automaton.firsts(sequence, window)
            if n > 1 or min(firsts) < first:
                out.append((anchor, key, firsts))
        return _rows(out, MATCHED)

    shard: list[list] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "key", "words", "first", "n")), strict=True):
            if shard and shard[-1][0] == row[0] and shard[-1][1] == row[1]:
                shard[-1][3] = min(shard[-1][3], row[3])
                shard[-1][4] += row[4]
                continue
            if size >= SHARD_WORDS and row[0] != shard[-1][0]:
                yield matched(shard)
                shard, size = [], 0
            shard.append(list(row))
            size += row[2].count(" ") + 1
    if shard:
        yield matched(shard)


def _remove(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            found = words(part.column("text"))
            normal, place = _normal(found.data, found.start, found.rows)
            from_, to = place[found.start], place[found.end]
            removed, sha, left = [], [], []
            for row, starts in enumerate(part.column("starts").to_pylist()):
                first, last = int(found.rows[row]), int(found.rows[row + 1])
                gone = np.zeros(last - first + 1, np.int64)
                if starts:
                    at = np.array(starts, np.int64)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + window, -1)
                keep = np.concatenate([[False], np.cumsum(gone[:-1]) == 0, [False]])
                begins, ends = np.flatnonzero(keep[1:] & ~keep[:-1]), np.flatnonzero(keep[:-1] & ~keep[1:])
                runs = [normal[from_[first + b] : to[first + e - 1]].tobytes() for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
                text = b" ".join(runs)
                removed.append(last - first - int(keep.sum()))
                sha.append(hashlib.sha256(text).hexdigest())
                left.append(text.decode())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": part.column("doc_id"), "n_words": np.diff(found.rows), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": sha, "kept_text": left}
            )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept_text.

    Words are runs of non-space.  A word goes if a window over it also starts in a document
    with a smaller doc_id, as the texts were given.  ``kept_text`` joins the words left by
    one space.  Null and empty texts have no words.  Rows with a null id are neither cut nor
    a reference; rows that repeat an id do not cut one another.  Segments of an anchor that is found in very many surroundings are matched
    window by window, with the same result.  Other columns are not read.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "passages")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("version"))
    rows = texts.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(
        lambda it: _anchor_rows(it, window), "route long, anchor long, doc_id long, known boolean, lead boolean"
    )
    met = rows.repartition("route").drop("route").sortWithinPartitions("lead", "anchor")
    hits = met.mapInArrow(_repeated, "doc_id long, anchor long").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    cut = texts.where("text IS NOT NULL").join(hits, "doc_id").mapInArrow(lambda it: _cut(it, window), CUT_COLUMNS)
    cut = stored(cut, "cut")
    found = cut.where("words IS NULL").select("doc_id", "version", "anchor", "key", "start")
    said = cut.where("words IS NOT NULL").select("anchor", "key", "words", "first", "n")
    segments = said.select("anchor", "key").distinct().groupBy("anchor").agg(F.count("*").alias("n"))
    crowded = stored(segments.where(F.col("n") > ANCHOR_SEGMENTS).select("anchor"), "crowded")
    some_crowded = not crowded.isEmpty()

    quiet = said.join(crowded, "anchor", "left_anti") if some_crowded else said
    shards = quiet.repartition("anchor").sortWithinPartitions("anchor", "key")
    matched = stored(shards.mapInArrow(lambda it: _match(it, window), "anchor long, key long, firsts array<long>"), "matched")
    starts = F.filter(F.transform("firsts", lambda first, i: F.when(first < F.col("doc_id"), F.col("start") + i)), lambda x: x.isNotNull())
    spans = found.join(matched, ["anchor", "key"]).select("doc_id", "version", starts.alias("starts"))

    if some_crowded:
        split = F.split("words", " ")
        each = F.transform(F.sequence(F.lit(0), F.size(split) - window), lambda i: F.concat_ws(" ", F.slice(split, i + 1, window)))
        told = said.join(crowded, "anchor", "left_semi").groupBy("anchor", "key").agg(F.min(F.struct("words", "first")).alias("t"))
        told = stored(told.select("anchor", "key", "t.*"), "told")
        single = told.select("first", F.explode(each).alias("words"))
        single = stored(single.groupBy("words").agg(F.min("first").alias("first")), "windows")
        own = found.join(told.drop("first"), ["anchor", "key"]).select("doc_id", "version", "start", F.posexplode(each).alias("i", "words"))
        own = own.join(single, "words").where("first < doc_id")
        spans = spans.unionByName(own.select("doc_id", "version", F.array(F.col("start") + F.col("i")).alias("starts")))

    spans = spans.where(F.size("starts") > 0).groupBy("doc_id", "version").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    return texts.join(spans, ["doc_id", "version"], "left").select("doc_id", "text", "starts").mapInArrow(
        lambda it: _remove(it, window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
