"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to a fixed depth.  A context gives a byte
that it has seen its share of the context's count, and leaves the escape share (method
C: distinct bytes over count plus distinct bytes) to the next shorter context, spread
over the bytes not seen here; the shortest falls back to even odds.  Statistics are
frozen after training, so the code length of a byte depends on its context alone and is
tabulated once: the trees of all languages become one automaton whose state is the
longest known context, with a code length per language on every edge.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.arrays import slices, text_buffers

#: Longest context in bytes.
DEPTH = 3
#: The training sample: about so many documents of each language, by a hash of the id, and so many bytes of each.
TRAIN_DOCS = 400
TRAIN_BYTES = 1 << 16
#: Contexts kept in the automaton, the most frequent ones; bounds what is broadcast.
MAX_CONTEXTS = 16_000
#: Bytes that are scored as one run; runs of all texts advance side by side.
RUN = 256
UNDETERMINED = "und"


def _gram_counts(batches: Iterator[pa.RecordBatch], depth: int, most: int) -> Iterator[pa.RecordBatch]:
    """Counts of (language, order, context and byte packed in a long)."""
    for batch in batches:
        for part in slices(batch):
            data, offs = text_buffers(part.column("text"))
            for row, lang in enumerate(part.column("lang").to_pylist()):
                text = data[offs[row] : min(offs[row + 1], offs[row] + most)].astype(np.int64)
                for order in range(depth + 1):
                    if len(text) <= order:
                        break
                    gram = np.zeros(len(text) - order, np.int64)
                    for k in range(order + 1):
                        gram = gram << 8 | text[k : len(text) - order + k]
                    values, n = np.unique(gram, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": [lang] * len(n), "order": pa.array([order] * len(n), pa.int32()), "gram": values, "n": n})


@dataclass
class Model:
    """``move[state, byte class]`` and ``cost[state, byte class, language]`` in bits; the last class is padding."""

    langs: list[str]
    classes: np.ndarray
    move: np.ndarray
    cost: np.ndarray
    depth: int


def build_model(counts: dict[str, list[np.ndarray]], depth: int = DEPTH, max_contexts: int = MAX_CONTEXTS) -> Model:
    """``counts``: for each language and order the rows (gram, n)."""
    langs = sorted(counts)
    seen = np.unique(np.concatenate([c[0][:, 0] for c in counts.values()] or [np.zeros(0, np.int64)]))
    classes = np.full(256, len(seen), np.uint8 if len(seen) < 255 else np.int16)
    classes[seen] = np.arange(len(seen))
    width = len(seen) + 1  # one class for all bytes never seen
    names: dict[tuple[int, int], int] = {(0, 0): 0}
    total: dict[tuple[int, int], int] = {}
    for per in counts.values():
        for order in range(1, depth + 1):
            context, at = np.unique(per[order][:, 0] >> 8, return_inverse=True)
            n = np.bincount(at, per[order][:, 1], len(context))
            for c, k in zip(context.tolist(), n.tolist(), strict=True):
                total[order, c] = total.get((order, c), 0) + k
    often = sorted((key for key, n in total.items() if n > 1 or key[0] == 1), key=lambda key: (key[0] > 1, -total[key], key))[: max_contexts - 1]
    kept = set(often)
    for order, c in sorted(kept):  # shorter contexts first; a context needs its suffix
        if order == 1 or (order - 1, c & (1 << 8 * (order - 1)) - 1) in names:
            names[order, c] = len(names)
    cost = np.zeros((len(names), width + 1, len(langs)), np.float32)
    suffix = np.zeros(len(names), np.int64)
    by_order = [[(c, s) for (o, c), s in names.items() if o == order] for order in range(depth + 1)]
    for order in range(1, depth + 1):
        for c, s in by_order[order]:
            suffix[s] = names[order - 1, c & (1 << 8 * (order - 1)) - 1] if order > 1 else 0
    for k, lang in enumerate(langs):
        odds = np.full((len(names), width), 1 / width)
        for order in range(depth + 1):
            states = np.array([s for _, s in by_order[order]], np.int64)
            if not len(states):
                continue
            base = odds[suffix[states]] if order else odds[states]
            place = {s: i for i, s in enumerate(states.tolist())}
            found = np.zeros((len(states), width))
            rows = counts[lang][order]
            where = np.array([place.get(names.get((order, c), -1), -1) for c in (rows[:, 0] >> 8).tolist()], np.int64)
            known = where >= 0
            np.add.at(found, (where[known], classes[rows[known, 0] & 255].astype(np.int64)), rows[known, 1])
            n, kinds = found.sum(1, keepdims=True), (found > 0).sum(1, keepdims=True)
            rest = np.maximum(1 - np.where(found > 0, base, 0).sum(1, keepdims=True), 1e-12)
            own = np.where(found > 0, found / np.maximum(n + kinds, 1), kinds / np.maximum(n + kinds, 1) * base / rest)
            odds[states] = np.where(n > 0, own, base)
        cost[:, :width, k] = -np.log2(np.maximum(odds, 1e-12))
    move = np.zeros((len(names), width + 1), np.int32)
    for (order, c), s in names.items():
        follow = move[suffix[s]].copy() if order else move[0]
        for b in seen.tolist():
            longer = names.get((order + 1, c << 8 | b)) if order < depth else None
            if longer is not None:
                follow[classes[b]] = longer
        move[s] = follow
    return Model(langs, classes, move, cost, depth)


def train(docs: DataFrame, depth: int = DEPTH, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> Model:
    """Fit the trees on a sample of rows with a language, taken by a hash of the id.

    Each language gives about ``train_docs`` documents, the first ``train_bytes`` bytes of
    each.  What reaches the driver is the table of byte runs seen in this sample.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(train_docs / n)).otherwise(share)
    sample = known.where(drawn < share).select("lang", "text")
    counted = sample.mapInArrow(lambda it: _gram_counts(it, depth, train_bytes), "lang string, order int, gram long, n long")
    table = counted.groupBy("lang", "order", "gram").agg(F.sum("n").alias("n")).toArrow()
    lang, order = np.array(table["lang"].to_pylist(), object), table["order"].to_numpy()
    rows = np.stack([table["gram"].to_numpy(), table["n"].to_numpy()], 1) if table.num_rows else np.zeros((0, 2), np.int64)
    return build_model({name: [rows[(lang == name) & (order == o)] for o in range(depth + 1)] for name in sorted(set(lang))}, depth)


def code_lengths(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each whole text under each language, and its length in bytes."""
    data, offs = text_buffers(texts)
    size = np.diff(offs)
    runs = -(-size // RUN)
    row = np.repeat(np.arange(len(size)), runs)
    first = np.cumsum(runs) - runs
    start = (np.arange(len(row)) - first[row]) * RUN
    pad = model.move.shape[1] - 1
    padded = np.concatenate([np.full(model.depth, pad, np.int64), model.classes[data], np.full(RUN, pad, np.int64)]).astype(np.int32)
    langs = len(model.langs)
    bits = np.zeros((len(row), langs))
    cost, move = model.cost.reshape(-1, langs), model.move.reshape(-1)
    state = np.zeros(len(row), np.int64)
    left = size[row] - start
    base = offs[row] + start  # in ``padded`` this is ``depth`` before the run
    for step in range(-model.depth, RUN):
        byte = padded[base + step + model.depth]
        if step < 0:  # the run's context; a text's first run has none
            byte = np.where(start + step >= 0, byte, pad)
        else:
            byte = np.where(step < left, byte, pad)
        edge = state * (pad + 1) + byte
        if step >= 0:
            bits += cost[edge]
        state = move[edge].astype(np.int64)
    out = np.zeros((len(size), langs))
    np.add.at(out, row, bits)
    return out, size


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: its columns doc_id and bits_per_byte, lang_pred, score.

    ``score`` is the posterior of the language under even priors.  Texts that are null or
    have no letter are ``und`` with score 0, and so is everything if no language was
    learned.  Ties go to the first language by name.  Whole texts are scored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in slices(batch):
                letter = np.array(part.column("letter").to_pylist(), bool)
                if model.langs:
                    bits, size = code_lengths(model, part.column("text"))
                    best = bits.argmin(1)
                    low = bits[np.arange(len(best)), best]
                    odds = 1 / np.exp2(np.clip(low[:, None] - bits, -1000, 0)).sum(1)
                    names = np.where(letter, np.array(model.langs, object)[best], UNDETERMINED)
                    rate = low / np.maximum(size, 1)
                else:
                    odds, rate, names = np.zeros(len(letter)), np.zeros(len(letter)), np.full(len(letter), UNDETERMINED, object)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": np.where(letter, odds, 0.0), "bits_per_byte": rate}
                )

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", letter)
    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double, bits_per_byte double")


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether a document is kept from training: one in five, by a checksum of the id (a null id is)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))
