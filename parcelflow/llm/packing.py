"""Pack documents into token sequences by best-fit decreasing.

Documents are tokenized where they are read; only pieces (id, start, length, checksum)
are shuffled.  A document longer than a window is first cut into full windows, which are
sequences of their own; the pieces left are packed in groups of bounded size, longest
first, each into the open window that it fills most tightly.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.arrays import slices
from parcelflow.session import work_dir

WINDOW = 2048
END_ID = 1
#: Pieces packed together.  The windows left open at the end of a group are the padding.
GROUP_PIECES = 4096
#: Pre-tokens whose ids a Python worker remembers before it starts anew, and their longest.
REMEMBERED = 1 << 19
REMEMBERED_CHARS = 64

#: The split rule of the vocabulary's byte-level pre-tokenizer, with its classes
#: of letters, digits and white space spelled out for the characters up to U+024F.
LETTERS = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
DIGITS = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
SPACES = "\\t\\n\\r \\xa0"
PRE_TOKENS = f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{SPACES}{LETTERS}{DIGITS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
#: Characters for which the rule above is not known to hold.
OTHERS = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa0-\\u024f]")

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """How the byte-level vocabulary spells bytes: printable ones as themselves, the others by the letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids as the tokenizer gives them for whole texts, at the cost of its new pre-tokens.

    A pre-token is encoded once by the tokenizer's model and its ids are remembered, since
    text repeats its words.  Texts with ``OTHERS`` or with the string of an added token,
    which has an id of its own, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.split = re.compile(PRE_TOKENS).findall
        self.known: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model(spelled)])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit values."""
        if OTHERS.search(text) or any(x in text for x in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, parts = self.known, self.split(text)
        try:
            return b"".join(map(known.__getitem__, parts))
        except KeyError:
            new = {x: self._piece(x) for x in set(parts) if x not in known}
            known.update((x, ids) for x, ids in new.items() if len(x) <= REMEMBERED_CHARS)
            return b"".join([known[x] if x in known else new[x] for x in parts])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    ids_of, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for part in slices(batch):
            rows: list[tuple] = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                ids = ids_of(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), PIECES, strict=True)], schema=PIECES)


def token_pieces(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: each document cut into windows, the rest last."""
    path = tokenizer or default_tokenizer()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda it: _pieces(it, path, window, end_id), schema)


class OpenWindows:
    """A segment tree over remaining capacities: how many open windows each range holds."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, window: int, capacity: int) -> None:
        if capacity:
            self.windows[capacity].append(window)
            self._change(capacity, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the window with the least capacity that is at least ``length``, and that capacity."""
        count, node = self.count, length + self.leaves
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):  # up to the first range to the right that holds one
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._change(capacity, -1)
        return self.windows[capacity].pop(), capacity


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; ``lengths`` must not increase."""
    tree, opened = OpenWindows(window), 0
    at, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        found = tree.tightest(length)
        if found is None:
            found, opened = (opened, window), opened + 1
        at[i], offset[i] = found[0], window - found[1]
        tree.put(found[0], found[1] - length)
    return at, offset


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone.  Pieces of a sequence lie side by side from
    offset 0.  Rows that repeat an id are packed each.  A group takes its pieces by a hash
    of id and start and sorts them, so a repeated task packs alike.  Memory holds one group
    and one text with its ids.  Other columns are not read.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "pack")
    token_pieces(docs, tokenizer, window, end_id).write.parquet(f"{folder}/pieces")
    pieces = spark.read.parquet(f"{folder}/pieces")
    groups = -(-pieces.count() // group_pieces) or 1

    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], na_position="last", kind="stable")
        at, offset = best_fit_decreasing(rows["length"].to_numpy(), window)
        return rows.assign(sequence_id=(rows["group"].to_numpy() << 32) + at, offset=offset).drop(columns="group")

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    grouped = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "start"), F.lit(groups)).cast("long"))
    return grouped.groupBy("group").applyInPandas(pack_group, schema)
