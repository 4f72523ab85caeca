"""Secrets in text: fixed patterns, and values that would be hard to guess.

Values that stand in a credential's context are judged by their guess cost: the cheapest
way to write the value as words, dates, repeats, keyboard walks and spans that must be
searched by brute force, found by dynamic programming over its positions.  A value that
costs enough is a secret even where no fixed pattern fits.  Where prose may follow the
keyword a value is scored only if it does not look like a word: after a bare space it needs
a digit, after "is" or "was" something besides lower-case letters behind its first character.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.arrays import slices

#: The base patterns, in the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: Contexts in which a value is taken for a credential: the separator as group 1, the value as group 2, that of a URL as group 3.
CONTEXTS = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|auth(?:orization)?|bearer|api[_\x20-]?key|access[_\x20-]?key|private[_\x20-]?key|client[_\x20-]?secret)"""
    r"""(?:[_\x20-]?(?:key|value|code|string|phrase|hash|text|data|number))*"""
    # runs of spaces are taken whole, so that long ones are read once
    r"""["']?\x20*+([:=]+>?|(?<=\x20)(?:is|was)\x20|(?<=\x20)bearer\x20|(?<=\x20))\x20*+(?:(?:bearer|basic)\x20++)?["']?([^\s"'<>,;]+)|://[^\s/:@]+:([^\s/@]+)@""",
    re.ASCII | re.IGNORECASE,
)
CONTEXT_WORDS = ("pass", "pwd", "pin", "secret", "token", "credential", "auth", "bearer", "key", "://")
#: Separators after which prose may follow, and what a value must have there to be scored.
PROSE = {" ": re.compile("[0-9]"), "is": re.compile("(?<=.)[^a-z]"), "was": re.compile("(?<=.)[^a-z]")}
GUESS_LEAST = 8
#: Bits of guessing from which a value counts as a secret.
GUESS_BITS = 40.0

#: Words common in passwords, the most common first.
COMMON = (
    "password pass admin user login welcome letmein master secret token test guest root hello love dragon monkey "
    "football baseball sunshine princess shadow summer winter spring autumn money star magic super change default "
    "key private public server system access account example sample demo temp changeme qwerty abc access "
    "the and for you with from this that have not are was but all can her has had his one our out day get "
    "january february march april may june july august september october november december monday tuesday friday sunday"
).split()
WORDS = {w: rank for rank, w in reversed(list(enumerate(COMMON, 1)))}
LONGEST_WORD = max(map(len, WORDS))
LEET = str.maketrans("43105$@7", "aeiossat")
#: Rows of the keyboard.
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
NEAR = {frozenset((a, b)) for row in KEY_ROWS for a, b in zip(row, row[1:], strict=False)} | {
    frozenset((a, b)) for up, down in zip(KEY_ROWS, KEY_ROWS[1:], strict=False) for i, b in enumerate(down) for a in up[i : i + 2]
}
DATE = re.compile(r"(?:(?:19|20)\d\d)[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:[12]\d|3[01]|0?[1-9])|(?:[12]\d|3[01]|0?[1-9])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
DATE_BITS, YEAR_BITS = math.log2(365 * 120), math.log2(120)


def _alphabet_bits(value: str) -> float:
    """Bits of one character searched by brute force, by the kinds of characters in the value."""
    size = 26 * bool(re.search("[a-z]", value)) + 26 * bool(re.search("[A-Z]", value)) + 10 * bool(re.search("[0-9]", value))
    size += 33 * bool(re.search("[^A-Za-z0-9]", value))
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", value):
        size = 16 if re.search("[a-fA-F]", value) else 10
    return math.log2(max(size, 2))


def guess_bits(value: str) -> float:
    """Bits of the cheapest segmentation of ``value``.

    Repeats and walks are taken as their longest runs and every cut of these, words up to
    the longest known, so the work is linear in the length of the value.
    """
    n = len(value)
    if not n:
        return 0.0
    low = value.lower()
    plain = low.translate(LEET) if len(low.translate(LEET)) == n else low
    per_char = _alphabet_bits(value)
    cost = [0.0] + [math.inf] * n

    def reach(end: int, bits: float) -> None:
        if bits < cost[end]:
            cost[end] = bits

    same = [1] * n  # length of the run of equal characters, and of the walk, that end here
    walk = [1] * n
    for i in range(1, n):
        same[i] = same[i - 1] + 1 if value[i] == value[i - 1] else 1
        walk[i] = walk[i - 1] + 1 if frozenset((low[i], low[i - 1])) in NEAR else 1
    period = [[0] * n for _ in range(5)]  # for periods 2 to 4: how far a repeat of the period reaches back
    for p in (2, 3, 4):
        for i in range(p, n):
            period[p][i] = period[p][i - 1] + 1 if value[i] == value[i - p] else 0
    dates: dict[int, list[int]] = {}
    for start in (i for i in range(n) if value[i].isdigit()):
        if m := DATE.match(value, start, start + 10):
            dates.setdefault(m.end(), []).append(start)
    for end in range(1, n + 1):
        last = end - 1
        reach(end, cost[last] + per_char)
        if same[last] >= 3:
            reach(end, cost[end - same[last]] + per_char + math.log2(same[last]))
        if walk[last] >= 3:
            reach(end, cost[end - walk[last]] + math.log2(40) + 2.0 * math.log2(walk[last]))
        for p in (2, 3, 4):
            if period[p][last] >= p:
                length = period[p][last] + p
                reach(end, cost[end - length] + p * per_char + math.log2(length / p))
        for start in dates.get(end, ()):
            reach(end, cost[start] + (DATE_BITS if end - start > 4 else YEAR_BITS))
        for size in range(3, min(LONGEST_WORD, end) + 1):
            start = end - size
            rank = WORDS.get(low[start:end])
            bits = None if rank is None else math.log2(rank) + 1
            if bits is None and (rank := WORDS.get(plain[start:end])) is not None:
                bits = math.log2(rank) + 3
            if bits is not None:
                case = 0 if value[start:end].islower() or value[start:end].isupper() else 1 if value[start + 1 : end].islower() else size / 2
                reach(end, cost[start] + bits + case)
    return cost[n]


def _scored(value: str, separator: str | None) -> bool:
    needed = PROSE.get(":" if separator is None else separator.strip().lower() or " ")
    return len(value) >= GUESS_LEAST and (needed is None or needed.search(value) is not None)


def find_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and added spans as (start, kind, end) in code points."""
    base = []
    low = text.lower() if text.isascii() else None
    if low is None or any(w in low for w in ("pass", "secret", "token", "api")):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    added = []
    if low is None or any(w in low for w in CONTEXT_WORDS):
        at, ordered = 0, sorted(base)
        starts, reach = [s for s, _, _ in ordered], list(accumulate((e for _, _, e in ordered), max))
        while m := CONTEXTS.search(text, at):
            start, end = m.span(2) if m[2] is not None else m.span(3)
            value = text[start:end].rstrip(".)")
            before = bisect_right(starts, start)
            covered = before > 0 and start + len(value) <= reach[before - 1]
            found = not covered and _scored(value, m[1]) and guess_bits(value) >= GUESS_BITS
            if found:
                added.append((start, 3, start + len(value)))
            at = end if covered or found else start  # a value that is none may be the next keyword
    return sorted(base), added


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_guess", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("least_bits", pa.float64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                text = text.as_py() or ""
                base, added = find_spans(text)
                counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
                values = [m[2] for s, kind, _ in base if kind == 0 and (m := ASSIGN.match(text, s))]
                values += [text[s:e] for s, _, e in added]
                weakest = min(map(guess_bits, values)) if values else None
                rows.append((doc_id, *counts, len(added), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + added), weakest))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans, least_bits.

    ``spans`` lists kind:start:end of the base patterns and of the added ``guess`` spans,
    by start and kind; ``least_bits`` is the guess cost of the weakest credential value
    (null if there is none).  Null and empty texts have no spans.  Matches of one kind do
    not overlap; a value that a base span covers whole is not added, one that it covers in
    part is added whole.  Repeated rows give repeated
    results.  Whole texts are scanned where they are read, without a shuffle.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string, least_bits double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, schema)


def redact(text: str) -> str:
    """``text`` with every span replaced by its kind."""
    base, added = find_spans(text)
    out, at = [], 0
    for start, kind, end in sorted(base + added):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
