"""The corpus pipeline, stage after stage, against brute force on a small table of documents."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelflow.llm import lines, mixing, packing
from parcelflow.session import work_dir
from tests.llm.test_operators import SCHEMA, WORD, distance, least_reachable, lowered, prose


@pytest.fixture(scope="module")
def stages(spark):
    """The input and what each stage left, as ``run`` writes and reads them again."""
    rng = random.Random(8)
    texts = ["\n".join(prose(rng, rng.randint(4, 9)) for _ in range(rng.randint(2, 6))) for _ in range(50)]
    texts += [texts[k] for k in (3, 3, 7)] + [t + " " + prose(rng, 1) for t in texts[10:16]]
    shared = "A line that stands in a number of the documents of this table."
    texts += [f"{prose(rng, 20)}\n{shared[: 40 + k]}{shared[40 + k :].upper() if k == 5 else shared[40 + k :]}\n{prose(rng, 15)}" for k in range(8)]
    texts += [None, "", " \n ", "12345 67 !?", prose(rng, 4000)]
    rows = [(i, t, rng.choice(["en", "fr"]), rng.choice(["a", "b", "b", None]), len(t or "")) for i, t in enumerate(texts)]
    folder = work_dir(spark, "pipeline-test")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        stage(spark, docs, folder).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return folder, [*out, docs]


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns_of_documents(stages):
    _, tables = stages
    assert [len(corpus_pipeline.STAGES), *[t.columns for t in tables[1:-1]]] == [5, *[tables[0].columns] * 4]


def test_language_rejects_what_has_no_letter(stages):
    _, tables = stages
    before, after = texts_of(tables[0]), texts_of(tables[1])
    assert after == {i: t for i, t in before.items() if t is not None and any(c.isalpha() for c in t)}


def test_lines_go_as_brute_force_says(stages):
    _, tables = stages
    before, first = texts_of(tables[1]), {}
    for i in sorted(before):
        for p, line in enumerate(before[i].split("\n")):
            if len(line) >= lines.EXACT_CHARS:
                first.setdefault(line, (i, p))
    near = dict(first)
    for a in first:
        for b in first:
            if min(len(a), len(b)) >= lines.NEAR_CHARS and abs(len(a) - len(b)) <= lines.MAX_EDITS and first[b] < near[a] and distance(a, b) <= lines.MAX_EDITS:
                near[a] = first[b]
    want = {i: "\n".join(x for p, x in enumerate(t.split("\n")) if len(x) < lines.EXACT_CHARS or (i, p) <= near[x]) for i, t in before.items()}
    assert texts_of(tables[2]) == want and want != before


def test_one_document_of_each_group_stays(stages):
    _, tables = stages
    before, sets = texts_of(tables[2]), {}
    for i, t in before.items():
        w = WORD.findall(lowered(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    top = least_reachable(list(sets), links)
    assert texts_of(tables[3]) == {i: t for i, t in before.items() if top[i] == i}


def test_sources_meet_their_targets(stages):
    _, tables = stages
    before, words = tables[3], F.sum(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(mixing.WORD))).cast("long")
    targets = {r.source: r.target for r in mixing.mix_sources(before).select("source", "target").distinct().collect()}
    taken = {r.source: r.n for r in tables[4].groupBy("source").agg(words.alias("n")).collect()}
    for source, target in targets.items():
        assert abs(taken.get(source, 0) - target) <= 1
    own, copies = texts_of(before), defaultdict(int)
    for r in tables[4].collect():
        copies[r.doc_id] += len(WORD.findall(r.text or ""))
    assert all(n <= 3 * len(WORD.findall(own[i])) for i, n in copies.items())


def test_packed_sequences_hold_all_tokens(spark, stages):
    folder, tables = stages
    encode = packing.Encoder(packing.default_tokenizer()).tokenizer.encode
    ids = defaultdict(list)
    for r in tables[4].collect():
        ids[r.doc_id].append(np.array([*encode(r.text or "", add_special_tokens=False).ids, 1], "<u4"))
    pieces, sequences = tables[5].collect(), defaultdict(list)
    assert sum(p.length for p in pieces) == sum(len(x) for own in ids.values() for x in own)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for x in ids[p.doc_id])
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    assert len(corpus_pipeline.run(spark, folder).collect()) == len(pieces)
