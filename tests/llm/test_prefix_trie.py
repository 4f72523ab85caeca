"""The conversation trie against one built turn by turn in Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from parcelflow.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth string, p string, _range string"


def brute_force(rows, rebuild=True):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        full[c] = own.get(c - c % 100, [])[:h] + turns[h:] if rebuild else turns
    members, ends, children = defaultdict(set), defaultdict(list), defaultdict(set)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    out, leaves, saved = set(), {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        listed = ",".join(map(str, sorted(ends[node])))
        parent = min(members[node[:-1]]) if node else None
        out.add((min(members[node]), len(node), parent, len(members[node]), len(below), leaves[node], saved[node], hashlib.sha256(listed.encode()).hexdigest()))
    return out


def feed(seed):
    rng = random.Random(seed)
    words = ["hello", "", None, "é ü", "x" * 30]
    rows = []
    for conv in [*range(0, 130), *range(200, 230), 777, 100_000_000_000]:
        n = rng.choice([1, 2, 3, 4, 6, 9, 20])
        shared = rng.random() < 0.6
        for turn in range(n):
            text = "shared" + str(turn) if shared and turn < 5 else rng.choice(words) or str(rng.random())
            rows.append((conv, turn, rng.choice(["user", None]) if not shared else "user", text))
    rows += [(300 + i, t, "user", f"copy {t}") for i in range(40) for t in range(10)]  # copies of one long conversation
    rows += [(340 + i, t, "user", f"copy {t}" if t < 9 else f"{i}") for i in range(3) for t in range(11)]
    rows += [(400, t, "user", f"long {t}") for t in range(300)]
    rows += [(None, 1, "user", "nobody"), (5, None, "user", "before all"), (6, 90, None, None)]
    rng.shuffle(rows)
    return [(*r, "mine", "mine", "mine") for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rows = feed(seed)
    got = prefix_trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == brute_force(rows)


def test_trie_of_conversations_as_they_are(spark):
    rows = feed(3)
    got = prefix_trie.shared_beginnings(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert {tuple(r) for r in got} == brute_force(rows, rebuild=False) and len(got) == len({tuple(r) for r in got})


def test_long_member_lists_pass_in_pieces(spark):
    ids = [7, -3, 10**15, *range(100, 900)]
    rows = [(1, 2, 3, i, 50) for i in ids] + [(1, 2, 4, 8, 9)]
    random.Random(1).shuffle(rows)
    got = prefix_trie.endings(spark.createDataFrame(rows, "p long, q long, depth long, conv_id long, sum_chars long"), chars=100).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(tuple(r)[2:] for r in got) == [(3, -3, len(ids), 50, digest(",".join(map(str, sorted(ids))))), (4, 8, 1, 9, digest("8"))]


def test_trie_of_nothing(spark):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([(None, 1, "a", "b", "", "", "")], SCHEMA)).count() == 0


def test_equal_turns_have_one_order(spark):
    rows = [(1000, 1, "user", t, "", "", "") for t in "abcdefgh"] + [(1000, 1, "user", "a", "", "", "")]
    results = []
    for parts in (1, 5):
        got = prefix_trie.shared_beginnings(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
        results.append(sorted(map(tuple, got), key=str))
    assert results[0] == results[1] and len(results[0]) == 10


def test_query_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = queries.QUERIES["op13_prefix_trie"](spark, path).collect()
    assert {tuple(r) for r in got} == brute_force(rows) and len(got) == len({tuple(r) for r in got})
