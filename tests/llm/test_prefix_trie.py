"""The conversation trie against prefixes listed one by one."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from odd import SF_DIR
from tallymart.llm import prefix_trie
from tallymart.llm import queries as Q
from tallymart.llm.common import table

COLUMNS = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _nodes(sequences):
    """sequences: {conv: [(role, text)]}"""
    members, ends = defaultdict(set), defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(conv)
        ends[tuple(turns)].append(conv)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += own
    return sorted(
        (len(node), min(m), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, m in members.items())


def _rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def _sequences(rows):
    """In order of turn, NULL first; rows of equal turn must not occur."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in out.items()}


def _branched(sequences):
    out = {}
    for c, turns in sequences.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = sequences.get(c - c % 100, [])[:h] + turns[h:]
    return out


SCHEMA = "conv_id int, turn bigint, role string, text string, depth string, prior string, hi string"


@pytest.fixture(scope="module")
def odd_turns():
    rows = []
    for c in (*range(0, 12), 100, 101, 130, 205, 299):
        for t in range((c * 7) % 11):
            rows.append((c, t, "user" if t % 2 else None, f"text é😀 {t}" if c % 3 else (None if t == 2 else "same"), "x", None, "h"))
    rows += [(1000, t, "u", f"long {t // 3}", "x", None, "h") for t in range(70)]
    rows += [(1001, t, "u", f"long {t // 3}" if t < 50 else "other", "x", None, "h") for t in range(61)]
    rows += [(1002, t, "u", f"long {t // 3}", "x", None, "h") for t in range(24)]
    rows += [(1003, None, "u", "long 0", None, None, None), (1003, -5, "u", "long 0", None, None, None),
             (None, 1, "u", "lost", None, None, None), (-7, 1, "u", "below zero", None, None, None),
             (5, None, "s", "w " * 40_000, None, None, None)]
    return rows


@pytest.mark.parametrize("run", [1024, 2])
def test_odd_conversations(spark, odd_turns, monkeypatch, run):
    monkeypatch.setattr(prefix_trie, "RUN", run)
    frame = spark.createDataFrame(odd_turns, SCHEMA).repartition(5)
    want = _nodes(_sequences([r[:4] for r in odd_turns]))
    assert _rows(prefix_trie.conversation_trie(frame)) == want


def test_branched_conversations(spark, odd_turns):
    frame = spark.createDataFrame(odd_turns, SCHEMA).filter("conv_id >= 0").repartition(3)
    sequences = _branched(_sequences([r[:4] for r in odd_turns if r[0] is not None and r[0] >= 0]))
    assert any(not s for s in sequences.values())  # some have no turn left
    assert _rows(prefix_trie.trie(*Q._branched(frame))) == _nodes(sequences)


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = Q.op11_conversation_trie(spark, SF_DIR)
    assert dict(got.dtypes) == {c: "string" if c == "ends_sha256" else "bigint" for c in COLUMNS}
    assert _rows(got) == _nodes(_branched(_sequences(rows)))


def test_equal_turns_and_repeats(spark):
    rows = [(1, 3, "u", "b"), (1, 3, "u", "a"), (1, 3, "u", "a"), (2, 3, "u", "a"), (2, 3, "u", "b"), (2, 3, "u", "a")]
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert sorted((r.depth, r.n_convs, r.n_children) for r in got) == [(0, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 0)]
    assert {r.saved_tokens for r in got if r.depth == 0} == {3}


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.conversation_trie(empty).count() == 0
    lost = spark.createDataFrame([(None, 1, "a", "b")], "conv_id int, turn int, role string, text string")
    assert prefix_trie.conversation_trie(lost).count() == 0
