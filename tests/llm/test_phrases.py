"""Phrases against a plain count of every run of words."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd import SF_DIR, no_docs, odd_docs  # noqa: F401
from tallymart.llm import phrases
from tallymart.llm.common import table
from tallymart.llm.rolling import Spans

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def _brute(rows, least, longest=5, best=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(ws)
            for m in range(1, longest + 1):
                for i in range(len(ws) - m + 1):
                    f[lang, tuple(ws[i:i + m])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    held = Counter()
    for (lang, ws), a in found.items():
        for m in range(2, len(ws)):
            for i in range(len(ws) - m + 1):
                key = lang, ws[i:i + m]
                held[key] = max(held[key], a)
    out = {}
    for (lang, ws), a in found.items():
        if 100 * held[lang, ws] >= 100 * a:
            continue
        cuts = []
        for k in range(1, len(ws)):
            l, r = f[lang, ws[:k]], f[lang, ws[k:]]
            cuts.append((1000 * a * n[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, items in out.items() for rank, (score, a, p, l, r) in enumerate(sorted(items)[:best], 1))


def _rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("least, longest, best", [(5, 5, 2000), (3, 3, 7)])
def test_given_documents(spark, least, longest, best):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r.text, r.lang) for r in docs.collect()]
    got = _rows(phrases.collocations(docs.repartition(5), least, longest, best))
    assert got == _brute(rows, least, longest, best) and got


def test_odd_documents(spark, odd_docs, no_docs):
    more = spark.createDataFrame(
        [("a b a b a b. a b", None), ("A\tB  c; é B c", "und"), ("x" * 3, ""), (". ! \n", ""), ("b c", "fr"), (None, "fr")],
        "text string, lang string").withColumn("rank", F.lit("old")).withColumn("phrase", F.lit("old"))
    both = odd_docs.select("text", "lang").unionAll(more.select("text", "lang"))
    rows = [(r.text, r.lang) for r in both.collect()]
    assert _rows(phrases.collocations(both, 2)) == _brute(rows, 2)
    got = _rows(phrases.collocations(more.union(more), 2))
    assert got == _brute([(r.text, r.lang) for r in more.collect()] * 2, 2)
    assert phrases.collocations(no_docs, 1).count() == 0


def test_chunks_do_not_change_counts(spark, monkeypatch):
    docs = table(spark, SF_DIR, "documents").limit(60)
    want = _brute([(r.text, r.lang) for r in docs.collect()], 4)
    monkeypatch.setattr(phrases, "CHUNK", 700)
    monkeypatch.setattr(phrases, "HELD", 300)
    assert _rows(phrases.collocations(docs, 4)) == want


def test_collisions_are_set_apart(spark, monkeypatch):
    """With fingerprints of three bits nearly all runs collide; the result stays the same."""
    docs = table(spark, SF_DIR, "documents").limit(25)
    want = _brute([(r.text, r.lang) for r in docs.collect()], 3)
    exact = phrases.mixed

    def poor(values):
        return exact(values) & np.uint64(7)

    monkeypatch.setattr(phrases, "mixed", poor)
    monkeypatch.setattr(Spans, "of", lambda self, start, end: poor(self.prefix[end] - self.prefix[start]))
    assert _rows(phrases.collocations(docs, 3)) == want


def test_spans_depend_on_content_only():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 4, 3000).astype(np.uint8)
    spans = Spans(a)
    start = rng.integers(0, 2900, 4000)
    end = start + rng.integers(0, 8, 4000)
    seen = {}
    for s, e, h in zip(start.tolist(), end.tolist(), spans.of(start, end).tolist()):
        assert seen.setdefault(a[s:e].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_products_past_64_bits(spark):
    """A score from counts whose products need more than 64 bits."""
    rows = spark.createDataFrame([(4 * 10 ** 9, 3 * 10 ** 13, 5 * 10 ** 9, 10 ** 10)], "a bigint, total bigint, l bigint, r bigint")
    got = rows.select(F.expr(phrases.SCORE).alias("s")).first()["s"]
    assert got == 1000 * 4 * 10 ** 9 * 3 * 10 ** 13 // (5 * 10 ** 9 * 10 ** 10)
