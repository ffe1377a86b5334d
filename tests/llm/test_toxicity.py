"""Toxicity: held-out accuracy on planted words, the label model on planted voters, odd tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd import SF_DIR, no_docs, odd_docs  # noqa: F401
from tallymart.llm import queries as Q
from tallymart.llm import toxicity


@pytest.fixture(scope="module")
def planted(spark):
    """1,800 texts; a fifth has words of one of two bad stems. Two labels in a hundred are wrong."""
    rng = random.Random(4)
    plain = ["".join(rng.choice("abcdeiou") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    rows = []
    for i in range(1800):
        words = [rng.choice(plain) for _ in range(rng.randint(8, 200))]
        bad = rng.random() < 0.2
        if bad:
            stem = rng.choice(["zwurk", "quöxel"])
            for _ in range(rng.randint(2, 3 + len(words) // 40)):
                words.insert(rng.randrange(len(words)), stem + rng.choice(["", rng.choice(plain)]))
        label = int(bad) if rng.random() > 0.02 else 1 - int(bad)
        rows.append((i, " ".join(words).capitalize() + ".", label if rng.random() < 0.5 else None, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, real int").repartition(6).cache()


@pytest.fixture(scope="module")
def scorer(planted):
    open_rows = planted.filter(~toxicity.held_out(F.col("doc_id")))
    return toxicity.learn(toxicity.training_rows(open_rows.select("doc_id", "text"), open_rows.select("doc_id", "toxic")))


def test_held_out_accuracy(planted, scorer):
    got = toxicity.score(planted, scorer).filter(toxicity.held_out(F.col("doc_id"))).collect()
    assert {r.doc_id for r in got} == {i for i in range(1800) if zlib.crc32(str(i).encode()) % 4 == 2}
    bad, good = [r for r in got if r.real], [r for r in got if not r.real]
    assert sum(r.predicted for r in bad) >= 0.95 * len(bad)
    assert sum(r.predicted for r in good) <= 0.03 * len(good)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_score_depends_on_the_text_alone(planted, scorer):
    texts = [r.text for r in planted.limit(70).collect()] + [None, "", " \n", "é" * 50, "word " * 60_000]
    together = scorer.scores(texts)
    assert np.allclose(together, [scorer.scores([t])[0] for t in texts], atol=1e-12)
    assert together[70] == together[71] < 0.3


def test_correlated_voters_count_once():
    """Five copies of one poor voter do not outvote three good ones."""
    rng = np.random.default_rng(1)
    real = rng.random(4000) < 0.25
    def voter(right):
        return np.where(rng.random(4000) < right, real, ~real).astype(int) + 1
    poor = voter(0.65)
    votes = np.stack([voter(0.9), voter(0.9), voter(0.88), *[poor] * 5], axis=1)
    votes[rng.random(votes.shape) < 0.2] = 0
    given = np.where(rng.random(4000) < 0.1, real.astype(float), np.nan)
    post, chance, weight = toxicity.label_model(votes, given, spoken=-1)
    assert ((post > 0.5) == real).mean() > 0.93
    assert weight[3:].max() < 0.5 < weight[:3].min()
    told = chance[1, 2] / (chance[1, 1] + chance[1, 2])   # says 2 when it speaks and the class is 1
    assert np.abs(told[:3] - 0.9).max() < 0.06 and np.abs(told[3:] - 0.65).max() < 0.08


def test_lexicon_holds_stems(planted):
    rows = planted.filter("toxic IS NOT NULL").select(F.col("doc_id").alias("id"), "text", F.col("toxic").alias("label"))
    entries = toxicity.mine(rows)
    held = set(entries.tolist())
    for word, sizes in (("zwurk", (4, 5)), ("quöxel", (4, 5, 6))):
        families = toxicity.Words([word]).families
        assert all(int(families[toxicity.STARTS.index(n) + 1][1][0]) in held for n in sizes)


def test_odd_and_empty_tables(spark, odd_docs, no_docs, scorer):
    got = toxicity.score(odd_docs.withColumn("score", F.lit("old")), scorer)
    assert got.columns == [*odd_docs.columns, "score", "predicted"] and got.count() == odd_docs.count()
    assert got.filter("score IS NULL OR predicted IS NULL").count() == 0
    assert toxicity.score(no_docs, scorer).count() == 0
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (3, None, 0), (None, 1, 1), (6, 0, 0)], "doc_id int, toxic int, text int")
    for docs, given in ((odd_docs, labels), (no_docs, labels), (odd_docs, labels.filter("false")), (no_docs, labels.filter("false"))):
        rows = toxicity.training_rows(docs, given)
        plain = toxicity.learn(rows)
        assert 0 < plain.scores([None])[0] < 1
    ids = sorted((r.id, r.label) for r in toxicity.training_rows(odd_docs, labels).filter("label IS NOT NULL").collect())
    assert ids == [(1, 1), (6, 0)]


def test_query(spark):
    got = Q.op12_toxicity(spark, SF_DIR)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    assert got.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
