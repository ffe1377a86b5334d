"""Toxicity by weak supervision: many voters, a generative model of their votes, a linear classifier on its posteriors.

Voters are lexicon entries mined from labelled rows (words, and starts of words for languages that build on
stems), patterns of spelling, the absence of any entry, and the labels themselves, which
may be wrong. An EM fit estimates how often each voter gives each of its votes in either class; what is left of
correlation inside the classes discounts voters that repeat each other. The posterior labels train a
logistic classifier on how densely the entries occur, and that alone scores texts.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import SLICE, stored
from .rolling import Spans, mixed

LABELLED_ROWS = 8_000    # expected number of labelled rows that anything is learned from
PLAIN_ROWS = 4_000       # expected number of further rows without label, for the label model
ENTRIES = 512            # most entries of the lexicon
VOTERS = 96              # entries that vote; all of them are features
LEAST_ROWS = 3           # labelled toxic rows that an entry occurs in
LEAST_Z = 3.5            # standard errors by which its log odds must be above zero
STARTS = (4, 5, 6, 7)    # code points of word starts
DENSE = 0.01             # occurrences a word from which on an entry counts in full
ROUNDS = 30              # of the EM fit
LABEL_TRUST = 0.97       # chance that a label is right
PLAIN_WEIGHT = 0.25
LEAST_CORRELATION = 0.1  # smaller ones are taken for chance
STEPS = 400              # of the classifier's fit
THRESHOLD = 0.3
BROADCAST_ROWS = 100_000
_FIRST = 32              # smallest divisor of a density, in words


# -- words --------------------------------------------------------------------

class Words:
    """Words of some texts, as fingerprints of lower-cased whole words and of their starts."""

    def __init__(self, texts: list):
        lowered = [(t or "").lower() for t in texts]
        # a sign that is no letter ends each text, so that no word crosses
        signs = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = ((signs >= 97) & (signs <= 122)) | (signs >= 192)
        inside = np.concatenate(([False], letter, [False]))
        self.start = np.flatnonzero(inside[1:] & ~inside[:-1])
        self.end = np.flatnonzero(inside[:-1] & ~inside[1:])
        ends = np.cumsum([len(t) + 1 for t in lowered])
        self.row = np.searchsorted(ends, self.start, side="right")
        self.sizes = np.bincount(self.row, minlength=len(texts))
        spans = Spans(signs)
        self.families = [(self.row, mixed(spans.of(self.start, self.end)))]
        for n in STARTS:
            long = np.flatnonzero(self.end - self.start >= n)
            at = self.start[long]
            self.families.append((self.row[long], mixed(spans.of(at, at + n) + np.uint64(n))))

    def found(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, numbers of ``entries`` that occur there, and how often, by row."""
        if not len(entries):
            return (np.zeros(0, np.int64),) * 3
        order = np.argsort(entries)
        in_order = entries[order]
        hits = []
        for row, keys in self.families:
            at = np.minimum(np.searchsorted(in_order, keys), len(entries) - 1)
            known = in_order[at] == keys
            hits.append(row[known] * len(entries) + order[at[known]])
        cells, counts = np.unique(np.concatenate(hits), return_counts=True)
        return cells // len(entries), cells % len(entries), counts


def spelling(text: str | None) -> list[float]:
    """Shares of capitals, of marks that are neither letters, digits nor blanks, and of words that repeat the one before."""
    text = text or ""
    if not text:
        return [0.0, 0.0, 0.0]
    n = len(text)
    words = text.split()
    again = sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words) - 1)
    signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    capital = ((signs >= 65) & (signs <= 90)).sum()
    marks = (((signs > 32) & (signs < 48)) | ((signs > 57) & (signs < 65))).sum()
    return [float(capital / n), float(marks / n), again]


PATTERNS = 3


def _densities(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.minimum(1.0, counts / (DENSE * np.maximum(sizes, _FIRST)))


# -- lexicon ------------------------------------------------------------------

def mine(sample: DataFrame, entries: int = ENTRIES) -> np.ndarray:
    """Fingerprints of the entries that speak most for a toxic label, the strongest first, from (id, text, label) rows.

    Entries are counted by Spark over the sample; the ``entries`` with the highest log odds, in standard
    errors, come to the driver.
    """
    labelled = sample.filter("label IS NOT NULL")
    schema = pa.schema([("key", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches):
        keys, toxic = [], []
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                texts, labels = (c.to_pylist() for c in batch.slice(start, SLICE).columns)
                label = np.array(labels, np.int64)
                for row, found in Words(texts).families:
                    # once a text; the fingerprint and the row make the cell
                    order = np.lexsort((found, row))
                    row, found = row[order], found[order]
                    new = np.ones(len(row), bool)
                    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
                    keys.append(found[new])
                    toxic.append(label[row[new]])
        if keys:
            every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            bad = np.bincount(inverse, np.concatenate(toxic), len(every)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(every.view(np.int64)), pa.array(bad), pa.array(np.bincount(inverse, minlength=len(every)) - bad)],
                schema=schema)

    totals = labelled.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not totals["t"]:
        return np.zeros(0, np.uint64)
    bad, good = F.col("toxic"), F.col("clean")
    odds = F.log((bad + 0.5) / (totals["t"] + 1.0)) - F.log((good + 0.5) / (totals["n"] - totals["t"] + 1.0))
    counted = labelled.repartition(8, "id").select("text", "label").mapInArrow(
        run, "key bigint, toxic bigint, clean bigint").groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    got = counted.filter(bad >= LEAST_ROWS).withColumn(
        "z", odds / F.sqrt(1.0 / (bad + 0.5) + 1.0 / (good + 0.5))).filter(F.col("z") >= LEAST_Z).orderBy(
        F.desc("z"), "key").limit(entries).select("key").toPandas()
    return got["key"].to_numpy(np.int64).view(np.uint64)


# -- label model --------------------------------------------------------------

def label_model(votes: np.ndarray, given: np.ndarray, spoken: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior chance of class 1 for each row of ``votes`` (0, 1 or 2), each voter's chance of each vote by class, and its weight.

    A voter that says 0 abstains and gives no evidence, but for the voter numbered ``spoken``.
    ``given`` are the labels, NaN where there is none. They vote with a fixed accuracy, ``LABEL_TRUST``, which keeps class 1 what
    they mean by it; rows without one weigh ``PLAIN_WEIGHT`` in the estimates. EM estimates all other chances. Votes that still vary together inside the classes are
    correlated; a voter's evidence is divided by one plus the sum of its correlations with the others, so that many
    that say the same count as one.
    """
    labelled = ~np.isnan(given)
    trust = np.log(LABEL_TRUST / (1 - LABEL_TRUST))
    said_label = np.where(labelled, np.where(np.nan_to_num(given) == 1, trust, -trust), 0.0)
    rate = (np.nansum(given) + 0.5) / (labelled.sum() + 1.0) if labelled.any() else 0.1
    weigh = np.where(labelled, 1.0, PLAIN_WEIGHT)
    post = np.where(labelled, np.where(np.nan_to_num(given) == 1, LABEL_TRUST, 1 - LABEL_TRUST), rate)
    there = np.stack([(votes == v).astype(np.float64) for v in range(3)])   # vote, row, voter
    silent = np.zeros((3, votes.shape[1]), bool)
    silent[0, np.arange(votes.shape[1]) != spoken] = True
    weight = np.ones(votes.shape[1])
    chance = np.zeros((2, 3, votes.shape[1]))
    for _ in range(rounds):
        for c, p in enumerate((1 - post, post)):
            seen = np.einsum("r,vrj->vj", p * weigh, there) + 0.5
            chance[c] = seen / seen.sum(axis=0)
        strength = np.where(silent, 0.0, np.log(chance[1]) - np.log(chance[0]))
        # what is left of each voter's evidence when the class explains its mean
        said = np.einsum("vrj,vj->rj", there, strength)
        left = np.zeros(votes.shape)
        for p in (1 - post, post):
            left += p[:, None] * (said - (p @ said) / max(p.sum(), 1e-9))
        left /= np.maximum(np.sqrt((left ** 2).mean(axis=0)), 1e-9)
        together = np.abs(left.T @ left) / len(left)
        np.fill_diagonal(together, 0.0)
        together[together < LEAST_CORRELATION] = 0.0
        weight = 1.0 / (1.0 + together.sum(axis=1))
        prior = np.clip((post * weigh).sum() / weigh.sum(), 1e-3, 0.5)
        evidence = said @ weight + said_label + np.log(prior / (1 - prior))
        post = 1.0 / (1.0 + np.exp(-np.clip(evidence, -30, 30)))
    return post, chance, weight


# -- classifier ---------------------------------------------------------------

def fit_linear(x: np.ndarray, target: np.ndarray, steps: int = STEPS, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic model for soft labels, by accelerated gradient steps on all rows.

    The last column of ``x`` is all ones, for the intercept. Rare classes weigh as they are.
    """
    n, m = x.shape
    bound = 0.25 * float(np.linalg.eigvalsh((x.T @ x).astype(np.float64) / n)[-1]) + ridge
    keep = np.full(m, ridge)
    keep[-1] = 0.0
    w = ahead = np.zeros(m)
    t = 1.0
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ ahead.astype(x.dtype), -30, 30).astype(np.float64)))
        new = ahead - ((p - target).astype(x.dtype) @ x / n + keep * ahead) / bound
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w[:-1], float(w[-1])


class Scorer:
    """The linear classifier: entries, their weights by presence and density, weights of spelling, intercept."""

    def __init__(self, entries: np.ndarray, weights: np.ndarray, intercept: float):
        self.entries, self.weights, self.intercept = entries, weights, intercept

    def scores(self, texts: list) -> np.ndarray:
        words = Words(texts)
        row, entry, counts = words.found(self.entries)
        k = len(self.entries)
        parts = self.weights[entry] + self.weights[k + entry] * _densities(counts, words.sizes[row])
        total = self.intercept + np.bincount(row, parts, len(texts))
        shape = np.array([spelling(t) for t in texts]).reshape(-1, PATTERNS)
        total += shape @ self.weights[2 * k:2 * k + PATTERNS]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def learn(sample: DataFrame, entries: int = ENTRIES) -> Scorer:
    """A scorer from (id, text, label) rows; ``label`` is 0, 1 or NULL. The rows must be a bounded sample.

    What comes to the driver are at most ``entries`` fingerprints, and the cells of the sample's rows that hold one.
    """
    lexicon = mine(sample, entries)
    k = len(lexicon)
    known = sample.sparkSession.sparkContext.broadcast(lexicon)
    schema = pa.schema([("label", pa.int32()), ("entries", pa.list_(pa.int32())), ("dense", pa.list_(pa.float64())),
                        ("shape", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                texts, labels = (c.to_pylist() for c in batch.slice(start, SLICE).columns)
                words = Words(texts)
                row, entry, counts = words.found(known.value)
                dense = _densities(counts, words.sizes[row])
                cut = np.searchsorted(row, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(labels, pa.int32()),
                    pa.array([entry[a:b].tolist() for a, b in zip(cut, cut[1:])], pa.list_(pa.int32())),
                    pa.array([dense[a:b].tolist() for a, b in zip(cut, cut[1:])], pa.list_(pa.float64())),
                    pa.array([spelling(t) for t in texts], pa.list_(pa.float64()))], schema=schema)

    rows = sample.select("text", "label").mapInArrow(
        run, "label int, entries array<int>, dense array<double>, shape array<double>").toArrow()
    label = rows["label"].to_pandas().to_numpy(np.float64, na_value=np.nan)
    n = len(label)
    if not n or not k:
        given = label[~np.isnan(label)]
        rate = (given.sum() + 0.5) / (len(given) + 1.0) if len(given) else 0.1
        return Scorer(lexicon, np.zeros(2 * k + PATTERNS), float(np.log(rate / (1 - rate))))
    features = np.zeros((n, 2 * k + PATTERNS + 1), np.float32)   # presence, density, spelling, one
    at = 0
    for batch in rows.to_batches():
        held = batch.column("entries")
        row = at + np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy()))
        entry = held.flatten().to_numpy()
        features[row, entry] = 1.0
        features[row, k + entry] = batch.column("dense").flatten().to_numpy()
        features[at:at + len(held), 2 * k:-1] = batch.column("shape").flatten().to_numpy().reshape(-1, PATTERNS)
        at += len(held)
    features[:, -1] = 1.0
    votes = _votes(features[:, k:2 * k], features[:, 2 * k:-1])
    post, _, _ = label_model(votes, label, spoken=0)
    weights, intercept = fit_linear(features, post)
    return Scorer(lexicon, weights, intercept)


def _votes(dense: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Votes (0, 1 or 2) of the lexicon as a whole (absent, sparse, dense), of its strongest entries and of the spelling patterns."""
    by_entry = _grade(dense[:, :VOTERS])
    by_shape = np.where(shape > np.quantile(shape, 0.98, axis=0) + 1e-9, 1, 0)
    whole = _grade(dense.max(axis=1, initial=0.0))[:, None]
    return np.concatenate((whole, by_entry, by_shape), axis=1)


def _grade(dense: np.ndarray) -> np.ndarray:
    return np.where(dense >= 0.5, 2, np.where(dense > 0, 1, 0))


# -- tables -------------------------------------------------------------------

def _chance(col: Column, tag: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(tag), col), F.lit(1 << 40)) / float(1 << 40)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                  labelled_rows: int = LABELLED_ROWS, plain_rows: int = PLAIN_ROWS) -> DataFrame:
    """(id, text, label): about ``labelled_rows`` rows with a label and ``plain_rows`` without, drawn by hashes of the id, stored.

    All are taken where there are no more. Of several labels of an id the largest counts. NULL ids, texts and labels are left out.
    """
    ids = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    given = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(label_col).cast("int").alias("label"))
    picked = stored(given.filter(_chance(F.col("id"), "label") < labelled_rows / max(1, given.count())), "picked")
    if picked.count() <= BROADCAST_ROWS:  # else left to Spark's own size check
        picked = F.broadcast(picked)
    plain = ids.filter(_chance(F.col("id"), "plain") < plain_rows / max(1, ids.count())).withColumn(
        "label", F.lit(None).cast("int")).select("id", "text", "label")
    return stored(ids.join(picked, "id").select("id", "text", "label").unionAll(plain), "training")


def score(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD, text_col: str = "text", score_col: str = "score",
          predicted: str = "predicted") -> DataFrame:
    """``docs`` with the chance that a row is toxic, and 1 or 0 by ``threshold``; columns of these names are replaced.

    Only the text is looked at, whole. A NULL or empty text has the score of a text without any
    sign. No row is moved; an empty table gives no rows.
    """
    held = docs.drop(score_col, predicted)
    known = held.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        out = [known.value.scores(texts.iloc[i:i + SLICE].tolist()) for i in range(0, len(texts), SLICE)]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return held.withColumn(score_col, scored(F.col(text_col))).withColumn(
        predicted, (F.col(score_col) >= threshold).cast("int"))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 2 when divided by 4; a NULL id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
