"""Phrases whose words occur together far more often than apart, per language.

Every run of up to five words gets a Rabin-Karp fingerprint from numpy prefix polynomials. Runs of
one length are counted by fingerprint, and only those whose two shorter runs are both frequent are shuffled
at all. A fingerprint carries a pointer to a text it occurs in; at the smallest and the largest
pointer the text of each frequent one is read, and only there phrases are ever made into text. Fingerprints that
stand for more than one text are counted anew by text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored
from .rolling import Spans, mixed

LEAST = 100             # occurrences of a candidate
LONGEST = 5             # words
BEST = 2000             # phrases of a language
HOLD = 100              # a phrase goes when a longer one has this percentage of its occurrences
CHUNK = 1 << 20         # bytes of text that are hashed together
HELD = 1 << 21          # fingerprints kept in a task before they are passed on
FILTER_BITS = 1 << 26   # of the filter of frequent fingerprints, 8 MB whatever the size of the corpus
PROBES = 3
SALTS = 256
UNKNOWN = "und"
SCORE = (
    "(CAST(1000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(20,0)) * CAST(total AS DECIMAL(20,0)))"
    " div (CAST(l AS DECIMAL(20,0)) * CAST(r AS DECIMAL(20,0)))")
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)   # 0 in a word, 1 between words, 2 between pieces
_KIND[list(b" \t")] = 1
_KIND[list(_BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -- words of a chunk ---------------------------------------------------------

def _parts(text: bytes) -> Iterator[bytes]:
    """The text in parts of about ``CHUNK`` bytes that end between pieces, where no phrase crosses."""
    while len(text) > CHUNK:
        at = max(text.rfind(b, 0, CHUNK) for b in map(bytes, zip(_BREAKS)))
        if at < 0:
            later = [p for b in map(bytes, zip(_BREAKS)) if (p := text.find(b, CHUNK)) >= 0]
            if not later:
                break
            at = min(later)
        yield text[:at + 1]
        text = text[at + 1:]
    yield text


def _chunks(batches) -> Iterator["Chunk"]:
    """Chunks of the rows of a task: language, text, and a number or a list of numbers that belongs to the text."""
    langs, parts, more, size = [], [], [], 0
    for batch in batches:
        for row in zip(*batch.columns):
            lang, text, own = (v.as_py() for v in row)
            for part in _parts((text or "").encode()):
                langs.append(lang)
                parts.append(part)
                more.append(own)
                size += len(part) + 1
                if size >= CHUNK:
                    yield Chunk(langs, parts, more)
                    langs, parts, more, size = [], [], [], 0
    if parts:
        yield Chunk(langs, parts, more)


class Chunk:
    """Words of some texts: their places, pieces, languages and fingerprints."""

    def __init__(self, langs: list[str], parts: list[bytes], more: list):
        self.more = more
        self.bytes = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
        kind = _KIND[self.bytes]
        word = np.concatenate(([False], kind == 0, [False]))
        self.start = np.flatnonzero(word[1:] & ~word[:-1])
        self.end = np.flatnonzero(word[:-1] & ~word[1:])
        self.piece = np.cumsum(kind == 2)[self.start]
        self.names = sorted(set(langs))
        code = {name: i for i, name in enumerate(self.names)}
        self.part = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), self.start, side="right")
        self.lang = np.array([code[x] for x in langs], np.int64)[self.part]
        self.seed = np.array([xxhash.xxh64_intdigest(name) for name in self.names], np.uint64)[self.lang]
        self.word = Spans(self.bytes).of(self.start, self.end)
        self.words = Spans(self.word)

    def runs(self, n: int) -> np.ndarray:
        """Places of the runs of ``n`` words within a piece."""
        most = max(0, len(self.piece) - n + 1)
        return np.flatnonzero(self.piece[n - 1:n - 1 + most] == self.piece[:most])

    def keys(self, at: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the runs of ``n`` words at these places; length and language are part of them."""
        return mixed(self.words.of(at, at + n) + self.seed[at] + np.uint64(n))

    def word_ids(self) -> np.ndarray:
        """Equal numbers for equal words, checked on their bytes."""
        _, first, ids = np.unique(self.word, return_index=True, return_inverse=True)
        other = first[ids]
        size = self.end - self.start
        if (size == size[other]).all():
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            if (self.bytes[np.repeat(self.start, size) + step] == self.bytes[np.repeat(self.start[other], size) + step]).all():
                return ids
        numbers: dict[bytes, int] = {}
        return np.array([numbers.setdefault(self.bytes[s:e].tobytes(), len(numbers))
                         for s, e in zip(self.start, self.end)], np.int64)

    def text(self, at: int, n: int) -> str:
        return b" ".join(self.bytes[self.start[i]:self.end[i]].tobytes() for i in range(at, at + n)).decode()


# -- filter of frequent fingerprints ------------------------------------------

def _bits(keys: np.ndarray) -> list[np.ndarray]:
    return [(keys * np.uint64(0xD1B54A32D192ED03 + 2 * p) >> np.uint64(7 * p)) & np.uint64(FILTER_BITS - 1)
            for p in range(PROBES)]


def _may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for at in _bits(keys):
        found &= (table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def _filter_of(keys: DataFrame) -> np.ndarray:
    """Bloom filter of ``key``: at most FILTER_BITS / 64 numbers come to the driver."""

    def run(batches):
        for batch in batches:
            got = np.concatenate(_bits(batch.column(0).to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((got >> np.uint64(6)).astype(np.int64)),
                 pa.array((np.uint64(1) << (got & np.uint64(63))).view(np.int64))], ["at", "bits"])

    parts = keys.mapInArrow(run, "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    table[parts["at"].to_numpy(np.int64)] = parts["bits"].to_numpy(np.int64).view(np.uint64)
    return table


# -- counting -----------------------------------------------------------------

def _level(texts: DataFrame, n: int, shorter: np.ndarray | None, least: int) -> DataFrame:
    """(key, n, low, high): fingerprints of runs of ``n`` words that occur at least ``least`` times, and two pointers to their texts."""
    known = None if shorter is None else texts.sparkSession.sparkContext.broadcast(shorter)

    def places(chunk: Chunk) -> np.ndarray:
        at = chunk.runs(n)
        if known is None:
            return at
        held = np.zeros(len(chunk.start) + 1, bool)
        inner = chunk.runs(n - 1)
        held[inner] = _may_hold(known.value, chunk.keys(inner, n - 1))
        return at[held[at] & held[at + 1]]

    def merged(rows: list[tuple]) -> tuple:
        keys, counts, docs = (np.concatenate(c) for c in zip(*rows))
        every, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        return every, np.bincount(inverse, counts, len(every)).astype(np.int64), docs[first]

    def batch_of(keys: np.ndarray, counts: np.ndarray, docs: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts), pa.array(docs)], ["key", "n", "doc"])

    def run(batches):
        rows, size = [], 0
        for chunk in _chunks(batches):
            at = places(chunk)
            keys, first, counts = np.unique(chunk.keys(at, n), return_index=True, return_counts=True)
            rows.append((keys, counts, np.array(chunk.more, np.int32)[chunk.part[at[first]]]))
            size += len(keys)
            if size > HELD:
                rows = [merged(rows)]
                size = len(rows[0][0])
                if size > HELD // 2:
                    yield batch_of(*rows[0])
                    rows, size = [], 0
        if size:
            yield batch_of(*merged(rows))

    return texts.select("lang", "text", "doc").mapInArrow(run, "key bigint, n bigint, doc int").groupBy("key").agg(
        F.sum("n").alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high")).filter(F.col("n") >= least)


def _groups(chunk: Chunk, ids: np.ndarray, n: int, wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, first place and size of each group of runs of ``n`` words with equal text, of those whose fingerprint is ``wanted``."""
    at = chunk.runs(n)
    keys = chunk.keys(at, n)
    may = wanted(keys)
    at, keys = at[may], keys[may]
    _, first, inverse, sizes = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    other = at[first[inverse]]
    same = chunk.lang[at] == chunk.lang[other]
    for i in range(n):
        same &= ids[at + i] == ids[other + i]
    if not same.all():  # fingerprints collided
        table = np.stack([chunk.lang[at], *[ids[at + i] for i in range(n)]], axis=1)
        _, first, sizes = np.unique(table, axis=0, return_index=True, return_counts=True)
    return keys[first], at[first], sizes


def _read(texts: DataFrame, found: DataFrame, longest: int) -> DataFrame:
    """(key, lang, phrase): the texts of the fingerprints ``found`` in the texts that their pointers name."""
    pointers = found.select("key", F.explode(F.array_distinct(F.array("low", "high"))).alias("doc")).groupBy("doc").agg(
        F.collect_list("key").alias("keys"))

    # copies of a text are one, found by partial maxima in each task
    named = texts.join(pointers.select("doc"), "doc", "left_semi").groupBy(F.xxhash64("lang", "text").alias("h"), "doc").agg(
        F.max(F.struct("lang", "text")).alias("own"))

    def run(batches):
        for chunk in _chunks(batches):
            wanted = np.unique(np.array([k for keys in chunk.more for k in keys], np.int64).view(np.uint64))
            ids = chunk.word_ids()

            def may(keys):
                return wanted[np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)] == keys

            out = [(key, chunk.names[chunk.lang[at]], chunk.text(at, n)) for n in range(1, longest + 1)
                   for key, at in zip(*(c.tolist() for c in _groups(chunk, ids, n, may)[:2]))]
            if out:
                keys, langs, said = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(langs), pa.array(said)], ["key", "lang", "phrase"])

    return named.join(pointers, "doc").select("own.lang", "own.text", "keys").mapInArrow(
        run, "key bigint, lang string, phrase string")


def _counted_by_text(texts: DataFrame, wanted: np.ndarray, longest: int) -> DataFrame:
    """(lang, phrase, n): counts of the phrases whose fingerprints the filter holds, by their text."""
    known = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for chunk in _chunks(batches):
            ids = chunk.word_ids()
            out = [(chunk.names[chunk.lang[at]], chunk.text(at, n), c) for n in range(1, longest + 1)
                   for at, c in zip(*(x.tolist() for x in _groups(chunk, ids, n, lambda k: _may_hold(known.value, k))[1:]))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["lang", "phrase", "n"])

    return texts.select("lang", "text", "doc").mapInArrow(run, "lang string, phrase string, n bigint").groupBy("lang", "phrase").agg(
        F.sum("n").alias("n"))


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text, doc); ``doc``, the pointer, is 32 bits of a hash of both."""
    return docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text")).withColumn(
        "doc", F.shiftright(F.xxhash64("lang", "text"), 32).cast("int"))


def word_totals(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, total): all words of each language."""
    texts = _texts(docs, text_col, lang_col)
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09.,;:!?\x0A-\x0D]+"))
    return texts.groupBy("lang").agg(F.sum(words).cast("bigint").alias("total"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col: str = "text",
                     lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, n) of all phrases of 1 to ``longest`` words with at least ``least`` occurrences.

    Every text is read once for each length, to count fingerprints. A run of n words occurs at most as often as
    the two runs of n - 1 words in it, so it is counted only where the filter
    holds both; a false positive there costs work and changes nothing. The texts that hold the two pointers of a frequent
    fingerprint are read once more. Where all runs of a fingerprint in them have one text, its count is
    that text's; all others are counted by text.
    """
    texts = _texts(docs, text_col, lang_col)
    levels, shorter = [], None
    for n in range(1, longest + 1):
        levels.append(stored(_level(texts, n, shorter, least), f"runs-{n}"))
        shorter = _filter_of(levels[-1].select("key"))
    found = levels[0]
    for level in levels[1:]:
        found = found.unionAll(level)
    said = stored(_read(texts, found, longest).groupBy("key").agg(
        F.min(F.struct("lang", "phrase")).alias("own"), F.max(F.struct("lang", "phrase")).alias("other")), "phrases")
    sure = said.filter("own = other").join(found, "key").select("own.lang", "own.phrase", "n")
    unsure = said.filter("own <> other").select("key")
    if unsure.isEmpty():
        return sure
    again = _counted_by_text(texts, _filter_of(unsure), longest).filter(F.col("n") >= least)
    # what the filter lets through by mistake is among the sure ones already
    return sure.unionAll(stored(again, "counted").join(sure, ["lang", "phrase"], "left_anti"))


# -- scores -------------------------------------------------------------------

def _first_words(words: Column, k: Column) -> Column:
    return F.array_join(F.slice(words, F.lit(1), k), " ")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, best: int = BEST, hold: int = HOLD,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language.

    A text is lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and these into words at blanks and tabs. ``a`` counts a
    phrase of 2 to ``longest`` words, at least ``least`` times. A cut into two parts with ``l`` and ``r`` occurrences has the score
    floor(1000 a n / (l r)), ``n`` being all words of the language; the lowest score of any cut counts, the first such cut
    among equal ones. A phrase goes when a longer candidate that holds its words has ``hold`` per cent of its
    occurrences. Ranks go by score, then ``a``, both falling, then the phrase in byte order. Products are
    decimals of 38 digits.

    A NULL text is empty, a NULL language ``und``; a repeated row counts again; other columns are ignored. A table without
    frequent phrases, as an empty one, gives no rows. A text of any length is cut between pieces; only a single piece
    is held in memory whole.
    """
    counts = stored(frequent_phrases(docs, least, longest, text_col, lang_col), "counts")
    words = F.split("phrase", " ")
    candidates = counts.withColumn("words", words).filter(F.size("words") > 1)
    size = F.size("words")
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), "words", F.explode(
        F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _first_words(F.col("words"), F.col("k")).alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " ").alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    totals = word_totals(docs, text_col, lang_col)
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang").withColumn(
        "score", F.expr(SCORE)).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", F.col("total").alias("n"))).alias("cut")).select(
        "lang", "phrase", "cut.*")

    places = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    inner = candidates.filter(size > 2).select("lang", F.col("n").alias("held"), F.explode(places).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.col("held").isNull() | (100 * F.col("held") < hold * F.col("a")))

    # a language's best are among the best of its parts, so no task sorts a whole language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(
        F.col("place") <= best)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(
        F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
