"""Language ID with one Bloom filter for all languages: each slot holds a bit mask of languages.

A language's set are the character n-grams that are typical of it. A probe of an n-gram
takes the AND of its slots' masks and so returns all languages that hold it. A text's
n-grams are counted per language, less those that chance explains, and the largest count decides.
"""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

SAMPLE_ROWS = 8_000      # expected number of labelled rows the filters are learned from
GRAMS = (1, 2, 3, 4)     # characters, over lower-cased text
PER_LANGUAGE = 30_000    # most typical n-grams kept for each language
TYPICAL = 0.5            # an n-gram's share in a language, against its largest in any
LEAST = 3                # occurrences in the sample
SLOTS = 1 << 20
PROBES = 2
UNKNOWN = "und"
_SIGN = re.compile(r"[^\W\d_]")  # letters, and number signs that are none
_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(text: str) -> np.ndarray:
    """Hashes of all n-grams of the lower-cased text; every run of other signs than letters is one space."""
    signs = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ascii_other = (signs < 65) | ((signs > 90) & (signs < 97)) | ((signs > 122) & (signs < 170))
    signs = np.where(ascii_other, np.uint64(32), signs)
    signs = signs[np.concatenate(([True], ~((signs[1:] == 32) & (signs[:-1] == 32))))]
    out = []
    for n in GRAMS:
        if len(signs) >= n:
            h = np.full(len(signs) - n + 1, np.uint64(n), np.uint64)
            for k in range(n):
                h = (h ^ signs[k:len(signs) - n + 1 + k]) * _STEP
                h ^= h >> np.uint64(32)
            out.append(h)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _slots(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    low = np.uint64(size - 1)
    return [(hashes >> np.uint64(20 * k)) & low for k in range(PROBES)]


class Filters:
    """The learned filters: at most 64 languages to a mask word, as many words as needed."""

    def __init__(self, languages: list[str], grams: list[np.ndarray], size: int = SLOTS):
        self.languages, self.size = languages, size
        words = -(-max(1, len(languages)) // 64)
        kind = np.uint8 if len(languages) <= 8 else np.uint64
        self.masks = np.zeros((words, size), kind)
        self.chance = np.zeros(len(languages))
        for i, found in enumerate(grams):
            for at in _slots(found, size):
                self.masks[i // 64][at] |= kind(1 << (i % 64))
            filled = np.count_nonzero(self.masks[i // 64] & kind(1 << (i % 64))) / size
            self.chance[i] = filled ** PROBES

    @classmethod
    def restored(cls, state: dict) -> "Filters":
        """The same filters from their plain attributes."""
        here = cls.__new__(cls)
        vars(here).update(state)
        return here

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """N-grams in each language's set, corrected for false positives."""
        raw = np.zeros(len(self.languages))
        slots = _slots(hashes, self.size)
        for w, masks in enumerate(self.masks):
            hit = masks[slots[0]]
            for at in slots[1:]:
                hit = hit & masks[at]
            for i in range(w * 64, min(len(self.languages), w * 64 + 64)):
                raw[i] = np.count_nonzero(hit & masks.dtype.type(1 << (i % 64)))
        return np.maximum(0.0, (raw - len(hashes) * self.chance) / (1.0 - self.chance))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its share of all counts; unknown without a letter or a learned language.

        A tie goes to the language that sorts first.
        """
        if not text or not self.languages or not any(m.group().isalpha() for m in _SIGN.finditer(text)):
            return UNKNOWN, 0.0
        counts = self.counts(gram_hashes(text))
        if not counts.any():
            return self.languages[0], 1.0 / len(self.languages)
        best = int(np.argmax(counts))
        return self.languages[best], float(counts[best] / counts.sum())


def learn(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Filters:
    """Filters from (id, text, lang) rows; rows without text or language are ignored.

    Of n such rows each is used with chance ``sample_rows`` / n, drawn from a hash of its id; all are used when
    there are no more. N-grams are counted by Spark and ranked per language; at most
    ``PER_LANGUAGE`` hashes of each language come to the driver. A language that ends
    up without n-grams is still known.
    """
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    n = rows.count()
    draw = F.pmod(F.xxhash64("id", F.length("text")), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.filter(draw < sample_rows / max(1, n)).select("id", "lang", "text")
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches):
        found: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                found.setdefault(lang, []).append(gram_hashes(text))
        for lang, parts in found.items():
            grams, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n, pa.int64())],
                schema=schema)

    # dealt by id, so that copies of one text do not meet in one task
    counted = sample.repartition(8, "id").select("lang", "text").mapInArrow(run, "lang string, gram bigint, n bigint").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))
    by_lang, by_gram = Window.partitionBy("lang"), Window.partitionBy("gram")
    shares = counted.withColumn("share", F.col("n") / F.sum("n").over(by_lang)).withColumn(
        "typical", (F.col("share") >= TYPICAL * F.max("share").over(by_gram)) & (F.col("n") >= LEAST))
    ranked = shares.filter("typical").withColumn(
        "place", F.row_number().over(by_lang.orderBy(F.desc("n"), "gram"))).filter(F.col("place") <= PER_LANGUAGE)
    got = ranked.select("lang", "gram").toPandas()
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().toLocalIterator())
    grams = [got.loc[got["lang"] == name, "gram"].to_numpy(np.int64).view(np.uint64) for name in languages]
    return Filters(languages, grams)


def detect(docs: DataFrame, filters: Filters, text_col: str = "text", lang: str = "lang_pred",
           score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1); columns of these names are replaced.

    Only the text is looked at, whole. NULL, empty and letterless texts are unknown, with
    score 0. No row is moved; an empty table gives no rows.
    """
    held = docs.drop(lang, score)
    known = held.sparkSession.sparkContext.broadcast(vars(filters))

    @F.pandas_udf(T.StructType([T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]))
    def judge(texts: pd.Series) -> pd.DataFrame:
        here = Filters.restored(known.value)
        return pd.DataFrame([here.predict(t) for t in texts], columns=[lang, score])

    return held.withColumn("_judged", judge(F.col(text_col))).select(
        *[F.col(f"`{c}`") for c in held.columns], f"_judged.{lang}", f"_judged.{score}")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3; a NULL id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
