"""Near copies by exact Jaccard similarity of word-shingle sets, through a prefix join that misses none."""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import components, stored

SHINGLE = 5
THRESHOLD = 0.8
SAMPLE_ROWS = 5_000   # rows that tell which shingles are common; that only orders them and never changes a result
COMMON = 50_000       # at most so many 8-byte hashes of common shingles are broadcast


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the different runs of words, A-Z lower-cased; fewer words are one run, no words none."""
    words = (text or "").encode().lower().split()
    k = min(shingle, len(words))
    if not k:
        return np.zeros(0, np.int64)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(words[i:i + k])) for i in range(len(words) - k + 1)], np.uint64).view(np.int64))


def _sets(shingle: int):
    @F.pandas_udf("array<bigint>")
    def sets(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, shingle) for t in texts])

    return sets


def _common(rows: DataFrame, shingle: int) -> np.ndarray:
    """Hashes of shingles that many of a hash-drawn sample of rows hold, sorted."""
    part = min(1.0, SAMPLE_ROWS / max(1, rows.count()))
    drawn = rows.filter(F.pmod(F.xxhash64(F.lit("sample"), "rid"), F.lit(1 << 30)) < int(part * (1 << 30)))
    got = drawn.select(F.explode(_sets(shingle)("text")).alias("h")).groupBy("h").count().filter("count >= 5").orderBy(
        F.desc("count"), "h").limit(COMMON).select("h").toPandas()
    return np.sort(got["h"].to_numpy(np.int64))


def _prefixes(rows: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """(rid, mark, n, prefix): 128 bits that stand for the set, its size, and its first n - ceil(threshold n) + 1 hashes, rare ones first."""
    common = rows.sparkSession.sparkContext.broadcast(_common(rows, shingle))

    @F.pandas_udf("mark binary, n int, prefix array<bigint>")
    def described(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            out = []
            for t in texts:
                held = shingle_set(t, shingle)
                often = np.isin(held, common.value)
                order = np.concatenate((held[~often], held[often]))
                length = len(held) - math.ceil(threshold * len(held) - 1e-9) + 1 if len(held) else 0
                out.append((xxhash.xxh128_digest(held.tobytes()), len(held), order[:length]))
            yield pd.DataFrame(out, columns=["mark", "n", "prefix"])

    return rows.withColumn("d", described("text")).select("rid", "d.mark", "d.n", "d.prefix")


def links(rows: DataFrame, sets: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """(a, b): rids of different sets (a < b) whose Jaccard similarity is at least ``threshold``.

    Sets that alike share one of their first hashes in any common order. At the first one they share, what is left of both must
    still reach the overlap, which is tested inside the join.
    """
    keys = sets.filter("n > 0").select("rid", "n", F.posexplode("prefix").alias("at", "h"))
    x, y = keys.alias("x"), keys.alias("y")
    need = F.ceil((F.col("x.n") + F.col("y.n")) * F.lit(threshold / (1 + threshold)) - F.lit(1e-6))
    reach = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at")) >= need
    pairs = stored(x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.rid") < F.col("y.rid")) & reach).select(
        F.col("x.rid").alias("a"), F.col("y.rid").alias("b")).distinct(), "set-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    held = stored(rows.join(wanted, "rid", "left_semi").select("rid", _sets(shingle)("text").alias("s")), "pair-sets")
    both = pairs.join(held.select(F.col("rid").alias("a"), F.col("s").alias("sa")), "a").join(
        held.select(F.col("rid").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    alike = shared >= threshold * (F.size("sa") + F.size("sb") - shared) - 1e-9
    return stored(both.select("a", "b", alike.alias("alike")), "set-links").filter("alike").select("a", "b")


def keep_one_alike(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row of each group of rows with like sets, linked directly or through others, with the columns of ``docs``.

    No two rows that stay have a similarity of ``threshold`` or more. The row with the smallest id stays, then the one
    with the smallest text hash; a NULL id comes last. Equal sets are folded before any join. Wordless texts are
    one group. Sets are compared by 64-bit hashes of their shingles. A group of k different near copies has up to k * k / 2 links.
    """
    tagged = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn(
        "rid", F.monotonically_increasing_id()), "set-docs")
    rows = tagged.select("rid", F.col(f"row.`{text_col}`").alias("text"))
    sets = stored(_prefixes(rows, threshold, shingle), "sets")
    nodes = stored(sets.groupBy("mark").agg(F.min("rid").alias("node")), "set-nodes")
    one = sets.join(nodes.select(F.col("node").alias("rid")), "rid", "left_semi")
    joined = components(links(rows, one, threshold, shingle)).withColumnRenamed("node", "rid")
    roots = nodes.withColumnRenamed("node", "rid").join(joined, "rid", "left").select("mark", F.coalesce("root", "rid").alias("root"))
    place = tagged.select("rid", F.col(f"row.`{id_col}`").alias("id"), F.xxhash64(f"row.`{text_col}`").alias("h"))
    firsts = sets.select("rid", "mark").join(place, "rid").groupBy("mark").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h", "rid")).alias("first"))
    kept = firsts.join(roots, "mark").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.rid").alias("rid"))
    return tagged.join(kept, "rid", "left_semi").select("row.*")
