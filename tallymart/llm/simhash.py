"""SimHash near-dedup: fingerprints linked by a grid join over segment bit counts."""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import components, stored

SEED = 42
SHINGLE = 4
MAX_BITS = 4
_SEGMENTS = 16  # two-bit segments in each half of a fingerprint
_EVEN_BITS = 0x55555555


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of all word shingles, repeats included; 0 without words.

    A-Z is lower-cased. A text of fewer words than a shingle is one shingle. A bit
    is set when it is set in more than half of the XXH64 values.
    """
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    values = np.fromiter((digest(flat[a:b], SEED) for a, b in spans), "<u8", len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 65536):
        part = values[at:at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(values)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprint_udf(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint((t or "").encode()) for t in texts], dtype="int64")


def fingerprints(docs: DataFrame, text_col: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with the signed fingerprint of every row; a NULL text counts as empty."""
    return docs.withColumn(name, _fingerprint_udf(F.col(text_col)))


def _cells(fps: DataFrame) -> DataFrame:
    """A row per fingerprint, half and grid cell at Manhattan distance 0 or 1 of its bit counts.

    The counts of a half's sixteen two-bit segments are packed two bits each. ``move``
    is 0 for the own cell, else plus or minus the 1-based segment that changed.
    """
    packed = F.array(*[
        h - F.shiftrightunsigned(h, 1).bitwiseAND(F.lit(_EVEN_BITS))
        for h in (F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))])

    def around(counts: Column, half: Column) -> Column:
        def step(seg: Column, sign: int) -> Column:
            # one unit of the segment as a power of four
            return F.struct((counts + sign * F.call_function("shiftleft", F.lit(1).cast("bigint"), 2 * seg)).alias("cell"),
                            (sign * (seg + 1)).cast("int").alias("move"))

        def count(seg: Column) -> Column:
            return F.call_function("shiftright", counts, 2 * seg).bitwiseAND(F.lit(3))

        segs = F.sequence(F.lit(0), F.lit(_SEGMENTS - 1))
        up = F.transform(F.filter(segs, lambda s: count(s) < 2), lambda s: step(s, 1))
        down = F.transform(F.filter(segs, lambda s: count(s) > 0), lambda s: step(s, -1))
        own = F.array(F.struct(counts.alias("cell"), F.lit(0).cast("int").alias("move")))
        return F.transform(F.concat(own, up, down), lambda c: F.struct(
            (c["cell"] + half.cast("bigint") * (1 << 33)).alias("cell"), c["move"].alias("move")))

    cells = F.flatten(F.transform(packed, around))
    return fps.select("fp", F.explode(cells).alias("c")).select("fp", "c.cell", "c.move")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of different fingerprints, a < b, that differ in at most ``max_bits`` (5 or fewer) bits.

    The Manhattan distance of segment bit counts never exceeds the number of
    differing bits, so a pair within 5 bits has a half whose counts are at most 2
    apart, and both points lie within 1 of a common grid cell. Which of the common
    cells counts is fixed by the moves, so a pair is made once in each half. Pairs
    are verified exactly inside the join. It is a merge join whatever the sizes: Spark
    sizes the cells by the fingerprints they are exploded from, some forty times too low.
    """
    if max_bits > 5:
        raise ValueError("the grid finds pairs of at most 5 differing bits")
    cells = _cells(fps)
    x, y = cells.alias("x"), cells.alias("y")
    one_cell = (F.col("x.move") == 0) | (
        (F.col("y.move") != 0) & (F.col("x.move") != F.col("y.move"))
        & (F.abs("x.move") <= F.abs("y.move")))
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits
    return x.join(y.hint("merge"), (F.col("x.cell") == F.col("y.cell")) & (F.col("x.fp") < F.col("y.fp")) & one_cell & near).select(
        F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct()


def _roots(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root): the smallest fingerprint reachable from each."""
    fps = prints.select("fp").distinct()
    joined = components(links(fps, max_bits))
    return fps.join(joined, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component_id): groups of rows whose fingerprints are linked, directly or through others.

    ``component_id`` is the smallest id of the group, NULL ids aside. Rows with
    equal fingerprints are folded before any join, so groups of copies make no
    pairs. NULL, empty and wordless texts share fingerprint 0. Repeated rows and ids
    each give a row; other columns are ignored; an empty table gives no rows.
    """
    prints = stored(fingerprints(docs.select(F.col(id_col).alias("id"), text_col), text_col).select("id", "fp"), "prints")
    roots = stored(_roots(prints, max_bits), "roots")
    firsts = prints.groupBy("fp").agg(F.min("id").alias("first_id")).join(roots, "fp").groupBy("root").agg(
        F.min("first_id").alias("component_id"))
    # a file of repeated fingerprints is far smaller than its rows, so its size must not make it a broadcast
    return prints.join(roots.join(firsts, "root").select("fp", "component_id").hint("merge"), "fp").select(
        "id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of ``near_groups``, with the columns of ``docs``.

    The row with the smallest id stays, then the one with the smallest text hash; a NULL id comes
    last. Of repeated rows one stays.
    """
    tagged = stored(fingerprints(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
                                 .withColumn("text", F.col(f"row.`{text_col}`"))).drop("text")
                    .withColumn("rid", F.monotonically_increasing_id()), "tagged")
    skinny = tagged.select("rid", "fp", F.col(f"row.`{id_col}`").alias("id"), F.xxhash64(f"row.`{text_col}`").alias("h"))
    roots = _roots(skinny, max_bits)
    firsts = skinny.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h", "rid")).alias("first"))
    kept = firsts.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.rid").alias("rid"))
    return tagged.select("rid", "row").join(kept, "rid", "left_semi").select("row.*")


def fingerprint_text(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
