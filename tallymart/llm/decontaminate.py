"""Benchmark decontamination: short test items found inside long documents, with Spark expressions only.

Items are partitioned by their number of word shingles. A document that holds at
least ``threshold`` of an item's n shingles misses at most n - ceil(threshold n) of
them, so it holds one of the item's n - ceil(threshold n) + 1 smallest shingle hashes. That
many MinHash values are the item's sketch; each size class has its own length. A
document's own size does not matter, however long it is, and no item is missed.
"""

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, stored

SHINGLE = 5
THRESHOLD = 0.8
BROADCAST_ROWS = 200_000  # rows of a few numbers that may be sent to every executor
SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words of the lower-cased (A-Z) text; none for NULL."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")


def shingles_of(words: Column, shingle: Column) -> Column:
    """Different runs of ``shingle`` words, joined by spaces."""
    last = F.size(words) - shingle + 1
    return F.when(last < 1, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(words, i, shingle), " "))))


def items_of(benchmark: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(item, item_id, width, shingles) of different items with a word; an item of fewer words is one shingle of all of them."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    width = F.least(F.size("words"), F.lit(shingle))
    return words.select("item_id", width.alias("width"), shingles_of(F.col("words"), width).alias("shingles")).distinct(
    ).select(F.monotonically_increasing_id().alias("item"), "*")


def sketches(items: DataFrame, width: int, threshold: float = THRESHOLD) -> DataFrame:
    """(item, hash): the smallest shingle hashes of each item of this width, as many as its size class needs."""
    size = F.size("shingles")
    length = size - F.ceil(size * F.lit(threshold) - F.lit(1e-9)) + 1
    hashes = F.array_sort(F.transform("shingles", lambda s: F.xxhash64(*[F.get(F.split(s, " "), k) for k in range(width)])))
    return items.filter(F.col("width") == width).select(
        "item", F.explode(F.slice(hashes, F.lit(1), length.cast("int"))).alias("hash"))


def _with_marks(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with 128 bits that stand for the text."""
    return docs.withColumns({
        "_m1": F.xxhash64(text_col), "_m2": F.xxhash64(F.lit("second"), F.col(text_col))})


def _candidates(docs: DataFrame, items: DataFrame, widths: list[int], text_col: str, threshold: float) -> DataFrame:
    """(_m1, _m2, item): texts that hold a MinHash value of an item, each pair once.

    A text's shingle hashes are made and probed in one pass; only its marks go with
    them, so that a join that has to shuffle moves short rows.
    """
    words = _with_marks(docs.select(text_col).filter(F.col(text_col) != ""), text_col).select(
        "_m1", "_m2", words_of(F.col(text_col)).alias("words"))
    hits = None
    for width in widths:
        starts = F.when(F.size("words") >= width, F.sequence(F.lit(0), F.size("words") - width))
        found = words.select("_m1", "_m2", "words", F.explode(starts).alias("i")).select(
            "_m1", "_m2", F.xxhash64(*[F.get("words", F.col("i") + k) for k in range(width)]).alias("hash")
        ).join(sketches(items, width, threshold), "hash").select("_m1", "_m2", "item")
        hits = found if hits is None else hits.unionAll(found)
    return hits.distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(id, text, item_id, containment): rows whose text holds at least ``threshold`` of an item's shingles.

    Texts that share a MinHash value with an item are fetched again and verified on the shingles themselves.
    Candidates are stored and counted: only up to ``BROADCAST_ROWS`` of them are broadcast.

    Matching ignores A-Z case and white space. NULL and empty texts hold nothing; items
    without a word match nothing; items of fewer than ``shingle`` words must occur whole. Different items that
    share an id each give a row, and so do repeated rows. Other columns are ignored; empty tables give no rows.
    """
    items = stored(items_of(benchmark, shingle), "items")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most ``shingle`` of them
    named = docs.select(F.col(id_col), F.col(text_col))
    if not widths:
        return named.select("*", F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"),
                            F.lit(0.0).alias("containment")).filter(F.lit(False))
    found = stored(_candidates(docs, items, widths, text_col, threshold), "candidates")
    pairs = _with_marks(named, text_col).join(_sized(found), ["_m1", "_m2"]).join(items, "item")
    # the words are a column of their own: inside the expression below they would be split anew for every shingle
    pairs = pairs.withColumn("_words", words_of(F.col(text_col)))
    shared = F.size(F.array_intersect("shingles", shingles_of(F.col("_words"), F.col("width"))))
    verified = stored(pairs.select(id_col, text_col, "item_id", (shared / F.size("shingles")).alias("containment")),
                      "verified")
    return verified.filter(F.col("containment") >= threshold - 1e-9)


def _sized(df: DataFrame) -> DataFrame:
    """A stored frame of short rows, marked for broadcast when counted few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          **settings) -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns and repeated rows stay."""
    held = contaminated(docs, benchmark, id_col, text_col, **settings)
    bad = stored(_with_marks(held.select(text_col), text_col).select("_m1", "_m2").distinct(), "leaks")
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text_col).alias("_text"))
    return _with_marks(carried, "_text").join(_sized(bad), ["_m1", "_m2"], "left_anti").select("_row.*")
