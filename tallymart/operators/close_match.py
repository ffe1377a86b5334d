"""Match misspelt terms to stored values: an inverted index of two-letter grams, then the exact edit distance.

A term and a value that are a few edits apart still share most of their grams. With all grams in one order, rare ones
first, two texts within d edits share one of their first 2 d + 1 grams, so only those are indexed and
probed. Candidates of fitting length are verified by the Levenshtein distance.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

GRAM = 2
ONE_FROM, TWO_FROM = 4, 7   # letters of a term from which one and two edits are allowed; shorter ones must be equal


def plain(text: Column) -> Column:
    """How terms and values are compared: without outer spaces, in lower case."""
    return F.lower(F.trim(text))


def allowed(text: Column) -> Column:
    """Edits that a term of this length may be away from a value."""
    return F.when(F.length(text) >= TWO_FROM, 2).when(F.length(text) >= ONE_FROM, 1).otherwise(0)


def _grams(text: Column) -> Column:
    """Grams of a text, the second and later ones of a kind told apart by a number."""
    cut = F.transform(F.sequence(F.lit(1), F.length(text) - (GRAM - 1)), lambda i: F.substring(text, i, F.lit(GRAM)))
    every = F.when(F.length(text) >= GRAM, cut).otherwise(F.array(text))

    def numbered(held: Column) -> Column:
        return F.transform(held, lambda g, i: F.concat(
            g, F.size(F.filter(F.slice(held, F.lit(1), i), lambda x: x == g)).cast("string")))

    # as the one element of an array the grams are worked out once, and not again for each of them
    return F.get(F.transform(F.array(every), numbered), F.lit(0))


def _prefixes(texts: DataFrame, often: DataFrame, edits: int) -> DataFrame:
    """(norm, gram) of the first grams of each text, rare ones first; grams that no value has come before all others."""
    grams = texts.select("norm", F.explode(_grams(F.col("norm"))).alias("gram")).join(often, "gram", "left")
    placed = grams.groupBy("norm").agg(F.array_sort(F.collect_list(
        F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "gram"))).alias("grams"))
    return placed.select("norm", F.explode(F.slice("grams", 1, GRAM * edits + 1)).alias("g")).select("norm", "g.gram")


def match_close(terms: DataFrame, values: DataFrame, term: str = "term") -> DataFrame:
    """(term, table_name, column_name, value, distance, best) of every value within reach of a term.

    Terms and values are compared without outer spaces and case. A term of 1 to 3 letters must be equal to a value, one of
    4 to 6 may be one edit away, a longer one two. ``best`` marks the value a term most likely means: the smallest
    distance, then the most rows (``values.rows``), then table, column and value in order. Equal texts are folded
    before any join, so neither a frequent term nor a value of many columns costs more than once. Terms without
    letters, NULLs and terms that match nothing give no row.
    """
    asked = terms.select(F.col(term).alias("term")).distinct().withColumn("norm", plain(F.col("term"))).filter("norm <> ''")
    known = values.select("table_name", "column_name", "value", "rows").withColumn("norm", plain(F.col("value"))).filter("norm <> ''")
    wanted, held = asked.select("norm").distinct(), known.select("norm").distinct()
    often = held.select(F.explode(_grams(F.col("norm"))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("rows"))

    pairs = wanted.select("norm", F.col("norm").alias("other")).join(held.withColumnRenamed("norm", "other"), "other", "left_semi").select(
        "norm", "other", F.lit(0).alias("distance"))
    # either number of edits has prefixes of its own length, so that one edit is not searched as widely as two
    for edits in (1, 2):
        some = wanted.filter(allowed(F.col("norm")) == edits)
        reach = held.filter(F.length("norm") >= (ONE_FROM, TWO_FROM)[edits - 1] - edits)
        probes = _prefixes(some, often, edits)
        index = _prefixes(reach, often, edits).withColumnRenamed("norm", "other")
        fits = F.abs(F.length("norm") - F.length("other")) <= edits
        near = probes.join(index, "gram").filter(fits & (F.col("norm") != F.col("other"))).select("norm", "other").distinct()
        pairs = pairs.unionAll(near.withColumn("distance", F.levenshtein("norm", "other", edits)).filter("distance > 0"))
    found = asked.join(pairs, "norm").join(known.withColumnRenamed("norm", "other"), "other")
    order = Window.partitionBy("term").orderBy("distance", F.desc("rows"), "table_name", "column_name", "value")
    return found.select("term", "table_name", "column_name", "value", "distance", (F.row_number().over(order) == 1).alias("best"))
