"""Mixing sources to target weights: token budgets down a domain-language-source tree.

A node's budget is shared among its children by weight. A child that cannot supply
its share gives what it can and its siblings take over the rest, within their
own supply; only what a whole subtree lacks goes back to its parent's
siblings. A leaf supplies its tokens once per allowed epoch, each epoch in another
seeded order, and its budget is a prefix of that stream.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORDS, stored

LEVELS = ("domain", "language", "source")
RANGES = 1024           # of a leaf's seeded order, at least; only one of them is ever sorted
ROWS_PER_RANGE = 100_000  # of all rows; a larger table has more ranges


def word_count(text: Column) -> Column:
    """Words as the measure of tokens; a tokenizer's count can be given instead."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("bigint")


def _weight(path: Column, weights: Mapping[str, float]) -> Column:
    """The weight of a node by its path, 1 when none is given."""
    if not weights:
        return F.lit(1.0)
    items = [F.lit(x) for name, w in weights.items() for x in (name, float(w))]
    return F.coalesce(F.try_element_at(F.create_map(*items), path), F.lit(1.0))


def _leaf_key(levels: Sequence[str], depth: int) -> Column:
    """One text for a node that no other names can give; NULL is a name of its own."""
    part = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")),
                       F.lit("null:")) for c in levels[:depth]]
    return F.concat(F.lit("/"), *part)


def allocate(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, float], budget: float,
             epochs: int) -> DataFrame:
    """Leaves with ``budget``: each level's shares are filled up to the supply below them.

    ``leaves`` has the level columns and ``tokens``. ``weights`` maps a node's path (its names
    joined by ``/``) to its weight among its siblings. Among siblings with supply s and weight w the
    shares are min(s, x w) with one x, found from running sums over siblings sorted by s / w. A
    weight of 0 takes nothing.
    """
    depths = range(len(levels) + 1)
    nodes = leaves.select(
        "*", *[_leaf_key(levels, d).alias(f"_n{d}") for d in depths],
        *[F.concat_ws("/", *[F.col(c).cast("string") for c in levels[:d]]).alias(f"_p{d}") for d in depths],
        (F.col("tokens") * epochs).cast("double").alias("_s"))
    parent = None
    for d in range(1, len(levels) + 1):
        supply = nodes.groupBy(f"_n{d - 1}", f"_n{d}", f"_p{d}").agg(F.sum("_s").alias("_s")).withColumn(
            "_w", _weight(F.col(f"_p{d}"), weights)).withColumn("_s", F.when(F.col("_w") > 0, F.col("_s")).otherwise(0.0))
        # s / w ascending: the first to run dry come first
        ratio = F.when(F.col("_w") > 0, F.col("_s") / F.col("_w")).otherwise(F.lit(float("inf")))
        order = Window.partitionBy(f"_n{d - 1}").orderBy("_r", f"_n{d}")
        past = order.rowsBetween(Window.unboundedPreceding, -1)
        left = Window.partitionBy(f"_n{d - 1}")
        ranked = supply.withColumn("_r", ratio)
        # the root's budget is a constant, all others come from the level above
        given = ranked.withColumn("_b0", F.lit(float(budget))) if parent is None else ranked.join(parent, f"_n{d - 1}")
        filled = given.withColumns({
            "_used": F.coalesce(F.sum("_s").over(past), F.lit(0.0)),
            "_rest": F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
        level = F.when(F.col("_rest") > 0, (F.col(f"_b{d - 1}") - F.col("_used")) / F.col("_rest")).otherwise(0.0)
        # the common x is reached at the first sibling that does not run dry
        wet = F.min(F.when((F.col("_x") < F.col("_r")) & (F.col("_w") > 0), F.struct("_r", "_x"))).over(left)["_x"]
        parent = filled.withColumn("_x", level).withColumn("_level", wet).select(
            f"_n{d}", F.when(F.col("_level").isNull(), F.col("_s")).otherwise(
                F.least("_s", F.greatest(F.lit(0.0), F.col("_level")) * F.col("_w"))).alias(f"_b{d}"))
    last = len(levels)
    return nodes.join(parent, f"_n{last}").select(*leaves.columns, F.col(f"_b{last}").alias("budget"))


def mix(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, float], share: float = 1.0,
        epochs: int = 2, seed: int = 17, tokens: Column | None = None, text_col: str = "text",
        id_col: str = "doc_id", text_hash: Column | None = None) -> DataFrame:
    """Rows of ``docs`` with their level columns, ``tokens`` and ``epoch`` (from 1), once for each time they are taken.

    ``levels`` names the tree's levels from the top and gives each row's node there. The total budget
    is ``share`` of all tokens. A leaf takes whole epochs while its budget lasts and then, in that
    epoch's seeded order, every row whose tokens start before the budget ends. ``text_hash`` takes the place of the
    text's xxhash64 where the text itself is not there.

    A leaf's order is cut into 1,024 ranges of a seeded hash, or one for every 100,000 rows of the table. Sums per range tell which
    range holds the end of the budget; rows before it are taken and rows after it
    left without being sorted or moved, so a leaf that holds a third of all rows is no hot group. The tree
    itself (a row per leaf) stays distributed.

    NULL level values are a node of their own. Rows without tokens cost nothing and are
    taken with each started epoch. Rows of equal id and text are ordered one after the other in any
    order. A row is carried as one column, so its own names clash with nothing; those that are named like a result are
    replaced. An empty table gives no rows.
    """
    names = list(levels)
    spent = word_count(F.col(text_col)) if tokens is None else tokens
    hashed = F.xxhash64(text_col) if text_hash is None else text_hash
    replaced = {*names, "tokens", "epoch"}
    carried = [c for c in docs.columns if c not in replaced]
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_row"), *[c.alias(n) for n, c in levels.items()],
        spent.alias("tokens"), F.col(id_col).alias("_id"), hashed.alias("_hash")).withColumn(
        "_key", F.xxhash64(F.lit(seed), "_id", "_hash"))

    leaves = keyed.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("_rows"))
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).first()
    ranges = max(RANGES, total["n"] // ROWS_PER_RANGE)

    def range_of(epoch: Column) -> Column:
        return F.pmod(F.xxhash64(epoch.cast("long"), "_key"), F.lit(ranges)).cast("int")

    budgets = allocate(leaves.drop("_rows"), names, weights, float(total["t"]) * share, epochs)
    whole = F.least(F.floor(F.when(F.col("tokens") > 0, F.col("budget") / F.col("tokens") + 1e-9).otherwise(0.0)),
                    F.lit(epochs)).cast("int")
    plan = stored(budgets.withColumn("_whole", whole).select(
        *names, "_whole", (F.col("budget") - F.col("_whole") * F.col("tokens")).alias("_want")), "budgets")

    same = [F.col(f"d.{n}").eqNullSafe(F.col(f"p.{n}")) for n in names]
    planned = keyed.alias("d").join(plan.alias("p"), same).select("d.*", "p._whole", "p._want").withColumn(
        "_range", range_of(F.col("_whole") + 1))
    leaf = _leaf_key(names, len(names)).alias("_leaf")
    sums = planned.filter("_want > 1e-6").groupBy(leaf, "_range").agg(
        F.sum("tokens").alias("_sum"), F.max("_want").alias("_want"))
    before = Window.partitionBy("_leaf").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    started = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).filter("_start < _want")
    ends = stored(started.groupBy("_leaf").agg(F.max(F.struct("_range", "_start")).alias("_end")), "ends")

    cut = planned.select("*", leaf).join(ends, "_leaf", "left").withColumn("_end_range", F.col("_end._range"))
    partly = F.col("_end_range").isNotNull() & (F.col("_range") < F.col("_end_range"))
    sure = cut.withColumn("_times", F.col("_whole") + partly.cast("int"))
    in_order = Window.partitionBy("_leaf").orderBy(
        F.xxhash64(F.col("_whole") + F.lit(1), F.lit("order"), "_key"), "_id", "_hash"
    ).rowsBetween(Window.unboundedPreceding, -1)
    edge = cut.filter(F.col("_range") == F.col("_end_range")).withColumn(
        "_at", F.col("_end._start") + F.coalesce(F.sum("tokens").over(in_order), F.lit(0))).filter("_at < _want")
    kept = ["_row", *[F.col(f"`{n}`") for n in names], "tokens"]
    taken = sure.filter("_times > 0").select(*kept, F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("epoch")).unionAll(
        edge.select(*kept, (F.col("_whole") + 1).alias("epoch")))
    return taken.select(*[F.col(f"_row.`{c}`") for c in carried], *kept[1:], "epoch")
