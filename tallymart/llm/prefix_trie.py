"""All common prefixes of conversations as a trie, by ROLLUP over columns of turn ids.

A conversation is laid out in blocks of eight turn-id columns. One ROLLUP over a block's columns, with
``grouping_id`` telling the length, makes every prefix that ends in the block a group. A conversation of more turns
goes on in further blocks, each keyed by the node that the one before ended at, so rows stay
narrow whatever the longest conversation is.

A node is named by its depth and 128 bits: the XOR of a hash of each (place, turn) on its path. The XOR up to a
block is a running fold, so all blocks are made at once.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.index import dense_index
from .common import stored

WIDTH = 8        # turn columns of a block
RUN = 1024       # rows of a running fold that are ordered in one group
NODE = ["depth", "hi", "lo"]


# -- turns --------------------------------------------------------------------

def turn_id(role: Column, text: Column) -> Column:
    """128 bits of role and text (NULL is empty), and the text's code points."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.struct(F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
                    F.length(text).cast("bigint").alias("chars"))


def ordered(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv_id, pos, turn): each conversation's turn ids, numbered from 1 by turn, NULL first; equal turns by their ids.

    Numbers come from one dense index over the whole table, so a conversation that holds a third of all rows is no group.
    Rows without a conversation are left out.
    """
    ids = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("at"),
        turn_id(F.col(role_col).cast("string"), F.col(text_col).cast("string")).alias("turn"))
    placed = dense_index(ids, ["conv_id", "at", "turn"], "place")
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("place") - F.col("first") + 1).alias("pos"), "turn")


def _sign(depth: Column, turn: Column) -> tuple[Column, Column]:
    """Two hashes of a turn at its depth; 0 without a turn."""
    return (F.when(turn.isNull(), F.lit(0)).otherwise(F.xxhash64(depth, turn["id"])).cast("bigint"),
            F.when(turn.isNull(), F.lit(0)).otherwise(F.xxhash64(turn["id"], F.lit("lo"), depth)).cast("bigint"))


def _before(rows: DataFrame, key: str, order: str, fold, columns: dict[str, str]) -> DataFrame:
    """``rows`` with, for each (name: column), the fold of the column over earlier rows of the key.

    Runs of ``RUN`` places are folded first and the folds run on, so no group has more rows than that, or one for each run.
    """
    run = F.floor(F.col(order) / RUN)
    in_run = Window.partitionBy(key, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    of_runs = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.withColumn("_run", run)
    runs = cut.groupBy(key, "_run").agg(*[fold(c).alias(f"_{n}") for n, c in columns.items()])
    past = runs.select(key, "_run", *[fold(f"_{n}").over(of_runs).alias(f"_{n}") for n in columns]).filter("_run > 0")
    both = cut.withColumns({n: F.coalesce(fold(c).over(in_run), F.lit(0)) for n, c in columns.items()}).join(
        past, [key, "_run"], "left")
    # folds are XOR or sum; one value is folded with another the same way
    join = (lambda a, b: a.bitwiseXOR(b)) if fold is F.bit_xor else (lambda a, b: a + b)
    return both.withColumns({n: join(F.col(n), F.coalesce(F.col(f"_{n}"), F.lit(0))) for n in columns}).drop(
        "_run", *[f"_{n}" for n in columns])


# -- trie ---------------------------------------------------------------------

def blocks(sequences: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and block: ``prior`` (block and the node it goes on from), t1..t8, and the block's XOR."""
    hi, lo = _sign(F.col("pos"), F.col("turn"))
    place = F.col("pos") - 1
    rows = sequences.select(
        "conv_id", F.floor(place / WIDTH).alias("block"), F.pmod(place, F.lit(WIDTH)).alias("slot"), "turn",
        hi.alias("hi"), lo.alias("lo"))
    nothing = convs.select(
        "conv_id", F.lit(0).cast("bigint").alias("block"), F.lit(-1).cast("bigint").alias("slot"),
        F.lit(None).cast(sequences.schema["turn"].dataType).alias("turn"), F.lit(0).cast("bigint").alias("hi"),
        F.lit(0).cast("bigint").alias("lo"))
    laid = rows.unionAll(nothing).groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("slot") == i, F.col("turn"))).alias(f"t{i + 1}") for i in range(WIDTH)],
        F.count("turn").alias("turns"), F.bit_xor("hi").alias("hi"), F.bit_xor("lo").alias("lo"))
    prior = _before(laid, "conv_id", "block", F.bit_xor, {"prior_hi": "hi", "prior_lo": "lo"})
    return prior.select(
        "conv_id", F.struct("block", F.col("prior_hi").alias("hi"), F.col("prior_lo").alias("lo")).alias("prior"),
        *[f"t{i + 1}" for i in range(WIDTH)], "turns", "hi", "lo")


def _prefixes(rows: DataFrame, aggregates: str) -> DataFrame:
    """Every prefix as a group: ``depth``, ``hi``, ``lo``, the ``last`` turn and the aggregates."""
    slots = [f"t{i + 1}" for i in range(WIDTH)]
    grouped = rows.sparkSession.sql(
        f"SELECT prior, {', '.join(slots)}, {WIDTH} - bit_count(grouping_id()) AS level, {aggregates}"
        f" FROM {{rows}} GROUP BY prior, ROLLUP({', '.join(slots)})", rows=rows)
    # the last turn of a group of n columns must be there: a conversation that ended earlier has a group of fewer
    there = F.when(F.col("level") == 0, F.col("prior.block") == 0).otherwise(
        F.element_at(F.array(*[F.col(s).isNotNull() for s in slots]), F.greatest(F.col("level"), F.lit(1)).cast("int")))
    first = F.col("prior.block") * WIDTH
    hi, lo = F.col("prior.hi"), F.col("prior.lo")
    for i, slot in enumerate(slots):
        h, l = _sign(first + F.lit(i + 1), F.col(slot))
        hi, lo = hi.bitwiseXOR(h), lo.bitwiseXOR(l)
    return grouped.filter(there).withColumns({
        "depth": first + F.col("level"), "hi": hi, "lo": lo, "last": F.coalesce(*[F.col(s) for s in reversed(slots)]),
    }).drop("prior", *slots, "level")


def _ends(rows: DataFrame) -> DataFrame:
    """SHA-256 of the conversations that end at each node, ascending and joined by commas.

    The rows come sorted and are hashed as they pass, so the ids of a node are never held together.
    """
    whole = rows.groupBy("conv_id").agg(
        F.sum("turns").alias("depth"), F.bit_xor("hi").alias("hi"), F.bit_xor("lo").alias("lo"))

    def run(batches):
        now, digest = None, None
        schema = pa.schema([("depth", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("ends_sha256", pa.string())])

        def batch_of(done):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

        for batch in batches:
            done = []
            for *node, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if node == now:
                    digest.update(b",%d" % conv)
                else:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = node, hashlib.sha256(b"%d" % conv)
            if done:
                yield batch_of(done)
        if now is not None:
            yield batch_of([(*now, digest.hexdigest())])

    return whole.select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id").mapInArrow(
        run, "depth bigint, hi bigint, lo bigint, ends_sha256 string")


def trie(sequences: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``sequences`` (conv_id, pos, turn); ``convs`` (conv_id) lists all conversations, also turnless ones.

    ``conv_id`` is the smallest member, ``n_leaves`` and ``saved_tokens`` go over the node's subtree; saved are the code points of a
    node's last text for each member but one. Each node's share is credited to its smallest member, and each leaf counts for
    its own, so that sums over a subtree are sums over members, and a second ROLLUP gives them without any
    walk down the trie. A member's own nodes above the one in question are taken off again.

    No conversations give no rows, not even a root. Rows of one conversation must have different places.
    """
    rows = stored(blocks(sequences, convs), "blocks")
    nodes = stored(_prefixes(rows, "min(conv_id) AS conv_id, count(*) AS n_convs").select(
        *NODE, "conv_id", "n_convs", F.coalesce(F.col("last.chars"), F.lit(0)).alias("chars"),
        *[F.col(n).bitwiseXOR(s).alias(f"parent_{n}") for n, s in zip(("hi", "lo"), _sign(F.col("depth"), F.col("last")))]), "nodes")
    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo")).agg(
        F.count(F.lit(1)).alias("n_children"))
    known = stored(nodes.join(children, NODE, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "own": (F.col("n_convs") - 1) * F.col("chars")}), "nodes-children")
    credit = known.groupBy("conv_id").agg(
        F.sum("own").alias("credit"), F.count_if(F.col("n_children") == 0).alias("leaves"))
    below = _prefixes(
        rows.join(credit, "conv_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("credit", "leaves")}),
        "sum(credit) AS credit, sum(leaves) AS n_leaves").select(*NODE, "credit", "n_leaves")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("parent_hi"),
                           F.col("lo").alias("parent_lo"), F.col("conv_id").alias("parent_conv_id"))
    return (
        _before(known, "conv_id", "depth", F.sum, {"above": "own"})
        .join(below, NODE).join(_ends(rows), NODE, "left")
        .join(parents, ["depth", "parent_hi", "parent_lo"], "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                (F.col("credit") - F.col("above")).alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """The trie of a table of turns, with the rows of ``trie``.

    A NULL turn number comes first, NULL role and text are empty, turns of equal number are ordered by a hash of role and text, a
    repeated row is a turn of its own, rows without a conversation and other columns are ignored. An empty table gives no rows.
    """
    places = ordered(turns, conv_col, turn_col, role_col, text_col)
    return trie(places, places.select("conv_id").distinct())
