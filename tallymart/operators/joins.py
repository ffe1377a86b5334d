"""Star join, fan-out-safe join of two facts, key resolution and dense grids."""

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources.tables import id_range
from .marks import marked, marks

HASHED = (T.StringType, T.IntegralType, T.DateType)  # equal values of one of these types have equal hashes


@dataclass(frozen=True)
class Join:
    """Left many-to-one join of ``source`` with ``df`` under the name ``alias``.

    ``range_on``, a (source column, joined column) pair that ``on`` equates, is for joins that few rows of the source
    have a partner in: only joined rows in the source's range of it are looked at, and only source rows that
    may have a partner are shuffled.
    """

    alias: str
    df: DataFrame
    on: str
    range_on: tuple[str, str] | None = None


def star_join(fact: DataFrame, joins: Sequence[Join], alias: str = "source") -> DataFrame:
    """``fact`` with every join attached; all fact rows stay.

    No broadcast of joined rows is forced: Spark broadcasts a side that its size statistics
    allow and sort-merges the rest, where adaptive execution splits hot keys on
    the fact side. Joins with ``range_on`` come first, as ``sparse_join``.
    """
    def sparse(join: Join) -> dict[str, str]:
        keys = _equal_columns(join.on, alias, join.alias) if join.range_on else {}
        return keys if _hash_alike(fact, join.df, keys) else {}

    rows = fact
    for join in joins:
        if join.range_on and sparse(join):
            near = in_range_of(join.df, join.range_on[1], fact, join.range_on[0])
            rows = sparse_join(rows, near, sparse(join), join.alias)
    out = rows.alias(alias)
    for join in joins:
        if not sparse(join):
            out = out.join(join.df.alias(join.alias), F.expr(join.on), "left")
    return out


def _equal_columns(on: str, left: str, right: str) -> dict[str, str]:
    """{left column: right column} of a condition made of such equalities only; else nothing."""
    found = {}
    for test in re.split(r"\s+AND\s+", on.strip(), flags=re.IGNORECASE):
        sides = re.fullmatch(r"`?(\w+)`?\.`?(\w+)`?\s*=\s*`?(\w+)`?\.`?(\w+)`?", test)
        named = {sides[1]: sides[2], sides[3]: sides[4]} if sides else {}
        if set(named) != {left, right} or named[left] in found:
            return {}
        found[named[left]] = named[right]
    return found


def _hash_alike(left: DataFrame, right: DataFrame, keys: Mapping[str, str]) -> bool:
    kinds = [(left.schema[l].dataType, right.schema[r].dataType) for l, r in keys.items()]
    return bool(kinds) and all(a == b and isinstance(a, HASHED) for a, b in kinds)


def in_range_of(df: DataFrame, column: str, source: DataFrame, source_column: str) -> DataFrame:
    """The rows whose ``column`` lies in the source's range of ``source_column``.

    The bounds are scalar subqueries on one column of the source. The filter goes below a sum that makes ``df``.
    """
    low, high = (source.agg(f(source_column)).scalar() for f in (F.min, F.max))
    return df.filter((F.col(column) >= low) & (F.col(column) <= high))


def sparse_join(left: DataFrame, right: DataFrame, keys: Mapping[str, str], name: str) -> DataFrame:
    """``left`` joined to ``right`` on equal ``keys`` (left column: right column), for few left rows with a partner.

    All left rows stay. The right row is in the struct column ``name``, NULL without a partner. Bitmaps of the right
    keys' hashes, 8 MB at most, tell which left rows may have a partner: these are joined, the others are not shuffled. Hashes that
    meet by chance cost a row in the shuffle and never change the result. ``left`` is read twice, so its rows must not
    change from one read to the next.
    """
    rows = marked(left, list(keys), marks(right, list(keys.values())), "_meets")
    own = [F.col(f"`{c}`") for c in left.columns]
    partner = right.select(
        *[F.col(f"`{r}`").alias(f"_key_{i}") for i, r in enumerate(keys.values())],
        F.struct(*[F.col(f"`{c}`") for c in right.columns]).alias(name))
    on = [F.col(f"`{l}`") == F.col(f"_key_{i}") for i, l in enumerate(keys)]
    met = rows.filter("_meets").select(*own).join(partner, on, "left").select(*own, name)
    alone = rows.filter("NOT _meets").select(*own, F.lit(None).cast(partner.schema[name].dataType).alias(name))
    return alone.unionAll(met)


def drill_across(
    left: DataFrame, right: DataFrame, keys: Mapping[str, str] | Sequence[str], aggs: Sequence[Column],
    range_on: str | None = None,
) -> DataFrame:
    """Left rows with right's aggregates at the same grain; one output row per left row.

    ``keys`` maps left column to right column (or lists shared names). ``right``
    is summed to the key grain before the join, so left rows cannot multiply and
    a repeated key is folded before it is shuffled. ``range_on`` names a left key, where few left rows have a partner: only right
    rows in the left's range of it are summed, and only left rows that may have a partner are shuffled.
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    sparse = range_on and _hash_alike(left, right, pairs)
    if sparse:
        right = in_range_of(right, pairs[range_on], left, range_on)
    summed = right.groupBy(*[F.col(r).alias(f"_{l}") for l, r in pairs.items()]).agg(*aggs)
    if sparse:
        out = sparse_join(left, summed, {l: f"_{l}" for l in pairs}, "_right")
        return out.select(*left.columns, *[f"_right.`{c}`" for c in summed.columns[len(pairs):]])
    on = [left[l] == summed[f"_{l}"] for l in pairs]
    return left.join(summed, on, "left").drop(*[f"_{l}" for l in pairs])


def resolve_index(df: DataFrame, master: DataFrame, index: str, columns: Sequence[str]) -> DataFrame:
    """Replace a dense index by columns of the master row that carries it (inner join)."""
    return df.join(master.select(index, *columns), index).drop(index)


def grid(spark: SparkSession, sizes: Mapping[str, int], parts: int | None = None) -> DataFrame:
    """Every combination of index values 0..n-1, the last name varying fastest.

    Made from one range by division and remainder: no join and no shuffle. The output
    has the product of all sizes, so this is for a full assortment that somebody asks for, not for joins.
    """
    step = prod(sizes.values())
    out = id_range(spark, step, parts)
    columns = []
    for name, n in sizes.items():
        inner = step // n
        columns.append(F.expr(f"cast(id % {step} div {inner} as bigint)").alias(name))
        step = inner
    return out.select(*columns)


def each_day(df: DataFrame, days: int, name: str = "day_idx") -> DataFrame:
    """Every row once per day 0..days-1."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
