"""Stored aggregates of a metric view that answer queries at any coarser grain, distinct counts included.

A rollup keeps the parts of measures at a grain of source columns, for instance day and store. Sums and counts add up. For a
distinct count every key has a dense number from a stored dictionary, and a group keeps the numbers it saw: a few as
they are, many as a bitmap for each bucket of 32,768. Bitmaps are put together by OR, so a distinct
count over any set of groups is exact and costs no pass over the base rows.
"""

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.index import dense_index
from ..sources.tables import _file_system, inside, scratch_table, write_table
from .metrics import _MERGE, Dimension, MetricView, Part, _joined

FEW = 512   # numbers of a bucket kept one by one; more are a bitmap of 4,096 bytes


# -- dictionary ---------------------------------------------------------------

def _stored(spark: SparkSession, path: str) -> bool:
    where, files = _file_system(spark, path)
    return files.exists(where)


def number_keys(keys: DataFrame, path: str) -> DataFrame:
    """(key, id) of every key ever seen, ids from 1 without gaps; new keys of ``keys`` (key, first) are appended, old ones keep theirs.

    New keys are numbered by ``first`` and key, so that keys of one time are near each other and fill few buckets.
    NULL is no key. One writer at a time.
    """
    spark = keys.sparkSession
    kind = keys.schema["key"].dataType.simpleString()
    shape = f"key {kind}, id bigint"
    wanted = keys.filter("key IS NOT NULL").groupBy("key").agg(F.min("first").alias("first"))
    known = spark.read.schema(shape).parquet(path) if _stored(spark, path) else spark.createDataFrame([], shape)
    size = known.count()
    new = dense_index(wanted.join(known, "key", "left_anti"), ["first", "key"], "place")
    new.select("key", (F.col("place") + size + 1).alias("id")).write.mode("append").parquet(path)
    return spark.read.schema(shape).parquet(path)


# -- rollup -------------------------------------------------------------------

def _source_columns(text: str) -> set[str]:
    return set(re.findall(r"\bsource`?\.`?(\w+)", text))


@dataclass(frozen=True)
class Rollup:
    """``rows``: the grain and a column per additive part. ``sets``: the grain, ``what`` (the distinct part), ``bucket``, ``few`` and ``bits``."""

    view: str
    grain: tuple[str, ...]
    parts: Mapping[Part, str]
    rows: DataFrame
    sets: DataFrame

    def covers(self, view: MetricView, dims: Mapping[str, Dimension], parts: Sequence[Part]) -> bool:
        """Whether a query can be answered from here: its parts are kept, and its dimensions follow from the grain."""
        if view.name != self.view or not set(parts) <= set(self.parts):
            return False
        joins = {j.alias: j for j in view.joins}
        texts = [d.expr for d in dims.values()]
        texts += [joins[a].on for a in view.aliases_in(texts)]
        return set().union(*map(_source_columns, texts)) <= set(self.grain)

    def grouped(self, view: MetricView, gold: Mapping[str, DataFrame], dims: Mapping[str, Dimension], keys: Sequence[str],
                parts: Mapping[Part, str], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """One row per combination of ``keys`` with a column for every part; ``keep`` filters by the dimensions."""
        used = view.aliases_in(d.expr for d in dims.values())

        def at_dims(df: DataFrame, *columns: str) -> DataFrame:
            return keep(_joined(view, gold, df, used).select(
                *[F.expr(d.expr).alias(n) for n, d in dims.items()], *[F.col(f"source.{c}") for c in columns]))

        by = [F.col(f"`{k}`") for k in keys]
        added = {p: c for p, c in parts.items() if p.how != "distinct"}
        rows = at_dims(self.rows, *[self.parts[p] for p in added])
        types = dict(self.rows.dtypes)
        out = rows.groupBy(*by).agg(
            F.lit(1).alias("_one"),
            *[_MERGE[p.how](F.col(self.parts[p])).cast(types[self.parts[p]]).alias(c) for p, c in added.items()])
        names = {self.parts[p]: c for p, c in parts.items() if p.how == "distinct"}
        if not names:
            return out
        counts = self._distinct(at_dims, by, names).withColumn("_one", F.lit(1))
        same = [F.col(f"rows.`{n}`").eqNullSafe(F.col(f"sets.`{n}`")) for n in ["_one", *keys]]
        return out.alias("rows").join(counts.alias("sets"), same, "left").select(
            "rows.*", *[F.coalesce(f"sets.{c}", F.lit(0)).alias(c) for c in names.values()])

    def _distinct(self, at_dims, by: list[Column], names: Mapping[str, str]) -> DataFrame:
        """Exact distinct counts: few numbers become bitmaps, bitmaps are put together, bits are counted."""
        asked = at_dims(self.sets.filter(F.col("what").isin(list(names))), "what", "bucket", "few", "bits")
        group = [*by, "what", "bucket"]
        few = asked.filter("few IS NOT NULL").select(*group, F.explode("few").alias("at")).groupBy(*group).agg(
            F.bitmap_construct_agg("at").alias("bits"))
        whole = few.unionByName(asked.filter("bits IS NOT NULL").select(*group, "bits")).groupBy(*group).agg(
            F.bitmap_or_agg("bits").alias("bits")).withColumn("n", F.bitmap_count("bits"))
        return whole.groupBy(*by).agg(*[
            F.coalesce(F.sum(F.when(F.col("what") == what, F.col("n"))), F.lit(0)).alias(c) for what, c in names.items()])


def _names(parts: Sequence[Part]) -> dict[Part, str]:
    return {p: f"{p.how}_{i}" for i, p in enumerate(parts)}


def store_rollup(view: MetricView, gold: Mapping[str, DataFrame], grain: Sequence[str], where: str, name: str) -> Rollup:
    """Aggregate all measures of ``view`` at ``grain`` (columns of its source) and store them in the folder ``where``.

    Parts other than sums, counts, smallest, largest and distinct values are left out, and with them the queries that need them.
    The dictionary of a distinct part is shared by all rollups of the folder.
    """
    parts = [p for p in dict.fromkeys(p for m in view.measures for p in m.parts.values())
             if p.how == "distinct" or p.how in _MERGE]
    named = _names(parts)
    base = _joined(view, gold, gold[view.source], view.aliases_in(p.of for p in parts)).select(
        *[F.col(f"source.{c}") for c in grain], *[F.expr(p.of).alias(c) for p, c in named.items()])
    adds = [p.over(c).alias(c) for p, c in named.items() if p.how != "distinct"]
    rows = base.groupBy(*grain).agg(F.count(F.lit(1)).alias("base_rows"), *adds)
    rows = write_table(rows, inside(where, f"{name}/rows"))

    sets = None
    for part, column in named.items():
        if part.how != "distinct":
            continue
        seen = write_table(base.select(*grain, F.col(column).cast("string").alias("key")).filter("key IS NOT NULL").distinct(),
                           scratch_table(base.sparkSession, "seen"))
        path = inside(where, f"keys/{re.sub(r'[^A-Za-z0-9]+', '_', part.of)}")
        keys = number_keys(seen.select("key", F.col(grain[0]).alias("first")), path)
        numbers = seen.join(keys, "key").select(
            *grain, F.lit(column).alias("what"), F.bitmap_bucket_number("id").alias("bucket"),
            F.bitmap_bit_position("id").alias("at"))
        sets = numbers if sets is None else sets.unionByName(numbers)
    return Rollup(view.name, tuple(grain), named, rows, _stored_sets(sets, grain, inside(where, f"{name}/sets"), base))


def _stored_sets(numbers: DataFrame | None, grain: Sequence[str], path: str, base: DataFrame) -> DataFrame:
    group = [*grain, "what", "bucket"]
    if numbers is None:
        nothing = base.select(*grain).limit(0)
        return write_table(nothing.select("*", F.lit("").alias("what"), F.lit(0).cast("bigint").alias("bucket"),
                                          F.expr("CAST(NULL AS ARRAY<BIGINT>)").alias("few"), F.lit(None).cast("binary").alias("bits")), path)
    # a bucket has at most 32,768 numbers, so no list is longer
    lists = write_table(numbers.groupBy(*group).agg(F.collect_list("at").alias("few")),
                        scratch_table(base.sparkSession, "lists"))
    small = F.size("few") <= FEW
    large = lists.filter(~small).select(*group, F.explode("few").alias("at")).groupBy(*group).agg(
        F.bitmap_construct_agg("at").alias("bits"))
    kind = lists.schema["few"].dataType
    return write_table(
        lists.filter(small).withColumn("bits", F.lit(None).cast("binary")).unionByName(
            large.withColumn("few", F.lit(None).cast(kind))), path)


def open_rollup(spark: SparkSession, view: MetricView, grain: Sequence[str], where: str, name: str) -> Rollup:
    """A stored rollup of ``view``; the same view and grain must be named as when it was stored."""
    parts = [p for p in dict.fromkeys(p for m in view.measures for p in m.parts.values())
             if p.how == "distinct" or p.how in _MERGE]
    return Rollup(view.name, tuple(grain), _names(parts), spark.read.parquet(inside(where, f"{name}/rows")),
                  spark.read.parquet(inside(where, f"{name}/sets")))
