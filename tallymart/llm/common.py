"""Helpers shared by the corpus operators: stored intermediates, text columns, Arrow passes, components."""

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.tables import durable, scratch_table, shuffles_dropped  # noqa: F401

WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE = 256  # texts turned into Python objects at a time


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str, level: int = 3, place: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder, or at ``place`` in it, and scan it.

    Later passes then see the same rows whatever is recomputed, and a lost
    executor costs nothing that was written. The folder goes when the driver ends.
    A higher ``level`` of zstd takes more time and less disk, for tables that stay beside many others.
    """
    spark = df.sparkSession
    path = place or scratch_table(spark, name)
    df.write.options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": level}).parquet(path)
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def by_row(make: Callable[..., Iterator[dict]], schema: pa.Schema):
    """``mapInArrow`` function from a per-task row maker.

    ``make()`` is called once a task and returns a function from a list of row
    tuples to a list of result tuples. Texts become Python objects in small slices.
    """

    def run(batches):
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                rows = work(list(zip(*[c.to_pylist() for c in part.columns])))
                if rows:
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    Alternates large-star and small-star rounds. Each round finds the smallest
    neighbour by a map-side combined minimum and joins it back to the links, so a
    node with very many links is an ordinary skewed join, never one group. Links
    are frozen by checkpoint() after each round; only their count and two sums of
    hashes come to the driver. Self-links and repeated links are ignored, so an
    empty frame gives no rows.
    """
    links = durable(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    seen = _mark(links)
    while seen[0]:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        small = large.join(large.groupBy("hi").agg(F.min("lo").alias("m")), "hi")
        links = durable(
            small.select("hi", F.col("m").alias("lo"))
            .unionAll(small.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))).distinct())
        now = _mark(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.bit_xor(F.xxhash64("lo", "hi"))).first())
