"""Hashes first, keys only where a hash repeats; and what stored tables are packed with."""

import glob

from pyspark.sql import functions as F

from tallymart.operators import glossary, quality
from tallymart.sources.tables import write_table


def keyed(spark):
    """3,000 keys that occur once, 500 twice, one 2,000 times, and 40 rows without one."""
    once = spark.range(3000).select(F.concat(F.lit("a"), "id").alias("k"))
    twice = spark.range(1000).select(F.concat(F.lit("b"), F.floor(F.col("id") / 2)).alias("k"))
    hot = spark.range(2000).select(F.lit("hot").alias("k"))
    none = spark.range(40).select(F.lit(None).cast("string").alias("k"))
    return once.union(twice).union(hot).union(none).withColumn("n", F.length("k"))


def test_key_audit_counts(spark):
    got = quality.audit_primary_key(keyed(spark), "k").first().asDict()
    assert got == {"total_rows": 6040, "null_keys": 40, "distinct_keys": 3501, "repeated_keys": 501, "surplus_rows": 2499}
    two = quality.audit_primary_key(keyed(spark), ["k", "n"]).first().asDict()
    assert two == got
    assert tuple(quality.audit_primary_key(keyed(spark).limit(0), "k").first()) == (0, 0, 0, 0, 0)


def test_exact_profile_counts(spark):
    rows = {r["column_name"]: r for r in glossary.profile_columns(keyed(spark), "t", distinct="exact").collect()}
    assert rows["k"]["distinct_count"] == 3501 and rows["k"]["null_count"] == 40
    assert rows["n"]["distinct_count"] == keyed(spark).filter("n IS NOT NULL").select("n").distinct().count()
    empty = glossary.profile_columns(keyed(spark).limit(0), "t", distinct="exact").collect()
    assert [r["distinct_count"] for r in empty] == [0, 0]


def test_keys_are_shuffled_only_where_their_hash_repeats(spark):
    for df in (quality.audit_primary_key(keyed(spark), "k"), glossary.profile_columns(keyed(spark), "t", distinct="exact")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "bitmap_construct_agg" in plan and "xxhash64" in plan


def test_hex_keys_take_half_their_length_when_stored(spark, tmp_path):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key")).coalesce(1)
    write_table(rows, f"{tmp_path}/t")
    (path,) = glob.glob(f"{tmp_path}/t/*.parquet")
    with open(path, "rb") as f:
        assert len(f.read()) < 20_000 * 42
