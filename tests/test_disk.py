"""What writes leave on disk: short rows in shuffles, no shuffle files afterwards, well packed keys."""

import glob
import os

from pyspark.sql import functions as F

from registry import queries as R
from tallymart.operators import glossary, inclusion
from tallymart.plans import increments as I
from tallymart.sources.tables import write_table
from test_late_keys import plan, tiny_folder  # noqa: F401


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {n for n in (blocks.apply(i).name() for i in range(blocks.size())) if n.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    rows = write_table(spark.range(1000).select("id", (F.col("id") % 7).alias("k")), f"{tmp_path}/t", cluster_by=["k"])
    assert not shuffle_files(spark) - before and rows.count() == 1000


def test_keys_pack(spark, tmp_path):
    key = F.sha2(F.pmod(F.xxhash64("id"), F.lit(30_000)).cast("string"), 256)
    for name, rows, most in (("once", spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key")), 34.5),
                             ("again", spark.range(300_000).select(key.alias("key")), 12)):
        write_table(rows.coalesce(1), f"{tmp_path}/{name}")
        (path,) = glob.glob(f"{tmp_path}/{name}/*.parquet")
        assert os.path.getsize(path) < rows.count() * most
        assert spark.read.parquet(path).exceptAll(rows).isEmpty()


def test_daily_sales_are_gathered_before_keys_are_hashed(spark, tiny_folder, monkeypatch):  # noqa: F811
    seen = []
    monkeypatch.setattr(R, "write_table", lambda df, ref, late, **layout: (seen.append(plan(df)), write_table(df, ref, late=late, **layout))[1])
    got = R.QUERIES["table_roundtrip"](spark, tiny_folder)
    want = R.gold_of(spark, tiny_folder)["daily_sales_by_product_store"]
    assert "sha2(" not in seen[0]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_rows_of_a_period_are_sorted_before_keys_are_hashed(spark, tiny_bronze, tmp_path, monkeypatch):
    seen, write = [], I._replace
    monkeypatch.setattr(I, "_replace", lambda df, *more: (seen.append(plan(df)), write(df, *more)))
    I.refresh_periods(tiny_bronze, str(tmp_path), "fact_inventory")
    (stock,) = seen
    assert stock.index("sha2(") < stock.index("Sort [snapshot_date") and "product_id" in stock[stock.index("Sort ["):].split("\n")[0]


def test_exact_profile_counts_texts(spark, tiny_folder, monkeypatch):  # noqa: F811
    seen, cells = [], glossary.long_values
    monkeypatch.setattr(glossary, "long_values", lambda df, columns: (seen.append(plan(df)), cells(df, columns))[1])
    for name in ("column_profile", "column_profile_sketch"):
        R.QUERIES[name](spark, tiny_folder)
    assert len(seen) == 12 and not any("sha2(" in p for p in seen)
    df = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    got = glossary.profile_columns(df.withColumn("k", F.sha2(F.col("k").cast("string"), 256)), "t", distinct="exact", alike=df)
    assert {r.column_name: (r.distinct_count, len(r.max_value)) for r in got.collect()} == {"k": (3, 64), "id": (10, 1)}


def test_uniqueness_shuffles_hashes(spark, monkeypatch):
    seen, audit = [], inclusion.audit_primary_key
    monkeypatch.setattr(inclusion, "audit_primary_key", lambda df, key: (seen.append(key), audit(df, key))[1])
    n = spark.range(50).select(F.col("id").alias("a.b"), (F.col("id") % 9).alias("k"), F.lit(None).cast("int").alias("no"))
    assert [inclusion._is_key(n, c) for c in n.columns] == [True, False, True] and seen == ["v"] * 3
