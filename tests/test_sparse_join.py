"""Joins in which few rows of the left side have a partner."""

from datetime import date

from pyspark.sql import functions as F

from tallymart.operators.joins import Join, drill_across, sparse_join, star_join
from tallymart.plans.definitions import INVENTORY
from tallymart.plans.metrics import metric_query


def both(spark):
    stock = spark.createDataFrame(
        [(f"s{i % 7}", date(2024, 1, 1 + i % 14), i) for i in range(500)] + [(None, date(2024, 1, 1), -1), ("s1", None, -2)],
        "store string, day date, stock int")
    sales = spark.createDataFrame(
        [("s1", date(2024, 1, 2), 5), ("s1", date(2024, 1, 2), 6), ("s3", date(2024, 1, 9), 7), ("x", date(2024, 1, 2), 8),
         ("s1", date(2031, 1, 2), 9), (None, date(2024, 1, 1), 1), ("s1", None, 2)], "shop string, d date, units int")
    return stock, sales


def test_rows_of_the_plain_join(spark):
    stock, sales = both(spark)
    got = sparse_join(stock, sales, {"store": "shop", "day": "d"}, "sale").select("store", "day", "stock", "sale.units")
    want = stock.join(sales, (F.col("store") == F.col("shop")) & (F.col("day") == F.col("d")), "left").select(
        "store", "day", "stock", "units")
    assert want.filter("units IS NOT NULL").count() > 0
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_every_partner_is_found(spark):
    left = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("k"))
    right = left.filter("id % 3 = 0").select("k", F.col("id").alias("n"))
    got = sparse_join(left, right, {"k": "k"}, "r").select("id", "r.n")
    assert got.filter("n = id").count() == right.count() and got.filter("n IS NULL").count() == 20_000 - right.count()


def test_star_join_and_drill_across_agree_with_the_plain_way(spark):
    stock, sales = both(spark)
    once = sales.filter("units <> 6")
    on = "source.store = sales.shop AND source.day = sales.d"
    plain, sparse = (star_join(stock, [Join("sales", once, on, r)]).select("source.stock", "sales.units") for r in (None, ("day", "d")))
    assert sorted(map(str, plain.collect())) == sorted(map(str, sparse.collect()))
    keys, aggs = {"store": "shop", "day": "d"}, [F.sum("units").alias("units")]
    plain, sparse = (drill_across(stock, sales, keys, aggs, range_on=r) for r in (None, "day"))
    assert plain.columns == sparse.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, sparse.collect()))


def test_stock_rows_are_not_shuffled_to_meet_sales(spark, made_gold, tmp_path):
    for name in ("fact_inventory", "daily_sales_by_product_store"):
        made_gold[name].write.parquet(f"{tmp_path}/{name}")
    stored = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("fact_inventory", "daily_sales_by_product_store")}
    df = metric_query(INVENTORY, {**made_gold, **stored}, ["Snapshot Date"], ["Units On Hand"])
    asked = metric_query(INVENTORY, {**made_gold, **stored}, ["Snapshot Date"], ["Units On Hand", "Units Sold"])
    plan = asked._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "bitmap_construct_agg" in plan
    assert {r[0]: r[1] for r in df.collect()} == {r[0]: r[1] for r in asked.collect()}
