"""Stored aggregates: the same rows as base rows for every measure, and they are read where they cover the query."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallymart.plans import rollups as R
from tallymart.plans.definitions import INVENTORY, SALES
from tallymart.plans.metrics import Dimension, metric_query
from test_releases import rows

MONTHLY = SALES.with_dimensions(Dimension("month", "trunc(source.transaction_date, 'MM')"))
ALL = [m.name for m in SALES.measures]


@pytest.fixture(scope="module", params=[512, 3])
def sales(request, spark, made_gold, tmp_path_factory):
    """Rollups by day and store, and by day and product; with few numbers, and with bitmaps nearly everywhere."""
    where = str(tmp_path_factory.mktemp("rollups"))
    few, R.FEW = R.FEW, request.param
    try:
        for name, grain in (("store", ["transaction_date", "store_key"]), ("product", ["transaction_date", "product_key"])):
            R.store_rollup(MONTHLY, made_gold, grain, where, name)
    finally:
        R.FEW = few
    return [R.open_rollup(spark, MONTHLY, ["transaction_date", "store_key"], where, "store"),
            R.open_rollup(spark, MONTHLY, ["transaction_date", "product_key"], where, "product")]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


ASKS = [
    dict(dimensions=["month"], measures=ALL), dict(dimensions=["Store Region"], measures=ALL),
    dict(dimensions=["month", "Store District"], measures=["Transaction Count", "Guest Count"]),
    dict(measures=ALL), dict(dimensions=["Product Category"], measures=ALL),
    dict(dimensions=["Product Subcategory", "Transaction Date"], measures=["Net Sales", "Guest Count"]),
    dict(dimensions=["month"], measures=["Average Order Value"], where={"Store Region": ["West", "South"]}),
    dict(dimensions=["Store Region"], measures=["Net Sales"], where="`Transaction Date` >= DATE'2024-02-10'",
         having="`Transaction Count` > 10", order_by=[("Guest Count", "desc")], limit=2),
    dict(dimensions=["Store Region"], measures=ALL, where={"Transaction Date": date(1999, 1, 1)}),
    dict(measures=ALL, where={"Transaction Date": date(1999, 1, 1)}),
]


@pytest.mark.parametrize("ask", ASKS)
def test_same_rows_as_base(made_gold, sales, ask):
    base = metric_query(MONTHLY, made_gold, **ask)
    stored = metric_query(MONTHLY, made_gold, **ask, rollups=sales)
    assert stored.schema.simpleString() == base.schema.simpleString()
    assert rows(stored) == rows(base)
    text = plan(stored)
    assert "Expand" not in text and text.count("transaction_line_key") == 0


def test_every_stock_measure(spark, made_gold, tmp_path):
    names = [m.name for m in INVENTORY.measures]
    kept = R.store_rollup(INVENTORY, made_gold, ["snapshot_date", "store_key"], str(tmp_path), "stock")
    for dims in ([], ["Snapshot Date"], ["Store Region"], ["Snapshot Date", "Store Region"]):
        assert rows(metric_query(INVENTORY, made_gold, dims, names, rollups=[kept])) == rows(
            metric_query(INVENTORY, made_gold, dims, names))


def test_base_rows_are_read_where_no_rollup_covers(spark, made_gold, sales):
    def read(df):
        return any(r in plan(df) for r in ("base_rows", "bits", "sum_0"))

    assert read(metric_query(MONTHLY, made_gold, ["month"], ["Net Sales"], rollups=sales))
    both = metric_query(MONTHLY, made_gold, ["Product Category", "Store Region"], ["Net Sales"], rollups=sales)
    assert not read(both)      # neither grain has product and store
    filtered = metric_query(MONTHLY, made_gold, ["Product Category"], ["Net Sales"], where={"Store Region": "West"}, rollups=sales)
    assert not read(filtered)  # nor can it be filtered by the other
    assert not read(metric_query(INVENTORY, made_gold, ["Store Region"], ["Units On Hand"], rollups=sales))
    assert rows(both) == rows(metric_query(MONTHLY, made_gold, ["Product Category", "Store Region"], ["Net Sales"]))


def test_new_keys_are_appended(spark, tmp_path):
    path = str(tmp_path / "keys")
    first = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("c", 5), (None, 1)], "key string, first int")
    assert rows(R.number_keys(first, path)) == [("a", 2), ("b", 3), ("c", 1)]
    more = spark.createDataFrame([("a", 0), ("z", 1), ("y", 1)], "key string, first int")
    assert rows(R.number_keys(more, path)) == [("a", 2), ("b", 3), ("c", 1), ("y", 4), ("z", 5)]
    assert rows(R.number_keys(more.filter("false"), path)) == [("a", 2), ("b", 3), ("c", 1), ("y", 4), ("z", 5)]


def test_keys_past_one_bucket(spark, tmp_path):
    """Numbers over several buckets of 32,768, counted over groups that share keys."""
    fact = spark.range(0, 90_000, 1, 6).select(
        F.lit(date(2024, 1, 1)).alias("transaction_date"), (F.col("id") % 3).cast("string").alias("store_key"),
        F.concat(F.lit("t"), (F.col("id") % 70_000).cast("string")).alias("transaction_id"), F.lit("g").alias("guest_key"),
        F.lit("p").alias("product_key"), F.lit(1).alias("quantity"), F.lit(2).cast("decimal(10,2)").alias("net_amount"))
    gold = {"fact_transaction": fact}
    kept = R.store_rollup(SALES, gold, ["transaction_date", "store_key"], str(tmp_path), "r")
    ask = dict(dimensions=["Transaction Date"], measures=["Transaction Count", "Guest Count", "Units Sold"])
    assert rows(metric_query(SALES, gold, **ask, rollups=[kept])) == [(date(2024, 1, 1), 70_000, 1, 90_000)]
    assert kept.sets.filter("bits IS NOT NULL").count() >= 9


def test_empty_fact(spark, made_gold, tmp_path):
    gold = {**made_gold, "fact_transaction": made_gold["fact_transaction"].filter("false")}
    kept = R.store_rollup(MONTHLY, gold, ["transaction_date", "store_key"], str(tmp_path), "r")
    for dims in ([], ["month"]):
        assert rows(metric_query(MONTHLY, gold, dims, ALL, rollups=[kept])) == rows(metric_query(MONTHLY, gold, dims, ALL))
