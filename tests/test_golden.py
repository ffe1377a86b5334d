"""Figures known from outside this code, and settings."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from registry.queries import gold_of
from tallymart.operators import quality
from tallymart.plans import questions as Q
from tallymart.plans.definitions import INVENTORY, SALES
from tallymart.plans.metrics import metric_query
from tallymart.session import settings

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def gold(spark):
    return gold_of(spark, SMALL)


def test_sales_lines(gold):
    lines = gold["fact_transaction"]
    assert tuple(lines.agg(F.count(F.lit(1)), F.countDistinct("transaction_line_key"), F.count("net_amount")).first()
                 ) == (6_000, 4_599, 6_000)
    audit = quality.audit_primary_key(lines, "transaction_line_key").first()
    assert (audit["total_rows"], audit["distinct_keys"]) == (6_000, 4_599)


def test_daily_sales(gold):
    daily = gold["daily_sales_by_product_store"]
    assert tuple(daily.agg(F.count(F.lit(1)), F.sum("units_sold"), F.sum("net_sales")).first()) == (
        5_996, 152_257, Decimal("138243039.07"))


def test_stock(gold):
    stock = gold["fact_inventory"]
    assert tuple(stock.agg(F.count(F.lit(1)), F.countDistinct("inventory_key"), F.min("quantity_on_hand"),
                           F.max("quantity_on_hand")).first()) == (26_670, 26_670, 0, 125)


def test_sales_metrics(gold):
    row = metric_query(
        SALES, gold, ["Product Category", "Store Region"], [m.name for m in SALES.measures],
        where={"Product Category": "ECONOMY", "Store Region": "AFRICA"}).first()
    assert (row["Net Sales"], row["Units Sold"], row["Transaction Count"], row["Guest Count"]) == (
        Decimal("4317691.11"), 4_757, 180, 106)
    assert row["Average Order Value"] == pytest.approx(23_987.172833)


def test_months(gold):
    months = Q.monthly_net_sales(gold).agg(F.count(F.lit(1)), F.max("net_sales")).first()
    assert tuple(months) == (83, Decimal("2424997.06"))


@pytest.mark.parametrize("region,on_hand,sold,rate,turnover", [
    ("AFRICA", 6_480, 70, 0.010687023, 10.888888889),
    ("AMERICA", 32_784, None, None, None),
    ("ASIA", 31_076, 34, 0.001092896, 0.566739606),
    ("EUROPE", 125_150, 152, 0.001213069, 2.533535757),
    ("MIDDLE EAST", 63_854, 40, 0.000626037, 0.6665205),
])
def test_inventory_metrics(gold, region, on_hand, sold, rate, turnover):
    row = metric_query(INVENTORY, gold, [], [m.name for m in INVENTORY.measures],
                       where={"Product Category": "PROMO", "Store Region": region}).first()
    assert (row["Units On Hand"], row["Units Sold"]) == (on_hand, sold)
    for got, want in ((row["Sell-Through Rate"], rate), (row["Inventory Turnover"], turnover)):
        assert got is None if want is None else got == pytest.approx(want, abs=1e-9)


def test_settings_grow_with_the_work():
    small, large = settings(8, 1 << 30), settings(8_000, 100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(large["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    assert large["spark.sql.adaptive.skewJoin.enabled"] == "true"
