from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import START
from tallymart import fixed_values as V
from tallymart.plans import generate
from tallymart.plans.build import build
from tallymart.schemas import GOLD
from tallymart.sources.tables import id_range


def shares(df, column):
    n = df.count()
    return {r[column]: r["count"] / n for r in df.groupBy(column).count().collect()}


def test_sizes(made_bronze):
    assert {n: df.count() for n, df in made_bronze.items()} == {
        "guest": 5_000, "product": 500, "store": 25, "transaction_line": 150_000, "inventory_snapshot": 175_000}


def test_guest_and_product_shares(made_bronze):
    got = shares(made_bronze["guest"], "home_region")
    for region, want in zip(V.REGIONS, V.GUEST_REGION_WEIGHTS):
        assert got[region] == pytest.approx(want, abs=0.03)
    got = shares(made_bronze["product"], "category")
    for category, want in zip(V.CATEGORIES, V.CATEGORY_WEIGHTS):
        assert got[category] == pytest.approx(want, abs=0.06)


def test_products_stay_in_their_band(made_bronze):
    for r in made_bronze["product"].collect():
        assert V.PRICE_LOW[r.category] <= r.list_price <= V.PRICE_HIGH[r.category]
        assert 0.34 <= float(r.unit_cost / r.list_price) <= 0.56
        assert r.subcategory in V.SUBCATEGORIES[r.category] and r.product_name.endswith(r.subcategory)


def test_stores(made_bronze):
    stores = made_bronze["store"].orderBy("store_id").collect()
    assert [s.region for s in stores] == [r for r, _, n in V.STORE_BLOCKS for _ in range(n)]
    assert stores[24].district == "South-2" and stores[24].state == "GA" and stores[24].store_id == "S024"


def test_lines(made_bronze):
    lines = made_bronze["transaction_line"]
    first, last = lines.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    assert (first, last) == (START, START + timedelta(days=89))
    got = shares(lines, "quantity")
    assert got[1] == pytest.approx(0.70, abs=0.01) and got[2] == pytest.approx(0.279, abs=0.01)
    busiest = max(shares(lines, "store_id").values())
    assert busiest == pytest.approx(1 / 5, abs=0.01)      # sqrt(1/25) of the traffic
    assert lines.select("transaction_id", "line_number").distinct().count() == 60_000


def test_promotion(made_bronze):
    promo = made_bronze["transaction_line"].filter("discount_amount > 0")
    assert promo.count() == 15_000
    assert shares(promo.join(made_bronze["product"], "product_id"), "category") == {"Bottoms": 1.0}
    low, high = promo.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    assert (low, high) == (START + timedelta(days=35), START + timedelta(days=41))
    assert promo.filter("abs(discount_amount - unit_price * 0.2) > 0.005").count() == 0
    tax = "abs(tax_amount - (unit_price * quantity - discount_amount) * 0.08) > 0.0051"
    assert made_bronze["transaction_line"].filter(tax).count() == 0


def test_stock(made_bronze):
    stock = made_bronze["inventory_snapshot"].join(made_bronze["store"], "store_id").join(
        made_bronze["product"], "product_id")
    south = stock.filter("region = 'South' AND category = 'Bottoms'")
    by_day = {r.snapshot_date: (r.lo, r.hi) for r in south.groupBy("snapshot_date").agg(
        F.min("quantity_on_hand").alias("lo"), F.max("quantity_on_hand").alias("hi")).collect()}
    first = START + timedelta(days=42)
    assert by_day == {first + timedelta(days=d): (max(0, 18 - 2 * d),) * 2 for d in range(14)}
    rest = stock.filter("NOT (region = 'South' AND category = 'Bottoms')").groupBy(
        (F.col("category") == "Bottoms").alias("focus")).agg(
        F.min("quantity_on_hand").alias("lo"), F.max("quantity_on_hand").alias("hi"))
    assert {r.focus: (r.lo, r.hi) for r in rest.collect()} == {True: (56, 64), False: (116, 124)}


def test_same_rows_on_any_partitioning(spark):
    def made(parts):
        ids = id_range(spark, 2_000, parts)
        return sorted(map(tuple, generate.guest_rows(ids, 5, START).collect()))

    assert made(1) == made(9)
    other = sorted(map(tuple, generate.guest_rows(id_range(spark, 2_000), 6, START).collect()))
    assert other != made(1)


def test_ids_stay_unique_past_their_usual_width(spark):
    assert generate.gen_products(spark, 100_500, 1).select("product_id").distinct().count() == 100_500
    assert generate.gen_stores(spark, 1_200, 1).select("store_id").distinct().count() == 1_200


def test_two_sizes(spark):
    small = generate.generate_bronze(spark, 3, date(2024, 6, 1), 50, 40, 25, 900, 100, 400)
    assert {n: df.count() for n, df in small.items()} == {
        "guest": 50, "product": 40, "store": 25, "transaction_line": 1_000, "inventory_snapshot": 25 * 40 * 14}


def test_build_into_schemas_and_folders(spark, tmp_path):
    sizes = dict(n_guests=50, n_products=40, n_stores=25, n_lines=900, n_promo=100, n_baskets=400)
    made = build(spark, str(tmp_path / "bronze"), str(tmp_path / "gold"), 3, START, **sizes)
    try:
        named = build(spark, "tallymart_b", "tallymart_g", 3, START, **sizes)
        for name in GOLD:
            assert sorted(map(str, named[name].collect())) == sorted(map(str, made[name].collect()))
        assert made["fact_transaction"].count() == 1_000
        described = {r.col_name: r.comment for r in spark.sql("DESCRIBE tallymart_g.dim_store").collect()}
        assert described["region"] == "First level of store geography."
    finally:
        spark.sql("DROP SCHEMA IF EXISTS tallymart_b CASCADE")
        spark.sql("DROP SCHEMA IF EXISTS tallymart_g CASCADE")
