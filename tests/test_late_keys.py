"""Keys are hashed after the joins, groups and shuffles that go by them, and come out the same."""

import pytest
from pyspark.sql import functions as F

from registry import queries as R
from tallymart.functions import columns as C
from tallymart.operators.joins import Join, star_join
from tallymart.plans import gold as G, increments as I, reports
from tallymart.plans.definitions import INVENTORY, SALES
from tallymart.plans.metrics import metric_query
from test_releases import rows


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def before_shuffles(df):
    """What is worked out below the topmost shuffle."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[text.index("Exchange hashpartitioning"):]


@pytest.fixture
def tiny_folder(monkeypatch, tiny_bronze):
    monkeypatch.setattr(R, "read_testdata", lambda spark, d: tiny_bronze)
    return "unread"


def test_hashed_texts_are_the_keys(tiny_bronze):
    texts, keys = G.build_gold(tiny_bronze, hashed=False), G.build_gold(tiny_bronze)
    for name in keys:
        made = texts[name].withColumns({c: C.hashed_key(c) for c in texts[name].columns if c.endswith("_key")})
        assert "sha2(" not in plan(texts[name])
        assert rows(made) == rows(keys[name])
        assert texts[name].schema.simpleString() == keys[name].schema.simpleString()


@pytest.mark.parametrize("view", [SALES, INVENTORY])
def test_measures_by_text(tiny_bronze, view):
    ask = dict(dimensions=["Product Category", "Store Region"], measures=[m.name for m in view.measures])
    assert rows(metric_query(view, G.build_gold(tiny_bronze, hashed=False), **ask)) == rows(
        metric_query(view, G.build_gold(tiny_bronze), **ask))


def test_daily_sales_are_summed_by_text(tiny_bronze):
    daily = G.build_gold(tiny_bronze)["daily_sales_by_product_store"]
    assert "sha2(" in plan(daily) and "sha2(" not in before_shuffles(daily)


def test_star_join_hashes_what_it_returns(spark, tiny_folder, tiny_bronze):
    g, out = G.build_gold(tiny_bronze), R.star_join_sales(spark, tiny_folder)
    want = star_join(g["fact_transaction"], [Join(j.alias, g[j.table], j.on) for j in SALES.joins]).select(
        "source.transaction_line_key", "source.net_amount", "guest.home_region", "product.category",
        F.col("store.region").alias("store_region"))
    assert rows(out) == rows(want)
    text = plan(out)
    assert text.count("sha2(") == 1 and text.index("sha2(") < text.index("Join")


def test_distinct_counts_by_text(spark, tiny_folder, tiny_bronze):
    out = R.distinct_counts(spark, tiny_folder)
    assert rows(out) == rows(G.build_gold(tiny_bronze)["fact_transaction"].groupBy("store_key").agg(
        F.countDistinct("transaction_id").alias("baskets"), F.countDistinct("guest_key").alias("guests"),
        F.countDistinct("product_key").alias("products")))
    assert "sha2(" in plan(out) and "sha2(" not in before_shuffles(out)


@pytest.mark.parametrize("name", ["m_aov", "m_guest_count", "d_category", "net_sales_by_category"])
def test_measures_hash_nothing(spark, tiny_folder, name):
    assert "sha2(" not in plan(R.QUERIES[name](spark, tiny_folder))


def test_rollups_keep_texts(spark, tiny_folder, tiny_bronze):
    asked = R.QUERIES["rollup_sales_by_category"](spark, tiny_folder)
    assert "sha2(" not in plan(asked)
    out = {r["product_category"]: r["guest_count"] for r in asked.collect()}
    want = metric_query(SALES, G.build_gold(tiny_bronze), ["Product Category"], ["Guest Count"]).collect()
    assert out == {r[0]: r[1] for r in want}


def test_column_lists_hash_nothing(spark, tiny_folder, tiny_bronze):
    for name in ("column_lists", "table_prompts", "table_drafts"):
        assert "sha2(" not in plan(R.QUERIES[name](spark, tiny_folder))
    lists = R.column_lists(spark, tiny_folder)
    assert "min(" not in plan(lists)
    assert rows(lists) == rows(reports.column_lists(spark, G.build_gold(tiny_bronze)))


@pytest.mark.parametrize("text", ["", "x", "ab", "AB", "a" * 64, "0123" * 16, "0123" * 16 + "f", "\x01", "hé", None])
def test_packed_key(spark, text):
    row = spark.createDataFrame([(text,)], "k string").select(C.packed_key("k").alias("p")).select(
        "p", C.unpacked_key("p").alias("k")).first()
    assert row["k"] == text
    if text == "0123" * 16:
        assert len(row["p"]) == 33


def test_periods_are_gathered_in_short(spark, tiny_bronze, tmp_path, monkeypatch):
    seen, write = [], I._replace
    monkeypatch.setattr(I, "_replace", lambda df, *more: (seen.append(plan(df)), write(df, *more)))
    I.refresh_periods(tiny_bronze, str(tmp_path), unit="month")
    fact, daily = seen
    assert fact.index("sha2(") < fact.index("RebalancePartitions") and "sha2(" not in fact[fact.index("RebalancePartitions"):]
    assert "unhex(" in daily[daily.index("RebalancePartitions"):]
    assert "lower(hex(" in daily[:daily.index("RebalancePartitions")]


@pytest.mark.parametrize("name", ["top_region_sell_through", "lowest_sell_through"])
def test_sell_through_questions_hash_nothing(spark, tiny_folder, name):
    assert "sha2(" not in plan(R.QUERIES[name](spark, tiny_folder))
