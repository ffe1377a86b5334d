from datetime import date
from decimal import Decimal
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tallymart.functions.columns import ratio
from tallymart.operators import quality
from tallymart.plans import gold as G, questions as Q
from tallymart.plans.definitions import INVENTORY, SALES
from tallymart.plans.metrics import Dimension, JoinSpec, Measure, MetricView, Part, distinct, metric_query, total
from tallymart.schemas import GOLD


def key(text):
    return sha256(text.encode()).hexdigest()


@pytest.fixture
def gold(tiny_bronze):
    return G.build_gold(tiny_bronze)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_gold_schemas(gold):
    for name, schema in GOLD.items():
        assert gold[name].columns == schema.names
        assert [f.dataType for f in gold[name].schema] == [f.dataType for f in schema]


def test_dimensions(gold):
    guests = {r.guest_id: r for r in gold["dim_guest"].collect()}
    assert set(guests) == {"G1", "G2", "G3"}      # NULL id dropped, bad mail kept
    assert guests["G1"].guest_key == key("G1")
    products = {r.product_id: r for r in gold["dim_product"].collect()}
    assert products["P2"].list_price == Decimal("-3.00")   # bad price is only counted
    assert products["P3"].list_price is None               # does not fit DECIMAL(10,2)


def test_sales_lines(gold):
    lines = gold["fact_transaction"].collect()
    assert len(lines) == 5       # zero, negative, NULL and text quantities and NULL ids are gone
    first = next(r for r in lines if r.transaction_id == "T1" and r.line_number == 1)
    assert first.transaction_line_key == key("T1-1") and first.store_key == key("S1")
    assert first.net_amount == Decimal("19.00")
    assert next(r for r in lines if r.transaction_id == "T3").unit_price == Decimal("99999999.99")


def test_stock_and_daily(gold):
    assert gold["fact_inventory"].count() == 5
    row = gold["fact_inventory"].filter(F.col("quantity_on_hand") == 8).first()
    assert row.inventory_key == key("2024-01-01-S1-P1")
    daily = {(r.sale_date, r.store_key, r.product_key): (r.units_sold, r.net_sales)
             for r in gold["daily_sales_by_product_store"].collect()}
    assert daily[(date(2024, 1, 1), key("S1"), key("P2"))] == (2, Decimal("10.00"))


def test_rules_on_ids_equal_rules_on_hashed_keys(tiny_bronze):
    for table, source in [("fact_transaction", "transaction_line"), ("fact_inventory", "inventory_snapshot")]:
        typed = G.typed_source(table, tiny_bronze[source])
        assert quality.keep_rows(typed, G.RULES[table]).count() == G.build_gold(tiny_bronze)[table].count()
    report = {(r.rule): r.failed for r in quality.rule_report(
        G.typed_source("fact_transaction", tiny_bronze["transaction_line"]), G.RULES["fact_transaction"]).collect()}
    assert report == {"valid_line_key": 1, "valid_keys": 1, "non_negative_quantity": 4}


def test_refresh_writes_what_build_defines(spark, tiny_bronze, gold, tmp_path):
    stored = G.refresh_gold(tiny_bronze, str(tmp_path))
    clustered = G.refresh_gold(tiny_bronze, str(tmp_path / "c"), "cluster")
    parted = G.refresh_gold(tiny_bronze, str(tmp_path / "p"), "partition")
    for name in GOLD:
        for other in (stored, clustered, parted):
            assert same(other[name], gold[name])
    with pytest.raises(ValueError, match="layout"):
        G.refresh_gold(tiny_bronze, str(tmp_path), "other")
    again = G.read_tables(spark, str(tmp_path), GOLD)
    assert same(again["dim_store"], gold["dim_store"])


# -- metric query -----------------------------------------------------------

def test_measures_by_region(gold):
    out = {r["Store Region"]: r for r in metric_query(
        SALES, gold, ["Store Region"], [m.name for m in SALES.measures]).collect()}
    north = out["North"]
    assert (north["Net Sales"], north["Units Sold"], north["Transaction Count"], north["Guest Count"]) == (
        Decimal("29.00"), 4, 1, 1)
    assert north["Average Order Value"] == 29.0


def test_no_sales_gives_null_and_zero_stock_gives_null(gold):
    out = {r["Snapshot Date"]: r for r in metric_query(
        INVENTORY, gold, ["Snapshot Date"], [m.name for m in INVENTORY.measures],
        where={"Product Category": "B"}).collect()}
    row = out[date(2024, 2, 1)]
    assert row["Units On Hand"] == 0 and row["Units Sold"] is None
    assert row["Sell-Through Rate"] is None and row["Inventory Turnover"] is None


def test_inventory_join_keeps_unsold_rows(gold):
    out = metric_query(INVENTORY, gold, [], ["Units On Hand", "Units Sold", "Inventory Turnover"]).first()
    assert out["Units On Hand"] == 19
    assert out["Units Sold"] == 2 + 2 + 3
    assert out["Inventory Turnover"] == pytest.approx(7 / (19 / 5))


@pytest.mark.parametrize("dims", [[], ["Store Region"], ["Product Category", "Transaction Date"],
                                  ["Store District", "Product Subcategory"]])
def test_pruned_full_and_folded_agree(gold, dims):
    names = [m.name for m in SALES.measures]
    plain = metric_query(SALES, gold, dims, names)
    for other in (metric_query(SALES, gold, dims, names, prune_joins=False),
                  metric_query(SALES, gold, dims, names, pre_aggregate=True),
                  metric_query(SALES, gold, dims, names, pre_aggregate=True, prune_joins=False)):
        assert same(plain, other)


@pytest.mark.parametrize("dims", [[], ["Store Region"], ["Product Category", "Snapshot Date"]])
def test_folded_inventory_agrees(gold, dims):
    names = [m.name for m in INVENTORY.measures]
    assert same(metric_query(INVENTORY, gold, dims, names),
                metric_query(INVENTORY, gold, dims, names, pre_aggregate=True))


@pytest.mark.parametrize("where", [{"Store Region": "South"}, {"Store Region": ["South", "West"], "Product Category": "Bottoms"},
                                   "`Store Region` = 'South'", {"Store Region": None}])
def test_filters_before_and_after_folding_agree(made_gold, where):
    for view in (SALES, INVENTORY):
        names = [m.name for m in view.measures]
        assert same(metric_query(view, made_gold, ["Product Category"], names, where=where),
                    metric_query(view, made_gold, ["Product Category"], names, where=where, pre_aggregate=True))


def test_filtered_dimension_cuts_the_source_before_the_fold(made_gold):
    df = metric_query(SALES, made_gold, [], ["Units Sold"], where={"Store Region": "South"}, pre_aggregate=True)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("Aggregate")      # below the fold


def test_sales_outside_the_stock_days_never_reach_the_join(spark, tmp_path, made_gold):
    from tallymart.plans import gold as G

    folder = str(tmp_path)
    for name in ("fact_inventory", "daily_sales_by_product_store"):
        made_gold[name].write.parquet(f"{folder}/{name}")
    stored = {**made_gold, **G.read_tables(spark, folder, ["fact_inventory", "daily_sales_by_product_store"])}
    df = metric_query(INVENTORY, stored, [], ["Units Sold"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "sale_date" in plan and plan.count("scalar-subquery") >= 2
    assert same(df, metric_query(INVENTORY, made_gold, [], ["Units Sold"]))


def test_bucketed_stock_and_sales_join_without_a_shuffle(spark, tiny_bronze):
    from tallymart.plans import gold as G

    spark.sql("CREATE SCHEMA IF NOT EXISTS tallymart_buckets")
    try:
        stored = G.refresh_gold(tiny_bronze, "tallymart_buckets", "bucket", buckets=4)
        joined = stored["fact_inventory"].alias("i").hint("merge").join(
            stored["daily_sales_by_product_store"].alias("d"),
            F.expr("i.store_key = d.store_key AND i.product_key = d.product_key AND i.snapshot_date = d.sale_date"), "left")
        assert joined.count() == stored["fact_inventory"].count()
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
        described = spark.sql("DESCRIBE TABLE EXTENDED tallymart_buckets.dim_store").filter("col_name = 'Comment'").first()
        assert described["data_type"] == "One row per physical store with its region and district."
    finally:
        spark.sql("DROP SCHEMA tallymart_buckets CASCADE")


def test_required_keys_are_not_null_in_the_schema(gold):
    from tallymart.schemas import GOLD

    for name, schema in GOLD.items():
        assert [f.name for f in gold[name].schema if not f.nullable] == [f.name for f in schema if not f.nullable]


def test_repeated_dimension_key_changes_sums_and_is_audited(gold):
    doubled = {**gold, "dim_store": gold["dim_store"].union(gold["dim_store"])}
    assert quality.audit_many_to_one(doubled["dim_store"], "store_key").first()["is_many_to_one"] is False
    total_of = lambda g, **kw: metric_query(SALES, g, [], ["Units Sold"], **kw).first()[0]
    assert total_of(doubled) == total_of(gold)                 # the pruned query never meets it
    assert total_of(doubled, prune_joins=False) == 2 * total_of(gold)


def test_join_pruning_shows_in_the_plan(gold):
    def joins(*dims):
        plan = metric_query(SALES, gold, dims, ["Net Sales"])._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join")

    assert (joins("Transaction Date"), joins("Store Region"), joins("Store Region", "Product Category")) == (0, 1, 2)


def test_where_forms_agree(gold):
    def ask(where):
        return metric_query(SALES, gold, ["Product Category"], ["Units Sold"], where=where)

    text = ask("`Store Region` = 'North' AND `Transaction Date` < DATE'2024-02-01'")
    named = ask({"Store Region": "North", "Transaction Date": lambda d: d < F.lit(date(2024, 2, 1))})
    assert same(text, named) and text.count() == 1
    assert same(ask({"Store Region": ["North", "South"]}), ask(None))


def test_having_order_limit_and_hidden_measures(gold):
    out = metric_query(SALES, gold, ["Product Subcategory"], ["Net Sales"], having="`Units Sold` > 1",
                       order_by=[("Units Sold", "desc")], limit=1)
    assert out.columns == ["Product Subcategory", "Net Sales"]
    assert [r[0] for r in out.collect()] == ["A1"]
    last = metric_query(INVENTORY, gold, ["Product Category"], ["Sell-Through Rate"], order_by=["Sell-Through Rate"])
    assert last.collect()[-1][1] is None       # NULLs last


def test_unknown_names_are_refused(gold):
    with pytest.raises(ValueError, match="no measure"):
        metric_query(SALES, gold, [], ["Profit"])
    with pytest.raises(ValueError, match="no dimension"):
        metric_query(SALES, gold, ["Colour"], ["Net Sales"])
    with pytest.raises(ValueError, match="at least one"):
        metric_query(SALES, gold)
    with pytest.raises(ValueError, match="order_by"):
        metric_query(SALES, gold, ["Store Region"], ["Net Sales"], order_by=["Colour"])


def test_view_of_ones_own(gold):
    """Any Spark aggregate, a dimension over two tables, and a join that goes through another join."""
    view = MetricView(
        "mine", "fact_transaction",
        [JoinSpec("store", "dim_store", "source.store_key = store.store_key"),
         JoinSpec("peer", "dim_store", "store.region = peer.region")],
        [Dimension("Region", "peer.region"), Dimension("Label", "concat(store.region, source.line_number)")],
        [Measure("Dearest", {"top": Part("max", "source.unit_price")}),
         Measure("Per Basket", {"u": total("source.quantity"), "b": distinct("source.transaction_id")}, ratio_of),
         Measure("Spread", {"s": Part("stddev", "source.quantity")})],
    )
    assert view.aliases_in(["peer.region"]) == {"peer", "store"}
    plain = metric_query(view, gold, ["Region", "Label"], ["Dearest", "Per Basket"])
    assert same(plain, metric_query(view, gold, ["Region", "Label"], ["Dearest", "Per Basket"], pre_aggregate=True))
    assert metric_query(view, gold, ["Region"], ["Spread"]).count() == 2
    with pytest.raises(ValueError, match="stddev"):
        metric_query(view, gold, ["Region"], ["Spread"], pre_aggregate=True)


def ratio_of(u, b):
    return ratio(u, b)


# -- invariants and the stock story at the default sizes --------------------

@pytest.mark.parametrize("dim", [d.name for d in SALES.dimensions])
def test_sums_add_up_over_any_dimension(made_gold, dim):
    whole = metric_query(SALES, made_gold, [], ["Net Sales", "Units Sold", "Guest Count"]).first()
    parts = metric_query(SALES, made_gold, [dim], ["Net Sales", "Units Sold", "Guest Count"]).agg(
        F.sum("`Net Sales`"), F.sum("`Units Sold`"), F.sum("`Guest Count`")).first()
    assert (parts[0], parts[1]) == (whole[0], whole[1])
    assert parts[2] >= whole[2]      # distinct guests do not add up


def test_stock_story(made_bronze, made_gold):
    k = made_bronze["product"].filter("category = 'Bottoms'").count()
    out = {r["Store Region"]: r for r in metric_query(
        INVENTORY, made_gold, ["Store Region"], ["Units On Hand", "Sell-Through Rate"],
        where={"Product Category": "Bottoms"}).collect()}
    assert out["South"]["Units On Hand"] == 360 * k
    rates = {region: r["Sell-Through Rate"] for region, r in out.items()}
    assert max(rates, key=rates.get) == "South"
    assert rates["South"] > 2 * max(v for region, v in rates.items() if region != "South")
    top = Q.top_region_sell_through(made_gold, "Bottoms").first()
    assert (top["Store Region"], top["Units On Hand"]) == ("South", 360 * k)


def test_lowest_sell_through_is_ordered(made_gold):
    out = [r.sell_through_rate for r in Q.lowest_sell_through(made_gold, 20).collect()]
    assert out == sorted(out) and len(out) == 20


def test_last_month_from_data_and_from_argument(made_gold):
    last = made_gold["fact_transaction"].agg(F.max("transaction_date")).first()[0]
    assert same(Q.region_sales_last_month(made_gold), Q.region_sales_last_month(made_gold, last))


def test_shares_add_to_one(made_gold):
    assert sum(r.share for r in Q.category_distribution(made_gold).collect()) == pytest.approx(1)
