"""What the plans look like: pushdown, narrow scans, hot keys, no single-task step over a table."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tallymart.operators.joins import Join, star_join
from tallymart.plans import gold as G, questions as Q
from tallymart.plans.definitions import INVENTORY, SALES
from tallymart.plans.metrics import metric_query
from tallymart.schemas import GOLD
from tallymart.sources.testdata import read_testdata


def plan(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("gold"))
    G.refresh_gold(read_testdata(spark, "/root/testdata/sf0.001"), folder)
    return G.read_tables(spark, folder, GOLD)


def test_date_filter_reaches_the_scan(stored):
    text = plan(metric_query(SALES, stored, ["Store Region"], ["Units Sold"],
                             where="`Transaction Date` >= DATE'1999-01-01'"))
    assert "GreaterThanOrEqual(transaction_date,1999-01-01)" in text


def test_date_filter_prunes_folders(spark, tmp_path):
    bronze = read_testdata(spark, "/root/testdata/sf0.001")
    parted = G.refresh_gold(bronze, str(tmp_path), "partition")["fact_inventory"]
    text = plan(parted.filter("snapshot_date = DATE'1998-02-15'"))
    assert "PartitionFilters: [isnotnull(snapshot_date" in text and "InMemoryFileIndex(1 paths)" in text
    assert parted.filter("snapshot_date = DATE'1998-02-15'").count() == 26_670 // 14


def test_scan_reads_only_the_asked_columns(stored):
    text = plan(metric_query(SALES, stored, ["Transaction Date"], ["Units Sold"]))
    assert "ReadSchema: struct<transaction_date:date,quantity:int>" in text
    assert "Join" not in text


def test_snapshot_date_filter_reaches_both_facts(stored):
    text = plan(metric_query(INVENTORY, stored, [], ["Units Sold"],
                             where="`Snapshot Date` = DATE'1998-02-15'"))
    assert "EqualTo(snapshot_date,1998-02-15)" in text and "EqualTo(sale_date,1998-02-15)" in text


def test_rules_reach_the_bronze_scan(spark, tmp_path):
    folder = str(tmp_path)
    read_testdata(spark, "/root/testdata/sf0.001")["inventory_snapshot"].write.parquet(f"{folder}/stock")
    stock = G.fact_inventory(spark.read.parquet(f"{folder}/stock"))
    text = plan(stock.groupBy("store_key").agg(F.sum("quantity_on_hand")))
    assert "GreaterThanOrEqual(quantity_on_hand,0)" in text and "IsNotNull(product_id)" in text
    assert text.count("sha2(") == 1      # the keys nobody asked for are not hashed


@pytest.mark.parametrize("ask", [
    lambda g: metric_query(SALES, g, ["Product Category"], [m.name for m in SALES.measures]),
    lambda g: metric_query(INVENTORY, g, ["Store Region"], [m.name for m in INVENTORY.measures]),
    Q.monthly_net_sales, Q.region_sales_last_month, lambda g: Q.lowest_sell_through(g, 5),
])
def test_no_window_and_no_cross_join(stored, ask):
    text = plan(ask(stored))
    assert "Window" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_daily_table_needs_one_shuffle(stored):
    assert plan(G.daily_sales(stored["fact_transaction"])).count("Exchange hashpartitioning") == 1


def test_facts_are_written_without_a_shuffle(spark, stored):
    lines = spark.createDataFrame([], "transaction_id string, line_number bigint, transaction_date date, "
                                  "guest_id string, store_id string, product_id string, quantity int, "
                                  "unit_price double, discount_amount double, tax_amount double")
    assert "Exchange" not in plan(G.fact_transaction(lines))


@pytest.fixture(scope="module")
def hot(spark):
    """A fact with a third of its rows on one key, and a dimension."""
    fact = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5_000).alias("k"), F.lit(1).alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"))
    dim = spark.range(5_000).select(F.col("id").alias("k"), (F.col("id") % 10).alias("grp"))
    return fact, dim


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}


def test_hot_key_is_split_in_the_star_join(spark, hot):
    fact, dim = hot
    small = {
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "200KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
    }
    with conf(spark, **NO_BROADCAST, **small):
        df = star_join(fact, [Join("d", dim, "source.k = d.k")]).groupBy("d.grp").agg(
            F.sum("source.v").alias("n"), F.max("source.text"))
        text = plan(df, run=True)
    assert "skew=true" in text
    assert df.agg(F.sum("n")).first()[0] == 300_000


def test_folding_shrinks_a_hot_key_before_its_shuffle(spark, hot, stored):
    from tallymart.plans.metrics import Dimension, JoinSpec, Measure, MetricView, total

    fact, dim = hot
    view = MetricView("hot", "f", [JoinSpec("d", "d", "source.k = d.k")], [Dimension("Group", "d.grp")],
                      [Measure("N", {"n": total("source.v")})])
    with conf(spark, **NO_BROADCAST):
        folded = metric_query(view, {"f": fact, "d": dim}, ["Group"], ["N"], pre_aggregate=True)
        text = plan(folded)
        plain = metric_query(view, {"f": fact, "d": dim}, ["Group"], ["N"])
        assert sorted(folded.collect()) == sorted(plain.collect())
    join = text.index("SortMergeJoin")
    assert "partial_sum" in text[join:]      # summed below the join
    assert stored


def test_audits_of_a_hot_key(spark, hot):
    from tallymart.operators import quality

    fact, dim = hot
    assert quality.audit_primary_key(fact, "k").first()["total_rows"] == 300_000
    with conf(spark, **NO_BROADCAST):
        used = quality.audit_foreign_key(fact, dim.filter("k <> 7"), "k")
        text = plan(used)
        assert [tuple(r) for r in used.collect()] == [(7, 100_000 + 40)]
    assert text.index("SortMergeJoin") < text.index("HashAggregate")      # folded before the anti join
