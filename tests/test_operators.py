
import pytest
from pyspark.sql import functions as F, types as T

from tallymart.functions.columns import draw
from tallymart.operators import glossary, quality
from tallymart.operators.index import dense_index
from tallymart.operators.joins import Join, drill_across, each_day, grid, resolve_index, star_join
from tallymart.operators.sampling import resample_into, split_by, subset_index
from tallymart.sources import tables as S


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# -- tables -----------------------------------------------------------------

def test_id_range(spark):
    df = S.id_range(spark, 1000, 7)
    assert df.rdd.getNumPartitions() == 7
    assert [r.id for r in df.orderBy("id").collect()] == list(range(1000))
    assert S.id_range(spark, 3 * S.ROWS_PER_RANGE_PART * 64).rdd.getNumPartitions() == 192
    assert S.id_range(spark, 0).count() == 0


def test_conform(spark):
    target = T.StructType([
        T.StructField("k", T.StringType(), False, {"comment": "The key."}),
        T.StructField("n", T.IntegerType()),
        T.StructField("m", T.DecimalType(5, 2)),
    ])
    df = spark.createDataFrame([("9999.5", "x", "a", 0), ("1.5", "7", "b", 0)], "m string, n string, k string, z int")
    out = S.conform(df, target)
    assert out.columns == ["k", "n", "m"]
    assert [f.dataType for f in out.schema] == [f.dataType for f in target]
    assert out.schema["k"].metadata == {"comment": "The key."}
    assert [(r.k, r.n, None if r.m is None else float(r.m)) for r in out.orderBy("k").collect()] == [
        ("a", None, None), ("b", 7, 1.5)]


def test_conform_stops_on_missing_required_value(spark):
    target = T.StructType([T.StructField("k", T.StringType(), False)])
    df = spark.createDataFrame([("a",), (None,)], "k string")
    with pytest.raises(Exception, match="k must not be NULL"):
        S.conform(df, target).collect()
    assert S.conform(df, target, check_required=False).count() == 2


def test_write_table_replaces_and_clusters(spark, tmp_path):
    ref = str(tmp_path / "t")
    S.write_table(spark.range(10), ref)
    df = spark.range(1000).withColumn("day", (F.col("id") % 5).cast("int"))
    back = S.write_table(df, ref, cluster_by=["day"])
    assert rows(back) == rows(df)
    back = S.write_table(df, ref, partition_by=["day"])
    assert rows(back.select("id", "day")) == rows(df)
    with pytest.raises(ValueError):
        S.write_table(df, ref, bucket_by=(4, ["id"]))


def test_bucketed_tables_join_without_shuffle(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tallymart_test")
    try:
        a = S.write_table(spark.range(100).withColumn("x", F.lit(1)), "tallymart_test.a", bucket_by=(4, ["id"]))
        b = S.write_table(spark.range(100).withColumn("y", F.lit(2)), "tallymart_test.b", bucket_by=(4, ["id"]))
        joined = a.hint("merge").join(b, "id")
        assert joined.count() == 100
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
    finally:
        spark.sql("DROP SCHEMA tallymart_test CASCADE")


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    ref = str(tmp_path / "t")
    S.write_table(spark.range(10), ref)
    with pytest.raises(Exception, match="stop"):
        S.write_table(spark.range(10).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id")), ref)
    assert rows(S.read_bronze(spark, ref)) == [(i,) for i in range(10)]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

    class Session:
        class conf:
            get = staticmethod(lambda name, default: default)
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.shared_folder(Session())


def test_row_count_is_lazy_and_exact(spark):
    df = spark.range(5).withColumn("n", S.row_count(spark.range(123)))
    assert {r.n for r in df.collect()} == {123}


def test_tables_are_made_on_demand(spark):
    made = []
    t = S.Tables({"a": lambda: made.append("a") or spark.range(1), "b": lambda: made.append("b") or spark.range(2)})
    assert t["b"].count() == 2 and t["b"] is t["b"]
    assert made == ["b"] and list(t) == ["a", "b"] and len(t) == 2


# -- dense index ------------------------------------------------------------

@pytest.mark.parametrize("parts", [None, 1, 3, 7])
def test_index_follows_the_order(spark, parts):
    df = spark.range(0, 1000, 1, 5).select(F.concat(F.lit("k"), F.lpad(F.col("id") * 7919 % 1000, 4, "0")).alias("k"))
    assert rows(dense_index(df, ["k"], "i", parts)) == [(f"k{i:04}", i) for i in range(1000)]


def test_ties_are_numbered_alike_whatever_the_layout_and_size(spark):
    df = spark.range(40).select((F.col("id") % 3).alias("k"), "id")
    one = rows(dense_index(df.repartition(1), ["k"], "i", 1))
    assert rows(dense_index(df.repartition(9), ["k"], "i", 5)) == one == rows(dense_index(df, ["k"], "i"))


def test_scaled_index_spreads_a_hot_key(spark):
    df = spark.range(0, 3000, 1, 4).withColumn("k", F.when(F.col("id") < 2500, 5).otherwise(F.col("id")))
    out = dense_index(df, ["k"], "i", 8).cache()
    assert sorted(r.i for r in out.collect()) == list(range(3000))
    assert out.orderBy("i").select("k").collect() == df.orderBy("k").select("k").collect()
    biggest = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert biggest < 2500


def test_index_of_exact_copies(spark):
    df = spark.createDataFrame([(1,)] * 500 + [(2,)] * 10, "k int")
    assert sorted(r.i for r in dense_index(df, ["k"], "i", 4).collect()) == list(range(510))



def test_subset_index(spark):
    df = spark.range(20)
    assert rows(subset_index(df, F.col("id") % 2 == 1, ["id"], "r")) == [(2 * i + 1, i) for i in range(10)]


# -- joins ------------------------------------------------------------------

def test_star_join_keeps_fact_rows(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, v int")
    dim = spark.createDataFrame([(1, "a")], "k int, name string")
    out = star_join(fact, [Join("d", dim, "source.k = d.k")]).select("source.v", "d.name")
    assert sorted(out.collect()) == [(10, "a"), (20, None), (30, None)]


def test_drill_across_does_not_fan_out(spark):
    stock = spark.createDataFrame([("s", 1, 5), ("s", 2, 6), ("t", 1, 7)], "store string, day int, stock int")
    sales = spark.createDataFrame([("s", 1, 1), ("s", 1, 2), ("x", 1, 9)], "shop string, d int, units int")
    out = drill_across(stock, sales, {"store": "shop", "day": "d"}, [F.sum("units").alias("units")])
    assert out.columns == ["store", "day", "stock", "units"]
    assert {tuple(r) for r in out.collect()} == {("s", 1, 5, 3), ("s", 2, 6, None), ("t", 1, 7, None)}


def test_grid(spark):
    out = grid(spark, {"a": 3, "b": 4, "c": 2}, 5)
    assert rows(out) == [(a, b, c) for a in range(3) for b in range(4) for c in range(2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_each_day(spark):
    assert rows(each_day(spark.range(2), 3)) == [(i, d) for i in range(2) for d in range(3)]


def test_resolve_index_drops_unknown(spark):
    df = spark.createDataFrame([(0, "x"), (5, "y")], "i int, v string")
    master = spark.createDataFrame([(0, "id0")], "i int, name string")
    assert rows(resolve_index(df, master, "i", ["name"])) == [("x", "id0")]


def test_resample_and_split(spark):
    df = spark.range(1000).withColumn("p", F.lit("old")).withColumn("flag", F.col("id") < 300)
    yes, no = split_by(df, "flag")
    assert (yes.count(), no.count()) == (300, 700)
    subset = spark.createDataFrame([(i, f"new{i}") for i in range(4)], "rank int, p string")
    out = resample_into(yes, subset, draw(1, "r", "id"), "p", "rank")
    assert out.count() == 300
    counts = {r.p: r["count"] for r in out.groupBy("p").count().collect()}
    assert set(counts) == {f"new{i}" for i in range(4)} and min(counts.values()) > 40


# -- quality ----------------------------------------------------------------

RULES = [quality.Rule("has_key", "k IS NOT NULL"), quality.Rule("positive", "q > 0"),
         quality.Rule("has_at", "e LIKE '%@%'", drop=False)]


@pytest.fixture
def checked(spark):
    return spark.createDataFrame(
        [("a", 1, "x@y"), ("b", 0, "x@y"), ("c", None, "x@y"), (None, 2, "x@y"), ("d", 3, "none"), ("e", 4, None)],
        "k string, q int, e string")


def test_apply_rules(checked):
    result = quality.apply_rules(checked, RULES)
    assert sorted(r.k for r in result.kept.collect()) == ["a", "d", "e"]
    assert {(r.k, tuple(r.failed_rules)) for r in result.violations.collect()} == {
        ("b", ("positive",)), ("c", ("positive",)), (None, ("has_key",)), ("d", ("has_at",)), ("e", ("has_at",))}
    assert [tuple(r) for r in result.report.collect()] == [
        ("has_key", "drop", 5, 1), ("positive", "drop", 4, 2), ("has_at", "keep", 4, 2)]


def test_kept_and_dropped_make_the_input(checked):
    kept = quality.keep_rows(checked, RULES).count()
    assert kept + quality.failing_rows(checked, RULES, only_dropped=True).count() == checked.count()


def test_flag_rows(checked):
    flags = {r.k: r.positive for r in quality.flag_rows(checked, RULES).collect()}
    assert flags["a"] is True and flags["b"] is False and flags["c"] is False


def test_primary_key_audit(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert tuple(quality.audit_primary_key(df, "k").first()) == (6, 2, 2, 1, 2)
    assert rows(quality.duplicate_keys(df.dropna(), "k")) == [("a", 3)]
    assert tuple(quality.audit_primary_key(df.limit(0), "k").first()) == (0, 0, 0, 0, 0)


def test_foreign_key_and_cardinality_audit(spark):
    fact = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    assert rows(quality.audit_foreign_key(fact, dim, "k")) == [("z", 2)]
    assert tuple(quality.audit_many_to_one(dim, "k").first()) == (2, False)
    assert tuple(quality.audit_many_to_one(dim.distinct(), "k").first()) == (1, True)
    assert rows(quality.audit_not_null(fact, ["k"])) == [("k", 1)]


# -- glossary ---------------------------------------------------------------

def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, "b")], "n int, s string")
    want = [("t", "n", 3, 1, 2, "1", "2"), ("t", "s", 3, 0, 2, "a", "b")]
    for distinct in ("exact", "sketch"):
        assert rows(glossary.profile_columns(df, "t", distinct=distinct)) == want
    assert rows(glossary.profile_columns(df, "t", ["s"], None)) == [("t", "s", 3, 0, "a", "b")]


def test_gaps_are_filled_and_comments_kept(spark):
    meta = spark.createDataFrame(
        [("t", "a", "int", 1, "Kept."), ("t", "b", "int", 2, None), ("t", "c", "int", 3, ""), ("t", "d", "int", 4, " ")],
        glossary.COLUMN_META)
    gaps = glossary.find_gaps(meta)
    assert [r.column_name for r in gaps.orderBy("position").collect()] == ["b", "c", "d"]
    drafts = glossary.draft(gaps.withColumn("prompt", glossary.column_prompt()), lambda p: F.concat(F.lit("  It's "), p))
    filled = {r.column_name: r.comment for r in glossary.fill(meta, drafts).collect()}
    assert filled["a"] == "Kept." and filled["b"].startswith("It's Say in one short sentence what column 'b' (int)")
    statement = glossary.comment_statements(drafts).filter("column_name = 'b'").first().statement
    assert statement.startswith("ALTER TABLE t ALTER COLUMN b COMMENT 'It''s Say") and "''b''" in statement
    assert glossary.column_lists(meta).first().columns == "a, b, c, d"


def test_entity_lookup(spark):
    table = spark.createDataFrame([("West", "x"), ("West", None), ("East", "y")], "region string, `My Dim` string")
    values = glossary.entity_values({"t": table}, {"t": ["region", "My Dim"]})
    assert rows(values) == [("t", "My Dim", "x", 1), ("t", "My Dim", "y", 1), ("t", "region", "East", 1),
                            ("t", "region", "West", 2)]
    terms = spark.createDataFrame([(" WEST ",), (" WEST ",), ("none",)], "term string")
    assert rows(glossary.entity_match(terms, values)) == [(" WEST ", "t", "region", "West")]


def test_uncommented_columns():
    schema = T.StructType([T.StructField("a", T.IntegerType(), True, {"comment": "x"}), T.StructField("b", T.DateType())])
    assert glossary.uncommented({"t": schema}) == {"t": ["b"]}


def test_keys_are_summed_up_in_one_pass(spark):
    fact = spark.createDataFrame([("a", "x"), ("a", "z"), (None, "z"), ("c", None)], "k string, m string")
    k, m = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string"), spark.createDataFrame([("x",)], "m string")
    got = {r.key_name: tuple(r)[1:] for r in quality.summarise_keys(fact, {"k": k, "m": m}).collect()}
    # child rows, null rows, matched, orphan rows, orphan keys, parent keys, unused keys
    assert got == {"k": (3, 1, 2, 1, 1, 2, 1), "m": (3, 1, 1, 2, 1, 1, 0)}
    empty = {r.key_name: tuple(r)[1:] for r in quality.summarise_keys(fact.filter("false"), {"k": k, "m": m}).collect()}
    assert empty == {"k": (0, 0, 0, 0, 0, 2, 2), "m": (0, 0, 0, 0, 0, 1, 1)}


def test_lists_hold_empty_tables_and_empty_columns(spark):
    from tallymart.plans import reports

    tables = {"full": spark.createDataFrame([(1, None, "v")], "a int, b string, added string"),
              "empty": spark.createDataFrame([], "c int, d string")}
    got = {r.table_name: tuple(r)[1:] for r in reports.column_lists(spark, tables).collect()}
    assert got == {"full": ("a, b, added", 1, 1), "empty": ("c, d", 0, 2)}
    gaps = {(r.table_name, r.column_name) for r in reports.column_gaps(spark, tables).collect()}
    assert gaps == {("full", "a"), ("full", "b"), ("full", "added"), ("empty", "c"), ("empty", "d")}
    drafts = reports.table_drafts(spark, tables, {"full": "Known.", "empty": " "}).collect()
    assert [(r.table_name, r.draft) for r in drafts] == [("empty", "empty: 0 rows with c, d.")]
