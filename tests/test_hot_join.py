"""A join whose fact has hot keys and rows without a key."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymart.operators.hot_join import hot_keys, split_join
from test_scale import conf, plan


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on key 7, a seventh without a key, the rest over 2,000 keys of which some have no partner."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 7 == 1, F.lit(None)).otherwise(n * 31 % 2000)
    return spark.range(0, 60_000, 1, 8).select(n.alias("line"), key.cast("bigint").alias("part"))


@pytest.fixture(scope="module")
def parts(spark):
    once = spark.range(0, 1900).select(F.col("id").alias("part"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    extra = spark.createDataFrame([(7, "other"), (None, "none"), (11, None)], "part bigint, name string")
    return once.unionAll(extra)


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_hot_keys_are_found(skewed, spark):
    assert hot_keys(skewed, "part") == [7]
    assert hot_keys(skewed.filter("part <> 7"), "part") == []
    assert hot_keys(skewed.filter("part IS NULL"), "part") == [] and hot_keys(skewed.limit(0), "part") == []


@pytest.mark.parametrize("some", ["true", "part <> 7", "part IS NULL", "part = 7", "false"])
def test_same_rows_as_the_plain_join(skewed, parts, some):
    fact = skewed.filter(some)
    want = fact.join(parts, "part", "left").select("line", "part", "name")
    got = split_join(fact, parts, "part", ["name"])
    assert got.columns == ["line", "part", "name"] and rows(got) == rows(want)


def test_a_side_that_is_too_large_is_not_broadcast(skewed, parts):
    got = split_join(skewed, parts, "part", ["name"], broadcast_chars=10)
    assert len(re.findall(r"Join \[", plan(got))) == 1 and len(re.findall(r"Join \[", plan(split_join(skewed, parts, "part", ["name"])))) == 2
    assert rows(got) == rows(skewed.join(parts, "part", "left").select("line", "part", "name"))


def test_no_task_holds_the_hot_key(spark, skewed, parts):
    with conf(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        got = split_join(skewed, parts, "part", ["name"])
        assert "SortMergeJoin" in plan(got) and "BroadcastHashJoin" in plan(got)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        plain = skewed.join(parts, "part", "left").groupBy(F.spark_partition_id()).count().collect()
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert max(r["count"] for r in plain) > 2 * sum(sizes) / len(plain)
