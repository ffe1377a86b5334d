"""Releases: published whole or not at all, pinned, pruned; row rules counted on the way."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tallymart.operators import quality
from tallymart.plans import gold as G, reports
from tallymart.schemas import GOLD
from tallymart.sources import releases


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def rewritten(bronze, **frames):
    return {**bronze, **frames}


SCHEMA = "tallymart_releases"


@pytest.fixture(params=["folder", "schema"])
def where(request, spark, tmp_path):
    if request.param == "folder":
        yield str(tmp_path / "gold")
    else:
        spark.sql(f"CREATE SCHEMA {SCHEMA}")
        yield SCHEMA
        spark.sql(f"DROP SCHEMA {SCHEMA} CASCADE")


def test_releases_are_pinned_and_pruned(spark, tiny_bronze, where):
    G.refresh_gold(tiny_bronze, where)
    first = {t: rows(df) for t, df in G.read_tables(spark, where, GOLD).items()}
    held = G.read_tables(spark, where, GOLD, 1)          # a reader that began before the next refresh
    fewer = rewritten(tiny_bronze, transaction_line=tiny_bronze["transaction_line"].filter("transaction_id <> 'T1'"))
    G.refresh_gold(fewer, where)
    assert releases.release_numbers(spark, where) == [1, 2]
    assert {t: rows(df) for t, df in held.items()} == first
    assert {t: rows(df) for t, df in G.read_tables(spark, where, GOLD, 1).items()} == first
    now = G.read_tables(spark, where, GOLD)
    assert now["fact_transaction"].count() == len(first["fact_transaction"]) - 3
    if where == SCHEMA:
        assert rows(spark.table(f"{SCHEMA}.fact_transaction")) == rows(now["fact_transaction"])
    G.refresh_gold(tiny_bronze, where)
    assert releases.release_numbers(spark, where) == [2, 3]
    with pytest.raises(LookupError):
        G.read_tables(spark, where, GOLD, 1)
    assert releases.quality_log(spark, where).select("release").distinct().count() == 3    # the log goes on
    assert {t: rows(df) for t, df in G.read_tables(spark, where, GOLD).items()} == first


def _places(spark, where):
    if where == SCHEMA:
        return sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {SCHEMA}").collect() if "__" in r.tableName)
    import glob

    return sorted(glob.glob(f"{where}/*/*/"))


def test_failed_write_and_failed_audit_leave_the_old_release(spark, tiny_bronze, where):
    G.refresh_gold(tiny_bronze, where, audit=reports.release_audits)
    want = {t: rows(df) for t, df in G.read_tables(spark, where, GOLD).items()}
    there = _places(spark, where)

    broken = tiny_bronze["inventory_snapshot"].withColumn(
        "quantity_on_hand", F.when(F.col("store_id") == "S2", F.raise_error(F.lit("stop")).cast("int")).otherwise(1))
    with pytest.raises(Exception, match="stop"):
        G.refresh_gold(rewritten(tiny_bronze, inventory_snapshot=broken), where)

    twice = tiny_bronze["store"].unionAll(tiny_bronze["store"].limit(1))
    with pytest.raises(G.AuditFailed) as failed:
        G.refresh_gold(rewritten(tiny_bronze, store=twice), where, audit=reports.release_audits)
    assert failed.value.rows == [
        {"table_name": "dim_store", "check_name": "repeated_keys", "failing": 1, "must_hold": True}]

    assert releases.release_numbers(spark, where) == [1]
    assert {t: rows(df) for t, df in G.read_tables(spark, where, GOLD).items()} == want
    assert _places(spark, where) == there                # nothing staged is left behind
    log = {(r.table_name, r.check_name): r.failing for r in releases.audit_log(spark, where).collect()}
    assert log["fact_transaction", "repeated_keys"] == 1 and log["fact_transaction", "orphans of dim_guest"] == 1
    assert log["dim_store", "null_keys"] == 0


def test_two_refreshes_at_once(spark, tiny_bronze, tmp_path):
    where = str(tmp_path / "g")
    releases.publish(spark, where, {}, 0)
    with pytest.raises(releases.Conflict):
        releases.publish(spark, where, {}, 0)
    assert releases.release_numbers(spark, where) == [1]
    with pytest.raises(ValueError):
        releases.prune(spark, where, 0)
    assert releases.prune(spark, where, 1) == []


def test_log_counts_what_the_rules_report(spark, tiny_bronze, tmp_path):
    where = str(tmp_path / "g")
    G.refresh_gold(tiny_bronze, where, "cluster")
    got = releases.quality_log(spark, where).drop("release")
    assert rows(got) == rows(reports.rules(tiny_bronze).select(got.columns)) and got.count() == 11
    assert {(r.rule, r.passed, r.failed) for r in got.filter("table_name = 'fact_transaction'").collect()} == {
        ("valid_line_key", 10, 1), ("valid_keys", 10, 1), ("non_negative_quantity", 7, 4)}


def test_bronze_is_read_once(spark, tiny_bronze, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    lines = tiny_bronze["transaction_line"]
    watched = rewritten(tiny_bronze, transaction_line=lines.mapInArrow(watch, lines.schema))
    G.refresh_gold(watched, str(tmp_path / "g"))
    assert seen.value == lines.count()


def test_empty_tables(spark, tiny_bronze, tmp_path):
    where = str(tmp_path / "g")
    G.refresh_gold({t: df.filter("false") for t, df in tiny_bronze.items()}, where, audit=reports.release_audits)
    assert all(df.count() == 0 for df in G.read_tables(spark, where, GOLD).values())
    log = releases.quality_log(spark, where)
    assert log.count() == 11 and log.filter("passed + failed > 0").count() == 0


RETRY = """
import sys
sys.path.insert(0, {repo!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
from tallymart.operators import quality
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()
def once(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")
for gather in (False, True):
    frame = spark.range(0, 1000, 1, 4)
    rules = [quality.Rule("even", "id % 2 = 0"), quality.Rule("low", "id < 900", drop=False)]
    counted = quality.counted_rows(frame, rules)
    kept = counted.kept.mapInArrow(once, "id long")
    if gather:
        kept = kept.repartition("id")
    path = {folder!r} + "/t" + str(gather)
    kept.write.parquet(path)
    print("GOT", counted.report(spark.read.parquet(path).count()))
"""


def test_a_retried_task_counts_once(tmp_path):
    import os

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", RETRY.format(repo=repo, folder=str(tmp_path))],
                          capture_output=True, text=True, timeout=300)
    want = ("GOT [{'rule': 'even', 'on_failure': 'drop', 'passed': 500, 'failed': 500}, "
            "{'rule': 'low', 'on_failure': 'keep', 'passed': 900, 'failed': 100}]")
    assert [line for line in done.stdout.splitlines() if line.startswith("GOT")] == [want, want], done.stderr[-2000:]


def test_counts_that_do_not_fit_the_stored_rows_are_refused(spark):
    counted = quality.counted_rows(spark.range(10), [quality.Rule("low", "id < 4")])
    counted.kept.count()
    assert counted.report(5) is None and counted.report(4) == [
        {"rule": "low", "on_failure": "drop", "passed": 4, "failed": 6}]
