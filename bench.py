"""Time the headline work: refresh the gold tables, then ask the stored tables.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from registry.queries import QUERIES, SEED, START
from tallymart.operators import quality
from tallymart.plans import generate, gold as G, questions as Q
from tallymart.plans.definitions import INVENTORY, SALES
from tallymart.plans.metrics import metric_query
from tallymart.schemas import PRIMARY_KEYS
from tallymart.session import settings
from tallymart.sources.testdata import read_testdata

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
# queries that start from the raw tables
FROM_RAW = [
    "net_sales_by_category", "quality_report", "fk_audit", "dense_index_scaled", "promo_resample",
    "gen_transaction_lines", "entity_values",
]


def session() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("tallymart-bench")
    for name, value in settings(cores=CPUS, shuffle_bytes=1 << 30).items():
        builder = builder.config(name, value)
    spark = (
        builder.config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df) -> None:
    """Compute every row and keep none."""
    df.write.format("noop").mode("overwrite").save()


def gold_queries(gold):
    grain = ["Product Category", "Store Region"]
    every = {
        "q_sales_all_measures": lambda: metric_query(SALES, gold, grain, [m.name for m in SALES.measures]),
        "q_inventory_all_measures": lambda: metric_query(INVENTORY, gold, grain, [m.name for m in INVENTORY.measures]),
        "q_inventory_folded": lambda: metric_query(
            INVENTORY, gold, grain, [m.name for m in INVENTORY.measures], pre_aggregate=True),
        "q_net_sales_by_category": lambda: Q.net_sales_by_category(gold),
        "q_monthly_net_sales": lambda: Q.monthly_net_sales(gold),
        "q_category_distribution": lambda: Q.category_distribution(gold),
        "q_region_sales_last_month": lambda: Q.region_sales_last_month(gold),
        "q_top_region_sell_through": lambda: Q.top_region_sell_through(gold, "PROMO"),
        "q_lowest_sell_through": lambda: Q.lowest_sell_through(gold, 10),
        "q_products_per_brand": lambda: Q.products_per_brand(gold),
    }
    for table, key in PRIMARY_KEYS.items():
        if table.startswith("fact"):
            every[f"q_pk_audit_{table}"] = lambda t=table, k=key: quality.audit_primary_key(gold[t], k)
    return every


def main() -> None:
    spark = session()
    spark.range(1).count()
    times = {}

    def clock(name, work):
        start = time.perf_counter()
        result = work()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    with tempfile.TemporaryDirectory(prefix="run-", dir="/tmp") as out:
        gold = clock("gold_refresh", lambda: G.refresh_gold(read_testdata(spark, FOLDER), out))
        for name, make in gold_queries(gold).items():
            clock(name, lambda: drain(make()))
        for name in FROM_RAW:
            clock(f"raw_{name}", lambda: drain(QUERIES[name](spark, FOLDER)))
        made = clock("generate_plan", lambda: generate.generate_bronze(spark, SEED, START))
        for name in ("transaction_line", "inventory_snapshot"):
            clock(f"generate_{name}", lambda: drain(made[name]))
    print(json.dumps({
        "metric": "gold refresh, metric queries, audits and generation, total",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
