"""The five bronze tables read from an order-entry style set of parquet tables."""

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import fixed_values as V
from ..functions.columns import cents, id_text, money
from ..functions.stock import stock_level
from ..operators.joins import each_day
from ..schemas import BRONZE
from .tables import Tables, conform

ID_WIDTH = 9
FIRST_SIGNUP = date(2022, 1, 1)
FIRST_OPENING = date(2015, 1, 1)
STOCK_START = date(1998, 2, 12)
DEPLETED_REGION = "AFRICA"
FOCUS_CATEGORY = "PROMO"


_SCHEMAS: dict[str, tuple[int, T.StructType]] = {}


def scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One given table. Its schema is read from the file again only when the file is newer."""
    path = f"{folder}/{table}.parquet"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    written = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).getModificationTime()
    if _SCHEMAS.get(path, (None,))[0] != written:
        _SCHEMAS[path] = (written, spark.read.parquet(path).schema)
    return spark.read.schema(_SCHEMAS[path][1]).parquet(path)


def _places(spark: SparkSession, folder: str) -> DataFrame:
    """Nation key with nation and region name."""
    nation = scan(spark, folder, "nation")
    region = scan(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def guests(spark: SparkSession, folder: str) -> DataFrame:
    customer = scan(spark, folder, "customer")
    df = customer.join(_places(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")).select(
        id_text("G", "c_custkey", ID_WIDTH).alias("guest_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.date_add(F.lit(FIRST_SIGNUP), (F.col("c_custkey") % 1000).cast("int")).alias("signup_date"),
        F.col("r_name").alias("home_region"),
    )
    return conform(df, BRONZE["guest"])


def products(spark: SparkSession, folder: str) -> DataFrame:
    list_cents = cents("p_retailprice")
    df = scan(spark, folder, "part").select(
        id_text("P", "p_partkey", ID_WIDTH).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        money(F.floor(list_cents * 45 / 100)).alias("unit_cost"),
        money(list_cents).alias("list_price"),
    )
    return conform(df, BRONZE["product"])


def stores(spark: SparkSession, folder: str) -> DataFrame:
    supplier = scan(spark, folder, "supplier")
    df = supplier.join(_places(spark, folder), F.col("s_nationkey") == F.col("n_nationkey")).select(
        id_text("S", "s_suppkey", ID_WIDTH).alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("district"),
        F.concat(F.col("s_name"), F.lit(" City")).alias("city"),
        F.substring("r_name", 1, 2).alias("state"),
        F.date_add(F.lit(FIRST_OPENING), (F.col("s_suppkey") % 2900).cast("int")).alias("open_date"),
    )
    return conform(df, BRONZE["store"])


def transaction_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Sales lines. Two inner joins of the lines with orders and parts, on unique keys."""
    line = scan(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_partkey",
        "l_quantity", "l_discount", "l_tax",
    )
    order = scan(spark, folder, "orders").select("o_orderkey", "o_custkey")
    part = scan(spark, folder, "part").select("p_partkey", "p_retailprice")
    price = cents("p_retailprice")
    quantity = F.col("l_quantity").cast("bigint")
    discount = F.floor(price * cents("l_discount") / 100)
    tax = F.floor((price * quantity - discount) * cents("l_tax") / 100)
    df = (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            id_text("T", "l_orderkey", ID_WIDTH).alias("transaction_id"),
            F.col("l_linenumber").cast("bigint").alias("line_number"),
            F.col("l_shipdate").cast("date").alias("transaction_date"),
            id_text("G", "o_custkey", ID_WIDTH).alias("guest_id"),
            id_text("S", "l_suppkey", ID_WIDTH).alias("store_id"),
            id_text("P", "l_partkey", ID_WIDTH).alias("product_id"),
            quantity.cast("int").alias("quantity"),
            money(price).alias("unit_price"),
            money(discount).alias("discount_amount"),
            money(tax).alias("tax_amount"),
        )
    )
    return conform(df, BRONZE["transaction_line"])


def inventory_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Stock of every store-product pair that ever sold, for each of the stock days.

    Pairs are deduplicated before the joins and before the days are added, so the
    only wide shuffles carry one row per pair.
    """
    pairs = scan(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()
    shop = scan(spark, folder, "supplier").join(
        _places(spark, folder), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", "r_name")
    part = scan(spark, folder, "part").select("p_partkey", "p_type")
    day = F.col("day_idx")
    noise = (F.col("l_suppkey") * 31 + F.col("l_partkey") * 17 + day * 7) % 11 - 5
    on_hand = stock_level(day, F.col("r_name"), F.col("p_type"), noise, DEPLETED_REGION, FOCUS_CATEGORY)
    named = (
        pairs.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(shop, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("store_id", id_text("S", "l_suppkey", ID_WIDTH))
        .withColumn("product_id", id_text("P", "l_partkey", ID_WIDTH))
    )
    df = each_day(named, V.STOCK_DAYS).select(
        F.date_add(F.lit(STOCK_START), day).alias("snapshot_date"), "store_id", "product_id",
        on_hand.alias("quantity_on_hand"),
    )
    return conform(df, BRONZE["inventory_snapshot"])


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "guest": guests,
    "product": products,
    "store": stores,
    "transaction_line": transaction_lines,
    "inventory_snapshot": inventory_snapshots,
}


def read_testdata(spark: SparkSession, folder: str) -> Tables:
    """The five bronze frames."""
    return Tables({name: partial(read, spark, folder) for name, read in READERS.items()})
