import os
from datetime import date

import pytest
from pyspark.sql import SparkSession

from tallymart.plans import generate, gold as G

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
START = date(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]").appName("tallymart-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "10000").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def made_bronze(spark):
    """The synthetic tables at their default sizes."""
    bronze = generate.generate_bronze(spark, 11, START)
    return {name: df.cache() for name, df in bronze.items()}


@pytest.fixture(scope="session")
def made_gold(made_bronze):
    gold = G.build_gold(made_bronze)
    return {name: gold[name].cache() for name in gold}


@pytest.fixture
def tiny_bronze(spark):
    """Hand-made rows: 2 stores, 3 products, 2 guests, a few lines and stock rows."""
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    d1, d2 = date(2024, 1, 1), date(2024, 2, 1)
    return {
        "guest": frame(
            [("G1", "Ada", "Abel", "a@x", d1, "West"), ("G2", "Bo", "Cy", None, d1, "East"),
             (None, "No", "Id", "n@x", d1, "East"), ("G3", "No", "At", "nomail", d1, "West")],
            "guest_id string, first_name string, last_name string, email string, signup_date date, home_region string"),
        "product": frame(
            [("P1", "One", "A", "A1", "X", 1.0, 2.0), ("P2", "Two", "A", "A2", "Y", 1.5, -3.0),
             ("P3", "Three", "B", "B1", "Y", None, 123456789.0)],
            "product_id string, product_name string, category string, subcategory string, brand string, "
            "unit_cost double, list_price double"),
        "store": frame(
            [("S1", "S one", "North", "N-1", "c", "st", d1), ("S2", "S two", "South", "S-1", "c", "st", d1)],
            "store_id string, store_name string, region string, district string, city string, state string, "
            "open_date date"),
        "transaction_line": frame(
            [("T1", 1, d1, "G1", "S1", "P1", "2", 10.0, 1.0, 0.5),
             ("T1", 2, d1, "G1", "S1", "P2", "1", 5.0, 0.0, 0.5),
             ("T1", 2, d1, "G1", "S1", "P2", "1", 5.0, 0.0, 0.5),    # repeated line key: both rows count
             ("T2", 1, d2, "G2", "S2", "P1", "3", 10.0, 0.0, 0.5),
             ("T3", 1, d2, "G9", "S2", "P3", "1", 99999999.99, 0.0, 0.5),  # guest without a row
             ("T4", 1, d2, "G1", "S2", "P1", "0", 10.0, 0.0, 0.5),
             ("T5", 1, d2, "G1", "S2", "P1", "-1", 10.0, 0.0, 0.5),
             ("T6", 1, d2, "G1", "S2", "P1", None, 10.0, 0.0, 0.5),
             ("T7", 1, d2, "G1", "S2", "P1", "x", 10.0, 0.0, 0.5),
             ("T8", 1, d2, None, "S2", "P1", "1", 10.0, 0.0, 0.5),
             (None, 1, d2, "G1", "S2", "P1", "1", 10.0, 0.0, 0.5)],
            "transaction_id string, line_number bigint, transaction_date date, guest_id string, store_id string, "
            "product_id string, quantity string, unit_price double, discount_amount double, tax_amount double"),
        "inventory_snapshot": frame(
            [(d1, "S1", "P1", 8), (d1, "S1", "P2", 4), (d1, "S2", "P1", 0), (d2, "S2", "P1", 7), (d2, "S1", "P3", 0),
             (d1, "S1", "P3", -1), (d1, None, "P1", 5), (None, "S1", "P1", 5), (d1, "S1", "P9", None)],
            "snapshot_date date, store_id string, product_id string, quantity_on_hand int"),
    }
