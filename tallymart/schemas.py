"""Declared tables: columns, types, comments, keys and relationships.

Bronze frames are the input contract; gold frames are written in exactly the
declared column order and types. Money may arrive as DOUBLE or DECIMAL in
bronze; gold money is always DECIMAL.
"""

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DATE = T.DateType()
MONEY = T.DecimalType(10, 2)
MONEY_TOTAL = T.DecimalType(12, 2)


def _table(*fields):
    """StructType from (name, type[, comment[, required]]) tuples."""
    out = []
    for name, kind, *rest in fields:
        comment = rest[0] if rest else None
        required = len(rest) > 1 and rest[1] == "required"
        out.append(T.StructField(name, kind, not required, {"comment": comment} if comment else None))
    return T.StructType(out)


BRONZE = {
    "guest": _table(
        ("guest_id", TEXT), ("first_name", TEXT), ("last_name", TEXT), ("email", TEXT),
        ("signup_date", DATE), ("home_region", TEXT),
    ),
    "product": _table(
        ("product_id", TEXT), ("product_name", TEXT), ("category", TEXT), ("subcategory", TEXT),
        ("brand", TEXT), ("unit_cost", MONEY), ("list_price", MONEY),
    ),
    "store": _table(
        ("store_id", TEXT), ("store_name", TEXT), ("region", TEXT), ("district", TEXT),
        ("city", TEXT), ("state", TEXT), ("open_date", DATE),
    ),
    "transaction_line": _table(
        ("transaction_id", TEXT), ("line_number", LONG), ("transaction_date", DATE),
        ("guest_id", TEXT), ("store_id", TEXT), ("product_id", TEXT), ("quantity", INT),
        ("unit_price", MONEY), ("discount_amount", MONEY), ("tax_amount", MONEY),
    ),
    "inventory_snapshot": _table(
        ("snapshot_date", DATE), ("store_id", TEXT), ("product_id", TEXT), ("quantity_on_hand", INT),
    ),
}

GOLD = {
    "dim_guest": _table(
        ("guest_key", TEXT, "Hashed guest id that sales lines join to.", "required"),
        ("guest_id", TEXT, "Guest id as the source system knows it."),
        ("first_name", TEXT), ("last_name", TEXT), ("email", TEXT),
        ("signup_date", DATE, "Day the guest signed up."),
        ("home_region", TEXT, "Region the guest lives in; the only level of guest geography."),
    ),
    "dim_product": _table(
        ("product_key", TEXT, "Hashed product id that both facts join to.", "required"),
        ("product_id", TEXT, "Product id (SKU) as the source system knows it."),
        ("product_name", TEXT),
        ("category", TEXT, "First level of the merchandise tree."),
        ("subcategory", TEXT, "Second level of the merchandise tree, below category."),
        ("brand", TEXT),
        ("unit_cost", MONEY, "What one unit costs to buy or make."),
        ("list_price", MONEY, "Regular shelf price of one unit."),
    ),
    "dim_store": _table(
        ("store_key", TEXT, "Hashed store id that both facts join to.", "required"),
        ("store_id", TEXT, "Store id as the source system knows it."),
        ("store_name", TEXT),
        ("region", TEXT, "First level of store geography."),
        ("district", TEXT, "Second level of store geography, below region."),
        ("city", TEXT), ("state", TEXT),
        ("open_date", DATE, "Day the store opened."),
    ),
    "fact_transaction": _table(
        ("transaction_line_key", TEXT, "Hashed basket id and line number.", "required"),
        ("transaction_id", TEXT, "Basket id as the source system knows it."),
        ("line_number", INT, "Position of the line in its basket."),
        ("transaction_date", DATE),
        ("guest_key", TEXT, "Points at dim_guest."),
        ("product_key", TEXT, "Points at dim_product."),
        ("store_key", TEXT, "Points at dim_store."),
        ("quantity", INT), ("unit_price", MONEY),
        ("discount_amount", MONEY, "Amount taken off this line, for example by a promotion."),
        ("tax_amount", MONEY),
        ("net_amount", MONEY, "Quantity times unit price, less discount, before tax; the base of net sales."),
    ),
    "fact_inventory": _table(
        ("inventory_key", TEXT, "Hashed snapshot date, store and product; one row each.", "required"),
        ("snapshot_date", DATE),
        ("store_key", TEXT, "Points at dim_store."),
        ("product_key", TEXT, "Points at dim_product."),
        ("quantity_on_hand", INT),
    ),
    "daily_sales_by_product_store": _table(
        ("sale_date", DATE),
        ("store_key", TEXT, "Points at dim_store."),
        ("product_key", TEXT, "Points at dim_product."),
        ("units_sold", INT),
        ("net_sales", MONEY_TOTAL),
    ),
}

TABLE_COMMENTS = {
    "dim_guest": "One row per guest.",
    "dim_product": "One row per SKU with its place in the merchandise tree.",
    "dim_store": "One row per physical store with its region and district.",
    "fact_transaction": "One row per product in a basket.",
    "fact_inventory": "Stock on hand per store, product and day.",
    "daily_sales_by_product_store": (
        "Sales summed to the grain of the stock snapshots, so the two can be joined without fan-out."
    ),
}

PRIMARY_KEYS = {
    "dim_guest": "guest_key",
    "dim_product": "product_key",
    "dim_store": "store_key",
    "fact_transaction": "transaction_line_key",
    "fact_inventory": "inventory_key",
}


@dataclass(frozen=True)
class Relationship:
    """Many rows of ``child`` point at one row of ``parent`` through ``key``."""

    child: str
    parent: str
    key: str


RELATIONSHIPS = [
    Relationship("fact_transaction", "dim_guest", "guest_key"),
    Relationship("fact_transaction", "dim_product", "product_key"),
    Relationship("fact_transaction", "dim_store", "store_key"),
    Relationship("fact_inventory", "dim_store", "store_key"),
    Relationship("fact_inventory", "dim_product", "product_key"),
    Relationship("daily_sales_by_product_store", "dim_store", "store_key"),
    Relationship("daily_sales_by_product_store", "dim_product", "product_key"),
]

# Columns whose values people name in questions (§ value lookup).
LOOKUP_COLUMNS = {
    "dim_guest": ["first_name", "last_name", "email", "home_region"],
    "dim_product": ["product_name", "category", "subcategory", "brand"],
    "dim_store": ["store_name", "region", "district", "city", "state"],
}
LOOKUP_DIMENSIONS = {
    "sales_metrics": ["Product Category", "Product Subcategory", "Store Region", "Store District"],
    "inventory_metrics": ["Product Category", "Store Region"],
}
