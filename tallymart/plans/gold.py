"""The six gold tables as functions of the bronze frames.

Row rules run on the typed source columns, before any key is hashed. A hashed
key is NULL exactly when one of its parts is NULL, so a rule on the key and a
rule on its parts drop the same rows; on the parts it reaches the parquet scan
and lets unused hashes be pruned.
"""

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import hashed_key, key_text, packed_key, surrogate_key, unpacked_key
from ..operators.quality import Counted, Rule, counted_rows, keep_rows, rule_report
from ..schemas import GOLD, TABLE_COMMENTS
from ..sources import releases
from ..sources.tables import Tables, conform, hold_required, inside, read_bronze

# Row rules per gold table, as conditions on the typed source columns.
RULES: dict[str, list[Rule]] = {
    "dim_guest": [
        Rule("valid_guest_key", "guest_id IS NOT NULL"),
        Rule("valid_email", "email LIKE '%@%'", drop=False),
    ],
    "dim_product": [
        Rule("valid_product_key", "product_id IS NOT NULL"),
        Rule("valid_price", "list_price >= 0 AND unit_cost >= 0", drop=False),
    ],
    "dim_store": [
        Rule("valid_store_key", "store_id IS NOT NULL"),
    ],
    "fact_transaction": [
        Rule("valid_line_key", "transaction_id IS NOT NULL AND line_number IS NOT NULL"),
        Rule("valid_keys", "guest_id IS NOT NULL AND product_id IS NOT NULL AND store_id IS NOT NULL"),
        Rule("non_negative_quantity", "quantity > 0"),
    ],
    "fact_inventory": [
        Rule("valid_inventory_key",
             "snapshot_date IS NOT NULL AND store_id IS NOT NULL AND product_id IS NOT NULL"),
        Rule("valid_keys", "store_id IS NOT NULL AND product_id IS NOT NULL"),
        Rule("non_negative_quantity", "quantity_on_hand >= 0"),
    ],
}

SOURCE_OF = {
    "dim_guest": "guest",
    "dim_product": "product",
    "dim_store": "store",
    "fact_transaction": "transaction_line",
    "fact_inventory": "inventory_snapshot",
}


def _number(df: DataFrame, name: str) -> Column:
    """The column as a number; text that is no number becomes NULL."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).try_cast("double")
    return F.col(name)


def _typed(df: DataFrame, casts: Mapping[str, str], **more: Column) -> DataFrame:
    return df.withColumns({**{c: F.col(c).try_cast(t) for c, t in casts.items()}, **more})


def typed_source(table: str, source: DataFrame) -> DataFrame:
    """Bronze columns in gold types, plus derived amounts: what the row rules look at."""
    if table == "dim_product":
        return _typed(source, {"unit_cost": "decimal(10,2)", "list_price": "decimal(10,2)"})
    if table == "fact_inventory":
        return _typed(source, {"quantity_on_hand": "int"})
    if table == "fact_transaction":
        amount = {c: "decimal(10,2)" for c in ("unit_price", "discount_amount", "tax_amount")}
        net = _number(source, "quantity") * _number(source, "unit_price") - _number(source, "discount_amount")
        return _typed(source, {"quantity": "int", **amount}, net_amount=net.try_cast("decimal(10,2)"))
    return source


def _clean(table: str, source: DataFrame) -> DataFrame:
    return keep_rows(typed_source(table, source), RULES[table])


# Hashed keys of each table and the ids they are made of.
KEY_PARTS = {
    "dim_guest": {"guest_key": ("guest_id",)},
    "dim_product": {"product_key": ("product_id",)},
    "dim_store": {"store_key": ("store_id",)},
    "fact_transaction": {
        "transaction_line_key": ("transaction_id", "line_number"),
        "guest_key": ("guest_id",), "product_key": ("product_id",), "store_key": ("store_id",)},
    "fact_inventory": {
        "inventory_key": ("snapshot_date", "store_id", "product_id"),
        "store_key": ("store_id",), "product_key": ("product_id",)},
}


def _keyed(table: str, clean: DataFrame, hashed: bool = True) -> DataFrame:
    key = surrogate_key if hashed else key_text
    # rows with a NULL required key are gone by now: every such key has a dropping rule
    keyed = clean.withColumns({k: key(*parts) for k, parts in KEY_PARTS[table].items()})
    return hold_required(conform(keyed, GOLD[table], check_required=False), GOLD[table])


def dim_guest(guest: DataFrame, hashed: bool = True) -> DataFrame:
    return _keyed("dim_guest", _clean("dim_guest", guest), hashed)


def dim_product(product: DataFrame, hashed: bool = True) -> DataFrame:
    return _keyed("dim_product", _clean("dim_product", product), hashed)


def dim_store(store: DataFrame, hashed: bool = True) -> DataFrame:
    return _keyed("dim_store", _clean("dim_store", store), hashed)


def fact_transaction(lines: DataFrame, hashed: bool = True) -> DataFrame:
    """Sales lines with hashed keys. Keys come from the ids on the line, so no dimension is joined."""
    return _keyed("fact_transaction", _clean("fact_transaction", lines), hashed)


def fact_inventory(snapshots: DataFrame, hashed: bool = True) -> DataFrame:
    return _keyed("fact_inventory", _clean("fact_inventory", snapshots), hashed)


def counted_table(table: str, source: DataFrame) -> tuple[DataFrame, Counted]:
    """The gold frame of a bronze frame, and the counts of its row rules, taken as it is written."""
    counted = counted_rows(typed_source(table, source), RULES[table])
    return _keyed(table, counted.kept), counted


def _daily(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.col("transaction_date").alias("sale_date"), "store_key", "product_key").agg(
        F.sum("quantity").alias("units_sold"), F.sum("net_amount").alias("net_sales")
    )


def daily_sales(fact: DataFrame) -> DataFrame:
    """Sales per day, store and product: the grain of the stock snapshots. Keys are shuffled in half their length."""
    keys = ("store_key", "product_key")
    summed = _daily(fact.withColumns({k: packed_key(k) for k in keys}))
    return conform(summed.withColumns({k: unpacked_key(k) for k in keys}), GOLD["daily_sales_by_product_store"])


def daily_sales_of(lines: DataFrame, hashed: bool = True) -> DataFrame:
    """``daily_sales`` of bronze lines. Rows are summed by the texts of their keys, and only the sums get hashed ones."""
    summed = _daily(fact_transaction(lines, hashed=False))
    if hashed:
        summed = summed.withColumns({k: hashed_key(k) for k in ("store_key", "product_key")})
    return conform(summed, GOLD["daily_sales_by_product_store"])


def build_gold(bronze: Mapping[str, DataFrame], hashed: bool = True) -> Tables:
    """The six gold frames over the bronze frames.

    With ``hashed=False`` every key is the text that the hashed key is made from (``key_text``). Joins, groups and distinct
    counts by such keys are those by hashed ones, and shuffle a few bytes a key for 64; ``hashed_key`` makes the others of them.
    """
    return Tables({
        "dim_guest": lambda: dim_guest(bronze["guest"], hashed),
        "dim_product": lambda: dim_product(bronze["product"], hashed),
        "dim_store": lambda: dim_store(bronze["store"], hashed),
        "fact_transaction": lambda: fact_transaction(bronze["transaction_line"], hashed),
        "fact_inventory": lambda: fact_inventory(bronze["inventory_snapshot"], hashed),
        "daily_sales_by_product_store": lambda: daily_sales_of(bronze["transaction_line"], hashed),
    })


def with_hashed_keys(table: str, by_text: DataFrame) -> DataFrame:
    """Rows of a table of ``build_gold(..., hashed=False)`` with the keys that its texts stand for."""
    keys = {c: hashed_key(c) for c in GOLD[table].names if c.endswith("_key")}
    return conform(by_text.withColumns(keys), GOLD[table], check_required=False)


# Date column of each fact, for the stored layout: most questions name a period.
DATE_OF = {
    "fact_transaction": "transaction_date",
    "fact_inventory": "snapshot_date",
    "daily_sales_by_product_store": "sale_date",
}


def read_tables(spark: SparkSession, where: str, names, release: int | None = None) -> dict[str, DataFrame]:
    """Scan stored gold tables of a folder (``where`` has a slash) or a schema, all of one release: the newest or a numbered one.

    Where nothing was ever published, the tables of these names are read.
    """
    if release is None and not releases.release_numbers(spark, where):
        places = {n: inside(where, n) for n in names}
    else:
        places = releases.places(spark, where, release)
    return {n: read_bronze(spark, places[n]).select(GOLD[n].names) for n in names}


# Both sides of the join of stock with sales, bucketed alike on all of its keys: no value repeats enough to fill a bucket.
BUCKETED = {
    "fact_inventory": ["store_key", "product_key", "snapshot_date"],
    "daily_sales_by_product_store": ["store_key", "product_key", "sale_date"],
}


class AuditFailed(RuntimeError):
    """Checks that must hold do not; ``rows`` are the findings."""

    def __init__(self, rows: list[dict]):
        super().__init__(f"not published: {rows}")
        self.rows = rows


def refresh_gold(
    bronze: Mapping[str, DataFrame], where: str, layout: str = "as_is", buckets: int = 200,
    audit: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None, keep: int = 2,
) -> dict[str, DataFrame]:
    """Recompute all six gold tables in a folder or schema and publish them as one release; returns scans of them.

    The daily table is summed from the stored sales lines, not from bronze again.
    Everything else is projection and filter, so ``as_is`` shuffles nothing on the
    way to the files. Two layouts spend one skew-safe shuffle per fact so that
    questions about a period read less: ``cluster`` gathers and sorts rows by date,
    ``partition`` makes a folder per date, for facts of many gigabytes a day. ``bucket``, for a
    schema, lays stock and daily sales out in the same ``buckets`` of store, product and day, so that
    joining them shuffles neither. Tables in a schema get their declared comments.

    Row rules are counted while the rows are written and go into the release's log (``releases.quality_log``); bronze is
    read once. The counts are held against the rows that were stored, and taken anew where they disagree.
    ``audit`` looks at the staged tables (``reports.release_audits`` does the declared keys and joins). Its findings are
    logged too, and where a check that must hold does not, nothing is published and the staged tables go. Of older
    releases ``keep`` - 1 stay readable.
    """
    if layout not in ("as_is", "cluster", "partition", "bucket"):
        raise ValueError(f"layout {layout!r} is not as_is, cluster, partition or bucket")
    spark = next(iter(bronze.values())).sparkSession
    after = max(releases.release_numbers(spark, where), default=0)
    places: dict[str, str] = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        by = [DATE_OF[name]] if name in DATE_OF else None
        places[name] = releases.stage(
            df, where, name,
            cluster_by=by if layout == "cluster" else None, partition_by=by if layout == "partition" else None,
            bucket_by=(buckets, BUCKETED[name]) if layout == "bucket" and name in BUCKETED else None)
        if "/" not in where:
            spark.sql(f"COMMENT ON TABLE {places[name]} IS '{releases.quoted(TABLE_COMMENTS[name])}'")
        return read_bronze(spark, places[name]).select(GOLD[name].names)

    try:
        out, quality = {}, []
        for name, source in SOURCE_OF.items():
            df, counted = counted_table(name, bronze[source])
            out[name] = write(name, df)
            report = counted.report(out[name].count())
            if report is None:
                report = [r.asDict() for r in rule_report(typed_source(name, bronze[source]), RULES[name]).collect()]
            quality += [{"table_name": name, **line} for line in report]
        name = "daily_sales_by_product_store"
        out[name] = write(name, daily_sales(out["fact_transaction"]))
        findings = [r.asDict() for r in audit(out).collect()] if audit else []
        broken = [f for f in findings if f["must_hold"] and f["failing"]]
        if broken:
            raise AuditFailed(broken)
        releases.publish(spark, where, places, after, quality, findings, TABLE_COMMENTS)
    except BaseException:
        releases.discard(spark, list(places.values()))
        raise
    releases.prune(spark, where, keep)
    return out
