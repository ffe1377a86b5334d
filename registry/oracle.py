"""SQL that gives the same rows as each registered query, for checking only."""

import re

from tallymart import fixed_values as V
from tallymart.schemas import GOLD, TABLE_COMMENTS
from tallymart.plans.definitions import VIEWS

SEED = 7


# -- text helpers -----------------------------------------------------------

def key(prefix, number, width=9):
    """Text id; numbers of more digits than ``width`` are not touched."""
    text = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || repeat('0', greatest(0, {width} - length({text}))) || {text}"


def cents(amount):
    return f"CAST(round({amount} * 100) AS BIGINT)"


def money(c):
    return f"CAST(CAST({c} AS DECIMAL(12,0)) * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(10,2))"


def bits(tag, *keys):
    text = " || '-' || ".join([*[f"CAST({k} AS VARCHAR)" for k in keys], f"'{SEED}'", f"'{tag}'"])
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


def draw(tag, *keys):
    return f"({bits(tag, *keys)} / 4503599627370496e0)"


def below(u, n):
    return f"CAST(floor({u} * {n}) AS BIGINT)"


def texts(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(u, values):
    return f"{texts(values)}[{below(u, len(values))} + 1]"


def weighted(u, values, edges):
    whens = " ".join(f"WHEN {u} < {e}e0 THEN '{v}'" for v, e in zip(values, edges))
    return f"CASE {whens} ELSE '{values[-1]}' END"


def case_of(column, mapping):
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {column} {whens} END"


def ratio(top, bottom, digits=6):
    return f"round(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0e0), {digits})"


CATEGORY_EDGES = ["0.3", "0.6", "0.75", "0.9"]
REGION_EDGES = ["0.35", "0.6", "0.85"]
SUBCATEGORY = case_of("category", {k: texts(v) for k, v in V.SUBCATEGORIES.items()})


def pick_subcategory(id_column):
    return f"({SUBCATEGORY})[{below(draw('subcategory', id_column), f'len({SUBCATEGORY})')} + 1]"


# -- shared steps -----------------------------------------------------------

STEPS = {
    "places": "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "b_guest": f"""
        SELECT {key('G', 'c_custkey')} AS guest_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name, lower(c_name) || '@example.com' AS email,
               DATE '2022-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS signup_date, r_name AS home_region
        FROM customer JOIN places ON c_nationkey = n_nationkey""",
    "b_product": f"""
        SELECT {key('P', 'p_partkey')} AS product_id, p_name AS product_name, p_type AS category,
               p_brand AS subcategory, p_brand AS brand,
               {money(f"{cents('p_retailprice')} * 45 // 100")} AS unit_cost,
               {money(cents('p_retailprice'))} AS list_price
        FROM part""",
    "b_store": f"""
        SELECT {key('S', 's_suppkey')} AS store_id, s_name AS store_name, r_name AS region, n_name AS district,
               s_name || ' City' AS city, substr(r_name, 1, 2) AS state,
               DATE '2015-01-01' + CAST(s_suppkey % 2900 AS INTEGER) AS open_date
        FROM supplier JOIN places ON s_nationkey = n_nationkey""",
    "raw_line": f"""
        SELECT *, {cents('p_retailprice')} AS price, CAST(l_quantity AS BIGINT) AS qty,
               {cents('p_retailprice')} * {cents('l_discount')} // 100 AS disc
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "b_line": f"""
        SELECT {key('T', 'l_orderkey')} AS transaction_id, CAST(l_linenumber AS BIGINT) AS line_number,
               CAST(l_shipdate AS DATE) AS transaction_date, {key('G', 'o_custkey')} AS guest_id,
               {key('S', 'l_suppkey')} AS store_id, {key('P', 'l_partkey')} AS product_id,
               CAST(qty AS INTEGER) AS quantity, {money('price')} AS unit_price, {money('disc')} AS discount_amount,
               {money(f"(price * qty - disc) * {cents('l_tax')} // 100")} AS tax_amount
        FROM raw_line""",
    "pairs": """
        SELECT DISTINCT l_suppkey, l_partkey, r_name, p_type
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN places ON s_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey""",
    "days": "SELECT CAST(range AS INTEGER) AS day_idx FROM range(14)",
    "b_stock": f"""
        SELECT DATE '1998-02-12' + day_idx AS snapshot_date, {key('S', 'l_suppkey')} AS store_id,
               {key('P', 'l_partkey')} AS product_id,
               CAST(CASE WHEN r_name = 'AFRICA' AND p_type = 'PROMO' THEN greatest(0, 18 - 2 * day_idx)
                    ELSE greatest(0, CASE WHEN p_type = 'PROMO' THEN 60 ELSE 120 END
                         + (l_suppkey * 31 + l_partkey * 17 + day_idx * 7) % 11 - 5) END AS INTEGER) AS quantity_on_hand
        FROM pairs CROSS JOIN days""",
}


def gold_steps(pre_b, pre_g):
    """Gold steps over bronze steps that start with ``pre_b``."""
    return {
        f"{pre_g}guest": f"""
            SELECT sha256(guest_id) AS guest_key, * FROM {pre_b}guest WHERE guest_id IS NOT NULL""",
        f"{pre_g}product": f"""
            SELECT sha256(product_id) AS product_key, * FROM {pre_b}product WHERE product_id IS NOT NULL""",
        f"{pre_g}store": f"""
            SELECT sha256(store_id) AS store_key, * FROM {pre_b}store WHERE store_id IS NOT NULL""",
        f"{pre_g}sale": f"""
            SELECT * FROM (
              SELECT sha256(transaction_id || '-' || CAST(line_number AS VARCHAR)) AS transaction_line_key,
                     transaction_id, CAST(line_number AS INTEGER) AS line_number, transaction_date,
                     sha256(guest_id) AS guest_key, sha256(product_id) AS product_key, sha256(store_id) AS store_key,
                     quantity, unit_price, discount_amount, tax_amount,
                     CAST(quantity * unit_price - discount_amount AS DECIMAL(10,2)) AS net_amount
              FROM {pre_b}line)
            WHERE transaction_line_key IS NOT NULL AND guest_key IS NOT NULL AND product_key IS NOT NULL
              AND store_key IS NOT NULL AND quantity > 0""",
        f"{pre_g}stock": f"""
            SELECT * FROM (
              SELECT sha256(CAST(snapshot_date AS VARCHAR) || '-' || store_id || '-' || product_id) AS inventory_key,
                     snapshot_date, sha256(store_id) AS store_key, sha256(product_id) AS product_key,
                     quantity_on_hand
              FROM {pre_b}stock)
            WHERE inventory_key IS NOT NULL AND store_key IS NOT NULL AND product_key IS NOT NULL
              AND quantity_on_hand >= 0""",
        f"{pre_g}daily": f"""
            SELECT transaction_date AS sale_date, store_key, product_key,
                   CAST(sum(quantity) AS INTEGER) AS units_sold, CAST(sum(net_amount) AS DECIMAL(12,2)) AS net_sales
            FROM {pre_g}sale GROUP BY ALL""",
    }


STEPS |= gold_steps("b_", "g_")
STEPS |= {
    "u_guest": """
        SELECT * REPLACE (
          CASE WHEN day(signup_date) = 1 THEN replace(email, '@', ' at ') ELSE email END AS email,
          CASE WHEN day(signup_date) = 2 THEN NULL ELSE guest_id END AS guest_id) FROM b_guest""",
    "u_product": """
        SELECT * REPLACE (
          CASE WHEN brand = 'Brand#13' THEN -list_price ELSE list_price END AS list_price,
          CASE WHEN category = 'SMALL' AND brand = 'Brand#2' THEN NULL ELSE product_id END AS product_id)
        FROM b_product""",
    "u_store": """
        SELECT * REPLACE (CASE WHEN district = 'NATION_3' THEN NULL ELSE store_id END AS store_id) FROM b_store""",
    "u_line": """
        SELECT * REPLACE (
          CASE WHEN line_number = 3 THEN -quantity ELSE quantity END AS quantity,
          CASE WHEN line_number = 4 THEN NULL ELSE store_id END AS store_id,
          CASE WHEN line_number = 5 THEN NULL ELSE guest_id END AS guest_id,
          CASE WHEN line_number = 6 THEN NULL ELSE product_id END AS product_id,
          CASE WHEN line_number = 7 THEN NULL ELSE transaction_id END AS transaction_id) FROM b_line""",
    "u_stock": """
        SELECT * REPLACE (
          CASE WHEN quantity_on_hand % 17 = 5 THEN NULL ELSE snapshot_date END AS snapshot_date,
          CASE WHEN quantity_on_hand % 11 = 5 THEN NULL ELSE store_id END AS store_id,
          CASE WHEN quantity_on_hand % 13 = 5 THEN NULL ELSE product_id END AS product_id,
          quantity_on_hand - 62 AS quantity_on_hand) FROM b_stock""",
}
STEPS |= gold_steps("u_", "ug_")
STEPS |= {
    "s_wide": """
        SELECT f.*, g.home_region, p.category, p.subcategory, s.region, s.district
        FROM g_sale f LEFT JOIN g_guest g USING (guest_key) LEFT JOIN g_product p USING (product_key)
        LEFT JOIN g_store s USING (store_key)""",
    "i_wide": """
        SELECT i.*, p.category, s.region, d.units_sold
        FROM g_stock i LEFT JOIN g_product p USING (product_key) LEFT JOIN g_store s USING (store_key)
        LEFT JOIN g_daily d ON i.store_key = d.store_key AND i.product_key = d.product_key
             AND i.snapshot_date = d.sale_date""",
    "guest_idx": "SELECT *, row_number() OVER (ORDER BY guest_id) - 1 AS guest_idx FROM b_guest",
    "product_idx": "SELECT *, row_number() OVER (ORDER BY product_id) - 1 AS product_idx FROM b_product",
    "store_idx": "SELECT *, row_number() OVER (ORDER BY store_id) - 1 AS store_idx FROM b_store",
    "promo_idx": """
        SELECT product_id, product_idx, list_price, row_number() OVER (ORDER BY product_id) - 1 AS promo_rank
        FROM product_idx WHERE category = 'PROMO'""",
}


def _line_step(ids, kind):
    promo = kind == "promo"
    day = below(draw(f"{kind}_day", "id"), V.PROMO_DAYS if promo else V.SALES_DAYS)
    u = draw(f"{kind}_store", "id")
    return f"""
        SELECT {key('T', 'id % (SELECT count(*) FROM orders)')} AS transaction_id, id % 4 + 1 AS line_number,
               DATE '2024-01-01' + CAST({day} + {V.PROMO_FIRST_DAY if promo else 0} AS INTEGER) AS transaction_date,
               {below(f'{u} * {u}', '(SELECT count(*) FROM supplier)')} AS store_idx,
               {below(draw('guest', 'id'), '(SELECT count(*) FROM customer)')} AS guest_idx,
               {below(draw('product', 'id'), '(SELECT count(*) FROM part)')} AS product_idx,
               CASE WHEN {draw(f'{kind}_one', 'id')} < 0.7e0 THEN 1
                    WHEN {draw(f'{kind}_two', 'id')} < 0.93e0 THEN 2 ELSE 3 END AS quantity,
               {str(promo).lower()} AS is_promo
        FROM ({ids})"""


STEPS |= {
    "made_line": f"""
        {_line_step('SELECT range AS id FROM range((SELECT count(*) FROM lineitem))', 'base')}
        UNION ALL {_line_step('SELECT o_orderkey AS id FROM orders', 'promo')}""",
    "made_redirected": f"""
        SELECT transaction_id, line_number, transaction_date, store_idx, guest_idx, quantity, is_promo,
               product_id, list_price
        FROM made_line JOIN product_idx USING (product_idx) WHERE NOT is_promo
        UNION ALL
        SELECT transaction_id, line_number, transaction_date, store_idx, guest_idx, quantity, is_promo,
               product_id, list_price
        FROM (SELECT *, {below(draw('promo_product', 'transaction_id', 'line_number'),
                               '(SELECT count(*) FROM promo_idx)')} AS promo_rank FROM made_line WHERE is_promo) m
        JOIN promo_idx USING (promo_rank)""",
    "made_priced": f"""
        SELECT *, {cents('list_price')} AS price,
               CASE WHEN is_promo THEN ({cents('list_price')} * 20 + 50) // 100 ELSE 0 END AS disc
        FROM made_redirected JOIN guest_idx USING (guest_idx) JOIN store_idx USING (store_idx)""",
    "profile": "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS row_count,
                   count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count,
                   CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM {step}"""
        for table, step in {
            "dim_guest": "g_guest", "dim_product": "g_product", "dim_store": "g_store",
            "fact_transaction": "g_sale", "fact_inventory": "g_stock", "daily_sales_by_product_store": "g_daily",
        }.items() for c in GOLD[table].names),
    "meta": "SELECT * FROM (VALUES " + ", ".join(
        "('{}', '{}', '{}', {}, {})".format(
            t, f.name, f.dataType.simpleString(), i,
            "'" + f.metadata["comment"].replace("'", "''") + "'" if f.metadata else "NULL")
        for t, schema in GOLD.items() for i, f in enumerate(schema.fields, 1)
    ) + ") v(table_name, column_name, data_type, position, comment)",
    "metric_meta": "SELECT * FROM (VALUES " + ", ".join(
        "('{}', '{}', '{}', {}, {})".format(
            v.name, x.name, kind, i, "'" + x.comment.replace("'", "''") + "'" if x.comment else "NULL")
        for v in VIEWS.values()
        for i, (x, kind) in enumerate(
            [(d, "dimension") for d in v.dimensions] + [(m, "measure") for m in v.measures], 1)
    ) + ") v(table_name, column_name, data_type, position, comment)",
    "gaps": "SELECT * FROM meta JOIN profile USING (table_name, column_name) WHERE comment IS NULL",
    "drafts": """
        SELECT table_name, column_name,
               replace(column_name, '_', ' ') || ' of ' || table_name || ': ' || distinct_count
               || ' distinct values from ' || coalesce(min_value, '-') || ' to ' || coalesce(max_value, '-') || '.'
               AS draft FROM gaps""",
    "lookup_values": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS rows FROM {step} GROUP BY ALL"
        for t, step, cols in [
            ("dim_guest", "g_guest", ["first_name", "last_name", "email", "home_region"]),
            ("dim_product", "g_product", ["product_name", "category", "subcategory", "brand"]),
            ("dim_store", "g_store", ["store_name", "region", "district", "city", "state"]),
        ] for c in cols),
}
STEPS["named_values"] = """
    SELECT * FROM lookup_values
    WHERE (table_name = 'dim_product' AND column_name IN ('product_name', 'category', 'brand'))
       OR (table_name = 'dim_store' AND column_name IN ('region', 'district'))"""


def _with(sql):
    """``sql`` with the shared steps it uses in front."""
    need, todo = set(), [sql]
    while todo:
        text = todo.pop()
        for name, body in STEPS.items():
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                todo.append(body)
    steps = [f"{n} AS ({b})" for n, b in STEPS.items() if n in need]
    return (f"WITH {', '.join(steps)} " if steps else "") + sql


# -- checks -----------------------------------------------------------------

ORACLE = {}

ORACLE["range_source"] = """
    SELECT id, coalesce(n, 0) AS orders
    FROM (SELECT range AS id FROM range((SELECT count(*) FROM customer)))
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON id = o_custkey"""
ORACLE["scan_bronze"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"
ORACLE["table_roundtrip"] = "SELECT * FROM g_daily"
ORACLE["refresh_gold"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(sum({c}) AS BIGINT) AS units FROM {step}"
    for t, step, c in [
        ("dim_guest", "g_guest", "0"), ("dim_product", "g_product", "0"), ("dim_store", "g_store", "0"),
        ("fact_transaction", "g_sale", "quantity"), ("fact_inventory", "g_stock", "quantity_on_hand"),
        ("daily_sales_by_product_store", "g_daily", "units_sold")])
ORACLE["conform_schema"] = """
    SELECT o_orderkey AS order_id, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_rank,
           TRY_CAST(o_orderpriority AS INTEGER) AS priority,
           TRY_CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(7,2)) AS total FROM orders"""
ORACLE["bottoms_count"] = """
    SELECT product_id, (SELECT count(*) FROM b_product WHERE category = 'PROMO') AS category_products
    FROM b_product WHERE category = 'PROMO'"""
for _table, _step in [("guest", "b_guest"), ("product", "b_product"), ("store", "b_store"),
                      ("transaction_line", "b_line"), ("inventory_snapshot", "b_stock")]:
    ORACLE[f"bronze_{_table}"] = f"SELECT * FROM {_step}"

ORACLE["project_guest"] = "SELECT guest_id AS guest, home_region AS region FROM b_guest"
ORACLE["derive_email"] = """
    SELECT guest_id, lower(first_name) || '.' || lower(last_name) || '@example.com' AS address FROM b_guest"""
ORACLE["split_promo"] = """
    SELECT transaction_date, CASE WHEN discount_amount > 0 THEN 'promo' ELSE 'regular' END AS part,
           count(*) AS line_count, CAST(sum(quantity) AS BIGINT) AS units FROM b_line GROUP BY ALL"""
ORACLE["filter_category"] = "SELECT product_id, list_price FROM b_product WHERE category = 'PROMO'"
ORACLE["email_like"] = "SELECT guest_id, email FROM u_guest WHERE email LIKE '%@%'"
ORACLE["weighted_pick"] = f"""
    SELECT c_custkey, {weighted(draw('pick', 'c_custkey'), V.CATEGORIES, CATEGORY_EDGES)} AS category FROM customer"""
ORACLE["price_band"] = """
    SELECT product_id, CASE category WHEN 'ECONOMY' THEN 10e0 WHEN 'SMALL' THEN 20e0 WHEN 'MEDIUM' THEN 30e0
           WHEN 'STANDARD' THEN 40e0 WHEN 'LARGE' THEN 50e0 END AS price_low FROM b_product"""


def stock_level(noise):
    return f"""CAST(CASE WHEN region = 'AFRICA' AND category = 'PROMO' THEN greatest(0, 18 - 2 * day_idx)
        ELSE greatest(0, CASE WHEN category = 'PROMO' THEN 60 ELSE 120 END
             + CAST(trunc({noise} * 10e0 - 5e0) AS INTEGER)) END AS INTEGER)"""


ORACLE["depletion"] = f"""
    SELECT region, category, day_idx, count(*) AS cells, CAST(sum(level) AS BIGINT) AS on_hand,
           min(level) AS least, max(level) AS most
    FROM (SELECT region, category, day_idx, {stock_level(draw('stock', 'store_id', 'product_id', 'day_idx'))} AS level
          FROM (SELECT {key('S', 'l_suppkey')} AS store_id, {key('P', 'l_partkey')} AS product_id,
                       r_name AS region, p_type AS category FROM pairs) CROSS JOIN days) GROUP BY ALL"""
ORACLE["promo_discount"] = f"""
    SELECT transaction_id, line_number, transaction_date, unit_price,
           {money(f"CASE WHEN month(transaction_date) = 2 THEN ({cents('unit_price')} * 20 + 50) // 100 ELSE 0 END")}
           AS discount FROM b_line"""
ORACLE["safe_cast"] = f"""
    SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS bad_text,
           TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS good_text,
           TRY_CAST({cents('o_totalprice')} AS DECIMAL(7,0)) AS too_big,
           TRY_CAST(o_orderkey * 1000000 AS INTEGER) AS small_int FROM orders"""

ORACLE["fk_resolve"] = f"""
    SELECT o_orderkey, guest_id, home_region
    FROM (SELECT o_orderkey, {below(draw('guest', 'o_orderkey'), '(SELECT count(*) FROM customer)')} AS guest_idx
          FROM orders) JOIN guest_idx USING (guest_idx)"""
ORACLE["star_join_sales"] = """
    SELECT transaction_line_key, net_amount, home_region, category, region AS store_region FROM s_wide"""
ORACLE["inventory_with_sales"] = """
    SELECT store_key, snapshot_date, count(*) AS cells, count(units_sold) AS cells_with_sales,
           CAST(sum(quantity_on_hand) AS BIGINT) AS on_hand, CAST(sum(units_sold) AS BIGINT) AS sold
    FROM i_wide GROUP BY ALL"""
ORACLE["drill_across"] = """
    SELECT i.product_key, count(*) AS cells, CAST(sum(quantity_on_hand) AS BIGINT) AS on_hand,
           CAST(sum(sold) AS BIGINT) AS sold, CAST(sum(n) AS BIGINT) AS line_count
    FROM g_stock i LEFT JOIN (
      SELECT store_key, product_key, transaction_date, sum(quantity) AS sold, count(*) AS n
      FROM g_sale GROUP BY ALL) d
      ON i.store_key = d.store_key AND i.product_key = d.product_key AND i.snapshot_date = d.transaction_date
    GROUP BY ALL"""
STEPS["stocked"] = f"""
    SELECT DISTINCT {key('S', 'l_suppkey')} AS store_id, {key('P', 'l_partkey')} AS product_id FROM lineitem"""
ORACLE["inventory_grid"] = """
    SELECT store_id, store_idx, product_id, day_idx FROM stocked JOIN store_idx USING (store_id) CROSS JOIN days"""
ORACLE["dense_index_tied"] = """
    SELECT o_orderpriority, min(n) AS first, max(n) AS last, count(DISTINCT n) AS numbers
    FROM (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS n FROM orders) GROUP BY 1"""
ORACLE["wide_ids"] = f"""
    SELECT o_orderkey, {key('T', 'o_orderkey * 10000000019')} AS order_id FROM orders"""

ORACLE["dense_index"] = """
    SELECT p_name, p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS position FROM part"""
ORACLE["subset_index"] = """
    SELECT product_id, category, row_number() OVER (ORDER BY product_id) - 1 AS rank
    FROM b_product WHERE category = 'PROMO'"""
ORACLE["dense_index_scaled"] = """
    SELECT o_orderpriority, o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS position
    FROM orders"""
ORACLE["union_lines"] = """
    SELECT l_orderkey, l_returnflag = 'R' AS back, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units,
           count(*) AS line_count FROM lineitem GROUP BY ALL"""
ORACLE["promo_resample"] = f"""
    SELECT transaction_id, line_number, p.product_id
    FROM (SELECT transaction_id, line_number, {below(draw('promo_product', 'transaction_id', 'line_number'),
          '(SELECT count(*) FROM promo_idx)')} AS promo_rank FROM b_line) JOIN promo_idx p USING (promo_rank)"""

ORACLE["sum_by_store"] = """
    SELECT store_key, CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(net_amount) AS DECIMAL(20,2)) AS net_sales
    FROM g_sale GROUP BY ALL"""
ORACLE["distinct_counts"] = """
    SELECT store_key, count(DISTINCT transaction_id) AS baskets, count(DISTINCT guest_key) AS guests,
           count(DISTINCT product_key) AS products FROM g_sale GROUP BY ALL"""
ORACLE["avg_on_hand"] = """
    SELECT store_key, round(avg(quantity_on_hand), 6) AS mean_on_hand FROM g_stock GROUP BY ALL"""
ORACLE["aov"] = f"""
    SELECT store_key, {ratio('sum(net_amount)', 'count(DISTINCT transaction_id)')} AS order_value
    FROM g_sale GROUP BY ALL"""
ORACLE["guarded_ratio"] = f"""
    SELECT product_id, transaction_date, {ratio('sum(tax_amount)', 'sum(discount_amount)')} AS tax_per_discount
    FROM b_line GROUP BY ALL"""
ORACLE["group_by_all"] = """
    SELECT category, brand, CAST(sum(list_price) AS DECIMAL(20,2)) AS list_total, count(*) AS products
    FROM g_product GROUP BY ALL"""

NET = "CAST(sum(net_amount) AS DECIMAL(20,2)) AS net_sales"
UNITS = "CAST(sum(quantity) AS BIGINT) AS units_sold"
BASKETS = "count(DISTINCT transaction_id) AS transaction_count"
AOV = f"{ratio('sum(net_amount)', 'count(DISTINCT transaction_id)')} AS average_order_value"
GUESTS = "count(DISTINCT guest_key) AS guest_count"
STOCK = "CAST(sum(quantity_on_hand) AS BIGINT) AS units_on_hand"
SOLD = "CAST(sum(units_sold) AS BIGINT) AS units_sold"
THROUGH = f"{ratio('sum(units_sold)', 'sum(units_sold) + sum(quantity_on_hand)')} AS sell_through_rate"
TURNOVER = f"{ratio('sum(units_sold)', 'avg(quantity_on_hand)')} AS inventory_turnover"
GRAIN = "category AS product_category, region AS store_region"

ORACLE["grand_total"] = f"SELECT {NET}, {UNITS}, {BASKETS}, {AOV}, {GUESTS} FROM g_sale"
ORACLE["dimension_values"] = f"SELECT DISTINCT {GRAIN} FROM s_wide"

# functions
ORACLE["surrogate_keys"] = """
    SELECT transaction_id, line_number, transaction_date, sha256(transaction_id) AS one_part,
           sha256(transaction_id || '-' || CAST(line_number AS VARCHAR)) AS two_parts,
           sha256(CAST(transaction_date AS VARCHAR) || '-' || store_id || '-' || product_id) AS three_parts
    FROM b_line"""
ORACLE["fn_string"] = """
    SELECT c_custkey, c_name || ' of ' || c_mktsegment AS joined,
           repeat('0', greatest(0, 3 - length(CAST(c_custkey AS VARCHAR)))) || CAST(c_custkey AS VARCHAR) AS padded, lower(c_name) AS lowered,
           trim('  ' || c_name || ' ') AS trimmed,
           '''' || replace('guest''s ' || c_name, '''', '''''') || '''' AS quoted,
           c_name || ', ' || c_mktsegment AS listed FROM customer"""
ORACLE["hash_pick"] = f"SELECT c_custkey, {pick(draw('brand', 'c_custkey'), V.BRANDS)} AS brand FROM customer"
ORACLE["seeded_draw"] = f"""
    SELECT o_orderkey, {bits('one', 'o_orderkey')} AS one_key, {bits('two', 'o_orderkey', 'o_custkey')} AS two_keys
    FROM orders"""
ORACLE["store_skew"] = f"""
    SELECT {below(f"pow({draw('store', 'o_orderkey')}, 2)", '(SELECT count(*) FROM supplier)')} AS store_idx,
           count(*) AS orders FROM orders GROUP BY ALL"""
ORACLE["fn_math"] = """
    SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice, 1) AS rounded, q + 3 AS plus, q - 30 AS minus,
           q * 7 AS times, round(q / 8e0, 6) AS over, CAST(trunc((q - 30) / 7e0) AS INTEGER) AS whole, q % 7 AS rest,
           greatest(0, q - 30) AS floored, pow(q, 2) AS squared
    FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q FROM lineitem)"""
ORACLE["fn_date"] = """
    SELECT o_orderkey, day + CAST(o_orderkey % 90 AS INTEGER) AS later, day - 90 AS window_start,
           day - 90 + 42 AS stock_start, CAST(date_trunc('month', day) AS DATE) AS month,
           CAST(date_trunc('month', day) - INTERVAL 1 MONTH AS DATE) AS last_month,
           DATE '2022-01-01' + CAST(o_custkey % 100 AS INTEGER) AS from_literal
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)"""
ORACLE["fn_array"] = f"""
    SELECT c_custkey, {texts(V.REGIONS)}[c_custkey % 4 + 1] AS region, 4 AS regions FROM customer"""
ORACLE["refresh_months"] = "SELECT * FROM g_daily"
ORACLE["changed_months"] = """
    SELECT DISTINCT CAST(date_trunc('month', transaction_date) AS DATE) AS period,
           CASE month(transaction_date) WHEN 1 THEN 'new' ELSE 'changed' END AS status
    FROM b_line WHERE month(transaction_date) IN (1, 12)
    UNION ALL
    SELECT DISTINCT CAST(date_trunc('month', transaction_date) + INTERVAL 480 MONTH AS DATE), 'gone'
    FROM b_line WHERE month(transaction_date) = 2"""
ORACLE["refresh_stock_days"] = """
    SELECT snapshot_date, count(*) AS rows, CAST(sum(quantity_on_hand) AS BIGINT) AS units,
           CASE day(snapshot_date) WHEN 13 THEN 'new' WHEN 20 THEN 'new' WHEN 15 THEN 'changed' END AS status
    FROM g_stock GROUP BY 1"""
_ALL_SALES = f"{NET}, {UNITS}, {BASKETS}, {AOV}, {GUESTS}"
ORACLE["rollup_sales_by_month_region"] = f"""
    SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, region AS store_region,
           {NET}, {UNITS}, {BASKETS}, {GUESTS}
    FROM s_wide GROUP BY 1, 2"""
ORACLE["rollup_sales_by_region"] = f"SELECT region AS store_region, {_ALL_SALES} FROM s_wide GROUP BY 1"
ORACLE["rollup_sales_total"] = f"SELECT {_ALL_SALES} FROM s_wide"
ORACLE["rollup_sales_by_category"] = f"SELECT category AS product_category, {_ALL_SALES} FROM s_wide GROUP BY 1"
ORACLE["rollup_stock_by_day_region"] = f"""
    SELECT snapshot_date, region AS store_region, {STOCK}, {SOLD}, {THROUGH}, {TURNOVER} FROM i_wide GROUP BY 1, 2"""
_CODE = "CASE region WHEN 'AFRICA' THEN 'AF' WHEN 'AMERICA' THEN 'AM' WHEN 'ASIA' THEN 'AS' WHEN 'EUROPE' THEN 'EU' END"
ORACLE["fn_map"] = f"SELECT store_id, {_CODE} AS by_key, {_CODE} AS by_element FROM b_store"
ORACLE["subcategory_pick"] = f"""
    SELECT p_partkey, category, {pick_subcategory('p_partkey')} AS subcategory
    FROM (SELECT p_partkey, {pick(draw('category', 'p_partkey'), V.CATEGORIES)} AS category FROM part)"""
ORACLE["fake_names"] = f"""
    SELECT c_custkey, {pick(draw('first_name', 'c_custkey'), V.FIRST_NAMES)} AS first_name,
           {pick(draw('last_name', 'c_custkey'), V.LAST_NAMES)} AS last_name,
           {pick(draw('city', 'c_custkey'), V.CITIES)} AS city,
           chr(65 + CAST(c_custkey % 26 AS INTEGER)) || chr(65 + CAST(c_custkey // 26 % 26 AS INTEGER))
           || chr(65 + CAST(c_custkey // 676 % 26 AS INTEGER)) AS code FROM customer"""

# row rules and audits
ORACLE["quality_kept"] = """
    SELECT transaction_line_key, guest_key, product_key, quantity, net_amount FROM ug_sale"""
ORACLE["quality_warn"] = """
    SELECT product_id, list_price, coalesce(list_price >= 0 AND unit_cost >= 0, false) AS valid_price
    FROM u_product WHERE sha256(product_id) IS NOT NULL"""
_RULES = [
    ("dim_guest", "u_guest", "valid_guest_key", "drop", "sha256(guest_id) IS NOT NULL"),
    ("dim_guest", "u_guest", "valid_email", "keep", "email LIKE '%@%'"),
    ("dim_product", "u_product", "valid_product_key", "drop", "sha256(product_id) IS NOT NULL"),
    ("dim_product", "u_product", "valid_price", "keep", "list_price >= 0 AND unit_cost >= 0"),
    ("dim_store", "u_store", "valid_store_key", "drop", "sha256(store_id) IS NOT NULL"),
    ("fact_transaction", "u_line", "valid_line_key", "drop",
     "sha256(transaction_id || '-' || CAST(line_number AS VARCHAR)) IS NOT NULL"),
    ("fact_transaction", "u_line", "valid_keys", "drop",
     "sha256(guest_id) IS NOT NULL AND sha256(product_id) IS NOT NULL AND sha256(store_id) IS NOT NULL"),
    ("fact_transaction", "u_line", "non_negative_quantity", "drop", "quantity > 0"),
    ("fact_inventory", "u_stock", "valid_inventory_key", "drop",
     "sha256(CAST(snapshot_date AS VARCHAR) || '-' || store_id || '-' || product_id) IS NOT NULL"),
    ("fact_inventory", "u_stock", "valid_keys", "drop",
     "sha256(store_id) IS NOT NULL AND sha256(product_id) IS NOT NULL"),
    ("fact_inventory", "u_stock", "non_negative_quantity", "drop", "quantity_on_hand >= 0"),
]
ORACLE["quality_report"] = "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, '{r}' AS rule, '{a}' AS on_failure, count(*) FILTER (coalesce({c}, false)) AS passed,
        count(*) FILTER (NOT coalesce({c}, false)) AS failed FROM {s}""" for t, s, r, a, c in _RULES)
ORACLE["quality_log"] = ORACLE["quality_report"]
ORACLE["quality_quarantine"] = """
    SELECT * FROM (
      SELECT transaction_id, line_number, guest_id, product_id, quantity, concat_ws(',',
        CASE WHEN transaction_id IS NULL THEN 'valid_line_key' END,
        CASE WHEN guest_id IS NULL OR product_id IS NULL OR store_id IS NULL THEN 'valid_keys' END,
        CASE WHEN NOT quantity > 0 THEN 'non_negative_quantity' END) AS failed_rules FROM u_line)
    WHERE failed_rules <> ''"""
_KEYS = [("dim_guest", "g_guest", "guest_key"), ("dim_product", "g_product", "product_key"),
         ("dim_store", "g_store", "store_key"), ("fact_transaction", "g_sale", "transaction_line_key"),
         ("fact_inventory", "g_stock", "inventory_key")]
ORACLE["pk_audit"] = "\nUNION ALL\n".join(f"""
    SELECT '{t}' AS table_name, CAST(sum(n) AS BIGINT) AS total_rows,
           CAST(coalesce(sum(n) FILTER (k IS NULL), 0) AS BIGINT) AS null_keys,
           count(k) AS distinct_keys, count(*) FILTER (k IS NOT NULL AND n > 1) AS repeated_keys,
           CAST(coalesce(sum(n - 1) FILTER (k IS NOT NULL), 0) AS BIGINT) AS surplus_rows
    FROM (SELECT {k} AS k, count(*) AS n FROM {s} GROUP BY 1)""" for t, s, k in _KEYS)
ORACLE["pk_duplicates"] = """
    SELECT transaction_line_key, count(*) AS rows FROM g_sale GROUP BY 1 HAVING count(*) > 1"""
_LINKS = [("fact_transaction", "dim_guest", "sale", "guest"), ("fact_transaction", "dim_product", "sale", "product"),
          ("fact_transaction", "dim_store", "sale", "store"), ("fact_inventory", "dim_store", "stock", "store"),
          ("fact_inventory", "dim_product", "stock", "product"),
          ("daily_sales_by_product_store", "dim_store", "daily", "store"),
          ("daily_sales_by_product_store", "dim_product", "daily", "product")]
ORACLE["fk_audit"] = "\nUNION ALL\n".join(f"""
    SELECT '{c}' AS child, '{p}' AS parent, count(DISTINCT {k}_key) AS orphan_keys, count(*) AS orphan_rows
    FROM ug_{f} f WHERE f.{k}_key IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM ug_{k} d WHERE d.{k}_key = f.{k}_key)""" for c, p, f, k in _LINKS)
ORACLE["release_audit"] = "\nUNION ALL\n".join([
    *[f"""SELECT 1 AS release, '{t}' AS table_name, 'null_keys' AS check_name, count(*) - count({k}) AS failing,
          true AS must_hold FROM u{s}""" for t, s, k in _KEYS],
    *[f"""SELECT 1, '{t}', 'repeated_keys', count(*), {str(t.startswith('dim')).lower()}
          FROM (SELECT {k} FROM u{s} WHERE {k} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""" for t, s, k in _KEYS],
    *[f"""SELECT 1, '{c}', 'orphans of {p}', count(*), false FROM ug_{f} f
          WHERE f.{k}_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ug_{k} d WHERE d.{k}_key = f.{k}_key)"""
      for c, p, f, k in _LINKS]])
ORACLE["release_history"] = "\nUNION ALL\n".join(
    f"SELECT {n} AS release, '{t}' AS table_name, count(*) AS row_count FROM {pre}{step}"
    for n, pre in ((1, "ug_"), (2, "g_"))
    for t, step in [("dim_guest", "guest"), ("dim_product", "product"), ("dim_store", "store"), ("fact_transaction", "sale"),
                    ("fact_inventory", "stock"), ("daily_sales_by_product_store", "daily")])
ORACLE["cardinality_audit"] = "\nUNION ALL\n".join(f"""
    SELECT '{c}' AS child, '{p}' AS parent, '{k}' AS join_key, max(n) AS max_rows_per_key,
           max(n) <= 1 AS is_many_to_one
    FROM (SELECT count(*) AS n FROM {s} WHERE {k} IS NOT NULL GROUP BY {k})""" for c, p, s, k in [
        *[(c, p, f"g_{k}", f"{k}_key") for c, p, _, k in _LINKS],
        ("fact_transaction", "fact_transaction", "g_sale", "transaction_line_key")])
_TEXT_CELLS = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS t, '{c.name}' AS c, {c.name} AS v, count(*) AS n FROM {v} WHERE {c.name} IS NOT NULL GROUP BY {c.name}"
    for t, v in [("dim_guest", "g_guest"), ("dim_product", "g_product"), ("dim_store", "g_store"), ("fact_transaction", "g_sale"),
                 ("fact_inventory", "g_stock"), ("daily_sales_by_product_store", "g_daily")]
    for c in GOLD[t].fields if c.dataType.simpleString() == "string")
ORACLE["found_joins"] = f"""
    SELECT * FROM (
      WITH cells AS MATERIALIZED ({_TEXT_CELLS}),
      met AS (SELECT a.t AS child, a.c AS child_column, b.t AS parent, b.c AS parent_column, CAST(sum(a.n) AS BIGINT) AS child_rows,
                     count(*) AS child_keys FROM cells a JOIN cells b ON a.v = b.v AND a.t <> b.t GROUP BY ALL),
      sizes AS (SELECT t, c, count(*) AS k, max(n) AS most FROM cells GROUP BY ALL)
      SELECT met.* FROM met JOIN sizes x ON x.t = child AND x.c = child_column AND x.k = child_keys
      JOIN sizes y ON y.t = parent AND y.c = parent_column AND y.most = 1)"""
ORACLE["model_summary"] = "\nUNION ALL\n".join(f"""
    SELECT '{c}' AS child, '{p}' AS parent, '{k}_key' AS join_key, count(f.{k}_key) AS child_rows,
           count(*) - count(f.{k}_key) AS null_rows, count(d.{k}_key) AS matched_rows,
           count(f.{k}_key) - count(d.{k}_key) AS orphan_rows,
           count(DISTINCT f.{k}_key) - count(DISTINCT d.{k}_key) AS orphan_keys,
           (SELECT count(DISTINCT {k}_key) FROM ug_{k}) AS parent_keys,
           (SELECT count(DISTINCT {k}_key) FROM ug_{k}) - count(DISTINCT d.{k}_key) AS unused_keys
    FROM ug_{f} f LEFT JOIN ug_{k} d ON f.{k}_key = d.{k}_key""" for c, p, f, k in _LINKS)
ORACLE["not_null_audit"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({e}) AS null_rows FROM {s}"
    for t, s, key, parts in [
        ("guest", "u_guest", "guest_key", ["guest_id"]), ("product", "u_product", "product_key", ["product_id"]),
        ("store", "u_store", "store_key", ["store_id"]),
        ("transaction_line", "u_line", "transaction_line_key", ["transaction_id", "line_number"]),
        ("inventory_snapshot", "u_stock", "inventory_key", ["snapshot_date", "store_id", "product_id"])]
    for c, e in [(key, " || ".join(f"CAST({x} AS VARCHAR)" for x in parts)), *[(x, x) for x in parts]])

# gold tables and metrics
for _name, _step in [("dim_guest", "g_guest"), ("dim_product", "g_product"), ("dim_store", "g_store"),
                     ("fact_transaction", "g_sale"), ("fact_inventory", "g_stock"), ("daily_sales", "g_daily")]:
    ORACLE[_name] = f"SELECT * FROM {_step}"
for _name, _wide, _measure in [
    ("m_net_sales", "s_wide", NET), ("m_units_sold", "s_wide", UNITS), ("m_transaction_count", "s_wide", BASKETS),
    ("m_aov", "s_wide", AOV), ("m_guest_count", "s_wide", GUESTS), ("m_units_on_hand", "i_wide", STOCK),
    ("m_inv_units_sold", "i_wide", SOLD), ("m_sell_through", "i_wide", THROUGH), ("m_turnover", "i_wide", TURNOVER),
]:
    ORACLE[_name] = f"SELECT {GRAIN}, {_measure} FROM {_wide} GROUP BY ALL"
for _name, _wide, _dim, _measures in [
    ("d_date", "s_wide", "transaction_date", f"{NET}, {BASKETS}"),
    ("d_category", "s_wide", "category AS product_category", f"{NET}, {GUESTS}"),
    ("d_subcategory", "s_wide", "subcategory AS product_subcategory", f"{NET}, {UNITS}"),
    ("d_region", "s_wide", "region AS store_region", f"{NET}, {BASKETS}"),
    ("d_district", "s_wide", "district AS store_district", f"{NET}, {UNITS}"),
    ("d_snapshot_date", "i_wide", "snapshot_date", f"{STOCK}, {SOLD}"),
    ("d_inv_category", "i_wide", "category AS product_category", f"{STOCK}, {SOLD}"),
    ("d_inv_region", "i_wide", "region AS store_region", f"{STOCK}, {SOLD}"),
]:
    ORACLE[_name] = f"SELECT {_dim}, {_measures} FROM {_wide} GROUP BY ALL"
ORACLE["metric_pruned_join"] = f"SELECT district AS store_district, {UNITS} FROM s_wide GROUP BY ALL"
ORACLE["metric_all_joins"] = ORACLE["metric_pruned_join"]
ORACLE["metric_folded"] = f"SELECT {GRAIN}, {STOCK}, {SOLD}, {THROUGH}, {TURNOVER} FROM i_wide GROUP BY ALL"
ORACLE["metric_where_having"] = """
    SELECT store_district, product_category, units_sold FROM (
      SELECT district AS store_district, category AS product_category, CAST(sum(quantity) AS BIGINT) AS units_sold,
             sum(net_amount) AS net
      FROM s_wide WHERE region IN ('ASIA', 'AFRICA') AND transaction_date >= DATE '1997-01-01'
      GROUP BY ALL HAVING count(DISTINCT guest_key) >= 10 AND sum(quantity) > 500)
    ORDER BY net DESC NULLS LAST, store_district, product_category LIMIT 20"""

# questions
ORACLE["monthly_net_sales"] = """
    SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, sum(net_amount) AS net_sales
    FROM g_sale GROUP BY ALL"""
ORACLE["category_distribution"] = """
    SELECT category, count(*) AS products, round(count(*) / CAST((SELECT count(*) FROM g_product) AS DOUBLE), 6) AS share
    FROM g_product GROUP BY ALL"""
ORACLE["region_sales_last_month"] = f"""
    SELECT region AS store_region, {NET} FROM s_wide, (SELECT max(transaction_date) AS last FROM g_sale)
    WHERE transaction_date >= date_trunc('month', last) - INTERVAL 1 MONTH
      AND transaction_date < date_trunc('month', last) GROUP BY ALL"""
ORACLE["top_region_sell_through"] = f"""
    SELECT region AS store_region, {ratio('sum(units_sold)', 'sum(units_sold) + sum(quantity_on_hand)', 9)}
           AS sell_through_rate, {STOCK} FROM i_wide WHERE category = 'PROMO' GROUP BY ALL
    ORDER BY CAST(sum(units_sold) AS DOUBLE) / nullif(sum(units_sold) + sum(quantity_on_hand), 0) DESC NULLS LAST,
             region LIMIT 1"""
ORACLE["lowest_sell_through"] = """
    SELECT product_id, product_name, units_sold, units_on_hand, round(rate, 9) AS sell_through_rate FROM (
      SELECT product_id, product_name, CAST(sum(units_sold) AS BIGINT) AS units_sold,
             CAST(sum(quantity_on_hand) AS BIGINT) AS units_on_hand,
             CAST(sum(units_sold) AS DOUBLE) / nullif(sum(units_sold) + sum(quantity_on_hand), 0) AS rate
      FROM i_wide LEFT JOIN g_product USING (product_key) GROUP BY ALL)
    ORDER BY rate NULLS LAST, product_id LIMIT 10"""
ORACLE["net_sales_by_category"] = f"SELECT category AS product_category, {NET}, {AOV} FROM s_wide GROUP BY ALL"
ORACLE["products_per_brand"] = "SELECT brand, count(*) AS products FROM g_product GROUP BY ALL"

# glossary
ORACLE["column_profile"] = "SELECT * FROM profile"
ORACLE["column_profile_sketch"] = "SELECT * EXCLUDE (distinct_count), true AS estimate_close FROM profile"
_SIZES = {"dim_store": "g_store", "fact_inventory": "g_stock"}
assert set(_SIZES) <= set(TABLE_COMMENTS)
ORACLE["table_gaps"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {s}" for t, s in _SIZES.items())
ORACLE["column_gaps"] = """
    SELECT table_name, column_name, data_type, row_count, null_count, distinct_count FROM gaps"""
STEPS["lists"] = """
    SELECT table_name, string_agg(column_name, ', ' ORDER BY position) AS columns, max(row_count) AS row_count,
           count(*) FILTER (null_count = row_count) AS empty_columns
    FROM meta JOIN profile USING (table_name, column_name) GROUP BY 1"""
STEPS["new_tables"] = """
    SELECT table_name, table_name || ': ' || row_count || ' rows with ' || columns || '.' AS draft
    FROM lists WHERE table_name IN ('dim_store', 'fact_inventory')"""
ORACLE["column_lists"] = "SELECT * FROM lists"
ORACLE["table_drafts"] = "SELECT * FROM new_tables"
ORACLE["table_statements"] = """
    SELECT table_name, 'COMMENT ON TABLE ' || table_name || ' IS ''' || replace(draft, '''', '''''') || '''' AS statement
    FROM new_tables"""
ORACLE["gap_prompts"] = """
    SELECT table_name, column_name, 'Say in one short sentence what column ''' || column_name || ''' (' || data_type
           || ') of the retail table ''' || table_name || ''' means.' AS prompt, row_count FROM gaps"""
ORACLE["gap_drafts"] = "SELECT table_name, column_name, draft FROM drafts"
ORACLE["gap_statements"] = """
    SELECT table_name, column_name, 'ALTER TABLE ' || table_name || ' ALTER COLUMN ' || column_name || ' COMMENT '''
           || replace(draft, '''', '''''') || '''' AS statement FROM drafts"""
ORACLE["table_prompts"] = """
    SELECT table_name, 'Say in one sentence what the retail table ''' || table_name || ''' is for. Its columns are: '
           || columns || '.' AS prompt, row_count
    FROM lists"""
ORACLE["glossary_filled"] = """
    SELECT table_name, column_name, data_type, position, coalesce(comment, draft) AS comment
    FROM meta LEFT JOIN drafts USING (table_name, column_name)
    UNION ALL SELECT table_name, column_name, data_type, position, comment FROM metric_meta"""
ORACLE["entity_values"] = """
    SELECT * FROM lookup_values
    UNION ALL SELECT 'sales_metrics', 'Product Category', category, count(*) FROM s_wide GROUP BY ALL
    UNION ALL SELECT 'sales_metrics', 'Product Subcategory', subcategory, count(*) FROM s_wide GROUP BY ALL
    UNION ALL SELECT 'sales_metrics', 'Store Region', region, count(*) FROM s_wide GROUP BY ALL
    UNION ALL SELECT 'sales_metrics', 'Store District', district, count(*) FROM s_wide GROUP BY ALL
    UNION ALL SELECT 'inventory_metrics', 'Product Category', category, count(*) FROM i_wide GROUP BY ALL
    UNION ALL SELECT 'inventory_metrics', 'Store Region', region, count(*) FROM i_wide GROUP BY ALL"""
ORACLE["entity_match"] = """
    SELECT term, table_name, column_name, value FROM (
      SELECT ' ' || lower(r_name) || '  ' AS term FROM region UNION SELECT ' ' || lower(n_name) || '  ' FROM nation
      UNION SELECT ' ' || upper(p_brand) || '  ' FROM part)
    JOIN lookup_values ON lower(trim(term)) = lower(trim(value))"""
ORACLE["entity_match_close"] = """
    SELECT term, table_name, column_name, value, CAST(distance AS INTEGER) AS distance,
           row_number() OVER (PARTITION BY term ORDER BY distance, rows DESC, table_name, column_name, value) = 1 AS best
    FROM (
      SELECT term, v.*, levenshtein(lower(trim(term)), lower(trim(value))) AS distance, length(trim(term)) AS size
      FROM (SELECT ' ' || upper(value[1:1] || value[3:]) AS term FROM named_values
            UNION SELECT value[1:1] || value[3:] || 'q' FROM named_values UNION SELECT value FROM named_values), named_values v)
    WHERE distance <= CASE WHEN size >= 7 THEN 2 WHEN size >= 4 THEN 1 ELSE 0 END"""

# synthetic data
ORACLE["gen_guests"] = f"""
    SELECT guest_id, first_name, last_name, lower(first_name) || '.' || lower(last_name) || '@example.com' AS email,
           signup_date, home_region FROM (
      SELECT {key('G', 'id')} AS guest_id, {pick(draw('first_name', 'id'), V.FIRST_NAMES)} AS first_name,
             {pick(draw('last_name', 'id'), V.LAST_NAMES)} AS last_name,
             DATE '2022-01-01' + CAST({below(draw('signup_date', 'id'), 730)} AS INTEGER) AS signup_date,
             {weighted(draw('home_region', 'id'), V.REGIONS, REGION_EDGES)} AS home_region
      FROM (SELECT c_custkey AS id FROM customer))"""
_LOW, _HIGH = case_of("category", V.PRICE_LOW), case_of("category", V.PRICE_HIGH)
ORACLE["gen_products"] = f"""
    SELECT {key('P', 'id')} AS product_id,
           {pick(draw('line', 'id'), V.PRODUCT_LINES)} || ' ' || {pick_subcategory('id')} AS product_name, category,
           {pick_subcategory('id')} AS subcategory, {pick(draw('brand', 'id'), V.BRANDS)} AS brand,
           {money(f"floor(list * (0.35e0 + {draw('unit_cost', 'id')} * 0.2e0))")} AS unit_cost,
           {money('list')} AS list_price
    FROM (SELECT id, category, CAST(floor(({_LOW} + {draw('list_price', 'id')} * ({_HIGH} - {_LOW})) * 100)
                 AS BIGINT) AS list
          FROM (SELECT id, {weighted(draw('category', 'id'), V.CATEGORIES, CATEGORY_EDGES)} AS category
                FROM (SELECT p_partkey AS id FROM part)))"""
_SLOT_REGION = texts([r for r, _, n in V.STORE_BLOCKS for _ in range(n)])
_SLOT_DISTRICT = texts([d for _, d, n in V.STORE_BLOCKS for _ in range(n)])
ORACLE["gen_stores"] = f"""
    SELECT {key('S', 'id')} AS store_id, city || ' Store' AS store_name, region, district, city,
           CASE region WHEN 'West' THEN 'CA' WHEN 'Central' THEN 'TX' WHEN 'East' THEN 'NY' ELSE 'GA' END AS state,
           DATE '2015-01-01' + CAST({below(draw('open_date', 'id'), 2900)} AS INTEGER) AS open_date
    FROM (SELECT s_suppkey AS id, {pick(draw('city', 's_suppkey'), V.CITIES)} AS city,
                 {_SLOT_REGION}[s_suppkey % 25 + 1] AS region, {_SLOT_DISTRICT}[s_suppkey % 25 + 1] AS district
          FROM supplier)"""
ORACLE["hot_key_join"] = """
    SELECT p_brand, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS units
    FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 7 <> 1 THEN l_partkey END AS part, l_quantity
          FROM lineitem) LEFT JOIN part AS p ON part = p_partkey GROUP BY p_brand"""
ORACLE["gen_lines"] = "SELECT * FROM made_line"
ORACLE["gen_transaction_lines"] = f"""
    SELECT transaction_id, line_number, transaction_date, guest_id, store_id, product_id, quantity,
           {money('price')} AS unit_price, {money('disc')} AS discount_amount,
           {money('((price * quantity - disc) * 8 + 50) // 100')} AS tax_amount FROM made_priced"""
ORACLE["gen_inventory"] = f"""
    SELECT store_id, product_id, DATE '2024-01-01' + 42 + day_idx AS snapshot_date,
           {stock_level(draw('stock', 'store_idx', 'product_idx', 'day_idx'))} AS quantity_on_hand
    FROM stocked JOIN store_idx USING (store_id) JOIN product_idx USING (product_id) CROSS JOIN days"""

ORACLE = {name: re.sub(r"\s*\n\s*", " ", _with(sql)).strip() for name, sql in ORACLE.items()}
