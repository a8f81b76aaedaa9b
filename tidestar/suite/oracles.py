"""SQL that gives the same result as each registered query, on the sample tables."""

from __future__ import annotations

from tidestar.schemas import STAR_TABLES, WIDE_ID, feed_schema, star_schema
from tidestar.functions.typing import inferred_type, type_name
from tidestar.sources import synth
from tidestar.suite.fixtures import BATCH_AT


def key(text: str) -> str:
    """First 64 bits of an MD5 as a signed number."""
    bits = f"('0x' || left(md5({text}), 16))::UBIGINT"
    return (f"(CASE WHEN {bits} > 9223372036854775807 THEN ({bits}::HUGEINT - 18446744073709551616)::BIGINT "
            f"ELSE {bits}::BIGINT END)")


RANK = """CASE "Op" WHEN 'I' THEN 1 WHEN 'U' THEN 2 WHEN 'D' THEN 3 ELSE 0 END"""


def won(source: str, *seq: str) -> str:
    order = ", ".join([f"{RANK} DESC", '"Timestamp" DESC NULLS LAST', *seq])
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS rn "
            f"FROM {source}) WHERE rn = 1")


T1, T2, T3 = "TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-02-01'", "TIMESTAMP '2024-03-01'"
NOW = f"TIMESTAMP '{BATCH_AT}'"
TOTAL = "DECIMAL(22,2)"

DIM_CUSTOMER = f"""SELECT {key("'dim_customer|' || id")} AS customer_key, id AS customer_id, name, email, city, country,
  created_at AS created_date, {{ts}} AS effective_start_date, CASE WHEN "Op" = 'D' THEN {{ts}} END AS effective_end_date,
  "Op" <> 'D' AS is_current FROM {{source}}"""
DIM_PRODUCT = f"""SELECT {key("'dim_product|' || id")} AS product_key, id AS product_id, name AS product_name, category,
  price AS unit_price, created_at AS created_date, {{ts}} AS effective_start_date,
  CASE WHEN "Op" = 'D' THEN {{ts}} END AS effective_end_date, "Op" <> 'D' AS is_current FROM {{source}}"""


def facts(items: str, customers: str, products: str, extra: str = "") -> str:
    return f"""SELECT {key("'fact_orders|' || i.order_id || '|' || i.product_id")} AS order_sk, i.order_id,
  {key("'dim_customer|' || o.customer_id")} AS customer_key, {key("'dim_product|' || i.product_id")} AS product_key,
  strftime(o.order_date, '%Y%m%d')::INTEGER AS date_sk, i.quantity, i.unit_price,
  (i.unit_price * i.quantity)::DECIMAL(12,2) AS total_amount, o.status AS order_status,
  o.order_date::TIMESTAMP AS order_timestamp{extra}
  FROM {items} i JOIN orders_won o ON i.order_id = o.id
  WHERE o.customer_id IN (SELECT customer_id FROM {customers} WHERE is_current)
    AND i.product_id IN (SELECT product_id FROM {products} WHERE is_current)"""


ALWAYS_CUSTOMER = "(SELECT id AS customer_id, true AS is_current FROM customer_rows)"
ALWAYS_PRODUCT = "(SELECT id AS product_id, true AS is_current FROM product_rows)"


def versions(feed: str, table: str, natural: str, names: str, changed: str) -> str:
    """History after inserts, updates that change something, and deletes."""
    return f"""SELECT {key(f"'{table}|' || v.id")} AS {table.removeprefix('dim_')}_key, v.id AS {natural}, {names},
  v.began AS effective_start_date, coalesce(v.nxt, d.began) AS effective_end_date, v.nxt IS NULL AND d.began IS NULL AS is_current
  FROM (SELECT *, lead(began) OVER (PARTITION BY id ORDER BY began) AS nxt
        FROM (SELECT *, "Timestamp" AS began FROM {feed} WHERE "Op" = 'I' OR ("Op" = 'U' AND {changed}))) v
  LEFT JOIN (SELECT id, "Timestamp" AS began FROM {feed} WHERE "Op" = 'D') d ON d.id = v.id"""


CTES = {
    "customer_rows": """SELECT c_custkey + 1 AS id, c_name AS name,
  lower(replace(c_name, '#', '.')) || '@example.com' AS email, n_name AS city, r_name AS country,
  TIMESTAMP '2023-06-01 12:00:00' AS created_at, c_mktsegment, c_acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "customers_feed": f"""SELECT 'I' AS "Op", id, name, email, city, country, created_at, {T1} AS "Timestamp" FROM customer_rows
  UNION ALL SELECT 'U', id, name, email, CASE WHEN c_mktsegment = 'BUILDING' THEN city || ' WEST' ELSE city END, country,
    created_at, {T2} FROM customer_rows WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')
  UNION ALL SELECT 'D', id, name, email, city, country, created_at, {T3} FROM customer_rows WHERE c_acctbal < 0""",
    "product_rows": """SELECT p_partkey + 1 AS id, p_name AS name, p_type AS category,
  p_retailprice::DECIMAL(10,2) AS price, TIMESTAMP '2023-06-01 12:00:00' AS created_at, p_size FROM part""",
    "products_feed": f"""SELECT 'I' AS "Op", id, name, category, price, created_at, {T1} AS "Timestamp" FROM product_rows
  UNION ALL SELECT 'U', id, name, category, (CASE WHEN p_size > 40 THEN price + 1.00 ELSE price END)::DECIMAL(10,2),
    created_at, {T2} FROM product_rows WHERE p_size > 35
  UNION ALL SELECT 'D', id, name, category, price, created_at, {T3} FROM product_rows WHERE p_size <= 2""",
    "orders_feed": f"""SELECT 'I' AS "Op", o_orderkey + 1 AS id, o_custkey + 1 AS customer_id, o_orderdate::DATE AS order_date,
  o_orderstatus AS status, o_totalprice::DECIMAL(12,2) AS total, {T1} AS "Timestamp" FROM orders""",
    "items_flagged": """SELECT 'I' AS "Op", l_orderkey * 10 + l_linenumber AS id, l_orderkey + 1 AS order_id,
  l_partkey + 1 AS product_id, l_quantity::INTEGER AS quantity, l_extendedprice::DECIMAL(10,2) AS unit_price,
  l_shipdate AS "Timestamp", l_returnflag FROM lineitem""",
    "items_feed": "SELECT * EXCLUDE (l_returnflag) FROM items_flagged",
    "customers_won": won("customers_feed"),
    "products_won": won("products_feed"),
    "orders_won": won("orders_feed"),
    "items_won": won("items_feed", "product_id", "quantity", "unit_price"),
    "dim_customer": DIM_CUSTOMER.format(ts=NOW, source="customers_won"),
    "dim_product": DIM_PRODUCT.format(ts=NOW, source="products_won"),
    "dim_date": """SELECT strftime(d, '%Y%m%d')::INTEGER AS date_sk, d AS full_date, year(d)::INTEGER AS year,
  month(d)::INTEGER AS month, day(d)::INTEGER AS day, quarter(d)::INTEGER AS quarter, dayname(d) AS day_of_week,
  isodow(d) >= 6 AS is_weekend
  FROM (SELECT DISTINCT order_date AS d FROM orders_won WHERE order_date IS NOT NULL)""",
    "fact_orders": facts("items_won", "dim_customer", "dim_product"),
    "customer_versions": versions("customers_feed", "dim_customer", "customer_id",
                                  "v.name, v.email, v.city, v.country, v.created_at AS created_date",
                                  "city LIKE '% WEST'"),
    "product_versions": versions("products_feed", "dim_product", "product_id",
                                 "v.name AS product_name, v.category, v.price AS unit_price, v.created_at AS created_date",
                                 "id IN (SELECT id FROM product_rows WHERE p_size > 40)"),
    "items_a": won("(SELECT * FROM items_flagged WHERE l_returnflag = 'A')", "product_id", "quantity", "unit_price"),
    "items_n": won("(SELECT * FROM items_flagged WHERE l_returnflag = 'N')", "product_id", "quantity", "unit_price"),
    "items_r": won("(SELECT * FROM items_flagged WHERE l_returnflag = 'R')", "product_id", "quantity", "unit_price"),
    "fact_versions": facts("items_a", ALWAYS_CUSTOMER, ALWAYS_PRODUCT, ", 0::BIGINT AS _batch_id") + " UNION ALL "
    + facts("items_n", ALWAYS_CUSTOMER, ALWAYS_PRODUCT, ", 1::BIGINT AS _batch_id") + " UNION ALL "
    + facts("items_r", "customer_versions", "product_versions", ", 2::BIGINT AS _batch_id"),
    "fact_left": """SELECT *, CASE WHEN order_status = 'P' THEN 3 WHEN order_id % 5 = 0 THEN 4 WHEN order_id % 7 = 0 THEN 6 END AS deleted_in
  FROM fact_versions""",
    "appended": " UNION ALL ".join(
        DIM_CUSTOMER.format(ts=ts, source=f"""(SELECT * FROM customers_feed WHERE "Op" = '{op}')""")
        for op, ts in (("I", T1), ("U", T2), ("D", T3))
    ),
}


def sql(body: str) -> str:
    """The body with the tables it is built on."""
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in CTES.items()) + "\n" + body


def _profile(table: str, relation: str, columns: list[tuple[int, str, str]], template: str) -> str:
    return " UNION ALL ".join(
        "SELECT " + template.format(table=table, position=i, name=name, type=kind) + f" FROM {relation}"
        for i, name, kind in columns
    )


def _star_profile(template: str) -> str:
    return " UNION ALL ".join(
        _profile(t, t, [(i + 1, f.name, type_name(f.dataType)) for i, f in enumerate(star_schema(t, WIDE_ID).fields)], template)
        for t in STAR_TABLES
    )


def _feed_profile(template: str) -> str:
    relations = {"customers": "customers_feed", "products": "products_feed", "orders": "orders_feed", "order_items": "items_feed"}
    return " UNION ALL ".join(
        _profile(t, r, [(i + 1, f.name, type_name(inferred_type(f.dataType)))
                        for i, f in enumerate(feed_schema(t, WIDE_ID).fields)], template)
        for t, r in relations.items()
    )


def _counts(relations: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {r}" for n, r in relations.items())


STAR_COUNTS = _counts({t: t for t in STAR_TABLES})
FEED_COUNTS = """SELECT '{t}' AS source_table, "Op", count(*) AS n_rows, min(id) AS min_id, max(id) AS max_id FROM {r} GROUP BY "Op" """
FEED_OF = {"customers": "customers_feed", "products": "products_feed", "orders": "orders_feed", "order_items": "items_feed"}
PER_FEED = " UNION ALL ".join(FEED_COUNTS.format(t=t, r=r) for t, r in FEED_OF.items())
ROWS_PER_FEED = " UNION ALL ".join(
    f"SELECT '{t}' AS source_table, count(*)::BIGINT AS n_rows FROM {r}" for t, r in FEED_OF.items()
)


# ---- synthetic values ----------------------------------------------------


def draw(row: str, salt: str) -> str:
    return f"(('0x' || left(md5('{salt}|' || ({row})), 8))::BIGINT)"


def pick(row: str, salt: str, n: object) -> str:
    return f"({draw(row, salt)} % ({n}))"


def listed(values: list[str], index: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][({index}) + 1]"


def _gen_customers() -> str:
    first = listed(synth.FIRST_NAMES, pick("c_custkey", "first", len(synth.FIRST_NAMES)))
    last = listed(synth.LAST_NAMES, pick("c_custkey", "last", len(synth.LAST_NAMES)))
    return f"""SELECT n + 1 AS id, f || ' ' || l AS name, lower(f) || '.' || lower(l) || n || '@example.com' AS email,
  {listed(synth.CITIES, pick("n", "city", len(synth.CITIES)))} AS city,
  TIMESTAMP '2024-03-01' - to_hours({pick("n", "created", 720)}) AS created_at
  FROM (SELECT c_custkey AS n, {first} AS f, {last} AS l FROM customer)"""


def _template(field: int, index: str) -> str:
    return listed([p[field] for p in synth.PRODUCTS], f"({index}) % {len(synth.PRODUCTS)}")


GEN_PRODUCTS = f"""SELECT p_partkey + 1 AS id, {_template(0, "p_partkey")} AS name, {_template(1, "p_partkey")} AS category,
  {_template(2, "p_partkey")}::DECIMAL(10,2) AS price,
  TIMESTAMP '2024-03-01' - to_hours({pick("p_partkey", "product", 2160)}) AS created_at FROM part"""
ROLL = draw("o_orderkey", "status")
GEN_ORDERS = f"""SELECT o_orderkey + 1 AS id, {pick("o_orderkey", "customer", "SELECT count(*) FROM customer")} + 1 AS customer_id,
  DATE '2024-03-01' - ({pick("o_orderkey", "day", 90)})::INTEGER AS order_date,
  CASE WHEN {ROLL} < 0.15 * 4294967296 THEN 'pending' WHEN {ROLL} < 0.40 * 4294967296 THEN 'shipped'
       WHEN {ROLL} < 0.95 * 4294967296 THEN 'delivered' ELSE 'cancelled' END AS status,
  (({pick("o_orderkey", "total", 19501)} + 500) * 0.01)::DECIMAL(12,2) AS total FROM orders"""
GEN_ITEMS = f"""SELECT n + 1 AS id, {pick("n", "item-order", "SELECT count(*) FROM orders")} + 1 AS order_id,
  {pick("n", "item-product", "SELECT count(*) FROM part")} + 1 AS product_id, ({pick("n", "quantity", 5)} + 1)::INTEGER AS quantity,
  {_template(2, pick("n", "item-product", "SELECT count(*) FROM part"))}::DECIMAL(10,2) AS unit_price
  FROM (SELECT l_orderkey * 10 + l_linenumber AS n FROM lineitem)"""

STAR_FROM = """FROM fact_orders f JOIN dim_customer c ON f.customer_key = c.customer_key
  JOIN dim_product p ON f.product_key = p.product_key JOIN dim_date d ON f.date_sk = d.date_sk"""


def _history(feed: str, columns: str, *seq: str) -> str:
    order = ", ".join([f"{RANK} DESC", *seq])
    return f"""SELECT "Op", id, {columns}, "Timestamp", "Timestamp" AS effective_start_date,
  CASE WHEN "Op" = 'D' THEN "Timestamp" ELSE nxt END AS effective_end_date, nxt IS NULL AND "Op" <> 'D' AS is_current
  FROM (SELECT *, lead("Timestamp") OVER (PARTITION BY id ORDER BY "Timestamp") AS nxt
        FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, "Timestamp" ORDER BY {order}) AS rn FROM {feed})
              WHERE rn = 1))"""


def _size(size: str) -> str:
    def tenths(shift: int) -> str:
        return f"(({size} * 10 + {1 << (shift - 1)}) // {1 << shift})"

    def text(shift: int, unit: str) -> str:
        return f"({tenths(shift)} // 10) || '.' || ({tenths(shift)} % 10) || ' {unit}'"

    return (f"CASE WHEN {size} < 1024 THEN {size} || ' B' WHEN {size} < {1 << 20} THEN {text(10, 'KB')} "
            f"WHEN {size} < {1 << 30} THEN {text(20, 'MB')} ELSE {text(30, 'GB')} END")


SIZE_ROWS = """(SELECT o_orderkey, CASE WHEN o_orderpriority < '2' THEN cents % 1024 WHEN o_orderpriority < '4' THEN cents
  ELSE cents * 1000 END AS size FROM (SELECT *, round(o_totalprice * 100)::BIGINT AS cents FROM orders))"""

DIFF_COLUMNS = ("name", "email", "city", "country")
_N = ", ".join(f"CASE WHEN n.id IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in DIFF_COLUMNS)
_CHANGED = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in DIFF_COLUMNS)


def oracle_sql() -> dict[str, str]:
    bodies = {
        # sources, ingest, sinks, tables
        "discover_files": " UNION ALL ".join(
            f"SELECT '{t}' AS source_table, count(*)::BIGINT AS n_rows FROM {r}"
            for t, r in FEED_OF.items() if t in ("orders", "order_items")
        ),
        "processed_ledger": f"SELECT *, 0::BIGINT AS found_again FROM ({ROWS_PER_FEED})",
        "hour_ledger": f"SELECT *, 0::BIGINT AS hours_left FROM ({ROWS_PER_FEED})",
        "size_formatted": f"SELECT o_orderkey, size, {_size('size')} AS size_text FROM {SIZE_ROWS}",
        "read_cdc_parquet": "SELECT * FROM items_feed",
        "stream_cdc": PER_FEED,
        "skip_corrupt_files": " UNION ALL ".join(
            f"""SELECT '{t}' AS source_table, "Op", id, "Timestamp" FROM {r}""" for t, r in FEED_OF.items()
        ),
        "file_error_report": " UNION ALL ".join(
            [*(f"SELECT '{t}' AS source_table, 1::BIGINT AS errors" for t in FEED_OF), f"SELECT 'TOTAL', {len(FEED_OF)}"]
        ),
        "file_catalog": f"SELECT *, true AS all_parquet, true AS sizes_agree, true AS all_timed FROM ({ROWS_PER_FEED})",
        "process_batch_split": f"""SELECT table_name, row_count, NULL::{TOTAL} AS amount FROM ({STAR_COUNTS}) WHERE table_name <> 'fact_orders'
  UNION ALL SELECT 'fact_orders', count(*), sum(total_amount)::{TOTAL} FROM fact_orders""",
        "pending_items": """SELECT order_id, product_id, quantity, unit_price,
    CASE WHEN o.id IS NULL THEN 'order not found' ELSE 'no current customer' END AS reason, 0::BIGINT AS since
  FROM items_won i LEFT JOIN (SELECT id FROM orders_won) o ON o.id = i.order_id""",
        "keyed_state_waiting": """SELECT order_id, product_id, quantity, unit_price,
    CASE WHEN o.id IS NULL THEN 'order not found' ELSE 'no current customer' END AS reason
  FROM items_won i LEFT JOIN (SELECT id FROM orders_won) o ON o.id = i.order_id""",
        **{name: f"""SELECT table_name, row_count, NULL::{TOTAL} AS amount FROM ({STAR_COUNTS}) WHERE table_name <> 'fact_orders'
  UNION ALL SELECT 'fact_orders', count(*), sum(total_amount)::{TOTAL} FROM fact_orders""" for name in ("keyed_state_star", "keyed_state_restarted")},
        "route_by_table": f'SELECT source_table, "Op", n_rows, max_id FROM ({PER_FEED})',
        "process_batch": f"""SELECT table_name, row_count, NULL::{TOTAL} AS amount FROM ({STAR_COUNTS}) WHERE table_name <> 'fact_orders'
  UNION ALL SELECT 'fact_orders', count(*), sum(total_amount)::{TOTAL} FROM fact_orders""",
        "create_star_tables": f"""SELECT table_name, row_count, CASE table_name WHEN 'dim_customer' THEN 10 WHEN 'dim_product' THEN 9
  WHEN 'dim_date' THEN 8 ELSE 11 END AS n_columns FROM ({STAR_COUNTS})""",
        "append_star_tables": "SELECT * FROM fact_orders",
        "fact_day_partition": f"""SELECT order_timestamp::DATE AS order_day, count(*) AS n_facts,
  sum(total_amount)::{TOTAL} AS amount FROM fact_orders GROUP BY ALL""",
        "evolve_add_columns": """SELECT "Op", id, name, email, city, created_at, "Timestamp", NULL AS country FROM customers_feed WHERE "Op" = 'I'
  UNION ALL SELECT "Op", id, name, email, city, created_at, "Timestamp", country FROM customers_feed WHERE "Op" = 'U'""",
        "schema_mismatch_report": """SELECT 'product_id' AS column_name, 'LONG' AS table_type, 'STRING' AS data_type,
    count(*) AS filled_rows, 0::BIGINT AS lost_rows FROM lineitem
  UNION ALL SELECT 'quantity', 'INT', 'STRING', count(*), count(*) FROM lineitem
  UNION ALL SELECT 'unit_price', 'DECIMAL(10,2)', 'DOUBLE', count(*), 0 FROM lineitem""",
        "register_tables": f"""SELECT table_name, key, value, row_count FROM ({STAR_COUNTS}),
  (VALUES ('layer', 'gold'), ('origin', 'feed')) AS p(key, value)""",
        "verify_tables": f"""SELECT table_name, true AS is_registered, row_count FROM ({STAR_COUNTS})
  UNION ALL SELECT 'fact_returns', false, NULL""",
        "delete_from_fact": "SELECT * FROM fact_orders WHERE order_id NOT IN (SELECT id FROM orders_feed WHERE status = 'P')",
        "snapshot_diff_cdc": f"""SELECT CASE WHEN o.id IS NULL THEN 'I' WHEN n.id IS NULL THEN 'D' ELSE 'U' END AS "Op",
  coalesce(n.id, o.id) AS id, {_N}, {T2} AS "Timestamp"
  FROM (SELECT * FROM customers_feed WHERE "Op" = 'I' AND country <> 'ASIA') o
  FULL JOIN (SELECT * FROM customers_won WHERE "Op" <> 'D') n ON o.id = n.id
  WHERE o.id IS NULL OR n.id IS NULL OR {_CHANGED}""",
        "snapshot_diff_digest": f"""SELECT CASE WHEN o.id IS NULL THEN 'I' WHEN n.id IS NULL THEN 'D' ELSE 'U' END AS "Op",
  coalesce(n.id, o.id) AS id, {_N}, {T2} AS "Timestamp"
  FROM (SELECT * FROM customers_feed WHERE "Op" = 'I' AND country <> 'ASIA') o
  FULL JOIN (SELECT * FROM customers_won WHERE "Op" <> 'D') n ON o.id = n.id
  WHERE o.id IS NULL OR n.id IS NULL OR {_CHANGED}""",
        "snapshot_diff_few": f"""SELECT "Op", count(*) AS n_rows, sum(id)::BIGINT AS ids, sum(total)::{TOTAL} AS amount FROM (
  SELECT CASE WHEN b = 0 THEN 'I' WHEN a = 0 THEN 'D' WHEN id % 400 = 9 AND status <> 'X' THEN 'U' END AS "Op", id, total
  FROM (SELECT *, CASE WHEN id % 600 <> 11 THEN 1 ELSE 0 END AS b, CASE WHEN id % 500 <> 7 THEN 1 ELSE 0 END AS a FROM orders_feed) WHERE a + b > 0)
  WHERE "Op" IS NOT NULL GROUP BY ALL""",
        "kept_daily_sales": f"""SELECT d.full_date, d.day_of_week, count(*) AS order_count, sum(f.total_amount)::{TOTAL} AS daily_revenue
  FROM fact_left f JOIN dim_date d ON f.date_sk = d.date_sk WHERE f.deleted_in IS NULL GROUP BY ALL""",
        "kept_quarter_category": f"""SELECT d.year, d.quarter, p.category, count(*) AS transactions, sum(f.total_amount)::{TOTAL} AS category_revenue
  FROM fact_left f JOIN dim_date d ON f.date_sk = d.date_sk JOIN product_versions p ON f.product_key = p.product_key
  WHERE f.deleted_in IS NULL AND p.is_current GROUP BY ALL""",
        "kept_category_totals": f"""SELECT c.name, p.category, sum((f.quantity * f.unit_price)::DECIMAL(12,2))::{TOTAL} AS total
  FROM fact_left f JOIN customer_versions c ON f.customer_key = c.customer_key JOIN product_versions p ON f.product_key = p.product_key
  WHERE f.deleted_in IS NULL AND c.is_current AND p.is_current GROUP BY ALL""",
        "kept_top_customers": f"""SELECT customer_id, customer_name, email, order_count, total_spent,
  (((2 * (total_spent * 100)::HUGEINT + order_count) // (2 * order_count))::DECIMAL(18,0) * 0.01)::DECIMAL(12,2) AS avg_order_value FROM (
  SELECT c.customer_id, c.name AS customer_name, c.email, count(*) AS order_count, sum(f.total_amount)::{TOTAL} AS total_spent
  FROM fact_left f JOIN customer_versions c ON f.customer_key = c.customer_key WHERE f.deleted_in IS NULL AND c.is_current
  GROUP BY ALL ORDER BY total_spent DESC, customer_id LIMIT 10)""",
        "untyped_star": f"SELECT table_name, row_count FROM ({STAR_COUNTS})",
        "untyped_mixed_fields": """SELECT 'product_id' AS field, 'BIGINT,STRING' AS value_types, count(*) AS n_values FROM lineitem""",
        "untyped_lost_values": """SELECT column_name, CASE WHEN column_name IN ('id', 'product_id') THEN n ELSE 0 END AS filled_rows,
    CASE WHEN column_name = 'product_id' THEN lost ELSE 0 END AS lost_rows
  FROM (SELECT count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS lost FROM lineitem),
    (VALUES ('Op'), ('id'), ('order_id'), ('product_id'), ('quantity'), ('unit_price'), ('Timestamp')) AS c(column_name)""",
        "row_group_recovery": "SELECT count(*) AS n_rows, 1::BIGINT AS blocks_lost, true AS rows_behind FROM orders_feed",
        "sql_count_at_version": "SELECT count(*) AS fact_count_at_version FROM fact_versions WHERE _batch_id <= 0",
        "sql_count_as_of": "SELECT count(*) AS fact_count_at_timestamp FROM fact_versions WHERE _batch_id <= 1",
        "sql_facts_of_version": "SELECT * EXCLUDE (deleted_in, _batch_id) FROM fact_left WHERE deleted_in IS NULL",
        "sql_report_of_version": f"""SELECT c.name, p.category, sum((f.quantity * f.unit_price)::DECIMAL(12,2))::{TOTAL} AS total
  FROM fact_versions f JOIN customer_versions c ON f.customer_key = c.customer_key JOIN product_versions p ON f.product_key = p.product_key
  WHERE f._batch_id <= 1 AND c.is_current AND p.is_current GROUP BY ALL""",
        "batch_checks": """SELECT metric, value, NULL::BIGINT AS limit_value, n AS facts_seen FROM (
    SELECT (SELECT count(*) FROM items_won) AS items, (SELECT count(*) FROM fact_orders) AS n),
    LATERAL (VALUES ('judged_items', items), ('rejected_items', items - n), ('facts', n), ('mismatched_totals', 0)) AS m(metric, value)
  UNION ALL SELECT 'rejected_items', (SELECT count(*) FROM items_won) - (SELECT count(*) FROM fact_orders), 0::BIGINT, 0::BIGINT""",
        "deletion_vectors": f"""SELECT v AS version, count(*) AS n_facts, sum(total_amount)::{TOTAL} AS amount
  FROM fact_left, (VALUES (2), (3), (4), (5), (6)) AS versions(v) WHERE deleted_in IS NULL OR deleted_in > v GROUP BY v""",
        "deleted_rows": "SELECT deleted_in::BIGINT AS batch_id, count(*) AS deleted FROM fact_left WHERE deleted_in IS NOT NULL GROUP BY deleted_in",
        "compacted_facts": "SELECT * EXCLUDE (deleted_in) FROM fact_left WHERE deleted_in IS NULL",
        "compacted_range": """SELECT * EXCLUDE (deleted_in) FROM fact_left WHERE deleted_in IS NULL
  AND order_timestamp BETWEEN TIMESTAMP '1995-04-01' AND TIMESTAMP '1995-06-30'""",
        # scalar functions
        "op_priority": f'SELECT id, "Op", {RANK} AS priority FROM customers_feed',
        "surrogate_key": f"""SELECT c_custkey, {key("'dim_customer|' || c_custkey")} AS customer_key,
  {key("'dim_customer|' || c_name")} AS name_key FROM customer""",
        "surrogate_key_composite": f"""SELECT l_orderkey, l_partkey, l_returnflag,
  {key("'fact_orders|' || l_orderkey || '|' || l_partkey")} AS order_sk,
  {key("'fact_orders|' || l_orderkey || '|' || CASE WHEN l_returnflag = 'N' THEN 'null' ELSE l_returnflag END")} AS flag_sk
  FROM lineitem""",
        "md5_hex": "SELECT doc_id, md5(text) AS digest FROM documents",
        "to_string_safe": """SELECT id, customer_id::VARCHAR AS customer_id_text, order_date::VARCHAR AS order_date_text,
  status AS status_text, total::VARCHAR AS total_text FROM orders_feed""",
        "to_int_safe": """SELECT p_partkey, replace(p_brand, 'Brand#', '')::INTEGER AS brand_no, 0 AS name_no, 0 AS fraction_no,
  trunc(p_retailprice)::INTEGER AS whole_price, CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS large_size FROM part""",
        "to_decimal_safe": """SELECT l_orderkey, l_linenumber, l_extendedprice::DECIMAL(10,2) AS price, 0::DECIMAL(10,2) AS flag,
  (l_linenumber + 0.25)::DECIMAL(10,2) AS line,
  try_cast(floor(l_extendedprice * 10000)::BIGINT::VARCHAR || '.5' AS DECIMAL(10,2)) AS wide_text,
  try_cast(floor(l_extendedprice * 10000)::BIGINT AS DECIMAL(10,2)) AS wide FROM lineitem""",
        "to_timestamp_safe": """SELECT event_id, ts AS stamp, ts::DATE::TIMESTAMP AS midnight, NULL::TIMESTAMP AS none FROM events""",
        "to_date_safe": "SELECT event_id, ts::DATE AS day, NULL::DATE AS none FROM events",
        "infer_column_types": _feed_profile(
            """'{table}' AS table_name, {position} AS position, '{name}' AS column_name,
  CASE WHEN count("{name}") > 0 THEN '{type}' END AS inferred_type, count("{name}") < count(*) AS is_optional"""),
        "type_name": _star_profile(
            """'{table}' AS table_name, '{name}' AS column_name, '{type}' AS type_name, count("{name}") AS filled_rows"""),
        "column_optionality": _star_profile(
            """'{table}' AS table_name, '{name}' AS column_name, count("{name}") < count(*) AS is_optional"""),
        "date_to_epoch_day": "SELECT id, date_diff('day', DATE '1970-01-01', order_date)::INTEGER AS epoch_day FROM orders_feed",
        "ts_to_epoch_micros": "SELECT event_id, (epoch_us(ts) // 1000) * 1000 AS micros FROM events",
        "batch_summary": f"""SELECT table_name, row_count, row_count = 0 AS is_empty FROM ({STAR_COUNTS})
  UNION ALL SELECT 'TOTAL', sum(row_count)::BIGINT, false FROM ({STAR_COUNTS})""",
        # dedup, dimensions, facts, history
        "dedup_customers": "SELECT * FROM customers_won",
        "dedup_products": "SELECT * FROM products_won",
        "dedup_orders": "SELECT * FROM orders_won",
        "dedup_order_items": "SELECT * FROM items_won",
        "dedup_missing_times": f"""SELECT "Op", id, product_id, quantity, unit_price, "Timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY pr DESC, pin DESC, "Timestamp" DESC NULLS LAST, product_id, quantity, unit_price) AS rn
  FROM (SELECT *, "Timestamp" IS NULL AND row_number() OVER (PARTITION BY id, pr ORDER BY product_id, quantity, unit_price, "Timestamp" NULLS FIRST) = 1 AS pin
        FROM (SELECT *, {RANK} AS pr FROM (
          SELECT CASE WHEN year("Timestamp") > 1996 THEN 'I' END AS "Op", id, product_id, quantity, unit_price,
            CASE WHEN l_returnflag <> 'N' THEN "Timestamp" END AS "Timestamp" FROM items_flagged)))) WHERE rn = 1""",
        "build_dim_customer": "SELECT * FROM dim_customer",
        "build_dim_product": "SELECT * FROM dim_product",
        "build_dim_date": "SELECT * FROM dim_date",
        "build_fact_orders": "SELECT * FROM fact_orders",
        "build_fact_orders_salted": "SELECT * FROM fact_orders",
        "fact_rejects": """SELECT order_id, product_id, quantity, unit_price, reason FROM (
  SELECT i.*, CASE WHEN o.id IS NULL THEN 'order not found' WHEN c.customer_id IS NULL THEN 'no current customer'
    WHEN p.product_id IS NULL THEN 'no current product' WHEN o.order_date IS NULL THEN 'no order date' END AS reason
  FROM items_won i LEFT JOIN (SELECT * FROM orders_won WHERE status <> 'O') o ON o.id = i.order_id
  LEFT JOIN (SELECT * FROM dim_customer WHERE is_current) c ON c.customer_id = o.customer_id
  LEFT JOIN (SELECT * FROM dim_product WHERE is_current) p ON p.product_id = i.product_id) WHERE reason IS NOT NULL""",
        "transform_star": STAR_COUNTS,
        "scd2_merge_customer": "SELECT * FROM customer_versions",
        "scd2_merge_product": "SELECT * FROM product_versions",
        "scd2_history": _history("customers_feed", "name, email, city, country, created_at"),
        **{
            name: _history("items_feed", "order_id, product_id, quantity, unit_price", "product_id", "quantity", "unit_price")
            for name in ("scd2_history_items", "scd2_history_items_spread")
        },
        "scd2_delete_expire": f"""SELECT 'close' AS event, * FROM customer_versions WHERE effective_end_date = {T3}""",
        "scd2_append": "SELECT * FROM appended",
        "dim_date_upsert": "SELECT * FROM dim_date",
        # reports, quality, time travel
        "q_row_counts": STAR_COUNTS,
        "q_star_join_top20": f"""SELECT customer_name, customer_email, customer_city, product_name, product_category, order_date, order_day,
  quantity, unit_price, total_amount, order_status FROM (
  SELECT c.name AS customer_name, c.email AS customer_email, c.city AS customer_city, p.product_name, p.category AS product_category,
    d.full_date AS order_date, d.day_of_week AS order_day, f.quantity, f.unit_price, f.total_amount, f.order_status, f.order_sk
  {STAR_FROM} WHERE c.is_current
  ORDER BY f.total_amount DESC, f.order_sk, f.quantity, f.unit_price, d.full_date, c.name, c.email, c.city, p.product_name, p.category LIMIT 20)""",
        "q_top_customers": f"""SELECT customer_id, customer_name, email, order_count, total_spent,
  (((2 * (total_spent * 100)::HUGEINT + order_count) // (2 * order_count))::DECIMAL(18,0) * 0.01)::DECIMAL(12,2) AS avg_order_value FROM (
  SELECT c.customer_id, c.name AS customer_name, c.email, count(*) AS order_count, sum(f.total_amount)::{TOTAL} AS total_spent
  FROM fact_orders f JOIN dim_customer c ON f.customer_key = c.customer_key WHERE c.is_current
  GROUP BY ALL ORDER BY total_spent DESC, customer_id LIMIT 10)""",
        "q_top_products": f"""SELECT p.product_id, p.product_name, p.category, count(*) AS units_sold,
  sum(f.total_amount)::{TOTAL} AS total_revenue FROM fact_orders f JOIN dim_product p ON f.product_key = p.product_key
  WHERE p.is_current GROUP BY ALL ORDER BY total_revenue DESC, product_id LIMIT 10""",
        "q_daily_sales": f"""SELECT d.full_date, d.day_of_week, count(*) AS order_count, sum(f.total_amount)::{TOTAL} AS daily_revenue
  FROM fact_orders f JOIN dim_date d ON f.date_sk = d.date_sk GROUP BY ALL ORDER BY d.full_date""",
        "q_quarter_category": f"""SELECT d.year, d.quarter, p.category, count(*) AS transactions, sum(f.total_amount)::{TOTAL} AS category_revenue
  FROM fact_orders f JOIN dim_date d ON f.date_sk = d.date_sk JOIN dim_product p ON f.product_key = p.product_key
  WHERE p.is_current GROUP BY ALL ORDER BY d.year, d.quarter, category_revenue DESC""",
        "q_category_totals": f"""SELECT c.name, p.category, sum((f.quantity * f.unit_price)::DECIMAL(12,2))::{TOTAL} AS total
  {STAR_FROM} WHERE c.is_current AND p.is_current GROUP BY ALL ORDER BY total DESC""",
        "q_top5_spend": f"""SELECT c.name, count(*) AS orders, sum(f.total_amount)::{TOTAL} AS spent
  FROM fact_orders f JOIN dim_customer c ON f.customer_key = c.customer_key WHERE c.is_current
  GROUP BY c.name ORDER BY spent DESC, c.name LIMIT 5""",
        "q_first_customer_history": f"""SELECT c.name AS customer_name, c.customer_id, p.product_name, d.full_date AS order_date, f.quantity,
  f.total_amount, f.order_status {STAR_FROM}
  WHERE c.is_current AND c.customer_id = (SELECT min(customer_id) FROM dim_customer WHERE is_current)""",
        "q_orphan_customers": """SELECT count(*) AS orphan_customer_facts FROM fact_orders
  WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer)""",
        "q_orphan_products": """SELECT count(*) AS orphan_product_facts FROM fact_orders
  WHERE product_key NOT IN (SELECT product_key FROM dim_product)""",
        "q_orphan_dates": """SELECT count(*) AS orphan_date_facts FROM fact_orders
  WHERE date_sk NOT IN (SELECT date_sk FROM dim_date)""",
        "q_orphan_customers_lossy": """SELECT count(*) AS orphan_customer_facts FROM fact_orders
  WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer WHERE country <> 'ASIA')""",
        "q_orphan_products_lossy": """SELECT count(*) AS orphan_product_facts FROM fact_orders
  WHERE product_key NOT IN (SELECT product_key FROM dim_product WHERE category <> 'ECONOMY')""",
        "q_orphan_dates_lossy": """SELECT count(*) AS orphan_date_facts FROM fact_orders
  WHERE date_sk NOT IN (SELECT date_sk FROM dim_date WHERE year <> 1997)""",
        "q_scd2_versions": """SELECT customer_id, count(*) AS version_count, count(*) FILTER (is_current) AS current_rows,
  count(*) FILTER (NOT is_current) AS historical_rows FROM customer_versions GROUP BY customer_id HAVING count(*) > 1""",
        "q_fact_count_as_of": "SELECT count(*) AS fact_count_at_timestamp FROM fact_versions WHERE _batch_id <= 1",
        "q_snapshots": f"""SELECT 'fact_orders' AS table_name, _batch_id AS batch_id,
  CASE _batch_id WHEN 0 THEN {T1} WHEN 1 THEN {T2} ELSE {T3} END AS committed_at, count(*) AS rows
  FROM fact_versions GROUP BY ALL ORDER BY committed_at DESC LIMIT 5""",
        "q_fact_count_version": "SELECT count(*) AS fact_count_at_version FROM fact_versions WHERE _batch_id <= 0",
        "q_facts_latest": "SELECT * FROM fact_versions",
        "q_mismatched_totals": """SELECT count(*) AS mismatched_totals FROM fact_orders
  WHERE total_amount IS NOT NULL AND abs(total_amount - quantity * unit_price) > 0.01""",
        "q_mismatched_totals_discounted": "SELECT count(*) AS mismatched_totals FROM fact_orders WHERE order_status = 'O'",
        "q_duplicate_active": """SELECT customer_id, count(*) AS active_rows FROM customer_versions WHERE is_current
  GROUP BY customer_id HAVING count(*) > 1""",
        "q_duplicate_active_appended": """SELECT customer_id, count(*) AS active_rows FROM appended WHERE is_current
  GROUP BY customer_id HAVING count(*) > 1""",
        "q_table_columns": " UNION ALL ".join(
            f"""SELECT {i + 1} AS ordinal_position, '{f.name}' AS column_name, '{type_name(f.dataType)}' AS data_type,
  count("{f.name}") AS filled_rows FROM dim_customer"""
            for i, f in enumerate(star_schema("dim_customer", WIDE_ID).fields)
        ),
        "q_source_counts": _counts({"customers": "customer", "products": "part", "orders": "orders", "order_items": "lineitem"}),
        "q_order_totals": """SELECT o.id, o.customer_id, o.order_date, o.status, coalesce(s.total, o.total)::DECIMAL(12,2) AS total
  FROM orders_feed o LEFT JOIN (SELECT order_id, sum(quantity * unit_price)::DECIMAL(12,2) AS total FROM items_feed GROUP BY order_id) s
  ON o.id = s.order_id""",
        # synthetic feed
        "gen_customers": _gen_customers(),
        "gen_products": GEN_PRODUCTS,
        "gen_orders": GEN_ORDERS,
        "gen_order_items": GEN_ITEMS,
        "reset_tables": _counts({"customers": "customer", "products": "part"}),
    }
    return {name: sql(body) for name, body in bodies.items()}
