"""DuckDB SQL with the result every registered query must have."""

from __future__ import annotations

# The Bronze tables of FIXTURES.md, section 3, then Silver and Gold.
TABLES = """
WITH o AS (
  SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_custkey AS INTEGER) AS user_id,
         CAST(row_number() OVER w AS INTEGER) AS order_number,
         count(*) OVER (PARTITION BY o_custkey) AS n_orders,
         CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
         CAST(o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
         CAST(date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS DOUBLE)
           AS days_since_prior_order
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
), orders_true AS (
  SELECT order_id, user_id,
         CASE WHEN order_number < n_orders THEN 'prior'
              WHEN user_id % 3 = 0 THEN 'test' ELSE 'train' END AS eval_set,
         order_number, order_dow, order_hour_of_day, days_since_prior_order
  FROM o
), bronze_orders AS (
  SELECT * FROM orders_true
  UNION ALL SELECT * FROM orders_true WHERE order_id % 10 = 0
), lines_raw AS (
  SELECT CAST(l_orderkey AS INTEGER) AS order_id, CAST(l_partkey // 20 AS INTEGER) AS product_id,
         CAST(l_linenumber AS INTEGER) AS add_to_cart_order
  FROM lineitem
), lines_flag AS (
  SELECT l.*, t.eval_set,
         t.order_number > min(t.order_number) OVER (PARTITION BY t.user_id, l.product_id) AS re
  FROM lines_raw l JOIN orders_true t USING (order_id)
), bronze_lines_all AS (
  SELECT order_id, product_id, add_to_cart_order, eval_set,
         CASE WHEN order_id % 7 = 0 THEN CASE WHEN re THEN 'true' ELSE 'false' END
              ELSE CASE WHEN re THEN '1' ELSE '0' END END AS reordered
  FROM lines_flag
), bronze_lines AS (
  SELECT order_id, product_id, add_to_cart_order, reordered
  FROM bronze_lines_all WHERE eval_set = 'prior'
), bronze_train AS (
  SELECT order_id, product_id, add_to_cart_order, reordered
  FROM bronze_lines_all WHERE eval_set = 'train'
), bronze_products AS (
  SELECT CAST(p_partkey // 20 AS INTEGER) AS product_id,
         p_name || ' ' || p_partkey AS product_name,
         CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS aisle_id,
         CAST(ascii(p_type) * 100 + length(p_type) AS INTEGER) AS department_id
  FROM part
), bronze_aisles AS (
  SELECT CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS aisle_id, p_brand AS aisle
  FROM part WHERE p_brand <> 'Brand#13' OR {complete}
), bronze_departments AS (
  SELECT CAST(ascii(p_type) * 100 + length(p_type) AS INTEGER) AS department_id,
         p_type AS department
  FROM part
), bronze_catalog_events AS (
  SELECT CASE WHEN p_partkey % 17 = 0 THEN '{bad ' || p_partkey
              ELSE '{"type":"' || kind || '","product_id":"' || p_partkey || '"}' END AS body,
         CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE kind END AS type
  FROM (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'store'
                               WHEN p_partkey % 4 = 0 THEN 'aisle'
                               WHEN p_partkey % 4 = 1 THEN 'department'
                               ELSE 'product' END AS kind FROM part) k
), catalog_parsed AS (
  SELECT body, type,
         CASE WHEN type IS NULL THEN 'invalid_json'
              WHEN type = 'store' THEN 'invalid_type' END AS reason,
         CASE WHEN type IS NULL OR type = 'store' THEN 'failed' ELSE 'ok' END AS status,
         2024 AS year, 1 AS month, 15 AS day
  FROM bronze_catalog_events
), stream AS (
  SELECT CASE WHEN event_id % 50 = 0 THEN 'bad'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_time,
         CAST(event_id AS INTEGER) AS order_id, CAST(user_id AS INTEGER) AS user_id,
         CASE WHEN k % 10 = 0 THEN CAST([] AS INTEGER[]) ELSE [k, (k + 7) % 100] END AS product_ids
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k
        FROM events WHERE event_type = 'purchase') e
  CROSS JOIN (SELECT unnest([1, 2]) AS copy) c
  WHERE copy = 1 OR event_id % 4 = 0
), silver_orders AS (
  SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day,
         coalesce(days_since_prior_order, 0.0) AS days_since_prior_order,
         user_id % 100 AS user_id_bucket
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY user_id, order_number) AS rn
        FROM bronze_orders) WHERE rn = 1
), silver_lines AS (
  SELECT order_id, product_id, add_to_cart_order, CAST(reordered AS BOOLEAN) AS reordered,
         order_id % 100 AS order_id_bucket
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, product_id
                                     ORDER BY add_to_cart_order, reordered) AS rn
        FROM bronze_lines) WHERE rn = 1
), silver_train AS (
  SELECT order_id, product_id, add_to_cart_order, CAST(reordered AS BOOLEAN) AS reordered,
         order_id % 100 AS order_id_bucket
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, product_id
                                     ORDER BY add_to_cart_order, reordered) AS rn
        FROM bronze_train) WHERE rn = 1
), silver_products AS (
  SELECT p.product_id, p.product_name, p.aisle_id, a.aisle_name, p.department_id,
         d.department_name
  FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                                     ORDER BY product_name, aisle_id, department_id) AS rn
        FROM bronze_products) p
  LEFT JOIN (SELECT aisle_id, min(aisle) AS aisle_name FROM bronze_aisles GROUP BY 1) a
    ON a.aisle_id = p.aisle_id
  LEFT JOIN (SELECT department_id, min(department) AS department_name
             FROM bronze_departments GROUP BY 1) d ON d.department_id = p.department_id
  WHERE p.rn = 1
), timeline AS (
  SELECT order_id, user_id, eval_set, order_number,
         sum(days_since_prior_order) OVER (PARTITION BY user_id ORDER BY order_number) AS cum_days
  FROM silver_orders
), totals AS (
  SELECT user_id, max(cum_days) AS last_day,
         count(*) FILTER (eval_set = 'prior') AS user_total_orders
  FROM timeline GROUP BY 1
), pairs AS (
  SELECT user_id, product_id, count(*) AS order_count,
         round(avg(CAST(reordered AS INTEGER)), 6) AS reorder_rate,
         round(avg(add_to_cart_order), 6) AS avg_cart_position, max(cum_days) AS pair_day
  FROM silver_lines JOIN timeline USING (order_id) WHERE eval_set = 'prior' GROUP BY 1, 2
), stats AS (
  SELECT p.user_id, product_id, order_count, reorder_rate, avg_cart_position,
         u.last_day - pair_day AS days_since_last_order, u.user_total_orders
  FROM pairs p JOIN totals u USING (user_id)
), popularity AS (
  SELECT product_id, CAST(sum(order_count) AS BIGINT) AS product_popularity
  FROM pairs GROUP BY 1
), features AS (
  SELECT p.user_id, p.product_id, order_count, reorder_rate, avg_cart_position,
         days_since_last_order, user_total_orders, product_popularity,
         s.aisle_name, s.department_name, p.user_id % 100 AS user_id_bucket
  FROM stats p JOIN popularity USING (product_id) LEFT JOIN silver_products s USING (product_id)
), labelled AS (
  SELECT s.*, CASE WHEN b.user_id IS NULL THEN 0 ELSE 1 END AS label,
         s.user_id % 5 = 0 AS is_validation
  FROM stats s
  LEFT JOIN (SELECT DISTINCT user_id, product_id
             FROM silver_train JOIN silver_orders USING (order_id) WHERE eval_set = 'train') b
    ON b.user_id = s.user_id AND b.product_id = s.product_id
  WHERE s.user_id IN (SELECT user_id FROM silver_orders WHERE eval_set = 'train')
)
"""


# Queries about products whose aisle never arrived.
WITHOUT_AN_AISLE = ("contract_violations_products", "dq_orphan_lines")


def over_tables(select: str, complete: bool) -> str:
    return TABLES.replace("{complete}", str(complete).upper()) + select


def rule_table(table: str, rules: list[tuple[str, str, str, str]]) -> str:
    """One row per (field, rule, expected) with the rows that meet the condition."""
    parts = [
        f"SELECT '{field}' AS field, '{rule}' AS rule, '{expected}' AS expected, "
        f"count(*) FILTER ({broken}) AS violations FROM {table}"
        for field, rule, expected, broken in rules
    ]
    return " UNION ALL ".join(parts)


def not_null_rules(*fields: str) -> list[tuple[str, str, str, str]]:
    return [(f, "not_null", "NOT NULL", f"{f} IS NULL") for f in fields]


def counted(table: str, rules: dict[str, str]) -> str:
    parts = [
        f"SELECT '{name}' AS rule, count(*) FILTER ({broken}) AS violations FROM {table}"
        for name, broken in rules.items()
    ]
    return " UNION ALL ".join(parts)


ORDER_COLUMNS = (
    "order_id",
    "user_id",
    "eval_set",
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "days_since_prior_order",
)
SILVER_ORDERS = "SELECT * FROM silver_orders"
SILVER_LINES = "SELECT * FROM silver_lines"
SILVER_PRODUCTS = "SELECT * FROM silver_products"

STREAM_ROWS = """
    SELECT order_id, user_id, CAST(coalesce(pos, 0) AS INTEGER) AS position,
           CAST(CASE WHEN pos IS NULL THEN -1 ELSE product_ids[pos] END AS INTEGER) AS product_id,
           'stream' AS source, event_time[1:10] AS event_date
    FROM (SELECT DISTINCT * FROM stream WHERE event_time <> 'bad') s
    LEFT JOIN (SELECT unnest([1, 2]) AS pos) c ON pos <= len(product_ids)"""

ORDER_RULES = [
    ("eval_set", "allowed_values", "train,test,prior",
     "eval_set NOT IN ('train', 'test', 'prior')"),
    ("order_number", "min_value", "1", "order_number < 1"),
    ("order_dow", "min_value", "0", "order_dow < 0"),
    ("order_dow", "max_value", "6", "order_dow > 6"),
    ("order_hour_of_day", "min_value", "0", "order_hour_of_day < 0"),
    ("order_hour_of_day", "max_value", "23", "order_hour_of_day > 23"),
    ("days_since_prior_order", "min_value", "0", "days_since_prior_order < 0"),
    *not_null_rules(*ORDER_COLUMNS),
]
LINE_RULES = [
    ("add_to_cart_order", "min_value", "1", "add_to_cart_order < 1"),
    *not_null_rules("order_id", "product_id", "add_to_cart_order", "reordered"),
]
DIRTY_ORDERS = """(SELECT * REPLACE (
    CASE WHEN order_id % 19 = 0 THEN 'odd' ELSE eval_set END AS eval_set,
    CASE WHEN order_id % 17 = 0 THEN 0 ELSE order_number END AS order_number,
    CASE WHEN order_id % 11 = 0 THEN 7 WHEN order_id % 29 = 0 THEN -1 ELSE order_dow END AS order_dow,
    CASE WHEN order_id % 13 = 0 THEN 24 WHEN order_id % 31 = 0 THEN -1
         ELSE order_hour_of_day END AS order_hour_of_day,
    CASE WHEN order_id % 7 = 0 THEN NULL WHEN order_id % 23 = 0 THEN -1
         ELSE days_since_prior_order END AS days_since_prior_order,
    CASE WHEN order_id % 37 = 0 THEN NULL ELSE user_id END AS user_id) FROM silver_orders)"""
DIRTY_LINES = """(SELECT * REPLACE (
    CASE WHEN order_id % 5 = 0 THEN 0 ELSE add_to_cart_order END AS add_to_cart_order,
    CASE WHEN order_id % 9 = 0 THEN NULL ELSE reordered END AS reordered) FROM silver_lines)"""
PRODUCT_RULES = not_null_rules(
    "product_id", "product_name", "aisle_id", "aisle_name", "department_id", "department_name"
)

AUC = """
        SELECT CAST(sum(label) AS BIGINT) AS positives,
               CAST(sum(1 - label) AS BIGINT) AS negatives,
               round((sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2)
                     / (sum(label) * sum(1 - label)), 6) AS auc
        FROM (SELECT label, rank() OVER (ORDER BY {score})
                     + (count(*) OVER (PARTITION BY {score}) - 1) / 2 AS r FROM labelled)"""

NAMED_PAIRS = """(SELECT l.user_id, l.product_id, l.label, (l.user_id // 5) % 4 AS fold, p.aisle_name, p.department_name
           FROM labelled l LEFT JOIN silver_products p USING (product_id) WHERE NOT l.is_validation)"""
NAME_COUNTS = f"""(SELECT * FROM (
        SELECT NULL AS feature, NULL AS name, fold, label FROM {NAMED_PAIRS}
        UNION ALL SELECT 'aisle_name', aisle_name, fold, label FROM {NAMED_PAIRS} WHERE aisle_name IS NOT NULL
        UNION ALL SELECT 'department_name', department_name, fold, label
        FROM {NAMED_PAIRS} WHERE department_name IS NOT NULL))"""
# Counts of all pairs of a name, and of those outside each fold that has the name.
RATES = f"""(SELECT r.feature, r.name, r.fold,
           CASE WHEN r.feature IS NULL THEN coalesce(r.s / nullif(r.n, 0), 0)
                ELSE (r.s + 20 * coalesce(o.s / nullif(o.n, 0), 0)) / (r.n + 20) END AS rate
    FROM (SELECT a.feature, a.name, f.fold, count(*) FILTER (f.fold IS NULL OR a.fold <> f.fold) AS n,
                 coalesce(sum(a.label) FILTER (f.fold IS NULL OR a.fold <> f.fold), 0) AS s
          FROM {NAME_COUNTS} a JOIN (SELECT DISTINCT feature, name, fold FROM {NAME_COUNTS}
                                     UNION SELECT feature, name, NULL FROM {NAME_COUNTS}) f
            ON a.feature IS NOT DISTINCT FROM f.feature AND a.name IS NOT DISTINCT FROM f.name
          GROUP BY 1, 2, 3) r
    LEFT JOIN (SELECT f.fold, count(*) FILTER (f.fold IS NULL OR a.fold <> f.fold) AS n,
                      coalesce(sum(a.label) FILTER (f.fold IS NULL OR a.fold <> f.fold), 0) AS s
               FROM {NAMED_PAIRS} a CROSS JOIN (SELECT unnest([NULL, 0, 1, 2, 3]) AS fold) f GROUP BY 1) o
      ON r.fold IS NOT DISTINCT FROM o.fold)"""

SELECTS = {
    "dq_rules_on_dirty_orders": f"""
        SELECT unnest(['no user', 'dow', 'hour', 'order_number', 'days', 'days, NULL passes', 'eval_set',
                       'eval_set length']) AS rule,
               unnest([count(*) FILTER (user_id IS NULL),
                       count(*) FILTER (order_dow NOT BETWEEN 0 AND 6),
                       count(*) FILTER (order_hour_of_day NOT BETWEEN 0 AND 23),
                       count(*) FILTER (order_number < 1),
                       count(*) FILTER (days_since_prior_order IS NULL OR days_since_prior_order NOT BETWEEN 0 AND 30),
                       count(*) FILTER (days_since_prior_order < 0),
                       count(*) FILTER (eval_set NOT IN ('prior', 'train', 'test')),
                       count(*) FILTER (length(eval_set) > 4)]) AS violations
        FROM {DIRTY_ORDERS}""",
    "column_sets": """
        SELECT 'orders' AS table_name, (SELECT count(*) FROM silver_orders) AS n, true AS exactly, true AS at_least
        UNION ALL SELECT 'orders with one more', count(*), false, true FROM silver_orders
        UNION ALL SELECT 'orders without one', count(*), false, false FROM silver_orders
        UNION ALL SELECT 'order_products', count(*), true, true FROM silver_lines
        UNION ALL SELECT 'products', count(*), true, true FROM silver_products""",
    "rows_read_and_written": """
        SELECT 'orders' AS table_name, 0 AS source, (SELECT count(*) FROM bronze_orders) AS rows_read,
               (SELECT count(*) FROM silver_orders) AS rows_written
        UNION ALL SELECT 'order_products', 0, (SELECT count(*) FROM bronze_lines), (SELECT count(*) FROM silver_lines)
        UNION ALL SELECT 'products', source, n, (SELECT count(*) FROM silver_products)
        FROM (SELECT 0 AS source, count(*) AS n FROM bronze_products
              UNION ALL SELECT 1, count(*) FROM bronze_aisles
              UNION ALL SELECT 2, count(*) FROM bronze_departments)""",
    "landed_load_times": """
        SELECT 'orders' AS table_name, '2024-01-15 10:30:00' AS load_time, count(*) AS n FROM bronze_orders
        UNION ALL SELECT 'order_products', '2024-01-15 10:30:00', count(*) FROM bronze_lines""",
    "name_rates_by_fold": f"""
        SELECT feature, name, CAST(fold AS INTEGER) AS fold, round(CAST(rate AS DOUBLE), 9) AS rate FROM {RATES}""",
    "training_pairs_with_rates": f"""
        SELECT p.user_id, p.product_id, p.label,
               round(coalesce(a.rate, o.rate), 9) AS aisle_name_rate,
               round(coalesce(d.rate, o.rate), 9) AS department_name_rate
        FROM {NAMED_PAIRS} p
        LEFT JOIN {RATES} a ON a.feature = 'aisle_name' AND a.name = p.aisle_name AND a.fold = p.fold
        LEFT JOIN {RATES} d ON d.feature = 'department_name' AND d.name = p.department_name AND d.fold = p.fold
        LEFT JOIN {RATES} o ON o.feature IS NULL AND o.fold = p.fold""",
    "model_quality": """
        SELECT CAST(sum(label) AS BIGINT) AS positives, CAST(sum(1 - label) AS BIGINT) AS negatives,
               true AS beats_single_features, true AS finds_reorders
        FROM labelled WHERE NOT is_validation""",
    "department_reorder_rate": """
        SELECT department_name, count(*) AS lines,
               count(*) FILTER (reordered) AS reordered_lines,
               round(count(*) FILTER (reordered) / count(*), 6) AS reorder_rate
        FROM silver_lines JOIN silver_orders USING (order_id)
        LEFT JOIN silver_products USING (product_id)
        WHERE eval_set = 'prior' GROUP BY 1""",
    "orders_clean": SILVER_ORDERS,
    "order_products_clean": SILVER_LINES,
    "products_wide": SILVER_PRODUCTS,
    "train_labels_clean": "SELECT * FROM silver_train",
    "products_distinct": "SELECT DISTINCT * FROM silver_products",
    "eval_set_split": """
        SELECT eval_set, count(*) AS orders, sum(days_since_prior_order) AS days
        FROM silver_orders GROUP BY 1""",
    "orders_roundtrip": SILVER_ORDERS,
    "lines_roundtrip": SILVER_LINES,
    "catalog_json_scan": SILVER_PRODUCTS,
    "orders_per_bucket": """
        SELECT user_id_bucket, count(*) AS orders, max(order_number) AS last_order_number
        FROM silver_orders GROUP BY 1""",
    "optional_source_missing": """
        SELECT 'there' AS table_name, count(*) AS n FROM bronze_train
        UNION ALL SELECT 'gone', CAST(0 AS BIGINT)""",
    "landing_reconciliation": """
        SELECT table_name, n AS source_rows, n AS landed_rows, CAST(0 AS BIGINT) AS diff
        FROM (SELECT 'orders' AS table_name, count(*) AS n FROM bronze_orders
              UNION ALL SELECT 'order_products', count(*) FROM bronze_lines)""",
    "seed_load_skip_force": """
        SELECT 1 AS step, TRUE AS loaded, count(*) AS n FROM bronze_orders
        UNION ALL SELECT 2, FALSE, count(*) FROM bronze_orders
        UNION ALL SELECT 3, TRUE, count(*) FROM silver_orders""",
    "medallion_features": "SELECT * FROM features",
    "contract_violations_orders": """
        SELECT 'user_id_bucket' AS field, 'present' AS rule, 'integer' AS expected,
               CAST(1 AS BIGINT) AS violations UNION ALL """
    + rule_table("bronze_orders", ORDER_RULES),
    "lines_without_keys_set_aside": """
        SELECT CASE WHEN n % 10 = 0 AND n % 14 = 0 THEN 'order_id is no id, product_id is no id'
                    WHEN n % 10 = 0 THEN 'order_id is no id'
                    WHEN n % 14 = 0 THEN 'product_id is no id' ELSE 'ok' END AS reason, count(*) AS n
        FROM (SELECT CAST(product_id AS BIGINT) * 31 + CAST(order_id AS BIGINT) AS n FROM bronze_lines)
        GROUP BY 1""",
    "contract_violations_dirty_orders": """
        SELECT 'user_id_bucket' AS field, 'present' AS rule, 'integer' AS expected,
               CAST(1 AS BIGINT) AS violations UNION ALL """
    + rule_table(DIRTY_ORDERS, ORDER_RULES),
    "contract_violations_dirty_lines": """
        SELECT 'order_id_bucket' AS field, 'present' AS rule, 'integer' AS expected,
               CAST(1 AS BIGINT) AS violations UNION ALL """
    + rule_table(DIRTY_LINES, LINE_RULES),
    "contract_violations_lines": """
        SELECT 'reordered' AS field, 'type' AS rule, 'integer' AS expected,
               CAST(1 AS BIGINT) AS violations UNION ALL """
    + rule_table("bronze_lines", LINE_RULES),
    "contract_violations_products": "SELECT * FROM ("
    + rule_table("silver_products", PRODUCT_RULES)
    + ") WHERE violations > 0",
    "contract_schema": " UNION ALL ".join(
        f"SELECT '{c}' AS field, '{kind}' AS declared, '{kind}' AS actual, "
        f"count({c}) AS filled_rows FROM silver_orders"
        for c, kind in zip(
            (*ORDER_COLUMNS, "user_id_bucket"),
            ("int", "int", "string", "int", "int", "int", "double", "int"),
        )
    ),
    "contract_declared_rules": """
        SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day,
               coalesce(days_since_prior_order, 0.0) AS days_since_prior_order,
               user_id % 100 AS user_id_bucket
        FROM bronze_orders""",
    "contract_default_values": """
        SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day,
               coalesce(days_since_prior_order, 0.0) AS days_since_prior_order
        FROM bronze_orders""",
    "dq_null_ids": counted(
        "bronze_orders",
        {c: f"{c} IS NULL" for c in ORDER_COLUMNS} | {"eval_set length": "length(eval_set) > 10"},
    ),
    "dq_duplicate_ids": """
        SELECT order_id, count(*) AS n FROM bronze_orders GROUP BY 1 HAVING count(*) > 1""",
    "dq_duplicate_composite_key": """
        SELECT order_id, product_id, count(*) AS n FROM bronze_lines
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_orphan_lines": """
        SELECT 'order_id' AS fk, order_id AS key, count(*) AS n FROM silver_train
        WHERE order_id NOT IN (SELECT order_id FROM silver_orders WHERE eval_set = 'prior')
        GROUP BY 2
        UNION ALL
        SELECT 'aisle_id', aisle_id, count(*) FROM bronze_products
        WHERE aisle_id NOT IN (SELECT aisle_id FROM bronze_aisles) GROUP BY 2""",
    "dq_range_rules": counted(
        "bronze_orders",
        {
            "dow": "order_dow NOT BETWEEN 0 AND 6 OR order_dow IS NULL",
            "hour": "order_hour_of_day NOT BETWEEN 0 AND 23 OR order_hour_of_day IS NULL",
            "order_number": "order_number < 1 OR order_number IS NULL",
            "days": "days_since_prior_order NOT BETWEEN 0 AND 30 "
            "OR days_since_prior_order IS NULL",
            "days, NULL passes": "days_since_prior_order NOT BETWEEN 0 AND 30",
        },
    ),
    "dq_allowed_values": counted(
        "bronze_orders", {"eval_set": "eval_set NOT IN ('prior', 'train', 'test')"}
    )
    + " UNION ALL "
    + counted("bronze_lines", {"reordered": "reordered NOT IN ('0', '1')"}),
    "rows_split_valid_rejected": """
        SELECT order_id, user_id,
               CASE WHEN days_since_prior_order IS NULL
                    THEN 'days_since_prior_order:not_null' ELSE 'ok' END AS reason
        FROM bronze_orders""",
    "drop_null_keys": """
        SELECT order_id, order_number,
               CASE WHEN days_since_prior_order IS NULL
                    THEN 'days_since_prior_order is NULL' ELSE 'ok' END AS reason
        FROM bronze_orders""",
    "catalog_events_routed": "SELECT * FROM catalog_parsed",
    "catalog_event_counts": """
        SELECT type, status, count(*) AS n FROM catalog_parsed GROUP BY 1, 2""",
    "catalog_events_landed": """
        SELECT body, type, year, month, day FROM catalog_parsed WHERE status = 'ok'""",
    "stream_events_silver": STREAM_ROWS,
    "stream_late_events": STREAM_ROWS,
    "stream_differing_copies": """
        SELECT cut, order_id, user_id, CAST(pos AS INTEGER) AS position,
               CAST(CASE WHEN pos = 1 THEN k ELSE k + days END AS INTEGER) AS product_id,
               strftime(ts - to_days(days), '%Y-%m-%d %H:%M:%S') AS event_second
        FROM (SELECT CAST(event_id AS INTEGER) AS order_id, CAST(user_id + u AS INTEGER) AS user_id, days, ts,
                     CAST(json_extract(props, '$.k') AS INTEGER) AS k,
                     row_number() OVER (PARTITION BY event_id
                                        ORDER BY date_trunc('second', ts - to_days(days)), user_id + u) AS rn
              FROM events CROSS JOIN (VALUES (0, 0), (1, 1), (0, -1)) c(days, u)
              WHERE event_type = 'purchase'
                AND (u = 0 OR (u = 1 AND event_id % 3 = 0) OR (u = -1 AND event_id % 5 = 0))) e
        CROSS JOIN (SELECT unnest([1, 2]) AS pos) p
        CROSS JOIN (SELECT unnest(['at once', 'two runs', 'file by file']) AS cut) d
        WHERE rn = 1""",
    "stream_bad_rows": """
        SELECT event_time, order_id, user_id, 'unreadable event_time' AS reason
        FROM stream WHERE event_time = 'bad'""",
    "user_order_timeline": """
        SELECT user_id, order_number, cum_days, last_day, user_total_orders
        FROM timeline JOIN totals USING (user_id)""",
    "user_product_stats": "SELECT * FROM stats",
    "user_totals": """
        SELECT user_id, count(*) AS user_total_orders
        FROM silver_orders WHERE eval_set = 'prior' GROUP BY 1""",
    "product_popularity": "SELECT * FROM popularity",
    "days_since_last_order": "SELECT user_id, product_id, days_since_last_order FROM stats",
    "user_product_features": "SELECT * FROM features",
    "training_set_labelled": """
        SELECT user_id, product_id, order_count, label, is_validation FROM labelled""",
    "topk_by_order_count": """
        SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rn) AS products,
               string_agg(CAST(order_count AS VARCHAR), ',' ORDER BY rn) AS counts
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                                           ORDER BY order_count DESC, product_id) AS rn FROM pairs)
        WHERE rn <= 10 GROUP BY 1""",
    "auc_by_reorder_rate": AUC.format(score="reorder_rate"),
    "auc_by_order_count": AUC.format(score="order_count"),
    "auc_by_close_scores": AUC.format(score="order_count"),
    "csv_of_two_headers": SILVER_ORDERS,
    "orders_incremental": SILVER_ORDERS,
    "model_scores_topk": """
        SELECT user_id, least(10, count(*)) AS products, true AS all_known, true AS sorted,
               true AS probabilities, true AS same_after_load
        FROM features WHERE user_id IN (SELECT user_id FROM silver_orders WHERE eval_set = 'test')
        GROUP BY 1""",
    "confusion_f1": """
        SELECT tp, fp, fn, tn, round(2 * tp / (2 * tp + fp + fn), 6) AS f1
        FROM (SELECT count(*) FILTER (reorder_rate >= 0.5 AND label = 1) AS tp,
                     count(*) FILTER (reorder_rate >= 0.5 AND label = 0) AS fp,
                     count(*) FILTER (reorder_rate < 0.5 AND label = 1) AS fn,
                     count(*) FILTER (reorder_rate < 0.5 AND label = 0) AS tn FROM labelled)""",
}

ORACLE_SQL = {
    name: over_tables(select, complete=name not in WITHOUT_AN_AISLE)
    for name, select in SELECTS.items()
}
