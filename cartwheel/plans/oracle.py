"""Oracle SQL (DuckDB dialect) for every registered query.

The oracle does not go through JSON at all: it builds both fact tables
straight from ``orders``, ``lineitem`` and ``part`` with window functions,
so agreement with the Spark plans checks the flatten, coercion and de-dup
path as well as each query. Half-even rounding is ``round_even`` (Spark's
``bround``); ratios are DOUBLE.
"""

from __future__ import annotations

FACTS = """
WITH fact_orders AS (
    SELECT order_id, user_id, order_number, order_dow, order_hour_of_day,
           days_since_prior_order, eval_set
    FROM (
        SELECT o_orderkey AS order_id,
               o_custkey AS user_id,
               row_number() OVER w AS order_number,
               CAST(dayofweek(o_orderdate) AS BIGINT) AS order_dow,
               CAST(o_orderkey % 24 AS BIGINT) AS order_hour_of_day,
               CAST(date_diff('day', CAST(lag(o_orderdate) OVER w AS DATE),
                              CAST(o_orderdate AS DATE)) AS DOUBLE) AS days_since_prior_order,
               coalesce(CASE o_orderstatus WHEN 'F' THEN 'prior' WHEN 'O' THEN 'train'
                                           WHEN 'P' THEN 'test' END, '') AS eval_set
        FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
    ) o
    WHERE order_id IS NOT NULL AND user_id IS NOT NULL
),
lines AS (
    SELECT l_orderkey AS order_id,
           l_partkey AS product_id,
           coalesce(p_name, '') AS product_name,
           coalesce(p_type, '') AS aisle,
           coalesce(p_brand, '') AS department,
           CAST(l_linenumber AS BIGINT) AS add_to_cart_order,
           CAST(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS BIGINT) AS reordered
    FROM lineitem JOIN part ON l_partkey = p_partkey
),
fact_order_products AS (
    SELECT order_id, product_id, product_name, aisle, department, add_to_cart_order, reordered
    FROM (
        SELECT *, row_number() OVER (
                   PARTITION BY order_id, product_id, add_to_cart_order
                   ORDER BY coalesce(reordered, -1), product_name, aisle, department) AS rn
        FROM lines
    ) t
    WHERE rn = 1
)
"""

DAY_NAME = """CASE {c} WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday'
    WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday'
    WHEN 6 THEN 'Saturday' ELSE 'Unknown' END"""

SHARE = "round_even(CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE), 2)"

BASKETS = "(SELECT order_id, count(*) AS total_products FROM fact_order_products GROUP BY order_id)"

_BODIES = {
    "total_orders": "SELECT count(*) AS total_orders FROM fact_orders",
    "total_product_line_items":
        "SELECT count(*) AS total_product_line_items FROM fact_order_products",
    "product_reorder_rate": """
        SELECT round_even(CAST(count(*) FILTER (WHERE reordered = 1) AS DOUBLE) * 100.0
                          / CAST(count(*) AS DOUBLE), 2) AS product_reorder_rate
        FROM fact_order_products""",
    "average_basket_size": f"""
        SELECT round_even(avg(total_products), 2) AS average_basket_size FROM {BASKETS} b""",
    "orders_by_day_of_week": f"""
        SELECT {DAY_NAME.format(c='order_dow')} AS day_name, count(*) AS total_orders
        FROM fact_orders GROUP BY order_dow ORDER BY order_dow""",
    "orders_by_hour_of_day": """
        SELECT order_hour_of_day AS hour_of_day, count(*) AS total_orders
        FROM fact_orders GROUP BY order_hour_of_day ORDER BY order_hour_of_day""",
    "top_ordering_time_windows": f"""
        SELECT {DAY_NAME.format(c='order_dow')} AS day_name,
               CAST(order_hour_of_day AS VARCHAR) || ':00' AS hour_of_day,
               count(*) AS total_orders
        FROM fact_orders GROUP BY order_dow, order_hour_of_day
        ORDER BY total_orders DESC, order_dow, order_hour_of_day LIMIT 5""",
    "reorder_interval_distribution": f"""
        SELECT CASE
                 WHEN days_since_prior_order IS NULL THEN 'Unknown'
                 WHEN days_since_prior_order = 0 THEN 'Same Day'
                 WHEN days_since_prior_order BETWEEN 1 AND 7 THEN '1-7 Days'
                 WHEN days_since_prior_order BETWEEN 8 AND 14 THEN '8-14 Days'
                 WHEN days_since_prior_order BETWEEN 15 AND 21 THEN '15-21 Days'
                 WHEN days_since_prior_order > 21 THEN '>21 Days'
                 ELSE 'Unknown' END AS reorder_interval,
               count(*) AS total_orders,
               {SHARE} AS percentage
        FROM fact_orders GROUP BY 1 ORDER BY total_orders DESC, reorder_interval""",
    "product_reorder_status": f"""
        SELECT CASE WHEN reordered = 1 THEN 'Reordered' WHEN reordered = 0 THEN 'Not Reordered'
                    ELSE 'Unknown' END AS reorder_status,
               count(*) AS total_product_line_items,
               {SHARE} AS percentage
        FROM fact_order_products GROUP BY 1
        ORDER BY total_product_line_items DESC, reorder_status""",
    "basket_size_category": f"""
        SELECT CASE
                 WHEN total_products BETWEEN 1 AND 5 THEN 'Small Basket (1-5)'
                 WHEN total_products BETWEEN 6 AND 10 THEN 'Medium Basket (6-10)'
                 WHEN total_products BETWEEN 11 AND 20 THEN 'Large Basket (11-20)'
                 WHEN total_products > 20 THEN 'Very Large Basket (>20)'
                 ELSE 'Unknown' END AS basket_size_category,
               count(*) AS total_orders,
               {SHARE} AS percentage
        FROM {BASKETS} b GROUP BY 1 ORDER BY total_orders DESC, basket_size_category""",
    "largest_basket_orders": f"""
        SELECT o.order_id, o.user_id, o.order_number,
               {DAY_NAME.format(c='o.order_dow')} AS day_name,
               CAST(o.order_hour_of_day AS VARCHAR) || ':00' AS hour_of_day,
               count(p.product_id) AS total_products
        FROM fact_orders o LEFT JOIN fact_order_products p ON o.order_id = p.order_id
        GROUP BY o.order_id, o.user_id, o.order_number, o.order_dow, o.order_hour_of_day
        ORDER BY total_products DESC, o.order_id, o.user_id, o.order_number,
                 o.order_dow, o.order_hour_of_day
        LIMIT 10""",
    "top_purchased_products": """
        SELECT product_name, count(*) AS total_purchased
        FROM fact_order_products GROUP BY product_name
        ORDER BY total_purchased DESC, product_name LIMIT 10""",
    "products_by_department": """
        SELECT department, count(*) AS total_products
        FROM fact_order_products GROUP BY department
        ORDER BY total_products DESC, department""",
    "product_reorder_opportunity": """
        SELECT product_name, count(*) AS total_purchased,
               count(*) FILTER (WHERE reordered = 1) AS total_reordered,
               round_even(CAST(count(*) FILTER (WHERE reordered = 1) AS DOUBLE) * 100.0
                          / CAST(count(*) AS DOUBLE), 2) AS reorder_rate
        FROM fact_order_products GROUP BY product_name
        ORDER BY total_purchased DESC, product_name LIMIT 10""",
    "day_hour_matrix": f"""
        SELECT order_dow, {DAY_NAME.format(c='order_dow')} AS day_name,
               {", ".join(f"count(*) FILTER (WHERE order_hour_of_day = {h}) AS hour_{h}"
                          for h in range(24))},
               count(*) FILTER (WHERE order_hour_of_day IS NULL OR order_hour_of_day NOT BETWEEN 0 AND 23) AS hour_other
        FROM fact_orders GROUP BY order_dow ORDER BY order_dow""",
    "dq_order_duplicates": """
        SELECT count(*) AS total_rows, count(DISTINCT order_id) AS unique_orders,
               count(*) - count(DISTINCT order_id) AS duplicate_orders
        FROM fact_orders""",
    "dq_order_nulls": """
        SELECT count(*) FILTER (WHERE order_id IS NULL) AS null_order_id,
               count(*) FILTER (WHERE user_id IS NULL) AS null_user_id,
               count(*) FILTER (WHERE order_number IS NULL) AS null_order_number,
               count(*) FILTER (WHERE order_dow IS NULL) AS null_order_dow,
               count(*) FILTER (WHERE order_hour_of_day IS NULL) AS null_order_hour
        FROM fact_orders""",
    "dq_order_ranges": """
        SELECT count(*) FILTER (WHERE order_dow < 0 OR order_dow > 6) AS invalid_order_dow,
               count(*) FILTER (WHERE order_hour_of_day < 0 OR order_hour_of_day > 23)
                   AS invalid_order_hour,
               count(*) FILTER (WHERE order_number < 1) AS invalid_order_number,
               count(*) FILTER (WHERE days_since_prior_order < 0)
                   AS invalid_days_since_prior_order
        FROM fact_orders""",
    "dq_eval_set_distribution": """
        SELECT eval_set, count(*) AS total_orders FROM fact_orders
        GROUP BY eval_set ORDER BY total_orders DESC, eval_set""",
    "dq_product_rows": """
        SELECT count(*) AS total_product_rows,
               count(*) FILTER (WHERE order_id IS NULL) AS null_order_id,
               count(*) FILTER (WHERE product_name = '') AS empty_product_name,
               count(*) FILTER (WHERE add_to_cart_order < 1) AS invalid_add_to_cart_order
        FROM fact_order_products""",
    "dq_average_basket": f"""
        SELECT round_even(avg(total_products), 2) AS avg_products_per_order FROM {BASKETS} b""",
    "dq_orphan_products": """
        SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_product_rows,
               count(*) AS orphan_orders
        FROM (SELECT order_id, count(*) AS n FROM fact_order_products GROUP BY order_id) p
        WHERE NOT EXISTS (SELECT 1 FROM fact_orders o WHERE o.order_id = p.order_id)""",
    "dq_product_line_consistency": """
        SELECT count(*) AS orders_checked,
               count(*) FILTER (WHERE max_cart IS NULL OR n <> max_cart) AS inconsistent_orders
        FROM (SELECT order_id, count(*) AS n, max(add_to_cart_order) AS max_cart
              FROM fact_order_products GROUP BY order_id) t""",
    "validate_load": """
        SELECT (SELECT count(*) FROM fact_orders) AS orders_count,
               (SELECT count(*) FROM fact_order_products) AS products_count,
               (SELECT count(*) - count(DISTINCT order_id) FROM fact_orders) AS duplicate_orders,
               (SELECT count(*) FILTER (WHERE order_dow < 0 OR order_dow > 6) FROM fact_orders)
                   AS invalid_order_dow,
               (SELECT count(*) FILTER (WHERE order_hour_of_day < 0 OR order_hour_of_day > 23)
                FROM fact_orders) AS invalid_order_hour""",
    # Every order of the tables is one raw row; the products lists built from
    # the tables always parse and the typed order columns always coerce.
    "dq_raw_orders": """
        SELECT count(*) AS raw_rows, CAST(0 AS BIGINT) AS unparsed_product_cells,
               CAST(0 AS BIGINT) AS coercion_failures
        FROM orders""",
    "fact_orders": "SELECT * FROM fact_orders",
    "fact_order_products": "SELECT * FROM fact_order_products",
    "landed_fact_orders": "SELECT * FROM fact_orders",
    "landed_fact_order_products": "SELECT * FROM fact_order_products",
}

ORACLE_SQL: dict[str, str] = {name: FACTS + body for name, body in _BODIES.items()}

# The facts of the dirty deliveries (``fixtures.delivered_raw_orders``), by the same rules.
DIRTY_FACTS = (FACTS.replace("WITH fact_orders AS", "WITH clean_orders AS")
               .replace("fact_order_products AS (", "clean_products AS (") + """,
deliveries(day) AS (VALUES (1), (2)),
fact_orders AS (
    SELECT order_id, user_id,
           CASE WHEN order_id % 37 = 0 THEN NULL WHEN order_id % 23 = 0 THEN 0 ELSE order_number END AS order_number,
           CASE WHEN order_id % 17 = 0 THEN NULL WHEN order_id % 7 = 0 THEN 9 ELSE order_dow END AS order_dow,
           CASE WHEN order_id % 19 = 0 THEN 24 ELSE order_hour_of_day END AS order_hour_of_day,
           CASE WHEN order_id % 53 = 0 THEN NULL WHEN order_id % 29 = 0 THEN CAST(-1 AS DOUBLE)
                ELSE days_since_prior_order END AS days_since_prior_order,
           eval_set
    FROM clean_orders, deliveries
    WHERE (day = 1 OR order_id % 11 = 0) AND order_id % 31 <> 0
),
fact_order_products AS (
    SELECT order_id, product_id, CASE WHEN order_id % 47 = 0 THEN '' ELSE product_name END AS product_name,
           aisle, department,
           CASE WHEN order_id % 47 <> 0 AND order_id % 43 = 0 AND add_to_cart_order = 1 THEN 0
                ELSE add_to_cart_order END AS add_to_cart_order,
           reordered
    FROM clean_products, deliveries
    WHERE (day = 1 OR order_id % 11 = 0) AND (order_id % 41 <> 0 OR order_id % 43 = 0 OR order_id % 47 = 0)
)
""")

for _name in ("dq_order_duplicates", "dq_order_nulls", "dq_order_ranges", "dq_product_rows", "dq_orphan_products",
              "dq_product_line_consistency", "validate_load", "reorder_interval_distribution", "fact_orders",
              "fact_order_products"):
    ORACLE_SQL[f"dirty_{_name}"] = DIRTY_FACTS + _BODIES[_name]
ORACLE_SQL["dirty_dq_raw_orders"] = """
    SELECT CAST(sum(n) AS BIGINT) AS raw_rows,
           CAST(sum(n) FILTER (WHERE k % 41 = 0 AND k % 43 <> 0 AND k % 47 <> 0) AS BIGINT) AS unparsed_product_cells,
           CAST(sum(n * (CAST(k % 17 = 0 AS INTEGER) + CAST(k % 53 = 0 AS INTEGER))) AS BIGINT) AS coercion_failures
    FROM (SELECT o_orderkey AS k, 1 + CAST(o_orderkey % 13 = 0 AS INTEGER) + CAST(o_orderkey % 11 = 0 AS INTEGER) AS n
          FROM orders) o"""
ORACLE_SQL["dirty_rejected_values"] = """
    WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey % 13 = 0 AS INTEGER) AS again,
                      1 + CAST(o_orderkey % 13 = 0 AS INTEGER) + CAST(o_orderkey % 11 = 0 AS INTEGER) AS n FROM orders),
    r AS (SELECT 'order' AS entity, 'order_dow' AS column_name, 'not a number' AS reason, n FROM o WHERE k % 17 = 0
          UNION ALL SELECT 'order', 'days_since_prior_order', 'not a number', n FROM o WHERE k % 53 = 0
          UNION ALL SELECT 'order', 'user_id', 'missing key', n - again FROM o WHERE k % 31 = 0
          UNION ALL SELECT 'products', 'products', 'not a list', n FROM o WHERE k % 41 = 0 AND k % 43 <> 0 AND k % 47 <> 0)
    SELECT entity, column_name, reason, CAST(sum(n) AS BIGINT) AS rejected FROM r GROUP BY ALL"""
ORACLE_SQL["mixed_fact_orders"] = FACTS + _BODIES["fact_orders"]
ORACLE_SQL["mixed_fact_order_products"] = FACTS + "SELECT * FROM fact_order_products WHERE order_id % 3 <> 2"
