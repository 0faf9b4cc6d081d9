"""The registered queries as SQL over the sample tables, for comparison with another engine."""

from __future__ import annotations

from tillwright.registry import AGENTS_BEFORE, BRANCHES_BEFORE, REPORT_DAY, STORED_BEFORE

RAW = """
raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
         strftime(o_orderdate, '%Y-%m-%d') AS transaction_date,
         o_custkey AS customer_id,
         split_part(c_name, '#', 1) AS customer_fname,
         split_part(c_name, '#', 2) AS cusomter_lname,
         CASE o_custkey % 4 WHEN 1 THEN 'c' || o_custkey || '@mail.com'
                            WHEN 2 THEN 'c' || o_custkey || '@mail.com77'
                            WHEN 3 THEN 'c' || o_custkey || '@mail.org' END AS cusomter_email,
         l_suppkey AS sales_agent_id,
         CAST(s_nationkey AS BIGINT) AS branch_id,
         l_partkey AS product_id,
         p_name AS product_name,
         p_type AS product_category,
         CASE WHEN l_discount IN (0.01, 0.02, 0.1) THEN TRUE END AS offer_1,
         CASE WHEN l_discount IN (0.03, 0.04) THEN TRUE END AS offer_2,
         CASE WHEN l_discount IN (0.05, 0.06) THEN TRUE END AS offer_3,
         CASE WHEN l_discount IN (0.07, 0.08) THEN TRUE END AS offer_4,
         CASE WHEN l_discount IN (0.09, 0.1) THEN TRUE WHEN l_discount = 0 THEN FALSE END AS offer_5,
         CAST(l_quantity AS INTEGER) AS units,
         p_retailprice AS unit_price,
         CASE WHEN o_orderstatus = 'O' THEN 'yes' ELSE 'no' END AS is_online,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Cash' WHEN '2-HIGH' THEN 'Card' WHEN '3-MEDIUM' THEN 'PayPal'
                              WHEN '4-NOT SPECIFIED' THEN 'Transfer' WHEN '5-LOW' THEN 'Wallet' END AS payment_method,
         CASE WHEN o_orderstatus = 'O'
              THEN concat_ws('/', 'Street', n_name, r_name, CAST(10000 + o_custkey AS VARCHAR)) END AS shipping_address
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
)"""

SALES = RAW + """,
sales AS (
  SELECT transaction_id, TRY_CAST(transaction_date AS DATE) AS transaction_date,
         customer_id, customer_fname, cusomter_lname AS customer_lname,
         split_part(cusomter_email, '.com', 1) || '.com' AS customer_email,
         sales_agent_id, branch_id, product_id, product_name, product_category,
         offer_1, offer_2, offer_3, offer_4, offer_5, units, unit_price, is_online, payment_method, shipping_address,
         nullif(split_part(shipping_address, '/', 2), '') AS city,
         nullif(split_part(shipping_address, '/', 3), '') AS state
  FROM raw
)"""

FACT = SALES + """,
named AS (
  SELECT *, concat_ws(',', CASE WHEN offer_1 THEN 'offer_1' END, CASE WHEN offer_2 THEN 'offer_2' END,
                      CASE WHEN offer_3 THEN 'offer_3' END, CASE WHEN offer_4 THEN 'offer_4' END,
                      CASE WHEN offer_5 THEN 'offer_5' END) AS names
  FROM sales
),
priced AS (
  SELECT *, CASE names WHEN 'offer_1' THEN 5 WHEN 'offer_2' THEN 10 WHEN 'offer_3' THEN 15
                       WHEN 'offer_4' THEN 20 WHEN 'offer_5' THEN 25 ELSE 0 END AS pct
  FROM named
),
fact AS (
  SELECT transaction_id, strftime(transaction_date, '%Y%m%d') AS transaction_date_id,
         customer_id, sales_agent_id, branch_id, product_id,
         concat_ws('-', city, state) AS location_id,
         concat_ws('-', is_online, payment_method) AS payment_id,
         CASE WHEN pct <> 0 THEN pct || '-' || names END AS offer_id,
         units, unit_price,
         round(units * unit_price * (1 - CAST(pct AS DOUBLE) / 100), 3) AS total_price,
         strftime(transaction_date, '%Y') AS "year", strftime(transaction_date, '%m') AS "month",
         strftime(transaction_date, '%d') AS "day"
  FROM priced
)"""

_FLAGS = " UNION ALL ".join(
    f"SELECT transaction_id, 'offer_{n}' AS offer_name, offer_{n} AS offer_value FROM sales WHERE offer_{n} IS NOT NULL"
    for n in range(1, 6)
)

#: Bodies of the dimensions, over any frame with the columns of ``sales``.
DIMENSIONS = {
    "customer": "SELECT DISTINCT customer_id, customer_fname, customer_lname, customer_email FROM {src}",
    "product": "SELECT DISTINCT product_id, product_name, product_category FROM {src}",
    "location": "SELECT DISTINCT city || '-' || state AS location_id, city, state FROM {src} "
                "WHERE city IS NOT NULL AND state IS NOT NULL",
    "payment": "SELECT DISTINCT is_online || '-' || payment_method AS payment_id, is_online, payment_method FROM {src} "
               "WHERE is_online IS NOT NULL AND payment_method IS NOT NULL",
    "offer": " UNION ".join(
        f"SELECT '{5 * n}-offer_{n}' AS offer_id, 'offer_{n}' AS offer_name, {5 * n} AS percentage "
        f"FROM {{src}} WHERE offer_{n} IS NOT NULL"
        for n in range(1, 6)
    ),
}

BRANCHES = """
branches AS (
  SELECT CAST(n_nationkey AS BIGINT) AS branch_id, n_name AS location,
         TRY_CAST(CASE WHEN n_nationkey = 13 THEN '2001-13-45'
                       ELSE CAST(DATE '2000-01-01' + n_nationkey * 100 AS VARCHAR) END AS DATE) AS establish_date,
         r_name AS class
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
)"""

AGENTS = """
agents AS (
  SELECT s_suppkey AS sales_person_id, s_name AS name,
         DATE '2015-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS hire_date
  FROM supplier
)"""

EVENTS = """
parsed AS (
  SELECT CASE event_type WHEN 'view' THEN 'productView' WHEN 'signup' THEN 'addToCart' WHEN 'purchase' THEN 'purchase'
                         WHEN 'click' THEN 'recommendationClick' WHEN 'error' THEN 'error' END AS "eventType",
         CAST(user_id AS VARCHAR) AS "customerId",
         CASE WHEN event_type <> 'click' THEN json_extract_string(props, '$.k') END AS "productId",
         ts AS "timestamp",
         CASE WHEN event_type = 'view' THEN 'cat' || CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 END AS category,
         CASE WHEN event_type = 'view' THEN 'src' || event_id % 3 END AS source,
         CASE WHEN event_type IN ('signup', 'purchase') THEN CAST(1 + event_id % 5 AS INTEGER) END AS quantity,
         CASE WHEN event_type = 'purchase' THEN value END AS "totalAmount",
         CASE WHEN event_type = 'purchase' THEN 'pm' || event_id % 3 END AS "paymentMethod",
         CASE WHEN event_type = 'click' THEN json_extract_string(props, '$.k') END AS "recommendedProductId",
         CASE WHEN event_type = 'click' THEN 'alg' || CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 END AS algorithm
  FROM events
)"""

ROUTES = {
    "product_view": """SELECT "eventType", "customerId", "productId", "timestamp", category, source
                       FROM parsed WHERE "eventType" = 'productView'""",
    "add_to_cart": """SELECT "eventType", "customerId", "productId", "timestamp", quantity
                      FROM parsed WHERE "eventType" = 'addToCart'""",
    "purchase": """SELECT "eventType", "customerId", "productId", "timestamp", quantity, "totalAmount", "paymentMethod"
                   FROM parsed WHERE "eventType" = 'purchase'""",
    "recommendation_click": """SELECT "eventType", "customerId", "recommendedProductId", algorithm, "timestamp"
                               FROM parsed WHERE "eventType" = 'recommendationClick'""",
}


def _windows(minutes: int, key: str, where: str = "TRUE") -> str:
    return f"""
windows AS (
  SELECT time_bucket(INTERVAL {minutes} MINUTE, "timestamp") AS window_start,
         time_bucket(INTERVAL {minutes} MINUTE, "timestamp") + INTERVAL {minutes} MINUTE AS window_end,
         "{key}", count(*) AS "count"
  FROM parsed WHERE {where} GROUP BY ALL
)"""


def _with(*parts: str, body: str) -> str:
    return "WITH " + ",".join(part.strip() for part in parts) + "\n" + body.strip()


def _kpi(table: str, body: str) -> str:
    return _with(EVENTS, f"{table} AS ({ROUTES[table]})", body=body)


def _new(batch: str, stored: str, key: str, *ctes: str) -> str:
    return _with(
        *ctes, f"batch AS ({batch})", f"stored AS ({stored})",
        body=f"SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.{key} = b.{key}) AND b.{key} IS NOT NULL",
    )


def _new_since(dimension: str, key: str) -> str:
    body = DIMENSIONS[dimension]
    return _new(
        body.format(src="late"), body.format(src="early"), key, SALES,
        f"early AS (SELECT * FROM sales WHERE transaction_date < DATE '{STORED_BEFORE}')",
        f"late AS (SELECT * FROM sales WHERE transaction_date >= DATE '{STORED_BEFORE}')",
    )


def _loaded(name: str, where: str = "TRUE") -> str:
    """A dimension after two hours: the rows of the first, and of the second those with a new key."""
    body, key = DIMENSIONS[name], f"{name}_id"
    return _with(
        SALES,
        f"early AS (SELECT * FROM sales WHERE transaction_date < DATE '{STORED_BEFORE}')",
        f"late AS (SELECT * FROM sales WHERE transaction_date >= DATE '{STORED_BEFORE}')",
        f"stored AS (SELECT * FROM ({body.format(src='early')}) WHERE {key} IS NOT NULL AND {where})",
        f"batch AS (SELECT * FROM ({body.format(src='late')}) WHERE {key} IS NOT NULL AND {where})",
        body=f"SELECT * FROM stored UNION ALL SELECT * FROM batch WHERE {key} NOT IN (SELECT {key} FROM stored)",
    )


def _dimension(name: str) -> str:
    return DIMENSIONS[name].format(src="sales")


_PRODUCT_JOIN = "JOIN product_dim p ON f.product_id = p.product_id"
_PRODUCT_DIM = f"product_dim AS ({_dimension('product')})"

_DAILY = _with(
    FACT, _PRODUCT_DIM, AGENTS,
    body=f"""
SELECT a.name AS sales_agent_name, p.product_name, CAST(sum(f.units) AS BIGINT) AS total_units_sold
FROM fact f {_PRODUCT_JOIN} JOIN agents a ON a.sales_person_id = f.sales_agent_id
WHERE f."year" = '{REPORT_DAY:%Y}' AND f."month" = '{REPORT_DAY:%m}' AND f."day" = '{REPORT_DAY:%d}'
GROUP BY 1, 2""",
)

_EVENT_COUNTS = _with(EVENTS, _windows(10, "eventType"), body="SELECT * FROM windows")

_ROUTED = _with(EVENTS, body=ROUTES["product_view"])

_VIEWS_PER_CATEGORY = _kpi(
    "product_view", "SELECT category, count(*) AS views_per_category FROM product_view GROUP BY 1"
)

_DIMENSION_COUNTS = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS row_count, count(DISTINCT {key}) AS key_count FROM ({body})"
    for table, key, body in [
        ("branches_Dim", "branch_id", "SELECT * FROM branches"),
        ("sales_agents_Dim", "sales_person_id", "SELECT * FROM agents"),
        *[(f"{name}_Dim", f"{name}_id", _dimension(name)) for name in DIMENSIONS],
    ]
)

_AGENT_ROWS = _with(AGENTS, body="""SELECT sales_person_id, name, CAST(hire_date AS VARCHAR) AS hire_date{more}
                                    FROM agents{where}""")

_ALL_EVENTS = _with(EVENTS, body="""SELECT * FROM parsed WHERE "eventType" <> 'error'""")

#: Clicks come after all else: those in windows that the watermark had closed by then are late.
_LATE_CLICK = """"eventType" = 'recommendationClick' AND time_bucket(INTERVAL 10 MINUTE, "timestamp") + INTERVAL 10 MINUTE <=
  (SELECT max("timestamp") - INTERVAL 2 MINUTE FROM parsed WHERE "eventType" <> 'recommendationClick')"""

_CHANGED_CUSTOMERS = f"""
customers AS ({_dimension('customer')}),
changed AS (
  SELECT * FROM customers
  UNION ALL SELECT * REPLACE ('Renamed' AS customer_fname) FROM customers WHERE customer_id % 5 = 0
  UNION ALL SELECT * FROM customers WHERE customer_id % 10 = 0)"""

ORACLE: dict[str, str] = {
    "clean_sales": _with(SALES, body="SELECT * EXCLUDE (city, state) FROM sales"),
    **{f"dim_{name}": _with(SALES, body=_dimension(name)) for name in DIMENSIONS},
    "dim_date": """
        SELECT CAST(d AS DATE) AS value, strftime(d, '%Y%m%d') AS date_id,
               CAST(day(d) AS INTEGER) AS "day", CAST(month(d) AS INTEGER) AS "month", CAST(year(d) AS INTEGER) AS "year",
               CAST(quarter(d) AS INTEGER) AS quarter, dayname(d) AS day_name
        FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                            INTERVAL 1 DAY)) AS d FROM orders)""",
    "dim_branches": _with(BRANCHES, body="SELECT * FROM branches"),
    "dim_sales_agents": _with(AGENTS, body="SELECT * FROM agents"),
    "unpivot_offers": _with(SALES, body=_FLAGS),
    "fact_sales": _with(FACT, body="SELECT * FROM fact"),
    "most_selling_products": _with(
        FACT, _PRODUCT_DIM,
        body=f"""SELECT p.product_name, CAST(sum(f.units) AS BIGINT) AS total_units_sold FROM fact f {_PRODUCT_JOIN}
                 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    ),
    "most_redeemed_offers": _with(
        FACT, f"offer_dim AS ({_dimension('offer')})",
        body="""SELECT o.offer_name, count(f.offer_id) AS total_redeemed_offer
                FROM fact f JOIN offer_dim o ON f.offer_id = o.offer_id
                GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    ),
    "most_redeemed_offers_by_product": _with(
        FACT, _PRODUCT_DIM,
        body=f"""SELECT p.product_name, count(f.offer_id) AS total_redeemed_offer FROM fact f {_PRODUCT_JOIN}
                 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    ),
    "lowest_online_cities": _with(
        FACT, f"location_dim AS ({_dimension('location')})",
        body="""SELECT c.city, round(sum(f.total_price), 3) AS total_online_sales
                FROM fact f JOIN location_dim c ON f.location_id = c.location_id
                WHERE f.payment_id LIKE 'yes%' GROUP BY 1 ORDER BY sum(f.total_price), 1 LIMIT 10""",
    ),
    "daily_agent_product_units": _DAILY,
    "incremental_branches": _new(
        "SELECT * FROM branches", f"SELECT * FROM branches WHERE establish_date < DATE '{BRANCHES_BEFORE}'",
        "branch_id", BRANCHES,
    ),
    "incremental_agents": _new(
        "SELECT * FROM agents", f"SELECT * FROM agents WHERE hire_date < DATE '{AGENTS_BEFORE}'",
        "sales_person_id", AGENTS,
    ),
    "incremental_customer": _new_since("customer", "customer_id"),
    "incremental_product": _new_since("product", "product_id"),
    "incremental_location": _new(
        _dimension("location"), f"SELECT * FROM ({_dimension('location')}) WHERE state = 'AFRICA'", "location_id", SALES
    ),
    "incremental_payment": _new(
        _dimension("payment"), f"SELECT * FROM ({_dimension('payment')}) WHERE is_online = 'no'", "payment_id", SALES
    ),
    "incremental_offer": _new(
        _dimension("offer"), f"SELECT * FROM ({_dimension('offer')}) WHERE percentage <= 10", "offer_id", SALES
    ),
    "scan_parquet": "SELECT * FROM orders",
    "scan_csv_roundtrip": _with(AGENTS, body="SELECT * FROM agents"),
    "land_hourly_partitions": _with(
        RAW, body="""SELECT *, '2024' AS "year", '05' AS "month", '01' AS "day", '09' AS "hour" FROM raw"""
    ),
    "fact_partitioned_roundtrip": _with(FACT, body="SELECT * FROM fact"),
    "b2b_csv_roundtrip": _DAILY,
    "warehouse_load_fact": _with(
        FACT,
        body=f"""SELECT *, CASE WHEN transaction_date_id < '{STORED_BEFORE:%Y%m%d}' THEN '2024050109'
                           ELSE '2024050110' END AS batch_hour FROM fact""",
    ),
    "fact_merge_closed_days": _with(
        FACT,
        body="""SELECT * REPLACE (left(transaction_date_id, 6) || '01' AS transaction_date_id,
                                  CASE WHEN "day" IS NOT NULL THEN '01' END AS "day"),
                       ['2024050109', '2024050110', '2024050200'][CAST(product_id % 3 AS INTEGER) + 1] AS batch_hour
                FROM fact""",
    ),
    "warehouse_load_dimensions": _with(SALES, BRANCHES, AGENTS, body=_DIMENSION_COUNTS),
    "warehouse_branches_Dim": _with(BRANCHES, body="SELECT * FROM branches"),
    "warehouse_sales_agents_Dim": _with(AGENTS, body="SELECT * FROM agents"),
    **{f"warehouse_{name}_Dim": _loaded(name) for name in DIMENSIONS},
    "warehouse_date_Dim": """
        SELECT CAST(d AS DATE) AS value, strftime(d, '%Y%m%d') AS date_id,
               CAST(day(d) AS INTEGER) AS "day", CAST(month(d) AS INTEGER) AS "month", CAST(year(d) AS INTEGER) AS "year",
               CAST(quarter(d) AS INTEGER) AS quarter, dayname(d) AS day_name
        FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS d)""",
    "scan_csv_reordered_columns": _with(AGENTS, body="SELECT * FROM agents"),
    "land_csv_extra_column": _AGENT_ROWS.format(more=", upper(name) AS badge", where=""),
    "land_last_hour": _AGENT_ROWS.format(
        more=""", '2024' AS "year", '05' AS "month", '01' AS "day", '09' AS "hour" """,
        where=" WHERE sales_person_id % 3 = 1",
    ),
    "land_late_files": _AGENT_ROWS.format(
        more=""", '2024' AS "year", '05' AS "month", '01' AS "day", '09' AS "hour" """,
        where=" WHERE sales_person_id % 3 <> 2",
    ),
    "land_csv_line_breaks": _with(
        AGENTS,
        body="""SELECT sales_person_id, hire_date, CASE WHEN sales_person_id % 2 = 0
                  THEN name || chr(10) || 'said "hi", ' || sales_person_id ELSE name END AS name FROM agents""",
    ),
    "load_partial_hour": _with(FACT, body="SELECT *, '2024050109' AS batch_hour FROM fact"),
    "warehouse_reload_missing_hour": _with(FACT, body="SELECT * FROM fact"),
    "incremental_null_keys": _loaded("customer", "customer_id % 10 <> 0"),
    "compact_then_stream": _ALL_EVENTS,
    "stream_router_events": _ALL_EVENTS,
    "stream_unrouted_messages": _with(
        EVENTS,
        body="""SELECT '{"eventType":"error","customerId":"' || "customerId" || '","productId":"' || "productId"
                       || '","timestamp":"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS value, "eventType"
                FROM parsed WHERE "eventType" = 'error'""",
    ),
    "kpi_job_outputs": _kpi(
        "add_to_cart",
        'SELECT "customerId", CAST(sum(quantity) AS BIGINT) AS total_quantity_added FROM add_to_cart GROUP BY 1',
    ),
    "compact_preserves_rows": _ROUTED,
    "compact_new_files": _ROUTED,
    "stream_parse_events": _with(EVENTS, body="SELECT * FROM parsed"),
    **{f"stream_route_{table}": _with(EVENTS, body=body) for table, body in ROUTES.items()},
    "stream_unrouted": _with(EVENTS, body="""SELECT "eventType" FROM parsed WHERE "eventType" = 'error'"""),
    "stream_router": _with(
        EVENTS,
        body="""SELECT CASE "eventType" WHEN 'productView' THEN 'product_view' WHEN 'addToCart' THEN 'add_to_cart'
                       WHEN 'purchase' THEN 'purchase' WHEN 'recommendationClick' THEN 'recommendation_click'
                       ELSE 'unrouted' END AS table_name, "eventType", count(*) AS row_count
                FROM parsed GROUP BY ALL""",
    ),
    "kpi_total_product_views": _kpi("product_view", "SELECT count(*) AS total_product_views FROM product_view"),
    "kpi_views_per_category": _VIEWS_PER_CATEGORY,
    "kpi_unique_customers_per_category": _kpi(
        "product_view",
        'SELECT category, count(DISTINCT "customerId") AS unique_customers FROM product_view GROUP BY 1',
    ),
    "kpi_total_add_to_cart": _kpi("add_to_cart", "SELECT count(*) AS total_add_to_cart FROM add_to_cart"),
    "kpi_add_to_cart_per_product": _kpi(
        "add_to_cart", 'SELECT "productId", count(*) AS add_to_cart_per_product FROM add_to_cart GROUP BY 1'
    ),
    "kpi_quantity_per_customer": _kpi(
        "add_to_cart",
        'SELECT "customerId", CAST(sum(quantity) AS BIGINT) AS total_quantity_added FROM add_to_cart GROUP BY 1',
    ),
    "kpi_total_revenue": _kpi("purchase", 'SELECT round(sum("totalAmount"), 2) AS total_revenue FROM purchase'),
    "kpi_purchases_per_method": _kpi(
        "purchase", 'SELECT "paymentMethod", count(*) AS purchases_per_method FROM purchase GROUP BY 1'
    ),
    "kpi_average_order_value": _kpi(
        "purchase", 'SELECT round(avg("totalAmount"), 4) AS average_order_value FROM purchase'
    ),
    "kpi_total_recommendation_clicks": _kpi(
        "recommendation_click", "SELECT count(*) AS total_recommendation_clicks FROM recommendation_click"
    ),
    "kpi_clicks_per_algorithm": _kpi(
        "recommendation_click",
        "SELECT algorithm, count(*) AS clicks_per_algorithm FROM recommendation_click GROUP BY 1",
    ),
    "kpi_unique_customers_clicking": _kpi(
        "recommendation_click",
        'SELECT count(DISTINCT "customerId") AS unique_customers_clicking FROM recommendation_click',
    ),
    "external_table_kpi": _VIEWS_PER_CATEGORY,
    "batch_event_counts": _EVENT_COUNTS,
    "stream_event_counts": _with(
        EVENTS, _windows(10, "eventType"),
        body="""SELECT * FROM windows
                WHERE window_end <= (SELECT max("timestamp") - INTERVAL 2 MINUTE FROM parsed)""",
    ),
    "stream_event_counts_update": _EVENT_COUNTS,
    "stream_event_counts_retired": _EVENT_COUNTS,
    "stream_late_data": _with(
        EVENTS,
        _windows(
            10, "eventType",
            """"eventType" <> 'recommendationClick'
               OR time_bucket(INTERVAL 10 MINUTE, "timestamp") + INTERVAL 10 MINUTE >
                  (SELECT max("timestamp") - INTERVAL 2 MINUTE FROM parsed WHERE "eventType" <> 'recommendationClick')""",
        ),
        body="SELECT * FROM windows",
    ),
    "stream_top_products": _with(
        EVENTS, _windows(30, "productId", "\"eventType\" = 'productView'"),
        body='SELECT * FROM windows ORDER BY "count" DESC, window_start, "productId" LIMIT 5',
    ),
    "stream_top_products_per_window": _with(
        EVENTS, _windows(30, "productId", "\"eventType\" = 'productView'"),
        """ranked AS (
             SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY "count" DESC, "productId") AS INTEGER) AS rank
             FROM windows WHERE window_end <=
               (SELECT max("timestamp") - INTERVAL 30 MINUTE FROM parsed WHERE "eventType" = 'productView'))""",
        body="SELECT * FROM ranked WHERE rank <= 5",
    ),
    "stream_late_side_table": _with(
        EVENTS,
        body=f"""SELECT '{{"eventType":"recommendationClick","customerId":"' || "customerId" || '","timestamp":"'
                        || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '","recommendedProductId":"'
                        || "recommendedProductId" || '","algorithm":"' || algorithm || '"' || '}}' AS value, "eventType", "timestamp",
                        time_bucket(INTERVAL 10 MINUTE, "timestamp") + INTERVAL 10 MINUTE AS window_end
                 FROM parsed WHERE {_LATE_CLICK}""",
    ),
    "stream_counts_beside_late": _with(
        EVENTS, _windows(10, "eventType", f"NOT ({_LATE_CLICK})"), body="SELECT * FROM windows"
    ),
    "dimension_key_violations": _with(
        SALES, _CHANGED_CUSTOMERS,
        body="""SELECT customer_id, count(*) AS row_count,
                       count(DISTINCT (customer_fname, customer_lname, customer_email)) AS version_count
                FROM changed GROUP BY customer_id HAVING count(*) > 1""",
    ),
    "dimension_unique_keys": _with(
        SALES, _CHANGED_CUSTOMERS,
        body="""SELECT *, row_number() OVER (
                  PARTITION BY customer_id ORDER BY customer_fname, customer_lname, customer_email NULLS FIRST) = 1 AS kept
                FROM changed""",
    ),
    "stream_top_products_latest_window": _with(
        EVENTS, _windows(30, "productId", "\"eventType\" = 'productView'"),
        """closed AS (SELECT * FROM windows WHERE window_end <=
             (SELECT max("timestamp") - INTERVAL 30 MINUTE FROM parsed WHERE "eventType" = 'productView'))""",
        body="""SELECT * FROM closed WHERE window_end = (SELECT max(window_end) FROM closed)
                ORDER BY "count" DESC, "productId" LIMIT 5""",
    ),
}
