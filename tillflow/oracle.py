"""The registered queries as DuckDB SQL over the supplied tables, for result checks.

Written from the meaning of each query, without looking at its Spark plan: joins,
windows and subqueries are the plain textbook forms.
"""

from __future__ import annotations


def total(x: str, digits: int = 2) -> str:
    return f"CAST(round(sum(CAST({x} AS DECIMAL(20,6))), {digits}) AS DOUBLE)"


def quotient(part: str, whole: str, digits: int) -> str:
    """part / whole of integers, rounded half away from zero."""
    part, whole = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    scaled = f"((2 * abs({part}) * {10**digits} + {whole}) // (2 * {whole}))"
    return f"CAST(sign({part}) * {scaled} AS DOUBLE) / {10**digits}"


def mean(x: str, digits: int = 2) -> str:
    millionths = f"sum(CAST(CAST({x} AS DECIMAL(20,6)) * 1000000 AS HUGEINT))"
    return quotient(millionths, f"(count({x}) * 1000000)", digits)


def money(x: str) -> str:
    return f"CAST(CAST(round({x} * 10000) AS BIGINT) AS VARCHAR)"


def event_item(number: str, pieces: int) -> str:
    """The text of one item of an event."""
    name = f"CAST({number} AS VARCHAR)"
    coupon = f"CASE WHEN {number} % 4 = 0 THEN 'C' || {name} ELSE '' END"
    return (
        f"{coupon} || '|' || {name} || '|item ' || {name} || '|' || {money(f'value * {pieces}')}"
        f" || '|' || {money('value')} || '|{pieces}'"
    )


def with_views(sql: str) -> str:
    """Prefix the query with the views it names."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if f"v_{name}" in text and name not in needed:
                visit(body)
                needed.append(name)

    visit(sql)
    heads = [f"v_{name} AS ({VIEWS[name].strip()})" for name in needed]
    return f"WITH {', '.join(heads)} {sql.strip()}" if heads else sql.strip()


VIEWS = {
    "lines": """
        SELECT l_orderkey, l_linenumber, l_shipdate AS shipped,
               CASE WHEN round(l_discount * 100) > 0
                    THEN 'D' || CAST(CAST(round(l_discount * 100) AS INT) AS VARCHAR) END AS coupon,
               CAST(l_partkey AS VARCHAR) AS item_id,
               'item ' || CAST(l_partkey AS VARCHAR) AS item_name,
               l_extendedprice * (100 - CAST(round(l_discount * 100) AS INT)) / 100 AS item_revenue_in_usd,
               l_extendedprice AS price_in_usd,
               CAST(l_quantity AS BIGINT) AS quantity
        FROM lineitem""",
    "sales": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
               c_name AS email,
               o_orderdate AS transaction_timestamp, l_orderkey, coupon, item_id, item_name,
               item_revenue_in_usd, price_in_usd, quantity
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN v_lines ON o_orderkey = l_orderkey""",
    "purchases": """
        SELECT o_orderkey AS order_id, c_name AS email, o_orderdate AS transaction_timestamp,
               o_totalprice AS purchase_revenue_in_usd
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS name, p_retailprice AS price
        FROM part""",
    "events": f"""
        SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS user_id,
               CASE event_type WHEN 'purchase' THEN 'finalize' ELSE event_type END AS event_name,
               CASE WHEN k < 95 THEN 'src_' || CAST(k AS VARCHAR) END AS traffic_source,
               ts AS event_timestamp,
               ts - to_minutes(k) AS event_previous_timestamp,
               ts - to_days(k) AS user_first_touch_timestamp,
               n_name AS city, r_name AS state,
               CASE WHEN event_type = 'purchase' THEN value END AS purchase_revenue_in_usd,
               CASE WHEN event_type = 'purchase' THEN CAST(3 AS BIGINT) END AS total_item_quantity,
               CASE WHEN event_type = 'purchase' THEN CAST(2 AS BIGINT) END AS unique_items,
               CASE event_type
                    WHEN 'purchase' THEN {event_item("k", 1)} || ',' || {event_item("((k + 37) % 100)", 2)}
                    WHEN 'click' THEN {event_item("k", 1)}
                    WHEN 'signup' THEN '' END AS basket,
               CASE event_type WHEN 'purchase' THEN 2 WHEN 'click' THEN 1 WHEN 'signup' THEN 0 END
                    AS basket_size,
               k, value
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events) e
        LEFT JOIN nation ON n_nationkey = e.user_id % 28
        LEFT JOIN region ON r_regionkey = n_regionkey""",
    "delivered": "SELECT * FROM v_events UNION ALL SELECT * FROM v_events",
    "eventitems": """
        SELECT *, CASE WHEN num % 4 = 0 THEN 'C' || CAST(num AS VARCHAR) END AS coupon,
               CAST(num AS VARCHAR) AS item_id, 'item ' || CAST(num AS VARCHAR) AS item_name,
               value * pieces AS item_revenue_in_usd, value AS price_in_usd,
               CAST(pieces AS BIGINT) AS quantity
        FROM (SELECT *, k AS num, 1 AS pieces FROM v_events WHERE event_name IN ('finalize', 'click')
              UNION ALL
              SELECT *, (k + 37) % 100 AS num, 2 AS pieces FROM v_events WHERE event_name = 'finalize')""",
    "recency": f"""
        SELECT email, max(transaction_timestamp) AS last_purchase,
               {total("purchase_revenue_in_usd")} AS revenue,
               CAST(date_diff('day', max(transaction_timestamp),
                    (SELECT max(o_orderdate) FROM orders)) AS INTEGER) AS days_since_last
        FROM v_purchases GROUP BY email""",
    "touch": """
        SELECT CAST(p.user_id AS VARCHAR) AS "user", first_purchase, first_touch,
               CAST(floor(epoch(first_purchase)) - floor(epoch(first_touch)) AS BIGINT) AS seconds
        FROM (SELECT user_id, min(ts) AS first_purchase FROM events
              WHERE event_type = 'purchase' GROUP BY 1) p
        JOIN (SELECT user_id, min(ts) AS first_touch FROM events
              WHERE event_type = 'view' GROUP BY 1) t USING (user_id)""",
    "conversion": f"""
        SELECT traffic_source, count(DISTINCT user_id) AS visitors,
               count(DISTINCT user_id) FILTER (WHERE event_name = 'finalize') AS buyers,
               {quotient("count(DISTINCT user_id) FILTER (WHERE event_name = 'finalize')",
                         "count(DISTINCT user_id)", 4)} AS conversion_rate
        FROM v_events GROUP BY traffic_source""",
    "cleanconversion": f"""
        SELECT traffic_source, count(DISTINCT user_id) AS visitors,
               count(DISTINCT user_id) FILTER (WHERE event_name = 'finalize') AS buyers,
               {quotient("count(DISTINCT user_id) FILTER (WHERE event_name = 'finalize')",
                         "count(DISTINCT user_id)", 4)} AS conversion_rate
        FROM v_events WHERE user_id IS NOT NULL GROUP BY traffic_source""",
    "once": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY email NULLS FIRST,
                       transaction_timestamp NULLS FIRST, price_in_usd NULLS FIRST,
                       quantity NULLS FIRST, coupon NULLS FIRST, item_id NULLS FIRST,
                       item_revenue_in_usd NULLS FIRST) AS place
            FROM v_sales) WHERE place = 1""",
    "enriched": """
        SELECT item_id, order_id, email, transaction_timestamp, coupon, item_name,
               item_revenue_in_usd, price_in_usd, quantity, name AS product_name, price AS product_price
        FROM v_once LEFT JOIN v_products USING (item_id) WHERE l_orderkey IS NOT NULL""",
    "segments": """
        SELECT CASE WHEN coupon IS NULL THEN 'no_coupon' ELSE 'coupon' END AS segment,
               round(sum(CAST(item_revenue_in_usd AS DECIMAL(20,6))), 2) AS amount,
               CAST(sum(quantity) AS BIGINT) AS quantity, count(*) AS line_items
        FROM v_lines GROUP BY 1""",
    "monthly": f"""
        SELECT strftime(event_timestamp, '%Y-%m') AS month, item_id, city,
               {total("item_revenue_in_usd")} AS revenue
        FROM v_eventitems WHERE event_name = 'finalize' GROUP BY 1, 2, 3""",
}

_EVENT = "user_id, event_name, traffic_source, event_timestamp"
_ITEM = "coupon, item_id, item_name, item_revenue_in_usd, price_in_usd, quantity"
_FIGURES = "purchase_revenue_in_usd, total_item_quantity, unique_items"
_TIMES = "event_previous_timestamp, user_first_touch_timestamp"


def _counted(lines: list[tuple[str, str]], **extra: str) -> str:
    more = "".join(f", {value} AS {name}" for name, value in extra.items())
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", (SELECT count(*) FROM {source}) AS rows{more}"
        for name, source in lines
    )


def _filled(name: str, source: str, columns: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", {place} AS position, '{column}' AS \"column\", "
        f"'{kind}' AS type, (SELECT count({seen}) FROM {source}) AS filled"
        for place, (column, kind, seen) in enumerate(columns, 1)
    )


_GEO = "struct<city:string,state:string>"
_ECOMMERCE = "struct<purchase_revenue_in_usd:double,total_item_quantity:bigint,unique_items:bigint>"
_ITEMS = (
    "array<struct<coupon:string,item_id:string,item_name:string,"
    "item_revenue_in_usd:double,price_in_usd:double,quantity:bigint>>"
)

_QUERIES = {
    "sql01_customer_revenue": f"""
        SELECT c_name AS customer_name, round(sum(o_totalprice), 2) AS total_order_amount
        FROM customer JOIN orders ON c_custkey = o_custkey
        WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'
        GROUP BY c_custkey, c_name HAVING sum(o_totalprice) > 1000000""",
    "sql02_avg_salary_by_dept": f"""
        SELECT n_name AS department_name,
               round(avg(s_acctbal), 4) AS avg_salary
        FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY n_nationkey, n_name""",
    "sql03_recent_orders": """
        SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderdate AS order_date,
               o_totalprice AS order_amount
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                        ORDER BY o_orderdate DESC, o_orderkey) AS rk FROM orders) WHERE rk <= 2""",
    "sql04_first_purchase": """
        SELECT o_custkey AS customer_id, min(o_orderdate) AS first_purchase
        FROM orders GROUP BY o_custkey""",
    "sql05_customers_no_orders": """
        SELECT c_custkey AS customer_id, c_name AS customer_name
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey
             AND o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'
        WHERE o_orderkey IS NULL""",
    "sql06_category_growth": """
        WITH yearly AS (
            SELECT p_type AS category, year(l_shipdate) AS y,
                   sum(CAST(l_extendedprice AS DECIMAL(20,6))) AS amount
            FROM lineitem JOIN part ON l_partkey = p_partkey
            WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1998-01-01' GROUP BY 1, 2)
        SELECT a.category, CAST(a.amount AS DOUBLE) AS sales_1997, CAST(b.amount AS DOUBLE) AS sales_1996,
               CAST(a.amount - b.amount AS DOUBLE) AS sales_increase
        FROM yearly a JOIN yearly b ON a.category = b.category
        WHERE a.y = 1997 AND b.y = 1996 AND a.amount > b.amount""",
    "sql07_monthly_churn": """
        SELECT strftime(ts, '%Y-%m') AS churn_month, count(*) AS churned_users
        FROM (SELECT ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
              FROM events WHERE event_type IN ('signup', 'error'))
        WHERE event_type = 'error' AND prev = 'signup' GROUP BY 1""",
    "sql08_duplicate_transactions": """
        SELECT l_suppkey AS user_id, l_quantity AS amount, CAST(l_shipdate AS DATE) AS transaction_day,
               count(*) AS occurrence
        FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "sql09_login_streaks": """
        WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'view'),
             runs AS (SELECT user_id, d,
                             d - CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INT) AS grp
                      FROM days)
        SELECT user_id, min(d) AS streak_start FROM runs GROUP BY user_id, grp HAVING count(*) >= 3""",
    "sql10_salary_p90": """
        SELECT s_suppkey AS emp_id, s_nationkey AS department, s_acctbal AS salary,
               round(quantile_cont(s_acctbal, 0.9) OVER (PARTITION BY s_nationkey), 4) AS percentile_salary
        FROM supplier""",
    "sql11_products_never_sold": """
        SELECT p_partkey AS product_id, p_name AS name FROM part
        WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL)""",
    "sql11_products_not_returned_1997": """
        SELECT p_partkey AS product_id, p_name AS name
        FROM part LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R'
             AND l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01') s
             ON p_partkey = l_partkey
        WHERE l_partkey IS NULL""",
    "sql12_running_total": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
               o_totalprice AS amount,
               round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total
        FROM orders""",
    "nb_table_counts": """
        SELECT 'users' AS "table", count(*) AS count FROM customer
        UNION ALL SELECT 'sales', count(*) FROM orders
        UNION ALL SELECT 'products', count(*) FROM part
        UNION ALL SELECT 'events', count(*) FROM events""",
    "nb_table_schemas": " UNION ALL ".join(
        [
            _filled(
                "users",
                "customer",
                [("email", "string", "c_name"), ("user_first_touch_timestamp", "timestamp_ntz", "*")],
            ),
            _filled(
                "sales",
                "v_sales",
                [
                    ("order_id", "string", "order_id"),
                    ("email", "string", "email"),
                    ("transaction_timestamp", "timestamp_ntz", "transaction_timestamp"),
                    ("purchase_revenue_in_usd", "double", "*"),
                    ("total_item_quantity", "bigint", "quantity"),
                    ("items", _ITEMS, "item_id"),
                ],
            ),
            _filled(
                "products",
                "v_products",
                [("item_id", "string", "item_id"), ("name", "string", "name"), ("price", "double", "price")],
            ),
            _filled(
                "events",
                "v_events",
                [
                    ("user_id", "string", "user_id"),
                    ("event_name", "string", "event_name"),
                    ("traffic_source", "string", "traffic_source"),
                    ("event_timestamp", "timestamp_ntz", "event_timestamp"),
                    ("event_previous_timestamp", "timestamp_ntz", "event_previous_timestamp"),
                    ("user_first_touch_timestamp", "timestamp_ntz", "user_first_touch_timestamp"),
                    ("geo", _GEO, "*"),
                    ("ecommerce", _ECOMMERCE, "*"),
                    ("items", _ITEMS, "basket"),
                ],
            ),
        ]
    ),
    "nb_sales_items": f"""
        SELECT order_id, email, transaction_timestamp, {_ITEM} FROM v_sales
        WHERE l_orderkey IS NOT NULL""",
    "nb_event_items": f"SELECT {_EVENT}, city, state, {_FIGURES}, {_ITEM} FROM v_eventitems",
    "nb_revenue_per_item": f"""
        SELECT item_id, {total("item_revenue_in_usd")} AS total_revenue FROM v_lines GROUP BY item_id""",
    "nb_sales_priced": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
               item_id, quantity, price_in_usd, price AS product_price
        FROM v_lines LEFT JOIN v_products USING (item_id)""",
    "nb_purchases_per_user": """
        SELECT email, count(DISTINCT order_id) AS num_purchases FROM v_purchases GROUP BY email""",
    "nb_revenue_per_user": f"""
        SELECT email, {total("purchase_revenue_in_usd")} AS total_revenue FROM v_purchases GROUP BY email""",
    "nb_top10_products": """
        SELECT item_id, CAST(sum(quantity) AS BIGINT) AS total_quantity FROM v_lines GROUP BY item_id
        ORDER BY total_quantity DESC, item_id LIMIT 10""",
    "nb_touch_to_purchase": f"""
        SELECT "user", first_purchase, first_touch, seconds / 3600 AS hours,
               {quotient("seconds", "86400", 2)} AS days FROM v_touch""",
    "nb_touch_to_purchase_avg": f"""
        SELECT {quotient("sum(seconds)", "(count(*) * 3600)", 2)} AS avg_hours_touch_to_purchase,
               {quotient("sum(seconds)", "(count(*) * 86400)", 2)} AS avg_days_touch_to_purchase,
               count(*) AS users_measured FROM v_touch""",
    "nb_monthly_revenue": f"""
        SELECT strftime(transaction_timestamp, '%Y-%m') AS month,
               {total("purchase_revenue_in_usd")} AS revenue FROM v_purchases GROUP BY 1""",
    "nb_monthly_events": """
        SELECT strftime(ts, '%Y-%m') AS month, count(*) AS count FROM events GROUP BY 1""",
    "nb_active_users_per_city": """
        SELECT city, count(DISTINCT user_id) AS active_users FROM v_events GROUP BY city""",
    "nb_revenue_per_source": f"""
        SELECT traffic_source, {total("item_revenue_in_usd")} AS revenue
        FROM v_eventitems GROUP BY traffic_source""",
    "nb_avg_items_per_txn": f"""
        SELECT count(*) AS total_transactions, CAST(sum(pieces) AS BIGINT) AS total_items_sold,
               {quotient("sum(pieces)", "count(pieces)", 4)} AS avg_items_per_transaction
        FROM orders LEFT JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS pieces
                               FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
    "nb_top5_products_detail": f"""
        SELECT item_id, name, price, revenue
        FROM (SELECT item_id, {total("item_revenue_in_usd")} AS revenue FROM v_lines GROUP BY item_id
              ORDER BY revenue DESC, item_id LIMIT 5) LEFT JOIN v_products USING (item_id)""",
    "nb_revenue_by_state": f"""
        SELECT state, {total("item_revenue_in_usd")} AS revenue FROM v_eventitems
        WHERE state IS NOT NULL GROUP BY state""",
    "nb_revenue_by_state_top15": f"""
        SELECT state, {total("item_revenue_in_usd")} AS revenue FROM v_eventitems
        WHERE state IS NOT NULL GROUP BY state ORDER BY revenue DESC, state LIMIT 15""",
    "nb_event_impact": f"""
        SELECT event_name, count(*) AS num_events,
               count(*) FILTER (WHERE purchase_revenue_in_usd > 0) AS events_with_rev,
               {total("purchase_revenue_in_usd")} AS total_revenue,
               {mean("purchase_revenue_in_usd")} AS avg_rev_per_event,
               round(stddev_samp(purchase_revenue_in_usd), 2) AS stddev_rev
        FROM v_events GROUP BY event_name""",
    # The chance is the area of the beta density up to d2 / (d2 + d1 * f), by Simpson's rule over the
    # square root of the place (which takes away the pole of the density at 0 or 1 degrees of freedom).
    "nb_event_significance": """
        SELECT * FROM (WITH known AS (
            SELECT traffic_source, purchase_revenue_in_usd AS v FROM v_events WHERE purchase_revenue_in_usd IS NOT NULL
        ), kinds AS (
            SELECT traffic_source, count(*) AS n, avg(v) AS m, var_pop(v) * count(*) AS s FROM known GROUP BY traffic_source
        ), parts AS (
            SELECT (SELECT count(*) FROM kinds) AS kinds, (SELECT count(*) FROM known) AS events,
                (SELECT sum(n * (m - (SELECT avg(v) FROM known)) ** 2) FROM kinds) AS b,
                (SELECT sum(s) FROM kinds) AS w
        ), tested AS (
            SELECT *, (b / (kinds - 1)) / (w / (events - kinds)) AS f, (events - kinds) / 2.0 AS p1,
                (kinds - 1) / 2.0 AS p2
            FROM parts
        ), points AS (
            SELECT t.*, i, CASE WHEN i = 0 OR i = 20000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS weight,
                sqrt((kinds - 1) * f / ((events - kinds) + (kinds - 1) * f)) AS lowest
            FROM tested t, range(20001) r(i)
        ), area AS (
            -- t = 1 - u * u from u = lowest to 1: 2 * (1 - u * u)^(p1 - 1) * u^(2 * p2 - 1)
            SELECT sum(weight * 2 * pow(greatest(1 - pow(lowest + (1 - lowest) * i / 20000.0, 2), 1e-300), p1 - 1)
                * pow(lowest + (1 - lowest) * i / 20000.0, 2 * p2 - 1)
                * exp(lgamma(p1 + p2) - lgamma(p1) - lgamma(p2))) * any_value(1 - lowest) / 60000.0 AS p
            FROM points
        )
        SELECT kinds, events, round(f, 6) AS f, round(p, 6) AS p, round(b / (b + w), 6) AS explained
        FROM tested, area)""",
    "nb_purchase_frequency": f"""
        SELECT email, count(DISTINCT order_id) AS purchases,
               count(DISTINCT CAST(transaction_timestamp AS DATE)) AS active_days,
               min(transaction_timestamp) AS first_purchase, max(transaction_timestamp) AS last_purchase,
               CAST(date_diff('day', min(transaction_timestamp), max(transaction_timestamp)) AS INTEGER)
                   AS tenure_days,
               {quotient("count(DISTINCT order_id)",
                         "greatest(count(DISTINCT CAST(transaction_timestamp AS DATE)), 1)", 4)}
                   AS purchase_frequency
        FROM v_purchases GROUP BY email""",
    "nb_coupon_split": f"""
        SELECT segment, CAST(amount AS DOUBLE) AS revenue, quantity, line_items,
               {quotient("amount * 10000", "(SELECT sum(amount) * 100 FROM v_segments)", 2)} AS pct_revenue,
               {quotient("quantity * 100", "(SELECT sum(quantity) FROM v_segments)", 2)} AS pct_quantity
        FROM v_segments""",
    "nb_product_stats": f"""
        SELECT item_id, min(item_name) AS item_name, CAST(sum(quantity) AS BIGINT) AS qty,
               {total("item_revenue_in_usd")} AS rev, {mean("price_in_usd")} AS avg_price
        FROM v_lines GROUP BY item_id""",
    "nb_product_corr": f"""
        SELECT 'product' AS grain, count(*) AS n, round(corr(qty, rev), 6) AS corr
        FROM (SELECT sum(quantity) AS qty, {total("item_revenue_in_usd")} AS rev FROM v_lines GROUP BY item_id)
        UNION ALL
        SELECT 'line', count(*), round(corr(quantity, item_revenue_in_usd), 6) FROM v_lines""",
    "nb_clv": f"""
        SELECT email, {total("purchase_revenue_in_usd")} AS clv, count(DISTINCT order_id) AS orders,
               {mean("purchase_revenue_in_usd")} AS avg_order_value,
               CAST(date_diff('day', min(transaction_timestamp), max(transaction_timestamp)) AS INTEGER)
                   AS active_days
        FROM v_purchases GROUP BY email""",
    "nb_conversion_by_source": "SELECT * FROM v_conversion",
    "nb_recency": "SELECT * FROM v_recency",
    "nb_churned": "SELECT * FROM v_recency WHERE days_since_last >= 180",
    "nb_recency_buckets": f"""
        SELECT CASE WHEN days_since_last <= 7 THEN '0-7d' WHEN days_since_last <= 14 THEN '8-14d'
                    ELSE '15d+' END AS recency_bucket,
               count(*) AS users, {mean("revenue")} AS avg_revenue
        FROM v_recency GROUP BY 1""",
    "bronze_products_in_parallel": """
        SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS name, p_retailprice AS price FROM part""",
    "quarantined_values": """
        SELECT 'products' AS source, 'price' AS "column", 'n/a' AS raw, 'not a double' AS reason,
               CAST(p_partkey AS VARCHAR) AS key
        FROM part WHERE p_partkey % 10 = 3
        UNION ALL
        SELECT 'sales', 'items', '[{"item_id"', 'malformed JSON', order_id FROM v_sales
        WHERE split_part(order_id, '-', 2) = '6'
        UNION ALL
        SELECT 'sales', 'items[0].quantity', 'many', 'not a bigint', order_id FROM v_sales
        WHERE split_part(order_id, '-', 2) = '7'
        UNION ALL
        SELECT 'sales', 'transaction_timestamp', 'yesterday', 'not an epoch time', order_id FROM v_sales
        WHERE split_part(order_id, '-', 2) = '5'""",
    "incremental_users": """
        SELECT 1 AS run, count(*) FILTER (WHERE c_custkey % 2 = 1) AS taken,
               count(*) FILTER (WHERE c_custkey % 2 = 1) AS stored FROM customer
        UNION ALL SELECT 2, count(*) FILTER (WHERE c_custkey % 2 = 0), count(*) FROM customer
        UNION ALL SELECT 3, 0, count(*) FROM customer""",
    "raw_tables": """
        SELECT 'users' AS "table", count(*) AS rows, CAST(0 AS BIGINT) AS null_texts FROM customer
        UNION ALL SELECT 'products', count(*), 0 FROM part
        UNION ALL SELECT 'sales', count(*),
               CAST(3 * count(*) FILTER (WHERE l_orderkey IS NULL) AS BIGINT) FROM v_sales
        UNION ALL SELECT 'events', count(*),
               count(*) FILTER (WHERE user_id IS NULL) + count(*) FILTER (WHERE traffic_source IS NULL)
               + count(*) FILTER (WHERE basket IS NULL) FROM v_delivered""",
    "bronze_events": f"""
        SELECT {_EVENT}, {_TIMES}, city, state, {_FIGURES}, basket, CAST(basket_size AS INTEGER) AS basket_size
        FROM v_delivered""",
    "bronze_sales": f"""
        SELECT order_id, email, transaction_timestamp, coalesce(price_in_usd, 0) AS purchase_revenue_in_usd,
               quantity AS total_item_quantity,
               coalesce(coupon, '') || '|' || item_id || '|' || item_name || '|'
                   || {money("item_revenue_in_usd")} || '|' || {money("price_in_usd")} || '|'
                   || CAST(quantity AS VARCHAR) AS basket,
               CASE WHEN l_orderkey IS NOT NULL THEN 1 END AS basket_size
        FROM v_sales""",
    "bronze_users": """
        SELECT c_name AS email,
               TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INT))
                   AS user_first_touch_timestamp
        FROM customer""",
    "bronze_products": "SELECT item_id, name, price FROM v_products",
    "silver_events": f"""
        SELECT DISTINCT {_EVENT}, {_TIMES}, city, state, {_FIGURES}, basket,
               CAST(basket_size AS INTEGER) AS basket_size
        FROM v_events WHERE user_id IS NOT NULL""",
    "silver_sales_enriched": "SELECT * FROM v_enriched WHERE order_id IS NOT NULL",
    "silver_event_items": f"""
        SELECT {_EVENT}, city, {_ITEM} FROM v_eventitems WHERE user_id IS NOT NULL""",
    "gold_monthly_revenue_by_product_city": "SELECT * FROM v_monthly",
    "gold_top10_customers_by_ltv": f"""
        SELECT email, {total("coalesce(price_in_usd, 0)")} AS clv, count(DISTINCT order_id) AS orders
        FROM v_sales GROUP BY email ORDER BY clv DESC, email LIMIT 10""",
    "gold_conversion_by_traffic_source": "SELECT * FROM v_cleanconversion",
    "gold_customer_ltv": """
        SELECT email, round(sum(coalesce(price_in_usd, 0)), 2) AS clv, count(DISTINCT order_id) AS orders
        FROM v_sales GROUP BY email""",
    "dq_report": """
        SELECT 'bronze_users' AS dataset, 'values_fit' AS expectation, 'keep' AS action, count(*) AS rows,
               0 AS violations FROM customer
        UNION ALL
        SELECT 'bronze_products', 'values_fit', 'keep', count(*), 0 FROM part
        UNION ALL
        SELECT 'bronze_sales', 'values_fit', 'keep', count(*), 0 FROM v_sales
        UNION ALL
        SELECT 'bronze_events', 'values_fit', 'keep', count(*), 0 FROM v_delivered
        UNION ALL
        SELECT 'bronze_sales', 'has_items', 'keep', count(*),
               count(*) FILTER (WHERE l_orderkey IS NULL) FROM v_sales
        UNION ALL
        SELECT 'silver_events', 'valid_user', 'drop', count(*), count(*) FILTER (WHERE user_id IS NULL)
        FROM v_events
        UNION ALL
        SELECT 'silver_events', 'non_null_ts', 'keep', count(*),
               count(*) FILTER (WHERE event_timestamp IS NULL) FROM v_events
        UNION ALL
        SELECT 'silver_sales_enriched', 'valid_order', 'drop', count(*),
               count(*) FILTER (WHERE order_id IS NULL) FROM v_enriched
        UNION ALL
        SELECT 'gold_customer_ltv', 'positive_clv', 'fail', count(*), count(*) FILTER (WHERE NOT clv >= 0)
        FROM (SELECT sum(coalesce(price_in_usd, 0)) AS clv FROM v_sales GROUP BY email)""",
    "audit_table_history": _counted(
        [
            ("bronze.users", "customer"),
            ("bronze.products", "part"),
            ("bronze.sales", "v_sales"),
            ("bronze.events", "v_delivered"),
            ("quarantine.lost_values", "(SELECT 1 WHERE false)"),
            ("silver.events", "(SELECT * FROM v_events WHERE user_id IS NOT NULL)"),
            ("silver.sales_enriched", "v_enriched"),
            ("silver.event_items", "(SELECT * FROM v_eventitems WHERE user_id IS NOT NULL)"),
            ("gold.monthly_revenue_by_product_city", "v_monthly"),
            (
                "gold.top10_customers_by_ltv",
                "(SELECT DISTINCT email FROM v_sales LIMIT 10)",
            ),
            ("gold.conversion_by_traffic_source", "v_cleanconversion"),
            ("gold.customer_ltv", "(SELECT DISTINCT email FROM v_sales)"),
        ],
        version="0",
        operation="'write'",
        mode="'overwrite'",
    ),
    "catalog_tables": """
        SELECT 'raw' AS layer, 'users' AS "table", count(*) AS rows FROM customer
        UNION ALL SELECT 'raw', 'products', count(*) FROM part
        UNION ALL SELECT 'raw', 'sales', count(*) FROM v_sales
        UNION ALL SELECT 'raw', 'events', count(*) FROM v_delivered""",
}

SQL = {name: with_views(sql) for name, sql in _QUERIES.items()}
