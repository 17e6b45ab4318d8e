"""Plain SQL for every registered query, for an independent engine to run on the same tables.

Doubles are added exactly, as whole numbers of 2**-60, of which all amounts and temperatures of the
tables are multiples; the total is rounded once, on its way through text.
"""

from __future__ import annotations

from skyledger.sources import messy


UNITS = 1 << 60


def total(x: str, over: str = "") -> str:
    units = f"SUM(CAST({x} * {UNITS}::DOUBLE AS HUGEINT)) {over}"
    return f"(CAST(CAST({units} AS VARCHAR) AS DOUBLE) / {UNITS}::DOUBLE)"


def mean(x: str) -> str:
    return f"({total(x)} / NULLIF(COUNT({x}), 0))"


def rounded(x: str, digits: int) -> str:
    # Adding 0 turns a negative zero into zero.
    return f"(ROUND({x}, {digits}) + 0.0::DOUBLE)"


# Named steps; a query lists the ones it needs, in order.
STEPS = {
    "deliveries_raw": messy.plain(messy.DELIVERIES),
    "deliveries_tidy": messy.plain(messy.DELIVERIES_TIDY),
    "deliveries": messy.plain(messy.DELIVERIES_TYPED),
    "weather_raw": messy.plain(messy.WEATHER),
    "raw_orders": messy.plain(messy.RAW_ORDERS),
    "restaurant_orders_raw": messy.plain(messy.RESTAURANT_ORDERS),
    "requests": messy.plain(messy.REQUESTS),
    "registry": messy.plain(messy.CITY_REGISTRY),
    "texts": messy.plain(messy.TEXTS),
    "wide": messy.plain(messy.WIDE_ORDERS),
    # What the messy deliveries are made of, before any text was made of it.
    "known_deliveries": """
        SELECT o_orderkey AS id, lower(n_name) AS nation,
          o_orderkey % 97 = 0 AS null_city,
          o_orderkey % 97 <> 0 AND o_orderkey % 89 = 0 AS blank_city,
          o_orderstatus IN ('F', 'O') AS delivered,
          CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN ' delivered '
            ELSE 'CANCELLED' END AS status_text,
          o_orderkey % 83 = 0 AS no_amount,
          CASE WHEN o_orderkey % 83 <> 0 AND o_orderkey % 79 <> 0
            THEN CAST(floor(o_totalprice) AS BIGINT) % 20000 END AS cents,
          CAST(o_orderdate AS DATE) AS day
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    # Limits and labels of the tiers, the limit of a high value.
    "stg_deliveries": """
        SELECT id AS delivery_id, nation AS city,
          CASE WHEN delivered THEN 'delivered' ELSE 'cancelled' END AS status,
          cents / 100::DOUBLE AS amount, cents > 5000 AS is_high_value, day AS order_date,
          ROUND(cents / 100::DOUBLE / 100, 2) AS amount_usd,
          CASE WHEN cents >= 10000 THEN 'high' WHEN cents >= 5000 THEN 'medium' ELSE 'low' END
            AS order_tier
        FROM known_deliveries WHERE cents IS NOT NULL AND NOT null_city AND NOT blank_city""",
    "weather_summary": f"""
        SELECT trim(lower(city)) AS city, {rounded(mean('temperature_c'), 1)} AS avg_temp,
          MAX(temperature_c) AS max_temp, MIN(temperature_c) AS min_temp,
          COUNT(*) AS record_count
        FROM weather_raw GROUP BY trim(lower(city))""",
    "weather_nonnull": f"""
        SELECT trim(lower(city)) AS city, round_even({mean('temperature_c')} * 10, 0) / 10
            AS avg_temp,
          MAX(temperature_c) AS max_temp, MIN(temperature_c) AS min_temp,
          COUNT(temperature_c) AS record_count
        FROM weather_raw WHERE city IS NOT NULL GROUP BY trim(lower(city))""",
    "int_orders_enriched": f"""
        SELECT d.delivery_id, d.city, d.status, d.amount, d.is_high_value, d.order_date,
          w.avg_temp, {rounded('d.amount / NULLIF(w.avg_temp, 0)', 2)} AS revenue_per_degree
        FROM stg_deliveries d LEFT JOIN weather_summary w ON d.city = w.city""",
    "mart_city_summary": f"""
        SELECT city, COUNT(*) AS total_orders, {total('amount')} AS total_revenue,
          {rounded(mean('amount'), 2)} AS avg_order_value,
          COUNT(*) FILTER (WHERE status = 'delivered') AS delivered_count,
          {rounded(mean('avg_temp'), 1)} AS avg_temp,
          {rounded(mean('revenue_per_degree'), 4)} AS avg_revenue_per_degree
        FROM int_orders_enriched GROUP BY city""",
    "known_orders": """
        SELECT o_orderkey AS order_id, lower(n_name) AS nation, s_name,
          concat('category ', s_nationkey % 5) AS category,
          CASE WHEN o_orderkey % 71 <> 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 200 AS DOUBLE)
            END AS total,
          CAST(o_orderkey % 4 AS DOUBLE) AS fee, o_orderstatus, CAST(o_orderdate AS DATE) AS day
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN supplier ON s_suppkey = o_orderkey % (SELECT count(*) FROM supplier)""",
    "stg_orders": """
        SELECT order_id, nation AS customer_city, lower(s_name) AS restaurant_name,
          category AS restaurant_category, total AS order_total, fee AS delivery_fee,
          'delivered' AS order_status, day + INTERVAL 750 MINUTE AS ordered_at,
          total - fee AS order_revenue, fee = 0 AS is_free_delivery
        FROM known_orders WHERE o_orderstatus IN ('F', 'O')""",
    "stg_restaurant_orders": """
        SELECT order_id, lower(s_name) AS restaurant_name, concat(' ', nation) AS city,
          total AS amount, 'delivered' AS status, CAST(day AS VARCHAR) AS order_date,
          total > 80 AS is_high_value
        FROM known_orders WHERE o_orderstatus = 'F'""",
    "int_orders_by_restaurant": f"""
        SELECT restaurant_name, restaurant_category, {total('order_total')} AS total_orders,
          {total('order_revenue')} AS total_revenue,
          {rounded(mean('order_total'), 2)} AS avg_order_value,
          CAST(SUM(CAST(is_free_delivery AS INTEGER)) AS BIGINT) AS free_delivery_count
        FROM stg_orders GROUP BY restaurant_name, restaurant_category""",
    "mart_restaurant_summary": """
        SELECT *, CASE WHEN total_revenue >= 100 THEN 'high' WHEN total_revenue >= 50 THEN 'med'
                  ELSE 'low' END AS revenue_tier
        FROM int_orders_by_restaurant""",
    "mart_restaurant_daily": f"""
        SELECT *, CASE WHEN total_revenue >= 200 THEN 'high' WHEN total_revenue >= 100 THEN 'med'
                  ELSE 'low' END AS revenue_tier
        FROM (SELECT order_date, restaurant_name, COUNT(*) AS total_orders,
                {total('amount')} AS total_revenue, {mean('amount')} AS avg_order_value
              FROM stg_restaurant_orders GROUP BY order_date, restaurant_name)""",
    "mart_city_orders": f"""
        SELECT customer_city, {total('order_total')} AS total_orders,
          {total('order_revenue')} AS total_revenue, {mean('order_total')} AS avg_order_value,
          COUNT(DISTINCT restaurant_name) AS unique_restaurants
        FROM stg_orders GROUP BY customer_city""",
    "city_avgs": f"SELECT city, {mean('amount')} AS average FROM deliveries GROUP BY city",
    "clean_sql": """
        SELECT id, nation AS city, cents / 100::DOUBLE AS amount, status_text AS status,
          cents > 5000 AS is_high_value
        FROM known_deliveries WHERE cents IS NOT NULL AND NOT null_city AND NOT blank_city""",
    "dim_date": """
        SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date,
          dayname(date) AS day_of_week, CAST(weekofyear(date) AS INTEGER) AS week_number,
          monthname(date) AS month_name, CAST(quarter(date) AS INTEGER) AS quarter,
          CAST(year(date) AS INTEGER) AS year, dayofweek(date) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(MIN(CAST(order_date AS DATE)),
                MAX(CAST(order_date AS DATE)), INTERVAL 1 DAY)) AS DATE) AS date
              FROM deliveries_tidy)""",
    "dim_city": """
        SELECT ROW_NUMBER() OVER (ORDER BY city NULLS LAST) AS city_key, city AS city_name
        FROM (SELECT DISTINCT city FROM deliveries_tidy)""",
    "dim_status": """
        SELECT ROW_NUMBER() OVER (ORDER BY status NULLS LAST) AS status_key,
          status AS status_name
        FROM (SELECT DISTINCT status FROM deliveries_tidy)""",
    "fact_orders": """
        SELECT t.id AS order_key, d.date_key, c.city_key, s.status_key,
          TRY_CAST(t.amount AS DOUBLE) AS amount, TRY_CAST(t.amount AS DOUBLE) > 50 AS is_high_value
        FROM deliveries_tidy t LEFT JOIN dim_date d ON CAST(t.order_date AS DATE) = d.date
        LEFT JOIN dim_city c ON t.city = c.city_name
        LEFT JOIN dim_status s ON t.status = s.status_name
        WHERE t.amount IS NOT NULL""",
    "wide_orders": """
        SELECT f.order_key, f.amount, f.is_high_value, c.city_name, d.day_of_week, d.month_name,
          d.is_weekend, s.status_name
        FROM fact_orders f LEFT JOIN dim_date d ON f.date_key = d.date_key
        LEFT JOIN dim_city c ON f.city_key = c.city_key
        LEFT JOIN dim_status s ON f.status_key = s.status_key""",
    "dim_customers": """
        SELECT ROW_NUMBER() OVER (ORDER BY name NULLS LAST, email NULLS LAST) AS customer_id, *
        FROM (SELECT DISTINCT customer_name AS name, customer_email AS email FROM wide)""",
    "dim_products": """
        SELECT ROW_NUMBER() OVER (ORDER BY name NULLS LAST, category NULLS LAST,
          unit_price NULLS LAST) AS product_id, *
        FROM (SELECT DISTINCT product_name AS name, product_category AS category,
                product_price AS unit_price FROM wide)""",
    "dim_cities": """
        SELECT ROW_NUMBER() OVER (ORDER BY city_name NULLS LAST, region NULLS LAST) AS city_id, *
        FROM (SELECT DISTINCT customer_city AS city_name, customer_region AS region FROM wide)""",
    "judged": """
        SELECT r.*, k.cents / 100::DOUBLE AS parsed, COALESCE(k.cents, 0) <> 0 AS usable,
          CASE WHEN k.blank_city THEN '' WHEN NOT k.null_city THEN k.nation END AS place
        FROM deliveries_raw r JOIN known_deliveries k ON r.id = k.id""",
}
CLEAN = ["deliveries_raw", "known_deliveries", "clean_sql"]
JUDGED = ["deliveries_raw", "known_deliveries", "judged"]
DELIVERY_STEPS = ["known_deliveries", "stg_deliveries"]
TYPED = ["deliveries"]
AVERAGES = ["deliveries", "city_avgs"]
CITY_MART = [*DELIVERY_STEPS, "weather_raw", "weather_summary", "int_orders_enriched",
             "mart_city_summary"]
RESTAURANT = ["known_orders", "stg_orders", "int_orders_by_restaurant"]
DAILY = ["known_orders", "stg_restaurant_orders", "mart_restaurant_daily"]
STAR = ["deliveries_tidy", "dim_date", "dim_city", "dim_status", "fact_orders"]


# Inlining this step trips an internal assertion of the engine on larger tables.
KEPT = {"known_orders"}


def query(steps: list[str], select: str) -> str:
    named = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in KEPT else ''}({STEPS[name]})" for name in steps
    )
    return f"WITH {named}\n{select}"


def _check(table: str, column: str, name: str, condition: str) -> str:
    count = f"SELECT COUNT(*) AS n FROM {table} WHERE {condition}"
    if name == "unique":
        count = (
            f"SELECT COUNT(*) AS n FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING COUNT(*) > 1)"
        )
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{name}' AS check_name, "
        f"n AS violations, n = 0 AS passed FROM ({count})"
    )


QUALITY = " UNION ALL ".join(
    _check(table, column, name, condition or f"{column} IS NULL")
    for table, column, name, condition in [
        ("stg_deliveries", "delivery_id", "unique", ""),
        ("stg_deliveries", "delivery_id", "not_null", ""),
        ("stg_deliveries", "city", "not_null", ""),
        ("stg_deliveries", "status", "not_null", ""),
        ("stg_deliveries", "amount", "not_null", ""),
        ("stg_deliveries", "status", "accepted_values", "status NOT IN ('delivered', 'cancelled')"),
        ("stg_deliveries", "amount", "no_negative_amount_when_delivered",
         "amount < 0 AND status = 'delivered'"),
        ("stg_weather", "city", "not_null", ""),
        ("stg_weather", "avg_temp", "not_null", ""),
        ("stg_weather", "city", "unique", ""),
        ("stg_orders", "order_id", "not_null", ""),
        ("stg_orders", "order_status", "not_null", ""),
        ("stg_orders", "order_total", "not_null", ""),
        ("stg_orders", "order_id", "unique", ""),
        ("stg_orders", "order_status", "accepted_values", "order_status NOT IN ('delivered')"),
        ("stg_restaurant_orders", "order_id", "not_null", ""),
        ("stg_restaurant_orders", "order_id", "unique", ""),
        ("mart_city_summary", "city", "not_null", ""),
        ("mart_city_summary", "total_revenue", "not_null", ""),
        ("mart_city_summary", "city", "unique", ""),
        ("mart_city_summary", "total_revenue", "revenue_positive", "total_revenue <= 0"),
        ("mart_restaurant_summary", "restaurant_name", "not_null", ""),
        ("mart_restaurant_summary", "total_revenue", "not_null", ""),
        ("mart_restaurant_summary", "restaurant_name", "unique", ""),
        ("mart_restaurant_daily", "total_revenue", "not_null", ""),
    ]
).replace("stg_weather ", "weather_summary ")


def _profile(column: str) -> str:
    return f"""
        SELECT '{column}' AS column_name, CAST(SUM(n) AS BIGINT) AS row_count,
          COUNT(value) AS unique_count,
          (SELECT value FROM (SELECT CAST({column} AS VARCHAR) AS value, COUNT(*) AS n, MIN(id) AS seen
             FROM deliveries_raw WHERE {column} IS NOT NULL GROUP BY {column}
             ORDER BY n DESC, seen LIMIT 1)) AS most_common,
          CAST(COALESCE(SUM(n) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS null_count
        FROM (SELECT CAST({column} AS VARCHAR) AS value, COUNT(*) AS n FROM deliveries_raw GROUP BY {column})"""


RUNNING = query(TYPED, f"""
    SELECT id, city, order_date, amount,
      {total("amount", "OVER (PARTITION BY city ORDER BY order_date NULLS LAST)")} AS running_total
    FROM deliveries""")
RANKED = query(TYPED, """
    SELECT id, city, amount, ROW_NUMBER() OVER
      (PARTITION BY city ORDER BY amount DESC NULLS LAST, id) AS rank_in_city
    FROM deliveries""")
CHANGED = query(TYPED, """
    SELECT *, amount - prev_amount AS day_change
    FROM (SELECT id, city, order_date, amount, LAG(amount, 1) OVER
            (PARTITION BY city ORDER BY order_date NULLS LAST, id) AS prev_amount
          FROM deliveries)""")
COMPARED = query(AVERAGES, f"""
    SELECT id, city, amount, {rounded('average', 2)} AS city_avg,
      {rounded('amount - average', 2)} AS diff_from_avg
    FROM (SELECT d.*, a.average FROM deliveries d
          JOIN city_avgs a ON d.city IS NOT DISTINCT FROM a.city)""")
ABOVE = query(AVERAGES, f"""
    SELECT d.id, d.city, d.amount, d.status, {rounded('a.average', 2)} AS city_avg
    FROM deliveries d LEFT JOIN city_avgs a ON d.city = a.city WHERE d.amount > a.average""")
CITY_SUMMARY = query(CITY_MART, "SELECT * FROM mart_city_summary")
FACTS = query(STAR, "SELECT * FROM fact_orders")
DELIVERED = query([*STAR, "wide_orders"], f"""
    SELECT city_name, {total('amount')} AS total_amount
    FROM wide_orders WHERE status_name = 'delivered' GROUP BY city_name""")
CUSTOMERS = query(["wide", "dim_customers"], "SELECT * FROM dim_customers")

ORACLES: dict[str, str] = {
    "city_summary": CITY_SUMMARY,
    "city_summary_large_lookup": CITY_SUMMARY,
    "stg_deliveries": query(DELIVERY_STEPS, "SELECT * FROM stg_deliveries"),
    "stg_weather_readings": query(["weather_raw"], """
        SELECT trim(lower(city)) AS city, TRY_CAST(time AS TIMESTAMP) AS recorded_at, temperature_c
        FROM weather_raw WHERE temperature_c IS NOT NULL"""),
    "stg_orders": query(["known_orders", "stg_orders"], "SELECT * FROM stg_orders"),
    "stg_restaurant_orders": query(
        ["known_orders", "stg_restaurant_orders"], "SELECT * FROM stg_restaurant_orders"
    ),
    "weather_summary_sql": query(
        ["weather_raw", "weather_summary"], "SELECT * FROM weather_summary"
    ),
    "weather_summary_nonnull": query(
        ["weather_raw", "weather_nonnull"], "SELECT * FROM weather_nonnull"
    ),
    "orders_enriched": query([*CLEAN, "weather_raw", "weather_nonnull"], """
        SELECT o.*, r.order_date, w.* EXCLUDE (city)
        FROM clean_sql o JOIN deliveries_raw r ON o.id = r.id
        LEFT JOIN weather_nonnull w ON o.city = w.city"""),
    "int_orders_enriched": query(CITY_MART[:-1], "SELECT * FROM int_orders_enriched"),
    "warehouse_enriched": query([*CLEAN, "weather_raw", "weather_summary"], """
        SELECT o.*, w.* EXCLUDE (city)
        FROM clean_sql o LEFT JOIN weather_summary w ON o.city = w.city ORDER BY o.id"""),
    "restaurant_totals": query(RESTAURANT, "SELECT * FROM int_orders_by_restaurant"),
    "restaurant_summary": query(
        [*RESTAURANT, "mart_restaurant_summary"], "SELECT * FROM mart_restaurant_summary"
    ),
    "restaurant_daily": query(DAILY, "SELECT * FROM mart_restaurant_daily"),
    "city_orders": query(
        ["known_orders", "stg_orders", "mart_city_orders"], "SELECT * FROM mart_city_orders"
    ),
    "rank_in_city": RANKED,
    "rank_in_city_sliced": RANKED,
    "running_total": RUNNING,
    "running_total_large_lookup": RUNNING,
    "vs_city_average": COMPARED,
    "vs_city_average_large_lookup": COMPARED,
    "day_change": CHANGED,
    "day_change_sliced": CHANGED,
    "top_order": query(TYPED, """
        SELECT id, city, amount, status
        FROM (SELECT *, RANK() OVER (PARTITION BY city ORDER BY amount DESC NULLS LAST) AS place
              FROM deliveries) WHERE place = 1"""),
    "delivered_revenue": query(TYPED, f"""
        SELECT city, revenue, revenue > 100 AS exceeds_100
        FROM (SELECT city, {total('amount')} AS revenue FROM deliveries
              WHERE status = 'delivered' GROUP BY city)"""),
    "top_vs_average": query(AVERAGES, f"""
        SELECT t.city, t.amount AS top_amount, {rounded('a.average', 2)} AS city_avg,
          {rounded('t.amount - a.average', 2)} AS diff
        FROM (SELECT *, RANK() OVER (PARTITION BY city ORDER BY amount DESC NULLS LAST) AS place
              FROM deliveries) t
        LEFT JOIN city_avgs a ON t.city = a.city WHERE t.place = 1"""),
    "daily_totals": query(TYPED, f"""
        SELECT s.date, COALESCE({total('d.amount')}, 0) AS total_amount
        FROM (SELECT CAST(unnest(generate_series(MIN(order_date), MAX(order_date),
                INTERVAL 1 DAY)) AS DATE) AS date FROM deliveries) s
        LEFT JOIN deliveries d ON s.date = d.order_date GROUP BY s.date"""),
    "above_city_average": ABOVE,
    "above_city_average_correlated": query(TYPED, """
        SELECT id, city, amount, status FROM deliveries d1
        WHERE d1.amount > (SELECT AVG(d2.amount) FROM deliveries d2 WHERE d2.city = d1.city)"""),
    "dim_date": query(["deliveries_tidy", "dim_date"], "SELECT * FROM dim_date"),
    "dim_city": query(["deliveries_tidy", "dim_city"], "SELECT * FROM dim_city"),
    "dim_status": query(["deliveries_tidy", "dim_status"], "SELECT * FROM dim_status"),
    "dim_city_extended": query(["deliveries_raw"], """,
        first_load AS (
          SELECT ROW_NUMBER() OVER (ORDER BY city NULLS LAST) AS city_key, city AS city_name
          FROM (SELECT DISTINCT city FROM deliveries_raw WHERE order_date < '1995-02-01'))
        SELECT * FROM first_load
        UNION ALL
        SELECT ROW_NUMBER() OVER (ORDER BY city NULLS LAST)
            + (SELECT MAX(city_key) FROM first_load) AS city_key, city AS city_name
        FROM (SELECT DISTINCT city FROM deliveries_raw r WHERE NOT EXISTS
               (SELECT 1 FROM first_load f WHERE f.city_name IS NOT DISTINCT FROM r.city))"""),
    "fact_orders": FACTS,
    "fact_orders_large_lookup": FACTS,
    "star_weekday": query(STAR, f"""
        SELECT c.city_name AS city, s.status_name AS status, {total('f.amount')} AS total_amount,
          {rounded(mean('f.amount'), 2)} AS avg_amount, COUNT(*) AS order_count
        FROM fact_orders f LEFT JOIN dim_date d ON f.date_key = d.date_key
        LEFT JOIN dim_city c ON f.city_key = c.city_key
        LEFT JOIN dim_status s ON f.status_key = s.status_key
        WHERE d.is_weekend = false GROUP BY c.city_name, s.status_name"""),
    "wide_orders": query([*STAR, "wide_orders"], "SELECT * FROM wide_orders"),
    "delivered_normalized": DELIVERED,
    "delivered_wide": DELIVERED,
    "dim_customers": CUSTOMERS,
    "dim_customers_sliced": CUSTOMERS,
    "dim_products": query(["wide", "dim_products"], "SELECT * FROM dim_products"),
    "dim_cities": query(["wide", "dim_cities"], "SELECT * FROM dim_cities"),
    "order_lines": query(["wide", "dim_customers", "dim_products", "dim_cities"], """
        SELECT w.order_id, c.customer_id, p.product_id, t.city_id, w.quantity, w.order_date
        FROM wide w JOIN dim_customers c ON w.customer_name = c.name AND w.customer_email = c.email
        JOIN dim_products p ON w.product_name = p.name AND w.product_category = p.category
          AND w.product_price = p.unit_price
        JOIN dim_cities t ON w.customer_city = t.city_name AND w.customer_region = t.region"""),
    "dependency_report": query(["wide"], " UNION ALL ".join(
        f"""SELECT '{a}' AS determinant, '{b}' AS dependent, COUNT(*) AS determinants,
              COUNT(*) FILTER (WHERE n > 1) AS broken
            FROM (SELECT {a}, COUNT(*) AS n FROM (SELECT DISTINCT {a}, {b} FROM wide)
                  WHERE {a} IS NOT NULL GROUP BY {a})"""
        for a, b in [
            ("customer_name", "customer_email"), ("customer_city", "customer_region"),
            ("order_id", "customer_name"), ("order_id", "order_date"),
            ("product_name", "product_category"),
        ]
    )),
    # Fixed value: the price pattern.
    "price_parse": query(["texts"], r"""
        SELECT origin, id, TRY_CAST(NULLIF(regexp_extract(replace(value, ',', ''),
          '[-+]?\d*\.\d+|\d+', 0), '') AS DOUBLE) AS price FROM texts"""),
    "slug": query(["texts"], r"""
        SELECT origin, id, replace(lower(regexp_replace(value,
          '^[\s\x0b\x1c-\x1f\x{85}\p{Z}]+|[\s\x0b\x1c-\x1f\x{85}\p{Z}]+$', '', 'g')), ' ', '_')
          AS slug FROM texts"""),
    "process_orders": query(JUDGED, """
        SELECT id, place AS city, status, parsed AS amount, order_date FROM judged
        WHERE usable AND place IS NOT NULL"""),
    "rejected_orders": query(JUDGED, """
        SELECT id, city, status, amount, order_date,
          CASE WHEN usable THEN 'No city' ELSE 'No usable amount' END AS reason
        FROM judged WHERE NOT usable OR place IS NULL"""),
    "valid_failed_split": query(["known_deliveries"], """
        SELECT id, NOT (null_city OR blank_city) AS has_city,
          NOT (null_city OR blank_city OR no_amount) AS is_valid
        FROM known_deliveries"""),
    "valid_without_status": query(["known_deliveries"], """
        SELECT id, FALSE AS is_valid FROM known_deliveries"""),
    "normalized_names": "SELECT p_partkey AS id, replace(lower(p_name), ' ', '|') AS names FROM part",
    "column_profile": query(
        ["deliveries_raw"], " UNION ALL ".join(_profile(c) for c in ("id", "city", "status", "amount", "order_date"))
    ),
    "city_registry": query(["requests", "registry"], """
        SELECT q.position, q.city, r.name, r.lat, r.lon
        FROM requests q JOIN registry r ON lower(q.city) = r.name"""),
    "city_registry_unknown": query(["requests", "registry"], """
        SELECT q.position, q.city FROM requests q
        WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.name = lower(q.city))"""),
    "payload_flatten": f"""
        SELECT city, time, temperature_c
        FROM (SELECT concat('nation_', CAST(user_id % 25 AS STRING)) AS city,
                CAST(ts AS STRING) AS time,
                CASE WHEN event_id % 53 <> 0 THEN value END AS temperature_c,
                event_id // {messy.PAYLOAD_EVENTS} AS block,
                ROW_NUMBER() OVER part AS place, COUNT(*) OVER all_of AS held
              FROM events
              WINDOW part AS (PARTITION BY user_id % 25, event_id // {messy.PAYLOAD_EVENTS}
                              ORDER BY event_id),
                all_of AS (PARTITION BY user_id % 25, event_id // {messy.PAYLOAD_EVENTS}))
        WHERE place <= held - CASE WHEN block % 3 = 0 THEN 1 ELSE 0 END""",
    "quality_report": query(
        [*CITY_MART, "known_orders", "stg_orders", "int_orders_by_restaurant",
         "mart_restaurant_summary", *DAILY[1:]],
        QUALITY,
    ),
    "upsert": query(CLEAN, """
        SELECT c.id, c.city, c.amount,
          CASE WHEN r.order_date < '1999-01-01' THEN c.status
               WHEN c.amount > 50 THEN 'settled' ELSE 'open' END AS status, c.is_high_value
        FROM clean_sql c JOIN deliveries_raw r ON c.id = r.id"""),
    "history": query(["deliveries_tidy"], """,
        seen AS (
          SELECT 1 AS version, id, city, status, amount, order_date FROM deliveries_tidy
          WHERE order_date < '2001-01-01'
          UNION ALL
          SELECT 2, id, city,
            CASE WHEN order_date >= '2000-07-01' THEN 'delivered' ELSE status END, amount, order_date
          FROM deliveries_tidy
          UNION ALL
          SELECT 3, id, city,
            CASE WHEN order_date >= '2000-07-01' THEN 'delivered' ELSE status END,
            COALESCE(amount, '0.00'), order_date
          FROM deliveries_tidy WHERE order_date >= '1996-01-01'),
        compared AS (
          SELECT *, LAG(version) OVER w AS before, LAG(status) OVER w AS old_status,
            LAG(amount) OVER w AS old_amount
          FROM seen WINDOW w AS (PARTITION BY id ORDER BY version))
        SELECT id, city, status, amount, order_date, CAST(version AS BIGINT) AS valid_from,
          CAST(LEAD(version) OVER (PARTITION BY id ORDER BY version) AS BIGINT) AS valid_to
        FROM compared
        WHERE before IS NULL OR status IS DISTINCT FROM old_status
          OR amount IS DISTINCT FROM old_amount"""),
    "file_round_trip": query(["deliveries_raw"], """
        SELECT 'csv' AS format, id, NULLIF(CASE WHEN trim(city) = '' THEN '' ELSE city END, '')
          AS city, status, amount, order_date FROM deliveries_raw
        UNION ALL
        SELECT 'json' AS format, id, city, status, amount, order_date FROM deliveries_raw"""),
}

PAYLOAD_READINGS = ORACLES["payload_flatten"]
COURIER = "concat('rider ', id % 7) AS courier"
REPORTED = f"SELECT * FROM ({PAYLOAD_READINGS}) WHERE city <> 'nation_3'"
ORACLES |= {
    "split_files": query(["deliveries_raw", "known_deliveries"], f"""
        SELECT CAST(id AS VARCHAR) AS id, CASE WHEN NOT blank_city THEN city END AS city, amount,
          status, order_date, {COURIER}, NOT (null_city OR blank_city OR no_amount) AS is_valid
        FROM deliveries_raw JOIN known_deliveries USING (id)"""),
    "typed_files": query(["deliveries_raw", "known_deliveries"], """
        SELECT id, city, cents / 100::DOUBLE AS amount, status, day AS order_date,
          CASE WHEN id % 2 = 0 THEN concat('rider ', id % 7) END AS courier
        FROM deliveries_raw JOIN known_deliveries USING (id)"""),
    "process_order_files": query(JUDGED, f"""
        SELECT CAST(id AS VARCHAR) AS id, CASE WHEN reason IS NULL THEN place ELSE city END AS city,
          CASE WHEN reason IS NULL THEN parsed END AS amount, status,
          CASE WHEN reason IS NOT NULL THEN amount END AS raw_amount, reason,
          reason IS NULL AS is_valid, order_date, {COURIER}
        FROM (SELECT *, CASE
                WHEN amount IS NULL AND city IS NULL THEN 'Missing required keys: amount, city'
                WHEN amount IS NULL THEN 'Missing required keys: amount'
                WHEN city IS NULL THEN 'Missing required keys: city'
                WHEN NOT usable THEN 'No usable amount' END AS reason
              FROM judged)"""),
    "analysis_files": query([*CLEAN, "weather_raw", "weather_nonnull"], """
        SELECT o.*, r.order_date, concat('rider ', o.id % 7) AS courier, w.* EXCLUDE (city)
        FROM clean_sql o JOIN deliveries_raw r ON o.id = r.id
        LEFT JOIN weather_nonnull w ON o.city = w.city"""),
    "weather_report_files": f"""
        WITH asked AS (SELECT city, lower(city) AS name FROM ({STEPS['requests']})),
        known AS (SELECT name FROM ({STEPS['registry']}))
        SELECT 'summary' AS part, city, round_even({mean('temperature_c')} * 10, 0) / 10 AS avg_temp,
          MAX(temperature_c) AS max_temp, MIN(temperature_c) AS min_temp,
          COUNT(temperature_c) AS record_count
        FROM ({REPORTED}) WHERE city IN (SELECT name FROM asked) AND city IN (SELECT name FROM known)
        GROUP BY city
        UNION ALL
        SELECT DISTINCT 'failed', name, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
          CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT)
        FROM asked WHERE name = 'nation_3' AND name IN (SELECT name FROM known)
        UNION ALL
        SELECT 'unknown', city, NULL, NULL, NULL, COUNT(*)
        FROM asked WHERE name NOT IN (SELECT name FROM known) GROUP BY city""",
    "landed_readings": REPORTED,
    "landed_failures": f"""
        SELECT 'nation_3' AS city, COUNT(DISTINCT event_id // {messy.PAYLOAD_EVENTS}) AS payloads
        FROM events WHERE user_id % 25 = 3 HAVING COUNT(*) > 0""",
    "refusals": """
        SELECT * FROM (VALUES ('rows', 'restaurant orders is empty: nothing to load'),
          ('column', 'every record is missing field: courier'), ('key', 'occurs 2 times'),
          ('kept', NULL)) AS t(gate, said)
        UNION ALL
        SELECT 'fields', concat('record ', MIN(CAST(o_orderkey AS VARCHAR)), ' is missing field: amount')
        FROM orders WHERE o_orderkey % 71 = 0""",
    "history_table": ORACLES["history"],
    "history_as_of": f"""
        SELECT * FROM ({ORACLES["history"]})
        WHERE valid_from <= 2 AND (valid_to IS NULL OR valid_to > 2)""",
    "city_mart_two_loads": CITY_SUMMARY,
    "restaurants_in_periods": query(["known_orders", "stg_orders"], """,
        periods AS (
          SELECT * FROM (VALUES (DATE '1992-01-01', DATE '1993-06-30'),
            (DATE '1993-07-01', DATE '1996-02-29'), (DATE '1992-01-01', DATE '2005-01-01')) p(lo, hi))
        SELECT customer_city, strftime(hi, '%Y-%m-%d') AS until,
          COUNT(DISTINCT restaurant_name) AS restaurants, TRUE AS within
        FROM stg_orders JOIN periods ON CAST(ordered_at AS DATE) BETWEEN lo AND hi
        GROUP BY customer_city, hi"""),
    # All else cancels. Whole numbers of 2**-96, or 2**-110 where only small amounts are left.
    "sums_across_scales": """
        SELECT part, CASE WHEN part % 2 = 1 THEN CAST(CAST(small AS VARCHAR) AS DOUBLE) / pow(2, 110)
          ELSE CAST(CAST(usual AS VARCHAR) AS DOUBLE) / pow(2, 96) END AS total
        FROM (
          SELECT l_suppkey % 20 AS part,
            SUM(CAST(l_extendedprice * 1e-18 * pow(2, 110) AS HUGEINT)) AS small,
            SUM(CAST(l_extendedprice * 1e-18 * pow(2, 96) AS HUGEINT))
              + COALESCE(SUM(CAST(l_extendedprice * pow(2, 96) AS HUGEINT))
                  FILTER (WHERE l_linenumber = 1), 0) AS usual
          FROM lineitem GROUP BY 1)""",
    "stored_warehouse": ORACLES["warehouse_enriched"],
    "stored_star": query([*STAR[:2], "dim_city", "dim_status", "fact_orders"], """,
        first_cities AS (
          SELECT ROW_NUMBER() OVER (ORDER BY city NULLS LAST) AS city_key, city AS city_name
          FROM (SELECT DISTINCT city FROM deliveries_tidy WHERE order_date < '1995-01-15')),
        all_cities AS (
          SELECT * FROM first_cities
          UNION ALL
          SELECT ROW_NUMBER() OVER (ORDER BY city NULLS LAST)
              + (SELECT MAX(city_key) FROM first_cities), city
          FROM (SELECT DISTINCT city FROM deliveries_tidy t WHERE NOT EXISTS
                 (SELECT 1 FROM first_cities f WHERE f.city_name IS NOT DISTINCT FROM t.city)))
        SELECT f.order_key, f.date_key, k.city_key, f.amount, f.is_high_value, c.city_name,
          s.status_name
        FROM fact_orders f LEFT JOIN dim_city c ON f.city_key = c.city_key
        LEFT JOIN all_cities k ON c.city_name = k.city_name
        LEFT JOIN dim_status s ON f.status_key = s.status_key"""),
    "weather_batch_summary": CITY_SUMMARY,
    "stored_star_two_batches": query(STAR, """
        SELECT f.order_key, f.amount, f.is_high_value, c.city_name, s.status_name, d.date,
          d.day_of_week
        FROM fact_orders f LEFT JOIN dim_date d ON f.date_key = d.date_key
        LEFT JOIN dim_city c ON f.city_key = c.city_key
        LEFT JOIN dim_status s ON f.status_key = s.status_key"""),
    "stored_star_days": query(["deliveries_tidy", "dim_date"], "SELECT * FROM dim_date"),
    "restaurant_batch_daily": query(["known_orders"], f"""
        SELECT *, CASE WHEN total_revenue >= 200 THEN 'high' WHEN total_revenue >= 100 THEN 'med'
            ELSE 'low' END AS revenue_tier, NULL AS refusal
        FROM (SELECT CAST(day AS VARCHAR) AS order_date, lower(s_name) AS restaurant_name,
                COUNT(*) AS total_orders, {total('COALESCE(total, 0)')} AS total_revenue,
                {mean('COALESCE(total, 0)')} AS avg_order_value
              FROM known_orders WHERE o_orderstatus = 'F' GROUP BY day, s_name)
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL,
          concat('record ', MIN(CAST(order_id AS VARCHAR)), ' is missing field: amount')
        FROM known_orders WHERE total IS NULL"""),
}


def fix_extra_steps(sql: str) -> str:
    """A select that begins with a comma adds further named steps."""
    return sql.replace(")\n,", "),")


ORACLES = {name: fix_extra_steps(sql) for name, sql in ORACLES.items()}
ORACLES["process_order_arrays"] = ORACLES["process_order_files"]
