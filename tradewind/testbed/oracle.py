"""The same results in plain SQL over the test tables, for the side-by-side check."""

from __future__ import annotations

from tradewind.testbed.raw import FLAWS


def ratio(num: str, den: str, places: int = 2, factor: int = 1) -> str:
    """Half-up rounded quotient in exact integer arithmetic, as a double."""
    n, d = f"CAST(({num}) * 100 AS HUGEINT)", f"CAST(({den}) * 100 AS HUGEINT)"
    scaled = f"(2 * abs({n}) * {factor * 10**places} + abs({d})) // (2 * abs({d}))"
    return (
        f"CASE WHEN ({den}) <> 0 THEN CAST(sign({n}) * sign({d}) * ({scaled}) AS DOUBLE) / {10**places} END"
    )


def pct(num: str, den: str) -> str:
    return ratio(num, den, 2, 100)


def title(c: str) -> str:
    return (
        "array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN "
        f"regexp_extract_all(trim({c}, ' ' || chr(9)), '[A-Za-z]+|[^A-Za-z]+')], '')"
    )


def upper(c: str) -> str:
    return f"upper(trim({c}, ' ' || chr(9)))"


def date_key(c: str) -> str:
    return f"(year({c}) * 10000 + month({c}) * 100 + day({c}))"


def floor_days(a: str, b: str) -> str:
    return f"CAST(floor((epoch({a}) - epoch({b})) / 86400) AS INTEGER)"


# Common table expressions by name: the tables they use, and the SQL.
CTES: dict[str, tuple[list[str], str]] = {
    "raw_orders": (
        [],
        """SELECT CAST(k AS VARCHAR) AS order_id, CAST(k AS VARCHAR) AS customer_id, status AS order_status,
          CAST(p AS VARCHAR) AS order_purchase_timestamp,
          CASE WHEN k % 600 <> 11 THEN CAST(p + to_seconds((k * 13) % 7200) AS VARCHAR) END AS order_approved_at,
          CASE WHEN k % 700 = 5 THEN 'not a date' WHEN status IN ('delivered', 'shipped')
            THEN CAST(p + to_seconds(t // 2) AS VARCHAR) END AS order_delivered_carrier_date,
          CASE WHEN status = 'delivered' AND k % 1000 <> 7
            THEN CAST(p + to_seconds(t) AS VARCHAR) END AS order_delivered_customer_date,
          CAST(o_orderdate + to_days(CAST(20 + k % 11 AS INTEGER)) AS VARCHAR) AS order_estimated_delivery_date
        FROM (SELECT o_orderkey AS k, o_orderdate,
            CASE WHEN o_orderkey % 40 = 0 THEN 'canceled' WHEN o_orderkey % 40 = 1 THEN 'unavailable'
              WHEN o_orderstatus = 'P' THEN 'shipped' ELSE 'delivered' END AS status,
            o_orderdate + to_seconds((o_orderkey * 37) % 86400) AS p, (o_orderkey * 7919) % 3000000 AS t
          FROM orders)""",
    ),
    "raw_order_items": (
        [],
        """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
          CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
          l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
          CAST(l_quantity AS DECIMAL(12,2)) AS freight_value
        FROM lineitem""",
    ),
    "raw_order_payments": (
        [],
        """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(n AS INTEGER) AS payment_sequential,
          CASE WHEN n = 2 THEN 'voucher' WHEN o_orderkey % 5000 = 3 THEN 'not_defined'
            ELSE lower(substr(o_orderpriority, 3)) END AS payment_type,
          CAST(CASE n WHEN 2 THEN 1 ELSE o_orderkey % 13 END AS INTEGER) AS payment_installments,
          CAST(CASE n WHEN 2 THEN 10 ELSE o_totalprice END AS DECIMAL(12,2)) AS payment_value
        FROM (SELECT *, unnest(range(1, CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 2 END)) AS n FROM orders)""",
    ),
    "raw_order_reviews": (
        [],
        """SELECT 'r' || o_orderkey || CASE n WHEN 2 THEN 'b' ELSE '' END AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
          CAST(CASE n WHEN 2 THEN 1 ELSE 1 + (o_orderkey * 31) % 97 % 5 END AS INTEGER) AS review_score,
          CASE WHEN n = 1 AND o_orderkey % 2 = 1 THEN 'title ' || o_orderkey END AS review_comment_title,
          CASE WHEN n = 1 AND o_orderkey % 3 <> 0
            THEN 'says "fine", order ' || o_orderkey || chr(10) || 'thanks' END AS review_comment_message,
          o_orderdate + to_days(CAST(20 + o_orderkey % 11 + later AS INTEGER)) AS review_creation_date,
          o_orderdate + to_days(CAST(22 + o_orderkey % 11 + later AS INTEGER)) AS review_answer_timestamp
        FROM (SELECT *, CASE WHEN n = 2 AND o_orderkey % 200 <> 1 THEN 1 ELSE 0 END AS later FROM (
          SELECT *, unnest(range(1, CASE WHEN o_orderkey % 50 = 3 THEN 1 WHEN o_orderkey % 20 = 1 THEN 3 ELSE 2 END)) AS n
          FROM orders))""",
    ),
    "raw_customers": (
        [],
        """SELECT CAST(o_orderkey AS VARCHAR) AS customer_id, CAST(o_custkey AS VARCHAR) AS customer_unique_id,
          CAST(o_custkey % 500 AS INTEGER) AS customer_zip_code_prefix,
          '  ' || lower(c_mktsegment) || '-mirim d''oeste ' || chr(9) AS customer_city, lower(n_name) || ' ' AS customer_state
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    ),
    "raw_sellers": (
        [],
        """SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_suppkey % 500 AS INTEGER) AS seller_zip_code_prefix,
          ' ' || lower(s_name) AS seller_city, lower(n_name) AS seller_state
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    ),
    "raw_products": (
        [],
        """SELECT CAST(p_partkey AS VARCHAR) AS product_id,
          CASE WHEN p_partkey % 50 <> 0 THEN lower(p_brand) END AS product_category_name,
          length(p_name) AS product_name_lenght, length(p_type) AS product_description_lenght,
          p_size % 7 AS product_photos_qty, CASE WHEN p_partkey % 97 <> 5 THEN p_size * 100 END AS product_weight_g,
          CASE WHEN p_partkey % 97 <> 5 THEN p_size END AS product_length_cm,
          CASE WHEN p_partkey % 97 <> 5 THEN p_size + 1 END AS product_height_cm,
          CASE WHEN p_partkey % 97 <> 5 THEN p_size + 2 END AS product_width_cm
        FROM part""",
    ),
    "raw_translation": (
        [],
        """SELECT DISTINCT lower(p_brand) AS product_category_name, p_brand AS product_category_name_english
        FROM part WHERE p_brand <> 'Brand#13'""",
    ),
    "raw_geolocation": (
        [],
        """SELECT CAST(c_custkey % 500 AS INTEGER) AS geolocation_zip_code_prefix, c_acctbal / 100 AS geolocation_lat,
          -c_acctbal / 200 AS geolocation_lng, lower(c_mktsegment) AS geolocation_city, lower(n_name) AS geolocation_state
        FROM (SELECT *, unnest(range(CASE WHEN c_custkey % 7 = 0 THEN 2 ELSE 1 END)) AS copy FROM customer)
        JOIN nation ON n_nationkey = c_nationkey""",
    ),
    "parsed_orders": (
        ["raw_orders"],
        """SELECT order_id, customer_id, order_status,
          TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
          TRY_CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
          TRY_CAST(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_date,
          TRY_CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_date,
          TRY_CAST(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_date
        FROM raw_orders""",
    ),
    "stg_orders": (
        ["parsed_orders"],
        f"""SELECT *,
          {floor_days('order_delivered_customer_date', 'order_purchase_timestamp')} AS delivery_days,
          {floor_days('order_estimated_delivery_date', 'order_purchase_timestamp')} AS estimated_days,
          {floor_days('order_delivered_customer_date', 'order_estimated_delivery_date')} AS delivery_delay_days,
          order_status = 'delivered' AS is_delivered, order_status = 'canceled' AS is_cancelled,
          {floor_days('order_delivered_customer_date', 'order_estimated_delivery_date')} > 0 AS is_late
        FROM parsed_orders""",
    ),
    "stg_order_items": (["raw_order_items"], "SELECT * FROM raw_order_items"),
    "stg_order_payments": (
        ["raw_order_payments"],
        """SELECT order_id, payment_sequential, payment_type,
          CASE payment_installments WHEN 0 THEN 1 ELSE payment_installments END AS payment_installments, payment_value
        FROM raw_order_payments""",
    ),
    "stg_order_reviews": (
        ["raw_order_reviews"],
        """SELECT * FROM raw_order_reviews
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_creation_date DESC NULLS LAST, review_id) = 1""",
    ),
    "stg_customers": (
        ["raw_customers"],
        f"""SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
          {title('customer_city')} AS customer_city, {upper('customer_state')} AS customer_state FROM raw_customers""",
    ),
    "stg_sellers": (
        ["raw_sellers"],
        f"""SELECT seller_id, seller_zip_code_prefix, {title('seller_city')} AS seller_city,
          {upper('seller_state')} AS seller_state FROM raw_sellers""",
    ),
    "stg_products": (
        ["raw_products", "raw_translation"],
        """SELECT product_id, coalesce(p.product_category_name, 'unknown') AS product_category_name,
          CAST(product_name_lenght AS DOUBLE) AS product_name_length,
          CAST(product_description_lenght AS DOUBLE) AS product_description_length,
          CAST(product_photos_qty AS DOUBLE) AS product_photos_qty, CAST(product_weight_g AS DOUBLE) AS product_weight_g,
          CAST(product_length_cm AS DOUBLE) AS product_length_cm, CAST(product_height_cm AS DOUBLE) AS product_height_cm,
          CAST(product_width_cm AS DOUBLE) AS product_width_cm,
          coalesce(t.product_category_name_english, 'Unknown') AS product_category_name_english
        FROM raw_products p LEFT JOIN raw_translation t ON t.product_category_name = p.product_category_name""",
    ),
    "geo_points": (
        ["raw_geolocation"],
        """SELECT DISTINCT geolocation_zip_code_prefix AS zip, geolocation_lat AS lat, geolocation_lng AS lng,
          geolocation_city AS city, geolocation_state AS state FROM raw_geolocation""",
    ),
    "stg_geolocation": (
        ["geo_points"],
        f"""SELECT m.zip, m.lat, m.lng, {title('c.city')} AS city, {upper('s.state')} AS state
        FROM (SELECT zip, avg(lat) AS lat, avg(lng) AS lng FROM geo_points GROUP BY zip) m
        JOIN (SELECT zip, city FROM geo_points GROUP BY zip, city
          QUALIFY row_number() OVER (PARTITION BY zip ORDER BY count(*) DESC, city) = 1) c ON c.zip = m.zip
        JOIN (SELECT zip, state FROM geo_points GROUP BY zip, state
          QUALIFY row_number() OVER (PARTITION BY zip ORDER BY count(*) DESC, state) = 1) s ON s.zip = m.zip""",
    ),
    # Model tables carry natural keys here; surrogate keys are joined back to them before comparing.
    "day_bounds": (
        ["stg_orders", "stg_order_reviews"],
        """SELECT min(d) AS lo, max(d) AS hi FROM (
          SELECT unnest([order_purchase_timestamp, order_delivered_customer_date, order_estimated_delivery_date]) AS d FROM stg_orders
          UNION ALL SELECT review_creation_date FROM stg_order_reviews)""",
    ),
    "dim_date": (
        ["day_bounds"],
        """SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
          year(d) AS year, quarter(d) AS quarter, 'Q' || quarter(d) AS quarter_label, month(d) AS month,
          monthname(d) AS month_name, left(monthname(d), 3) AS month_short, strftime(d, '%Y-%m') AS year_month,
          day(d) AS day_of_month, isodow(d) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(make_date(year(lo), 1, 1), make_date(year(hi), 12, 31), INTERVAL 1 DAY)) AS d
          FROM day_bounds)""",
    ),
    "dim_customer": (
        ["stg_customers", "stg_geolocation"],
        """SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code_prefix, customer_city AS city,
          customer_state AS state, lat AS latitude, lng AS longitude
        FROM stg_customers LEFT JOIN (SELECT zip, lat, lng FROM stg_geolocation) g ON g.zip = customer_zip_code_prefix""",
    ),
    "dim_seller": (
        ["stg_sellers", "stg_geolocation"],
        """SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix, seller_city AS city, seller_state AS state,
          lat AS latitude, lng AS longitude
        FROM stg_sellers LEFT JOIN (SELECT zip, lat, lng FROM stg_geolocation) g ON g.zip = seller_zip_code_prefix""",
    ),
    "dim_product": (
        ["stg_products"],
        """SELECT product_id, product_category_name AS category_name, product_category_name_english AS category_name_english,
          product_weight_g AS weight_g, product_length_cm AS length_cm, product_height_cm AS height_cm,
          product_width_cm AS width_cm, product_photos_qty AS photos_qty FROM stg_products""",
    ),
    "fact_orders": (
        ["stg_orders", "stg_customers"],
        f"""SELECT order_id, customer_id, customer_unique_id, customer_state AS state,
          {date_key('order_purchase_timestamp')} AS purchase_date_key,
          {date_key('order_delivered_customer_date')} AS delivered_date_key,
          {date_key('order_estimated_delivery_date')} AS estimated_date_key,
          strftime(order_purchase_timestamp, '%Y-%m') AS year_month, year(order_purchase_timestamp) AS year,
          order_status, order_purchase_timestamp AS purchase_timestamp, delivery_days, estimated_days, delivery_delay_days,
          is_delivered, is_cancelled, is_late
        FROM stg_orders JOIN stg_customers USING (customer_id)""",
    ),
    "fact_order_items": (
        ["fact_orders", "stg_order_items", "stg_products", "stg_sellers"],
        """SELECT i.order_id, i.order_item_id, o.customer_id, o.customer_unique_id, o.state, i.product_id,
          p.product_category_name_english AS category, i.seller_id, s.seller_state, o.purchase_date_key, o.year_month, o.year,
          o.order_status, i.price, i.freight_value
        FROM stg_order_items i JOIN fact_orders o USING (order_id) JOIN stg_products p USING (product_id)
        JOIN stg_sellers s USING (seller_id)""",
    ),
    "fact_payments": (
        ["fact_orders", "stg_order_payments"],
        """SELECT p.*, o.customer_id, o.state, o.purchase_date_key, o.year_month, o.year, o.order_status
        FROM stg_order_payments p JOIN fact_orders o USING (order_id)""",
    ),
    "fact_reviews": (
        ["fact_orders", "stg_order_reviews"],
        f"""SELECT r.review_id, r.order_id, o.customer_id, o.state, o.purchase_date_key, o.year_month, o.year,
          {date_key('r.review_creation_date')} AS review_date_key, r.review_score,
          r.review_comment_message IS NOT NULL AS has_comment, r.review_score <= 2 AS is_negative,
          r.review_score >= 4 AS is_positive
        FROM stg_order_reviews r JOIN fact_orders o USING (order_id)""",
    ),
    **{
        f"months_{name}": (
            ["fact_order_items"],
            f"""SELECT g.*, no, printf('%04d-%02d', no // 12, no % 12 + 1) AS year_month, no // 12 AS year, value
            FROM (SELECT DISTINCT {by}, unnest(range((SELECT min(CAST(left(year_month, 4) AS INTEGER) * 12
                + CAST(right(year_month, 2) AS INTEGER) - 1) FROM fact_order_items WHERE {where}),
                (SELECT max(CAST(left(year_month, 4) AS INTEGER) * 12 + CAST(right(year_month, 2) AS INTEGER))
                FROM fact_order_items WHERE {where}))) AS no
              FROM fact_order_items WHERE {where}) g
            LEFT JOIN (SELECT {by}, CAST(left(year_month, 4) AS INTEGER) * 12 + CAST(right(year_month, 2) AS INTEGER) - 1 AS no,
              sum(price) AS value FROM fact_order_items WHERE {where} GROUP BY ALL) v USING ({by}, no)""",
        )
        for name, by, where in (
            ("category", "category", "state <> 'NATION_3'"),
            ("state_category", "state, category", "true"),
        )
    },
    "monthly": (
        ["fact_order_items"],
        "SELECT year_month, year, sum(price) AS value, count(DISTINCT order_id) AS orders FROM fact_order_items GROUP BY ALL",
    ),
}


# Raw tables with the planted faults, all as text, and the staging tables that read them leniently.
def _flawed() -> dict[str, tuple[list[str], str]]:
    columns: dict[str, dict[str, str]] = {}
    for entity, column, where, text in FLAWS:
        mine = columns.setdefault(f"raw_{entity}", {})
        value = "NULL" if text is None else f"'{text}'"
        mine[column] = f"CASE WHEN {where} THEN {value} ELSE {mine.get(column, f'CAST({column} AS VARCHAR)')} END"
    out: dict[str, tuple[list[str], str]] = {}
    for name, changed in columns.items():
        needed, sql = CTES[name]
        replaced = ", ".join(f"{value} AS {c}" for c, value in changed.items())
        out[name] = (needed, f"SELECT * REPLACE ({replaced}) FROM ({sql})")
    typed = {
        "raw_order_items": {"price": "DECIMAL(12,2)", "order_item_id": "INTEGER"},
        "raw_order_payments": {"payment_installments": "INTEGER", "payment_value": "DECIMAL(12,2)"},
        "raw_order_reviews": {"review_score": "INTEGER"},
        "raw_customers": {"customer_zip_code_prefix": "INTEGER"},
        "raw_products": {"product_weight_g": "DOUBLE"},
        "raw_geolocation": {"geolocation_lat": "DOUBLE", "geolocation_zip_code_prefix": "INTEGER"},
    }
    for name, kinds in typed.items():
        casts = ", ".join(f"TRY_CAST({c} AS {kind}) AS {c}" for c, kind in kinds.items())
        out[f"fit_{name}"] = ([name], f"SELECT * REPLACE ({casts}) FROM {name}")
    for name in ("stg_order_items", "stg_order_payments", "stg_order_reviews", "stg_customers", "stg_products", "geo_points"):
        needed, sql = CTES[name]
        for raw in typed:
            if raw in needed:
                needed = [f"fit_{n}" if n == raw else n for n in needed]
                sql = sql.replace(f"FROM {raw}", f"FROM fit_{raw}")
        out[name] = (needed, sql)
    needed, sql = CTES["stg_geolocation"]
    out["stg_geolocation"] = (needed, sql.replace("FROM geo_points", "FROM (SELECT * FROM geo_points WHERE zip IS NOT NULL)"))
    return out


FLAWED_CTES = CTES | _flawed()


def _closure(names: list[str], tables: dict[str, tuple[list[str], str]]) -> list[str]:
    seen: list[str] = []

    def visit(name: str) -> None:
        if name in seen:
            return
        for needed in tables[name][0]:
            visit(needed)
        seen.append(name)

    for name in names:
        visit(name)
    return seen


def with_tables(tables: str, select: str, flawed: bool = False) -> str:
    """``select`` with the named tables, and all they use, in front."""
    known = FLAWED_CTES if flawed else CTES
    parts = [f"{n} AS MATERIALIZED ({known[n][1]})" for n in _closure(tables.split(), known)]
    return "WITH " + ",\n".join(parts) + "\n" + select
