"""Every operator and question as a named query over the test tables, with its SQL.

Queries share one warehouse per session and data folder: staging and model tables
are derived from the given tables, written once and read by all later queries.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import date_key
from tradewind.operators import cleaning, ledger, profiling, quality, reconcile
from tradewind.operators.audit import decision_log
from tradewind.plans import metrics, prepare, profile, questions, reports, star, validate
from tradewind.plans.slicing import Between
from tradewind.plans.warehouse import DIMENSIONS, FACTS, Warehouse
from tradewind.session import work_dir
from tradewind.sources import files
from tradewind.sources.schemas import ORDER_DATES, RAW_COLUMNS, REQUIRED_RAW, ROW_KEYS, STAGING_TYPES, raw_types
from tradewind.sources.versions import Versions
from tradewind.testbed.oracle import date_key as sql_date_key
from tradewind.testbed.oracle import pct, ratio, title, upper, with_tables
from tradewind.testbed.raw import RawTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_warehouses: dict[tuple[str, str, bool], Warehouse] = {}
_lock = threading.RLock()


def warehouse(spark: SparkSession, folder: str, flawed: bool = False) -> Warehouse:
    """The shared warehouse of a data folder; a flawed one is built from raw tables with planted faults."""
    key = (spark.sparkContext.applicationId, str(folder).rstrip("/"), flawed)
    with _lock:
        if key not in _warehouses:
            _warehouses[key] = Warehouse(spark, RawTables(spark, key[1], flawed), work_dir(spark))
        return _warehouses[key]


def portable(df: DataFrame) -> DataFrame:
    """Column types that every client compares alike: exact decimals as doubles, dates as text."""

    def plain(field):
        kind = field.dataType.typeName()
        if kind == "decimal":
            return F.col(field.name).cast("double").alias(field.name)
        if kind in ("date", "timestamp", "timestamp_ntz"):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str, tables: str, sql: str, flawed: bool = False):
    def register(build: Callable[[Warehouse], DataFrame]):
        QUERIES[name] = lambda spark, folder: portable(build(warehouse(spark, folder, flawed)))
        ORACLE[name] = with_tables(tables, sql, flawed)
        return build

    return register


def union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def col_list(columns: list[str], text: tuple[str, ...] = ()) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in text else c for c in columns)


MONEY = "CAST({0} AS DOUBLE) AS {1}"


def money(expr: str, name: str) -> str:
    return MONEY.format(expr, name)


RAW_SQL = {e: f"raw_{e}" for e in RAW_COLUMNS} | {"product_category_name_translation": "raw_translation"}
ALL_RAW = " ".join(RAW_SQL.values())
ALL_STAGED = " ".join(f"stg_{e}" for e in STAGING_TYPES)
ALL_FACTS = " ".join(FACTS)

# ---------------------------------------------------------------- sources and sinks


def _csv_folder(wh: Warehouse, entities: list[str]) -> str:
    """The raw entities as delimited files, written anew by each query that reads them."""
    folder = f"{wh.root}/raw_csv"
    for e in entities:
        files.write_csv(wh.raw(e), f"{folder}/{e}.csv")
    return folder


@query(
    "scan_catalog",
    ALL_RAW,
    union_sql(
        [
            f"SELECT '{e}' AS entity, count(*) AS entity_rows, {len(RAW_COLUMNS[e])} AS entity_columns FROM {RAW_SQL[e]}"
            for e in sorted(RAW_COLUMNS)
        ]
    ),
)
def _(wh):
    catalog = files.scan_catalog(wh.spark, _csv_folder(wh, list(RAW_COLUMNS)))
    return profiling.union_all(
        [
            df.agg(F.count(F.lit(1)).alias("entity_rows")).select(
                F.lit(e).alias("entity"), "entity_rows", F.lit(len(df.columns)).alias("entity_columns")
            )
            for e, df in catalog.items()
        ]
    )


@query(
    "scan_csv",
    "raw_order_reviews",
    "SELECT "
    + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in RAW_COLUMNS["order_reviews"])
    + " FROM raw_order_reviews",
)
def _(wh):
    folder = _csv_folder(wh, ["order_reviews"])
    return files.read_entity(wh.spark, f"{folder}/order_reviews.csv", "order_reviews")


_STAGED_COUNTS = [f"SELECT 'stg_{e}' AS table_name, count(*) AS row_count FROM stg_{e}" for e in STAGING_TYPES]


@query("write_clean", ALL_STAGED, union_sql(_STAGED_COUNTS))
def _(wh):
    written = {
        f"stg_{e}": files.write_table(prepare.PREPARE[e](wh.raw), f"{wh.root}/clean_{e}") for e in prepare.PREPARE
    }
    return quality.row_counts(written)


@query(
    "stage_typed",
    "stg_order_items",
    "SELECT order_id, order_item_id, product_id, seller_id, CAST(shipping_limit_date AS VARCHAR) AS shipping_limit_date, "
    f"{money('price', 'price')}, {money('freight_value', 'freight_value')} FROM stg_order_items",
)
def _(wh):
    return wh.staged("order_items")


_GEO_SQL = {
    "geolocation_zip_code_prefix": "zip",
    "geolocation_lat": "lat",
    "geolocation_lng": "lng",
    "geolocation_city": "city",
    "geolocation_state": "state",
}


def _content_sql(column: str, kind: str) -> str:
    if kind == "string":
        return f"length({column})"
    if kind == "boolean":
        return f"CAST({column} AS INTEGER)"
    if kind == "timestamp_ntz":
        return f"({sql_date_key(column)} * 100 + hour({column}))"
    return f"CAST({column} AS DECIMAL(20,8))"


def _content(column: str, kind: str):
    c = F.col(column)
    if kind == "string":
        return F.length(c)
    if kind == "boolean":
        return c.cast("int")
    if kind == "timestamp_ntz":
        return date_key(c).cast("long") * 100 + F.hour(c)
    return c.cast("decimal(20,8)")


_TYPED_SQL = union_sql(
        [
            f"SELECT 'stg_{e}' AS table_name, '{c}' AS column_name, count(*) AS table_rows, count({s}) AS non_null, "
            f"CAST(round(CAST(sum({_content_sql(s, t)}) AS DECIMAL(38,8)), 4) AS DOUBLE) AS content_sum FROM stg_{e}"
            for e, types in STAGING_TYPES.items()
            for c, t in types.items()
            for s in [_GEO_SQL.get(c, c)]
        ]
    )


@query("stage_typed_columns_flawed", ALL_STAGED, _TYPED_SQL, flawed=True)
@query("stage_typed_columns", ALL_STAGED, _TYPED_SQL)
def _(wh):
    """Every column of every typed staging table: rows, values, and a sum over what the values hold."""
    tables = []
    for e, types in STAGING_TYPES.items():
        sums = [F.round(F.sum(_content(c, t)), 4).cast("double") for c, t in types.items()]
        totals = wh.staged(e).agg(
            F.count(F.lit(1)).alias("table_rows"),
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.count(c).alias("non_null"), s.alias("content_sum"))
                    for c, s in zip(types, sums, strict=True)
                ]
            ).alias("columns"),
        )
        tables.append(totals.select(F.lit(f"stg_{e}").alias("table_name"), "table_rows", F.inline("columns")))
    return profiling.union_all([t.select("table_name", "column_name", "table_rows", "non_null", "content_sum") for t in tables])


@query(
    "stage_verify",
    ALL_STAGED,
    f"SELECT * FROM ({union_sql(_STAGED_COUNTS)}) "
    f"UNION ALL SELECT 'TOTAL', CAST(sum(row_count) AS BIGINT) FROM ({union_sql(_STAGED_COUNTS)})",
)
def _(wh):
    return quality.with_total(quality.row_counts({f"stg_{e}": wh.staged(e) for e in STAGING_TYPES}))


_SQL_TYPES = {"int": "INTEGER", "double": "DOUBLE", "decimal(12,2)": "DECIMAL(12,2)", "timestamp_ntz": "TIMESTAMP"}


def _lost_sql(entity: str) -> list[tuple[str, str, str, bool, str]]:
    """Column, type, reason, whether it stops a run, and condition of every way to lose a cell."""
    ways = []
    for c, kind in raw_types(entity).items():
        required = c in REQUIRED_RAW[entity]
        if required:
            ways.append((c, kind, "missing", True, f"{c} IS NULL"))
        if kind != "string":
            unfit = f"({c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS {_SQL_TYPES[kind]}) IS NULL)"
            ways.append((c, kind, f"not {kind}", required or kind != "timestamp_ntz", unfit))
    return ways


def _any_lost(entity: str, missing: bool) -> str:
    ways = [w for _, _, reason, stops, w in _lost_sql(entity) if stops and (reason == "missing") == missing]
    return " OR ".join(ways) or "false"


def _unparsed_sql(columns: list[str]) -> str:
    return " OR ".join(f"({c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS TIMESTAMP) IS NULL)" for c in columns)


_AUDIT_SQL = union_sql(
    [
        "SELECT 'orders' AS entity, 'text that is no timestamp set to null' AS rule, count(*) AS rows_before, "
        f"count(*) AS rows_after, count(*) FILTER ({_unparsed_sql(ORDER_DATES)}) AS rows_changed FROM raw_orders",
        "SELECT 'orders', 'missing delivery date kept as null', count(*), count(*), "
        "count(*) FILTER (order_delivered_customer_date IS NULL) FROM stg_orders",
        "SELECT 'orders', 'lateness left null without delivery date', count(*), count(*), "
        "count(*) FILTER (is_late IS NULL) FROM stg_orders",
        "SELECT 'order_items', 'text that is no timestamp set to null', count(*), count(*), 0 FROM raw_order_items",
        "SELECT 'order_payments', 'zero installments set to one', count(*), count(*), "
        "count(*) FILTER (TRY_CAST(payment_installments AS INTEGER) = 0) FROM raw_order_payments",
        "SELECT 'order_payments', 'undefined payment type kept and flagged', count(*), count(*), "
        "count(*) FILTER (payment_type = 'not_defined') FROM raw_order_payments",
        "SELECT 'order_reviews', 'latest review per order kept', (SELECT count(*) FROM raw_order_reviews), count(*), 0 "
        "FROM stg_order_reviews",
        "SELECT 'order_reviews', 'missing comment kept as null', (SELECT count(*) FROM raw_order_reviews), count(*), "
        "count(*) FILTER (review_comment_message IS NULL) FROM stg_order_reviews",
        "SELECT 'customers', 'city and state case settled', count(*), count(*), count(*) FILTER ("
        f"customer_city <> {title('customer_city')} OR customer_state <> {upper('customer_state')}) FROM raw_customers",
        "SELECT 'sellers', 'city and state case settled', count(*), count(*), count(*) FILTER ("
        f"seller_city <> {title('seller_city')} OR seller_state <> {upper('seller_state')}) FROM raw_sellers",
        "SELECT 'products', 'missing category labelled', count(*), count(*), "
        "count(*) FILTER (product_category_name = 'unknown') FROM stg_products",
        "SELECT 'products', 'missing translation labelled', count(*), count(*), "
        "count(*) FILTER (product_category_name_english = 'Unknown') FROM stg_products",
        "SELECT 'geolocation', 'exact duplicates removed', (SELECT count(*) FROM raw_geolocation), count(*), 0 FROM geo_points",
        "SELECT 'geolocation', 'points merged per zip prefix', (SELECT count(*) FROM geo_points), count(*), 0 FROM stg_geolocation",
        "SELECT 'order_reviews', 'text that is no timestamp set to null', count(*), count(*), 0 FROM raw_order_reviews",
        *[
            f"SELECT '{e}', '{rule}', count(*), count(*), count(*) FILTER ({_any_lost(e, missing)}) FROM raw_{e}"
            for e in STAGING_TYPES
            for rule, missing in (("value that does not fit its type set to null", False), ("required value missing", True))
        ],
    ]
)
_AUDIT_TABLES = (
    f"{' '.join(f'raw_{e}' for e in STAGING_TYPES)} geo_points {ALL_STAGED}"
)


_DECISION_SQL = (
    "SELECT entity, rule, entity || ': ' || rule || ': ' || CASE WHEN rows_before > rows_after "
    "THEN format('{:,} rows reduced to {:,}', rows_before, rows_after) "
    f"ELSE format('{{:,}} of {{:,}} rows', rows_changed, rows_after) END AS message FROM ({_AUDIT_SQL})"
)


@query("cleaning_audit_flawed", _AUDIT_TABLES, _AUDIT_SQL, flawed=True)
@query("cleaning_audit", _AUDIT_TABLES, _AUDIT_SQL)
def _(wh):
    return prepare.cleaning_audit(wh.raw, wh.staged)


@query("decision_log_flawed", _AUDIT_TABLES, _DECISION_SQL, flawed=True)
@query("decision_log", _AUDIT_TABLES, _DECISION_SQL)
def _(wh):
    return decision_log(prepare.cleaning_audit(wh.raw, wh.staged))


def _row_key_sql(entity: str) -> str:
    def text(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN 'null' ELSE '\"' || CAST({c} AS VARCHAR) || '\"' END"

    return " || ',' || ".join(f"'\"{c}\":' || {text(c)}" for c in ROW_KEYS[entity])


@query(
    "ledger",
    " ".join(f"raw_{e}" for e in STAGING_TYPES),
    union_sql(
        [
            f"SELECT '{e}' AS entity, {'NULL' if e == 'geolocation' else f"'{{' || {_row_key_sql(e)} || '}}'"} AS row_key, "
            f"'{c}' AS column_name, '{kind}' AS declared, '{reason}' AS reason, CAST({c} AS VARCHAR) AS value, "
            f"{str(stops).lower()} AS stops FROM raw_{e} WHERE {way}"
            for e in STAGING_TYPES
            for c, kind, reason, stops, way in _lost_sql(e)
        ]
    ),
    flawed=True,
)
def _(wh):
    """Every cell lost from flawed raw tables. Points have no key but their coordinates, which print differently in SQL."""
    return wh.ledger.withColumn("row_key", F.when(F.col("entity") != "geolocation", F.col("row_key")))


@query(
    "ledger_summary",
    " ".join(f"raw_{e}" for e in STAGING_TYPES),
    union_sql(
        [
            f"SELECT '{e}' AS entity, '{c}' AS column_name, '{kind}' AS declared, '{reason}' AS reason, "
            f"{str(stops).lower()} AS stops, count(*) AS cells, min(CAST({c} AS VARCHAR)) AS first_value, "
            f"max(CAST({c} AS VARCHAR)) AS last_value FROM raw_{e} WHERE {way} HAVING count(*) > 0"
            for e in STAGING_TYPES
            for c, kind, reason, stops, way in _lost_sql(e)
        ]
    ),
    flawed=True,
)
def _(wh):
    return ledger.summary(wh.ledger)


_MODEL_COUNTS = [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in DIMENSIONS + FACTS]
_MODEL_SQL = union_sql(_MODEL_COUNTS)


@query("model_row_counts", " ".join(DIMENSIONS + FACTS), _MODEL_SQL)
def _(wh):
    return quality.row_counts({t: wh.table(t) for t in DIMENSIONS + FACTS})


@query(
    "rebuild_model",
    " ".join(DIMENSIONS + FACTS),
    f"SELECT table_name, row_count AS first_build, row_count AS second_build FROM ({_MODEL_SQL})",
)
def _(wh):
    """A version built anew, published after its checks, and opened; the one before the last is retired."""

    def check(new: Warehouse) -> list[str]:
        reports = {"row counts": validate.row_counts(new), "money totals": validate.money_totals(new)}
        return [name for name, report in reports.items() if not report.filter("not passed").isEmpty()]

    versions = Versions(wh.spark, wh.root)
    Warehouse(wh.spark, wh.raw, wh.root, staging=wh).rebuild_model(check, versions)
    versions.retire(keep=2)
    other = Warehouse.open(wh.spark, wh.root, wh.raw)
    first, second = (
        quality.row_counts({t: w.table(t) for t in DIMENSIONS + FACTS}).withColumnRenamed("row_count", name)
        for w, name in ((wh, "first_build"), (other, "second_build"))
    )
    return first.join(second, "table_name")


# ---------------------------------------------------------------- profiling


@query(
    "profile_table",
    ALL_STAGED,
    union_sql(
        [
            f"SELECT 'stg_{e}' AS table_name, {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, "
            f"count(*) AS table_rows, {len(types)} AS table_columns, count(*) FILTER ({sql} IS NULL) AS nulls FROM stg_{e}"
            for e, types in STAGING_TYPES.items()
            for i, (c, t) in enumerate(types.items())
            for sql in [
                {
                    "geolocation_zip_code_prefix": "zip",
                    "geolocation_lat": "lat",
                    "geolocation_lng": "lng",
                    "geolocation_city": "city",
                    "geolocation_state": "state",
                }.get(c, c)
            ]
        ]
    ),
)
def _(wh):
    return profiling.union_all([profiling.profile_table(wh.staged(e), f"stg_{e}") for e in STAGING_TYPES])


@query(
    "profile_nulls",
    ALL_RAW,
    union_sql(
        [
            f"SELECT '{e}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM {RAW_SQL[e]}"
            for e in RAW_COLUMNS
            for c in RAW_COLUMNS[e]
        ]
    ),
)
def _(wh):
    return profile.column_report(wh.raw).select("table_name", "column_name", "nulls")


@query(
    "profile_duplicates",
    ALL_RAW,
    union_sql(
        [
            f"SELECT '{e}' AS table_name, (SELECT count(*) FROM {t}) AS table_rows, "
            f"(SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS duplicates"
            for e, t in RAW_SQL.items()
        ]
    ),
)
def _(wh):
    return profile.duplicate_report(wh.raw)


def _key_sql(entity: str, columns: list[str]) -> str:
    c = ", ".join(columns)
    return (
        f"SELECT '{entity}' AS table_name, '{' + '.join(columns)}' AS key_columns, CAST(sum(n) AS BIGINT) AS table_rows, "
        f"count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS duplicates, "
        f"CAST(coalesce(sum(n) FILTER ({' OR '.join(x + ' IS NULL' for x in columns)}), 0) AS BIGINT) AS null_keys, "
        f"sum(n - 1) = 0 AS is_unique FROM (SELECT {c}, count(*) AS n FROM raw_{entity} GROUP BY {c})"
    )


@query(
    "key_unique",
    "raw_orders raw_customers raw_products raw_sellers raw_order_reviews",
    union_sql([_key_sql(e, k) for e, k in profile.SINGLE_KEYS]),
)
def _(wh):
    return profile.key_report(wh.raw, profile.SINGLE_KEYS)


@query("key_duplicates", "raw_order_items raw_order_payments", union_sql([_key_sql(e, k) for e, k in profile.COMPOSITE_KEYS]))
def _(wh):
    return profile.key_report(wh.raw, profile.COMPOSITE_KEYS)


@query(
    "distinct_count",
    "raw_customers",
    union_sql(
        [
            f"SELECT 'customers' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM raw_customers"
            for c in ("customer_id", "customer_unique_id")
        ]
    ),
)
def _(wh):
    return profiling.distinct_count(wh.raw("customers"), ["customer_id", "customer_unique_id"], "customers")


def _missing_sql(relations) -> str:
    return union_sql(
        [
            f"SELECT '{label}' AS relation, count(*) AS orphans FROM raw_{child} c "
            f"WHERE NOT EXISTS (SELECT 1 FROM raw_{parent} p WHERE p.{key} IS NOT DISTINCT FROM c.{key})"
            for label, child, parent, key in relations
        ]
    )


_RELATED = "raw_orders raw_order_items raw_order_payments raw_order_reviews raw_products raw_sellers raw_customers"


@query("orphan_check", _RELATED, _missing_sql(profile.ORPHANS))
def _(wh):
    return profile.relation_report(wh.raw, profile.ORPHANS)


@query("coverage_check", _RELATED, _missing_sql(profile.COVERAGE))
def _(wh):
    return profile.relation_report(wh.raw, profile.COVERAGE)


@query(
    "date_range",
    "parsed_orders",
    "SELECT CAST(min(order_purchase_timestamp) AS VARCHAR) AS min_value, "
    "CAST(max(order_purchase_timestamp) AS VARCHAR) AS max_value FROM parsed_orders",
)
def _(wh):
    return profile.date_report(wh.raw)


@query("value_counts", "raw_orders", "SELECT order_status AS value, count(*) AS n FROM raw_orders GROUP BY order_status")
def _(wh):
    return profile.status_report(wh.raw)


# ---------------------------------------------------------------- cleaning


@query(
    "clean_timestamps",
    "parsed_orders",
    f"SELECT order_id, {col_list(ORDER_DATES, tuple(ORDER_DATES))} FROM parsed_orders",
)
def _(wh):
    return cleaning.parse_timestamps(wh.raw("orders").select("order_id", *ORDER_DATES), ORDER_DATES)


_DELIVERY = ["delivery_days", "estimated_days", "delivery_delay_days", "is_delivered", "is_cancelled", "is_late"]


@query("delivery_metrics", "stg_orders", f"SELECT order_id, {col_list(_DELIVERY)} FROM stg_orders")
def _(wh):
    return prepare.prepare_orders(wh.raw).select("order_id", *_DELIVERY)


@query(
    "clean_order_items",
    "stg_order_items",
    "SELECT order_id, order_item_id, CAST(shipping_limit_date AS VARCHAR) AS shipping_limit_date, "
    f"{money('price', 'price')}, {money('freight_value', 'freight_value')} FROM stg_order_items",
)
def _(wh):
    items = prepare.stage(wh.raw, "order_items")
    return items.select("order_id", "order_item_id", "shipping_limit_date", "price", "freight_value")


@query(
    "clean_payments",
    "raw_order_payments",
    "SELECT order_id, payment_sequential, payment_type, "
    "CASE payment_installments WHEN 0 THEN 1 ELSE payment_installments END AS payment_installments, "
    f"{money('payment_value', 'payment_value')}, payment_type = 'not_defined' AS is_undefined FROM raw_order_payments",
)
def _(wh):
    payments = prepare.stage(wh.raw, "order_payments")
    return payments.withColumn("is_undefined", F.col("payment_type") == prepare.UNDEFINED_PAYMENT)


@query(
    "latest_per_key",
    "stg_order_reviews",
    "SELECT review_id, order_id, review_score, CAST(review_creation_date AS VARCHAR) AS review_creation_date FROM stg_order_reviews",
)
def _(wh):
    reviews = prepare.stage(wh.raw, "order_reviews")
    return reviews.select("review_id", "order_id", "review_score", "review_creation_date")


@query(
    "clean_text",
    "stg_customers stg_sellers",
    "SELECT customer_id AS id, 'customer' AS kind, customer_city AS city, customer_state AS state FROM stg_customers "
    "UNION ALL SELECT seller_id, 'seller', seller_city, seller_state FROM stg_sellers",
)
def _(wh):
    parts = [
        prepare.PREPARE[f"{kind}s"](wh.raw).select(
            F.col(f"{kind}_id").alias("id"),
            F.lit(kind).alias("kind"),
            F.col(f"{kind}_city").alias("city"),
            F.col(f"{kind}_state").alias("state"),
        )
        for kind in ("customer", "seller")
    ]
    return profiling.union_all(parts)


@query("clean_products", "stg_products", f"SELECT {', '.join(STAGING_TYPES['products'])} FROM stg_products")
def _(wh):
    return prepare.stage(wh.raw, "products")


@query(
    "geo_collapse",
    "stg_geolocation",
    "SELECT zip, round(lat, 6) AS lat, round(lng, 6) AS lng, city, state FROM stg_geolocation",
)
def _(wh):
    return prepare.prepare_geolocation(wh.raw).select(
        F.col("geolocation_zip_code_prefix").alias("zip"),
        F.round("geolocation_lat", 6).alias("lat"),
        F.round("geolocation_lng", 6).alias("lng"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
    )


# ---------------------------------------------------------------- dimensions and facts


_DAY_COLUMNS = [
    "date_key",
    "full_date",
    "year",
    "quarter",
    "quarter_label",
    "month",
    "month_name",
    "month_short",
    "year_month",
    "day_of_month",
    "day_of_week",
    "day_name",
    "is_weekend",
]


@query("dim_date", "dim_date", f"SELECT {col_list(_DAY_COLUMNS, ('full_date',))} FROM dim_date")
def _(wh):
    return wh.dim_date


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("latitude", "longitude")})


@query(
    "dim_customer",
    "dim_customer",
    "SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude) FROM dim_customer",
)
def _(wh):
    return _rounded(wh.dim_customer).drop("customer_key")


@query(
    "dim_seller",
    "dim_seller",
    "SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude) FROM dim_seller",
)
def _(wh):
    return _rounded(wh.dim_seller).drop("seller_key")


@query("dim_product", "dim_product", "SELECT * FROM dim_product")
def _(wh):
    return wh.dim_product.drop("product_key")


@query(
    "surrogate_key",
    " ".join([*star.DIMENSION_KEYS, *FACTS]),
    union_sql(
        [
            f"SELECT '{t}' AS table_name, count(*) AS table_rows, count(*) AS distinct_keys, 1 AS min_key, "
            f"count(*) AS max_key, true AS is_dense FROM {t}"
            for t in [*star.DIMENSION_KEYS, *FACTS]
        ]
    ),
)
def _(wh):
    frames = {t: (wh.table(t), key) for t, (key, _) in star.DIMENSION_KEYS.items()}
    frames |= {t: (wh.with_key(t), star.FACT_KEYS[t]) for t in FACTS}
    parts = []
    for table, (df, key) in frames.items():
        per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        summary = per_key.agg(
            F.sum("n").alias("table_rows"),
            F.count("k").alias("distinct_keys"),
            F.min("k").alias("min_key"),
            F.max("k").alias("max_key"),
        )
        dense = (F.col("table_rows") == F.col("distinct_keys")) & (F.col("max_key") == F.col("table_rows"))
        parts.append(summary.select(F.lit(table).alias("table_name"), "*", dense.alias("is_dense")))
    return profiling.union_all(parts)


def _natural(wh: Warehouse, fact: DataFrame) -> DataFrame:
    """The fact with natural keys in place of surrogate keys."""
    for table, (key, natural) in star.DIMENSION_KEYS.items():
        if key in fact.columns:
            fact = fact.join(wh.table(table).select(key, natural), key).drop(key)
    return fact.drop(star.MONTH_PARTITION)


@query(
    "fact_orders",
    "fact_orders",
    "SELECT order_id, customer_id, purchase_date_key, delivered_date_key, estimated_date_key, order_status, "
    "CAST(purchase_timestamp AS VARCHAR) AS purchase_timestamp, delivery_days, estimated_days, delivery_delay_days, "
    "is_delivered, is_cancelled, is_late FROM fact_orders",
)
def _(wh):
    return _natural(wh, wh.fact_orders)


@query(
    "fact_order_items",
    "fact_order_items",
    "SELECT order_id, order_item_id, customer_id, product_id, seller_id, purchase_date_key, order_status, "
    f"{money('price', 'price')}, {money('freight_value', 'freight_value')} FROM fact_order_items",
)
def _(wh):
    return _natural(wh, wh.fact_order_items)


@query(
    "fact_payments",
    "fact_payments",
    "SELECT order_id, payment_sequential, customer_id, purchase_date_key, order_status, payment_type, "
    f"payment_installments, {money('payment_value', 'payment_value')} FROM fact_payments",
)
def _(wh):
    return _natural(wh, wh.fact_payments)


@query(
    "fact_reviews",
    "fact_reviews",
    "SELECT review_id, order_id, customer_id, purchase_date_key, review_date_key, review_score, has_comment, "
    "is_negative, is_positive FROM fact_reviews",
)
def _(wh):
    return _natural(wh, wh.fact_reviews)


@query(
    "date_key",
    "parsed_orders",
    f"SELECT order_id, {sql_date_key('order_purchase_timestamp')} AS purchase_date_key, "
    f"{sql_date_key('order_delivered_customer_date')} AS delivered_date_key, "
    f"{sql_date_key('order_estimated_delivery_date')} AS estimated_date_key FROM parsed_orders",
)
def _(wh):
    return wh.staged("orders").select(
        "order_id",
        date_key(F.col("order_purchase_timestamp")).alias("purchase_date_key"),
        date_key(F.col("order_delivered_customer_date")).alias("delivered_date_key"),
        date_key(F.col("order_estimated_delivery_date")).alias("estimated_date_key"),
    )


@query(
    "conformed_keys",
    ALL_FACTS,
    union_sql(
        [
            f"SELECT '{f}' AS table_name, '{c}' AS key_column, count(*) AS table_rows, "
            f"count(*) FILTER ({n} IS NULL) AS nulls, 0 AS unmatched FROM {f}"
            for f in FACTS
            for c, n in (("customer_key", "customer_id"), ("purchase_date_key", "purchase_date_key"))
        ]
    ),
)
def _(wh):
    parents = {"customer_key": (wh.dim_customer, "customer_key"), "purchase_date_key": (wh.dim_date, "date_key")}
    parts = []
    for fact in FACTS:
        for column, (dim, key) in parents.items():
            per_key = wh.table(fact).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            known = dim.select(F.col(key).alias(column), F.lit(True).alias("known"))
            parts.append(
                per_key.join(known, column, "left").agg(
                    F.sum("n").alias("table_rows"),
                    F.coalesce(F.sum(F.when(F.col(column).isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
                    F.coalesce(
                        F.sum(F.when(F.col(column).isNotNull() & F.col("known").isNull(), F.col("n"))), F.lit(0)
                    ).alias("unmatched"),
                ).select(F.lit(fact).alias("table_name"), F.lit(column).alias("key_column"), "*")
            )
    return profiling.union_all(parts)


# ---------------------------------------------------------------- validation and reconciliation

@query(
    "check_row_counts",
    " ".join(f"stg_{s} {m}" for s, m in validate.LOADED.values()),
    "SELECT *, model_rows - staging_rows AS difference, model_rows = staging_rows AS passed FROM ("
    + union_sql(
        [
            f"SELECT '{e}' AS entity, (SELECT count(*) FROM stg_{s}) AS staging_rows, (SELECT count(*) FROM {m}) AS model_rows"
            for e, (s, m) in validate.LOADED.items()
        ]
    )
    + ")",
)
def _(wh):
    return validate.row_counts(wh)


_MEASURES = [
    ("price", "order_items", "fact_order_items"),
    ("freight_value", "order_items", "fact_order_items"),
    ("payment_value", "order_payments", "fact_payments"),
]


@query(
    "check_money_totals",
    "stg_order_items fact_order_items stg_order_payments fact_payments",
    "SELECT measure, CAST(a AS DOUBLE) AS staging_total, CAST(b AS DOUBLE) AS model_total, "
    "CAST(b - a AS DOUBLE) AS difference, a = b AS passed FROM ("
    + union_sql(
        [
            f"SELECT '{m}' AS measure, (SELECT sum({m}) FROM stg_{s}) AS a, (SELECT sum({m}) FROM {t}) AS b"
            for m, s, t in _MEASURES
        ]
    )
    + ")",
)
def _(wh):
    return validate.money_totals(wh)


@query(
    "check_grain",
    ALL_FACTS,
    union_sql(
        [
            f"SELECT '{f}' AS table_name, '{' + '.join(k)}' AS grain, n AS duplicate_count, n = 0 AS passed FROM "
            f"(SELECT (SELECT count(*) FROM {f}) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(k)} FROM {f})) AS n)"
            for f, k in star.FACT_GRAIN.items()
        ]
    ),
)
def _(wh):
    return validate.grain(wh)


@query(
    "check_identity",
    "dim_customer",
    "SELECT count(*) AS customer_rows, count(DISTINCT customer_unique_id) AS people, "
    "count(*) - count(DISTINCT customer_unique_id) AS overcount FROM dim_customer",
)
def _(wh):
    return validate.identity(wh)


@query(
    "fanout_demo",
    "fact_order_items fact_payments",
    f"SELECT method, {money('value', 'value')}, {money('value - own', 'phantom')}, "
    f"{pct('value - own', 'own')} AS phantom_pct FROM ("
    "SELECT 'joined to payments' AS method, (SELECT sum(price) FROM fact_order_items JOIN fact_payments USING (order_id)) AS value, "
    "(SELECT sum(price) FROM fact_order_items) AS own "
    "UNION ALL SELECT 'own grain', (SELECT sum(price) FROM fact_order_items), (SELECT sum(price) FROM fact_order_items))",
)
def _(wh):
    return validate.fanout(wh)


# The rules of the published model, written out here on their own: table, columns that must be
# present, unique column sets, dates that dim_date must have. A surrogate key stands for its natural key.
_RULES = [
    (
        "dim_date",
        "date_key full_date year quarter quarter_label month month_name month_short year_month day_of_month "
        "day_of_week day_name is_weekend",
        ["date_key", "full_date"],
        "",
    ),
    ("dim_customer", "customer_key customer_id customer_unique_id", ["customer_id", "customer_key"], ""),
    ("dim_seller", "seller_key seller_id", ["seller_id", "seller_key"], ""),
    ("dim_product", "product_key product_id category_name category_name_english", ["product_id", "product_key"], ""),
    (
        "fact_orders",
        "order_id purchase_date_key order_status purchase_timestamp is_delivered is_cancelled customer_key",
        ["order_id"],
        "purchase_date_key delivered_date_key estimated_date_key",
    ),
    (
        "fact_order_items",
        "order_id order_item_id purchase_date_key order_status price freight_value customer_key product_key seller_key",
        ["order_id order_item_id"],
        "purchase_date_key",
    ),
    (
        "fact_payments",
        "order_id payment_sequential purchase_date_key payment_type payment_installments payment_value customer_key",
        ["order_id payment_sequential"],
        "purchase_date_key",
    ),
    (
        "fact_reviews",
        "review_id order_id purchase_date_key review_score has_comment is_negative is_positive customer_key",
        ["order_id"],
        "purchase_date_key review_date_key",
    ),
]
_NATURAL = {"customer_key": "customer_id", "product_key": "product_id", "seller_key": "seller_id"}


def _constraint_sql() -> str:
    parts = []
    for t, required, unique, dates in _RULES:
        for c in required.split():
            n = _NATURAL.get(c, c)
            parent = f" OR {n} NOT IN (SELECT {n} FROM dim_{c.replace('_key', '')})" if c in _NATURAL and t.startswith("fact") else ""
            parts.append(
                f"SELECT '{t}' AS table_name, 'not null' AS rule, '{c}' AS columns, "
                f"count(*) FILTER ({n} IS NULL{parent}) AS violations FROM {t}"
            )
        for k in map(str.split, unique):
            natural = ", ".join(_NATURAL.get(c, c) for c in k)
            parts.append(
                f"SELECT '{t}', 'unique', '{' + '.join(k)}', (SELECT count(*) FROM {t}) - "
                f"(SELECT count(*) FROM (SELECT DISTINCT {natural} FROM {t}))"
            )
        for c in dates.split():
            parts.append(
                f"SELECT '{t}', 'foreign key', '{c}', count(*) FROM {t} WHERE {c} IS NOT NULL "
                f"AND {c} NOT IN (SELECT date_key FROM dim_date)"
            )
        for c in required.split() if t.startswith("fact") else []:
            if c in _NATURAL:
                parts.append(
                    f"SELECT '{t}', 'foreign key', '{c}', count(*) FROM {t} WHERE {_NATURAL[c]} NOT IN "
                    f"(SELECT {_NATURAL[c]} FROM dim_{c.replace('_key', '')})"
                )
    return f"SELECT *, violations = 0 AS passed FROM ({union_sql(parts)})"


@query("check_constraints", " ".join([*DIMENSIONS, *FACTS]), _constraint_sql())
def _(wh):
    return validate.constraints(wh)


def _reconcile_sql() -> str:
    metrics_sql = [
        ("Total orders", "count(DISTINCT order_id)", "orders", "fact_orders"),
        ("Delivered orders", "count(*) FILTER (order_status = 'delivered')", "orders", "fact_orders"),
        ("Cancelled orders", "count(*) FILTER (order_status = 'canceled')", "orders", "fact_orders"),
        ("Total order items", "count(*)", "order_items", "fact_order_items"),
        ("Merchandise value", "sum(price)", "order_items", "fact_order_items"),
        ("Freight value", "sum(freight_value)", "order_items", "fact_order_items"),
        ("Total payment records", "count(*)", "order_payments", "fact_payments"),
        ("Payment value", "sum(payment_value)", "order_payments", "fact_payments"),
        ("Total reviews", "count(*)", "order_reviews", "fact_reviews"),
        ("Total customers (unique people)", "count(DISTINCT customer_unique_id)", "customers", "dim_customer"),
        ("Total sellers", "count(*)", "sellers", "dim_seller"),
        ("Total products", "count(*)", "products", "dim_product"),
    ]
    stages = union_sql(
        [
            f"SELECT '{m}' AS metric, (SELECT CAST({e} AS DECIMAL(22,2)) FROM raw_{s}) AS r, "
            f"(SELECT CAST({e} AS DECIMAL(22,2)) FROM stg_{s}) AS c, (SELECT CAST({e} AS DECIMAL(22,2)) FROM {t}) AS w"
            for m, e, s, t in metrics_sql
        ]
    )
    ((metric, text),) = validate.EXPLANATIONS.items()
    status = f"CASE WHEN r = c AND c = w THEN 'Match' WHEN c = w AND metric = '{metric}' THEN 'Expected' ELSE 'MISMATCH' END"
    return (
        f"SELECT metric, {money('r', 'raw')}, {money('c', 'cleaned')}, {money('w', 'model')}, {status} AS status, "
        f"{money('r - c', 'difference')}, CASE WHEN {status} = 'Expected' THEN '{text}' END AS explanation FROM ({stages})"
    )


_RECONCILE_TABLES = (
    "raw_orders raw_order_items raw_order_payments raw_order_reviews raw_customers raw_sellers raw_products "
    "stg_orders stg_order_items stg_order_payments stg_order_reviews stg_customers stg_sellers stg_products "
    "fact_orders fact_order_items fact_payments fact_reviews dim_customer dim_seller dim_product"
)


@query("reconcile_stages", _RECONCILE_TABLES, _reconcile_sql())
def _(wh):
    return validate.reconciliation(wh)


@query(
    "reconcile_report",
    _RECONCILE_TABLES,
    "SELECT count(*) AS metrics, count(*) FILTER (status = 'Match') AS matching, count(*) FILTER (status = 'Expected') AS expected, "
    f"count(*) FILTER (status = 'MISMATCH') AS mismatching, bool_and(status <> 'MISMATCH') AS reconciled FROM ({_reconcile_sql()})",
)
def _(wh):
    return reconcile.overall(validate.reconciliation(wh))


# ---------------------------------------------------------------- business questions

ITEMS = "fact_order_items"


@query(
    "q01_monthly_growth",
    "monthly",
    f"SELECT year_month, orders, {money('value', 'merchandise_value')}, {money('prev', 'prev_month_value')}, "
    f"{pct('value - prev', 'prev')} AS mom_growth_pct "
    "FROM (SELECT *, lag(value) OVER (ORDER BY year_month) AS prev FROM monthly)",
)
def _(wh):
    return questions.monthly_growth(wh)


@query(
    "q02_ytd_revenue",
    "monthly",
    f"SELECT year, year_month, {money('value', 'merchandise_value')}, "
    + money("sum(value) OVER (PARTITION BY year ORDER BY year_month ROWS UNBOUNDED PRECEDING)", "ytd_merchandise_value")
    + " FROM monthly",
)
def _(wh):
    return questions.ytd_revenue(wh)


@query(
    "q03_top_categories",
    ITEMS,
    f"SELECT category, orders, {money('value', 'merchandise_value')}, {pct('value', 'total')} AS contribution_pct FROM ("
    "SELECT *, sum(value) OVER () AS total FROM (SELECT category, count(DISTINCT order_id) AS orders, sum(price) AS value "
    "FROM fact_order_items GROUP BY category)) ORDER BY value DESC, category LIMIT 10",
)
def _(wh):
    return questions.top_categories(wh)


@query(
    "q04_top_sellers_by_state",
    ITEMS,
    f"SELECT state, state_rank, seller_id, orders, {money('value', 'merchandise_value')} FROM ("
    "SELECT *, dense_rank() OVER (PARTITION BY state ORDER BY value DESC) AS state_rank FROM ("
    "SELECT seller_state AS state, seller_id, count(DISTINCT order_id) AS orders, sum(price) AS value "
    "FROM fact_order_items GROUP BY ALL)) WHERE state_rank <= 3",
)
def _(wh):
    return questions.top_sellers_by_state(wh)


@query(
    "q05_repeat_customers",
    "fact_orders fact_order_items",
    f"SELECT customer_type, customers, {pct('customers', 'all_customers')} AS pct_of_customers, {money('value', 'merchandise_value')}, "
    f"{pct('value', 'all_value')} AS pct_of_revenue, {ratio('value', 'customers')} AS revenue_per_customer FROM ("
    "SELECT *, sum(customers) OVER () AS all_customers, sum(value) OVER () AS all_value FROM ("
    "SELECT CASE WHEN n > 1 THEN 'Repeat' ELSE 'One-time' END AS customer_type, count(*) AS customers, "
    "sum(coalesce(v.value, 0)) AS value FROM "
    "(SELECT customer_unique_id, count(DISTINCT order_id) AS n FROM fact_orders GROUP BY ALL) o LEFT JOIN "
    "(SELECT customer_unique_id, sum(price) AS value FROM fact_order_items GROUP BY ALL) v USING (customer_unique_id) GROUP BY 1))",
)
def _(wh):
    return questions.repeat_customers(wh)


@query(
    "q06_second_order_gap",
    "fact_orders",
    f"SELECT gap_bucket, customers, {pct('customers', 'total')} AS pct FROM ("
    "SELECT *, sum(customers) OVER () AS total FROM (SELECT CASE WHEN days <= 0 THEN '1. Same day' "
    "WHEN days <= 30 THEN '2. 1-30 days' WHEN days <= 90 THEN '3. 31-90 days' "
    "WHEN days <= 180 THEN '4. 91-180 days' ELSE '5. Over 180 days' END AS gap_bucket, "
    "count(*) AS customers FROM (SELECT date_diff('day', purchase_timestamp, "
    "lead(purchase_timestamp) OVER w) AS days, row_number() OVER w AS seq FROM fact_orders "
    "WINDOW w AS (PARTITION BY customer_unique_id ORDER BY purchase_timestamp, order_id)) "
    "WHERE seq = 1 AND days IS NOT NULL GROUP BY 1))",
)
def _(wh):
    return questions.second_order_gap(wh)


@query(
    "q07_state_delivery",
    "fact_orders fact_reviews",
    f"SELECT o.state, count(*) AS delivered_orders, {ratio('sum(delivery_days)', 'count(delivery_days)')} AS avg_delivery_days, "
    f"{pct('count(*) FILTER (is_late)', 'count(*)')} AS late_pct, "
    f"{ratio('sum(review_score)', 'count(review_score)')} AS avg_review_score "
    "FROM fact_orders o LEFT JOIN fact_reviews r USING (order_id) WHERE delivery_days IS NOT NULL GROUP BY o.state",
)
def _(wh):
    return questions.state_delivery(wh)


@query(
    "q08_delay_vs_score",
    "fact_orders fact_reviews",
    f"SELECT delay_bucket, count(*) AS reviewed_orders, {ratio('sum(review_score)', 'count(review_score)')} AS avg_review_score, "
    f"{pct('count(*) FILTER (is_negative)', 'count(*)')} AS negative_review_pct FROM ("
    "SELECT CASE WHEN delivery_delay_days <= -10 THEN '1. 10+ days early' WHEN delivery_delay_days <= -1 THEN '2. 1-9 days early' "
    "WHEN delivery_delay_days <= 0 THEN '3. On estimated day' WHEN delivery_delay_days <= 7 THEN '4. 1-7 days late' "
    "WHEN delivery_delay_days <= 14 THEN '5. 8-14 days late' ELSE '6. 15+ days late' END AS delay_bucket, review_score, is_negative "
    "FROM fact_orders JOIN fact_reviews USING (order_id) WHERE delivery_delay_days IS NOT NULL) GROUP BY delay_bucket",
)
def _(wh):
    return questions.delay_vs_score(wh)


@query(
    "q09_at_risk_categories",
    "fact_order_items fact_reviews",
    f"SELECT revenue_rank, category, {money('value', 'merchandise_value')}, reviewed_orders, {ratio('score', 'scored')} AS avg_review_score "
    "FROM (SELECT category, sum(price) AS value, rank() OVER (ORDER BY sum(price) DESC) AS revenue_rank, "
    "avg(CAST(sum(price) AS DOUBLE)) OVER () AS mean_value FROM fact_order_items GROUP BY category) JOIN "
    "(SELECT category, count(*) AS reviewed_orders, sum(review_score) AS score, count(review_score) AS scored FROM "
    "(SELECT DISTINCT order_id, category FROM fact_order_items) JOIN fact_reviews USING (order_id) GROUP BY category) USING (category) "
    "WHERE value > mean_value AND score / scored < (SELECT avg(review_score) FROM fact_reviews)",
)
def _(wh):
    return questions.at_risk_categories(wh)


@query(
    "q10_freight_burden",
    ITEMS,
    f"SELECT category, count(*) AS items_sold, {ratio('sum(price)', 'count(price)')} AS avg_price, "
    f"{ratio('sum(freight_value)', 'count(freight_value)')} AS avg_freight, {pct('sum(freight_value)', 'sum(price)')} AS freight_pct "
    "FROM fact_order_items GROUP BY category HAVING count(*) >= 100 ORDER BY freight_pct DESC, category LIMIT 15",
)
def _(wh):
    return questions.freight_burden(wh)


@query(
    "q11_payment_mix",
    "fact_payments",
    f"SELECT payment_type, orders, transactions, {money('value', 'payment_value')}, {pct('value', 'total')} AS pct_of_payment_value, "
    f"{ratio('value', 'transactions')} AS avg_transaction_value, {ratio('installments', 'transactions')} AS avg_installments FROM ("
    "SELECT *, sum(value) OVER () AS total FROM (SELECT payment_type, count(DISTINCT order_id) AS orders, count(*) AS transactions, "
    "sum(payment_value) AS value, sum(payment_installments) AS installments FROM fact_payments GROUP BY payment_type))",
)
def _(wh):
    return questions.payment_mix(wh)


@query(
    "q12_seller_watchlist",
    "fact_order_items fact_orders fact_reviews",
    f"SELECT seller_id, state, orders, {money('value', 'merchandise_value')}, {pct('late', 'delivered')} AS late_pct, "
    f"{ratio('score', 'scored')} AS avg_review_score FROM ("
    "SELECT seller_id, seller_state AS state, count(*) AS orders, count(*) FILTER (is_late) AS late, count(is_late) AS delivered, "
    "sum(review_score) AS score, count(review_score) AS scored FROM (SELECT DISTINCT seller_id, seller_state, order_id FROM fact_order_items) "
    "JOIN fact_orders USING (order_id) LEFT JOIN fact_reviews USING (order_id) GROUP BY ALL) "
    "JOIN (SELECT seller_id, sum(price) AS value FROM fact_order_items GROUP BY ALL) USING (seller_id) "
    "WHERE orders >= 30 ORDER BY late_pct DESC NULLS LAST, seller_id LIMIT 20",
)
def _(wh):
    return questions.seller_watchlist(wh)


@query(
    "q13_cancellation_trend",
    "fact_orders",
    "SELECT year_month, count(*) AS orders, count(*) FILTER (is_cancelled) AS cancelled, "
    f"count(*) FILTER (order_status = 'unavailable') AS unavailable, {pct('count(*) FILTER (is_cancelled)', 'count(*)')} AS cancellation_pct "
    "FROM fact_orders GROUP BY year_month",
)
def _(wh):
    return questions.cancellation_trend(wh)


@query(
    "q14_spend_quartiles",
    ITEMS,
    f"SELECT spend_quartile, customers, {money('lo', 'min_spend')}, {money('hi', 'max_spend')}, {ratio('value', 'customers')} AS avg_spend, "
    f"{pct('value', 'total')} AS pct_of_revenue FROM (SELECT *, sum(value) OVER () AS total FROM ("
    "SELECT spend_quartile, count(*) AS customers, min(spend) AS lo, max(spend) AS hi, sum(spend) AS value FROM ("
    "SELECT spend, ntile(4) OVER (ORDER BY spend DESC, customer_unique_id) AS spend_quartile FROM ("
    "SELECT customer_unique_id, sum(price) AS spend FROM fact_order_items GROUP BY ALL)) GROUP BY spend_quartile))",
)
def _(wh):
    return questions.spend_quartiles(wh)


STATE_MINIMUM = 300  # the test tables have fewer delivered orders per state than the default asks for


@query(
    "q15_estimate_accuracy",
    "fact_orders",
    f"SELECT state, count(*) AS delivered_orders, {ratio('sum(estimated_days)', 'count(*)')} AS avg_promised_days, "
    f"{ratio('sum(delivery_days)', 'count(*)')} AS avg_actual_days, "
    f"{ratio('sum(estimated_days - delivery_days)', 'count(*)')} AS avg_buffer_days, "
    f"{pct('count(*) FILTER (delivery_delay_days <= -10)', 'count(*)')} AS pct_10plus_days_early FROM fact_orders "
    f"WHERE delivery_days IS NOT NULL AND estimated_days IS NOT NULL GROUP BY state HAVING count(*) >= {STATE_MINIMUM}",
)
def _(wh):
    return questions.estimate_accuracy(wh, min_orders=STATE_MINIMUM)


FIRST_DAY, LAST_DAY, STATE = 19971001, 19971231, "NATION_3"


@query(
    "q16_filtered_category_revenue",
    ITEMS,
    f"SELECT category, count(DISTINCT order_id) AS orders, {money('sum(price)', 'merchandise_value')} FROM fact_order_items "
    f"WHERE purchase_date_key BETWEEN {FIRST_DAY} AND {LAST_DAY} AND state = '{STATE}' GROUP BY category",
)
def _(wh):
    return questions.filtered_category_revenue(wh, FIRST_DAY, LAST_DAY, STATE)


# ---------------------------------------------------------------- metric layer


@query(
    "m_order_status_mix",
    "fact_orders",
    "SELECT year_month, count(DISTINCT order_id) AS total_orders, count(*) FILTER (order_status = 'delivered') AS completed_orders, "
    "count(*) FILTER (order_status = 'canceled') AS cancelled_orders, "
    "count(*) FILTER (order_status NOT IN ('delivered', 'canceled')) AS in_progress_orders FROM fact_orders GROUP BY year_month",
)
def _(wh):
    return metrics.order_status_mix(wh, ["year_month"])


@query(
    "m_customers",
    "fact_orders",
    f"SELECT customer_state, customers, repeat_customers, {pct('repeat_customers', 'customers')} AS repeat_customer_pct FROM ("
    "SELECT state AS customer_state, count(*) AS customers, count(*) FILTER (n > 1) AS repeat_customers FROM ("
    "SELECT state, customer_unique_id, count(DISTINCT order_id) AS n FROM fact_orders GROUP BY ALL) GROUP BY state)",
)
def _(wh):
    return metrics.customers(wh, ["customer_state"])


@query(
    "m_new_customers",
    "fact_orders",
    "SELECT year_month, count(*) AS new_customers FROM (SELECT strftime(min(purchase_timestamp), '%Y-%m') AS year_month "
    "FROM fact_orders GROUP BY customer_unique_id) GROUP BY year_month",
)
def _(wh):
    return metrics.new_customers(wh)


@query(
    "m_financials",
    "fact_order_items fact_payments",
    f"SELECT year_month, {money('m', 'merchandise_value')}, {money('f', 'freight_value')}, {money('p', 'payment_value')} FROM "
    "(SELECT year_month, sum(price) AS m, sum(freight_value) AS f FROM fact_order_items GROUP BY ALL) FULL JOIN "
    "(SELECT year_month, sum(payment_value) AS p FROM fact_payments GROUP BY ALL) USING (year_month)",
)
def _(wh):
    return metrics.financials(wh, ["year_month"])


@query(
    "m_average_order_value",
    "fact_orders fact_order_items",
    f"SELECT customer_state, total_orders, {money('m', 'merchandise_value')}, {ratio('m', 'total_orders')} AS average_order_value FROM "
    "(SELECT state AS customer_state, count(DISTINCT order_id) AS total_orders FROM fact_orders GROUP BY ALL) FULL JOIN "
    "(SELECT state AS customer_state, sum(price) AS m FROM fact_order_items GROUP BY ALL) USING (customer_state)",
)
def _(wh):
    return metrics.average_order_value(wh, ["customer_state"])


@query(
    "m_freight_pct",
    ITEMS,
    f"SELECT category, {money('sum(price)', 'merchandise_value')}, {money('sum(freight_value)', 'freight_value')}, "
    f"{pct('sum(freight_value)', 'sum(price)')} AS freight_pct FROM fact_order_items GROUP BY category",
)
def _(wh):
    return metrics.freight_pct(wh, ["category"])


@query(
    "m_contribution_pct",
    ITEMS,
    f"SELECT seller_state, {money('value', 'merchandise_value')}, {pct('value', 'total')} AS contribution_pct FROM ("
    "SELECT *, sum(value) OVER () AS total FROM (SELECT seller_state, sum(price) AS value FROM fact_order_items GROUP BY ALL))",
)
def _(wh):
    return metrics.contribution_pct(wh, ["seller_state"])


@query(
    "m_delivery_rates",
    "fact_orders",
    f"SELECT year, count(*) AS delivered_orders, {pct('count(*) FILTER (delivery_delay_days <= 0)', 'count(*)')} AS on_time_pct, "
    f"{pct('count(*) FILTER (delivery_delay_days > 0)', 'count(*)')} AS late_pct, "
    f"{ratio('sum(delivery_delay_days)', 'count(delivery_delay_days)')} AS avg_delay_days, "
    f"{ratio('sum(delivery_days)', 'count(delivery_days)')} AS avg_delivery_days, "
    f"{ratio('sum(estimated_days)', 'count(estimated_days)')} AS avg_estimated_days "
    "FROM fact_orders WHERE delivered_date_key IS NOT NULL GROUP BY year",
)
def _(wh):
    return metrics.delivery_rates(wh, ["year"])


@query(
    "m_reviews",
    "fact_reviews",
    f"SELECT year_month, count(DISTINCT order_id) AS reviewed_orders, {ratio('sum(review_score)', 'count(review_score)')} AS avg_review_score, "
    "count(*) FILTER (is_negative) AS negative_reviews, count(*) FILTER (is_positive) AS positive_reviews FROM fact_reviews GROUP BY year_month",
)
def _(wh):
    return metrics.reviews(wh, ["year_month"])


def _shift_sql(months: int, base: str, growth: str | None = None) -> str:
    extra = f", {pct('m.value - p.value', 'p.value')} AS {growth}" if growth else ""
    return (
        f"SELECT m.year_month, {money('m.value', 'merchandise_value')}, {money('p.value', base)}{extra} FROM monthly m "
        f"LEFT JOIN monthly p ON p.year_month = strftime(CAST(m.year_month || '-01' AS DATE) - to_months({months}), '%Y-%m')"
    )


@query("m_prev_month", "monthly", _shift_sql(1, "prev_month_value"))
def _(wh):
    return metrics.prev_month(wh)


@query("m_prev_year", "monthly", _shift_sql(12, "prev_year_value"))
def _(wh):
    return metrics.prev_year(wh)


@query("m_mom_growth", "monthly", _shift_sql(1, "prev_month_value", "mom_growth_pct"))
def _(wh):
    return metrics.mom_growth(wh)


@query("m_yoy_growth", "monthly", _shift_sql(12, "prev_year_value", "yoy_growth_pct"))
def _(wh):
    return metrics.yoy_growth(wh)


@query(
    "m_year_to_date",
    "monthly",
    f"SELECT year_month, {money('value', 'merchandise_value')}, "
    + money("sum(value) OVER (PARTITION BY year ORDER BY year_month ROWS UNBOUNDED PRECEDING)", "ytd_value")
    + " FROM monthly",
)
def _(wh):
    return metrics.year_to_date(wh)


# The same by one attribute with a filter, and by two without: every group has every month.
GROUPED = {
    "category": (["category"], {"customer_state": [f"NATION_{i}" for i in range(25) if i != 3]}),
    "state_category": (["customer_state", "category"], None),
}


def _grouped_sql(name: str, months: int, named: str, growth: str | None = None) -> str:
    on = "c.category = p.category" + (" AND c.state = p.state" if name == "state_category" else "")
    groups = "c.category" + (", c.state AS customer_state" if name == "state_category" else "")
    extra = f", {pct('c.value - p.value', 'p.value')} AS {growth}" if growth else ""
    return (
        f"SELECT {groups}, c.year_month, {money('c.value', 'merchandise_value')}, {money('p.value', named)}{extra} "
        f"FROM months_{name} c LEFT JOIN months_{name} p ON p.no = c.no - {months} AND {on}"
    )


def _grouped_ytd(name: str) -> str:
    groups = "category" + (", state" if name == "state_category" else "")
    shown = groups.replace("state", "state AS customer_state")
    running = f"sum(value) OVER (PARTITION BY {groups}, year ORDER BY no ROWS UNBOUNDED PRECEDING)"
    return f"SELECT {shown}, year_month, {money('value', 'merchandise_value')}, {money(running, 'ytd_value')} FROM months_{name}"


for _name, (_by, _where) in GROUPED.items():
    for _measure, _build, _sql in (
        ("prev_month", metrics.prev_month, _grouped_sql(_name, 1, "prev_month_value")),
        ("prev_year", metrics.prev_year, _grouped_sql(_name, 12, "prev_year_value")),
        ("mom_growth", metrics.mom_growth, _grouped_sql(_name, 1, "prev_month_value", "mom_growth_pct")),
        ("yoy_growth", metrics.yoy_growth, _grouped_sql(_name, 12, "prev_year_value", "yoy_growth_pct")),
        ("year_to_date", metrics.year_to_date, _grouped_ytd(_name)),
    ):
        query(f"m_{_measure}_by_{_name}", f"months_{_name}", _sql)(
            lambda wh, build=_build, by=_by, where=_where: build(wh, by=by, where=where)
        )


@query(
    "m_complete_months",
    "monthly fact_orders",
    f"SELECT year_month, {money('value', 'merchandise_value')} FROM monthly, "
    "(SELECT CAST(min(purchase_timestamp) AS DATE) AS lo, CAST(max(purchase_timestamp) AS DATE) AS hi FROM fact_orders) "
    "WHERE CAST(year_month || '-01' AS DATE) >= lo AND last_day(CAST(year_month || '-01' AS DATE)) <= hi",
)
def _(wh):
    return metrics.complete_months(wh)


# ---------------------------------------------------------------- report layer


@query(
    "b_conformed_filter",
    ALL_FACTS,
    union_sql(
        [
            f"SELECT '{f}' AS fact, count(*) AS fact_rows, count(DISTINCT order_id) AS orders, "
            f"CAST({'sum(' + m + ')' if m else 'NULL'} AS DOUBLE) AS measure_total FROM {f} "
            f"WHERE purchase_date_key BETWEEN 19970101 AND 19970630 AND state = '{STATE}'"
            for f, m in reports.FACT_MEASURES.items()
        ]
    ),
)
def _(wh):
    return reports.conformed_totals(wh, {"purchase_date_key": Between(19970101, 19970630)}, {"state": STATE})


@query(
    "b_treatas_propagation",
    "fact_order_items fact_orders fact_reviews",
    f"SELECT category, count(*) AS orders, count(review_score) AS reviewed_orders, "
    f"{ratio('sum(review_score)', 'count(review_score)')} AS avg_review_score, "
    f"{pct('count(*) FILTER (is_late)', 'count(is_late)')} AS late_pct FROM "
    "(SELECT DISTINCT category, order_id FROM fact_order_items) JOIN fact_orders USING (order_id) "
    "LEFT JOIN fact_reviews USING (order_id) GROUP BY category",
)
def _(wh):
    return reports.scores_by_category(wh)


SELLER = "7"


@query(
    "b_seller_detail",
    "fact_order_items fact_orders fact_reviews",
    f"SELECT seller_id, state, count(*) AS orders, CAST(sum(n) AS BIGINT) AS items, {money('sum(v)', 'merchandise_value')}, "
    f"{money('sum(f)', 'freight_value')}, {ratio('sum(v)', 'count(*)')} AS average_order_value, {pct('sum(f)', 'sum(v)')} AS freight_pct, "
    f"count(is_late) AS delivered_orders, {pct('count(*) FILTER (is_late)', 'count(is_late)')} AS late_pct, "
    f"{ratio('sum(delivery_delay_days)', 'count(delivery_delay_days)')} AS avg_delay_days, "
    f"{ratio('sum(delivery_days)', 'count(delivery_days)')} AS avg_delivery_days, count(review_score) AS reviewed_orders, "
    f"{ratio('sum(review_score)', 'count(review_score)')} AS avg_review_score, count(*) FILTER (is_negative) AS negative_reviews, "
    "count(*) FILTER (is_positive) AS positive_reviews FROM (SELECT seller_id, seller_state AS state, order_id, count(*) AS n, "
    f"sum(price) AS v, sum(freight_value) AS f FROM fact_order_items WHERE seller_id = '{SELLER}' GROUP BY ALL) "
    "JOIN (SELECT order_id, is_late, delivery_delay_days, delivery_days FROM fact_orders) USING (order_id) "
    "LEFT JOIN (SELECT order_id, review_score, is_negative, is_positive FROM fact_reviews) USING (order_id) GROUP BY ALL",
)
def _(wh):
    return reports.seller_detail(wh, SELLER)
