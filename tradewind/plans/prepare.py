"""Raw text to staging tables, entity by entity, and the audit of each step."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import strip_upper, title_case
from tradewind.operators import cleaning as C
from tradewind.operators import ledger
from tradewind.operators.audit import audit, row_count
from tradewind.operators.profiling import union_all
from tradewind.sources.files import to_typed
from tradewind.sources.schemas import ORDER_DATES, RENAMED, REQUIRED_RAW, ROW_KEYS, STAGING_TYPES, raw_types

# The labels that mark a product without a category or a translation,
# and the payment type that marks an undefined payment.
NO_CATEGORY = "unknown"
NO_TRANSLATION = "Unknown"
UNDEFINED_PAYMENT = "not_defined"

Raw = Callable[[str], DataFrame]


def prepare_orders(raw: Raw) -> DataFrame:
    orders = C.parse_timestamps(raw("orders"), ORDER_DATES)
    return C.delivery_metrics(
        orders,
        purchase="order_purchase_timestamp",
        delivered="order_delivered_customer_date",
        estimated="order_estimated_delivery_date",
        status="order_status",
    )


def prepare_order_items(raw: Raw) -> DataFrame:
    return C.parse_timestamps(raw("order_items"), ["shipping_limit_date"])


def prepare_order_payments(raw: Raw) -> DataFrame:
    payments = raw("order_payments").withColumn("payment_installments", F.col("payment_installments").try_cast("int"))
    return C.replace_value(payments, "payment_installments", 0, 1)


def prepare_order_reviews(raw: Raw) -> DataFrame:
    reviews = C.parse_timestamps(raw("order_reviews"), ["review_creation_date", "review_answer_timestamp"])
    return C.latest_per_key(reviews, ["order_id"], "review_creation_date", ["review_id"])


def prepare_customers(raw: Raw) -> DataFrame:
    return C.clean_place(raw("customers"), "customer_city", "customer_state")


def prepare_sellers(raw: Raw) -> DataFrame:
    return C.clean_place(raw("sellers"), "seller_city", "seller_state")


def prepare_products(raw: Raw) -> DataFrame:
    products = raw("products").withColumnsRenamed(RENAMED)
    products = C.fill_missing(products, "product_category_name", NO_CATEGORY)
    return C.lookup(
        products,
        raw("product_category_name_translation"),
        "product_category_name",
        {"product_category_name_english": NO_TRANSLATION},
    )


def geolocation_points(raw: Raw) -> DataFrame:
    """The raw points with numbers as numbers, so that equal coordinates are equal however written."""
    return to_typed(raw("geolocation"), STAGING_TYPES["geolocation"])


def prepare_geolocation(raw: Raw) -> DataFrame:
    # Spellings compete for the mode as they were entered; case is settled afterwards.
    collapsed = C.collapse_points(
        geolocation_points(raw),
        "geolocation_zip_code_prefix",
        ["geolocation_lat", "geolocation_lng"],
        ["geolocation_city", "geolocation_state"],
    )
    return C.clean_place(collapsed, "geolocation_city", "geolocation_state")


PREPARE: dict[str, Callable[[Raw], DataFrame]] = {
    "orders": prepare_orders,
    "order_items": prepare_order_items,
    "order_payments": prepare_order_payments,
    "order_reviews": prepare_order_reviews,
    "customers": prepare_customers,
    "sellers": prepare_sellers,
    "products": prepare_products,
    "geolocation": prepare_geolocation,
}


def stage(raw: Raw, entity: str) -> DataFrame:
    """The cleaned entity with its declared staging types."""
    return to_typed(PREPARE[entity](raw), STAGING_TYPES[entity])


def _unparsed(columns: list[str]) -> Column:
    """Rows where a text that should be a timestamp is not one."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | (F.col(c).isNotNull() & C.parse_timestamp(F.col(c)).isNull())
    return bad


UNFIT = "value that does not fit its type set to null"
UNPARSED = "text that is no timestamp set to null"
REQUIRED_MISSING = "required value missing"


def ledger_of(raw: Raw) -> DataFrame:
    """Every cell of the raw entities that typing loses, in one pass over each."""
    return union_all(
        [
            ledger.lost_cells(raw(e), e, raw_types(e), REQUIRED_RAW[e], ROW_KEYS[e])
            for e in STAGING_TYPES
        ]
    )


def _losses(entity: str) -> dict[str, Column]:
    types, required = raw_types(entity), REQUIRED_RAW[entity]
    return {
        UNFIT: ledger.lost_rows(types, required, "unfit"),
        REQUIRED_MISSING: ledger.lost_rows(types, required, "missing"),
    }


def lost_values(audit_rows: DataFrame) -> DataFrame:
    """What staging cannot keep, by entity. Lenient dates are a rule of the cleaning and not among it."""
    return audit_rows.filter(F.col("rule").isin(UNFIT, REQUIRED_MISSING) & (F.col("rows_changed") > 0))


def _recased(city: str, state: str) -> Column:
    return ~(
        F.col(city).eqNullSafe(title_case(F.col(city))) & F.col(state).eqNullSafe(strip_upper(F.col(state)))
    )


def cleaning_audit(raw: Raw, staged: Callable[[str], DataFrame]) -> DataFrame:
    """Rows before, after and changed of every cleaning rule.

    Rules on raw values, with the losses of typing, are counted together in one pass per entity.
    """
    installments = F.col("payment_installments").try_cast("int")
    dates = ["review_creation_date", "review_answer_timestamp"]
    on_raw: dict[str, dict[str, Column]] = {
        "orders": {UNPARSED: _unparsed(ORDER_DATES)},
        "order_items": {UNPARSED: _unparsed(["shipping_limit_date"])},
        "order_payments": {
            "zero installments set to one": installments == 0,
            "undefined payment type kept and flagged": F.col("payment_type") == UNDEFINED_PAYMENT,
        },
        "order_reviews": {UNPARSED: _unparsed(dates)},
        "customers": {"city and state case settled": _recased("customer_city", "customer_state")},
        "sellers": {"city and state case settled": _recased("seller_city", "seller_state")},
        "products": {},
        "geolocation": {},
    }
    parts = [audit(raw(e), e, rules | _losses(e)) for e, rules in on_raw.items()]
    parts += [
        audit(
            staged("orders"),
            "orders",
            {
                "missing delivery date kept as null": F.col("order_delivered_customer_date").isNull(),
                "lateness left null without delivery date": F.col("is_late").isNull(),
            },
        ),
        audit(
            staged("order_reviews"),
            "order_reviews",
            {
                "latest review per order kept": F.lit(False),
                "missing comment kept as null": F.col("review_comment_message").isNull(),
            },
            row_count(raw("order_reviews")),
        ),
        audit(
            staged("products"),
            "products",
            {
                "missing category labelled": F.col("product_category_name") == NO_CATEGORY,
                "missing translation labelled": F.col("product_category_name_english") == NO_TRANSLATION,
            },
        ),
    ]
    points = geolocation_points(raw)
    zips = staged("geolocation")
    parts.append(audit(points.distinct(), "geolocation", {"exact duplicates removed": F.lit(False)}, row_count(points)))
    parts.append(
        audit(zips, "geolocation", {"points merged per zip prefix": F.lit(False)}, row_count(points.distinct()))
    )
    return union_all(parts)
