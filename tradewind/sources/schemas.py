"""Declared schemas. Nothing in the library infers a type from data."""

from __future__ import annotations

# Entity and column names, column types and the two misspelled
# source headers are those of the public data set the library is made for.
ORDER_DATES = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

RAW_COLUMNS: dict[str, list[str]] = {
    "customers": [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ],
    "geolocation": [
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ],
    "order_items": [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ],
    "order_payments": [
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ],
    "order_reviews": [
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ],
    "orders": ["order_id", "customer_id", "order_status", *ORDER_DATES],
    "product_category_name_translation": [
        "product_category_name",
        "product_category_name_english",
    ],
    "products": [
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "sellers": [
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    ],
}

STAGING_TYPES: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        **{c: "timestamp_ntz" for c in ORDER_DATES},
        "delivery_days": "int",
        "estimated_days": "int",
        "delivery_delay_days": "int",
        "is_delivered": "boolean",
        "is_cancelled": "boolean",
        "is_late": "boolean",
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp_ntz",
        "price": "decimal(12,2)",
        "freight_value": "decimal(12,2)",
    },
    "order_payments": {
        "order_id": "string",
        "payment_sequential": "int",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": "decimal(12,2)",
    },
    "order_reviews": {
        "review_id": "string",
        "order_id": "string",
        "review_score": "int",
        "review_comment_title": "string",
        "review_comment_message": "string",
        "review_creation_date": "timestamp_ntz",
        "review_answer_timestamp": "timestamp_ntz",
    },
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "int",
        "customer_city": "string",
        "customer_state": "string",
    },
    "sellers": {
        "seller_id": "string",
        "seller_zip_code_prefix": "int",
        "seller_city": "string",
        "seller_state": "string",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_length": "double",
        "product_description_length": "double",
        "product_photos_qty": "double",
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
        "product_category_name_english": "string",
    },
    "geolocation": {
        "geolocation_zip_code_prefix": "int",
        "geolocation_lat": "double",
        "geolocation_lng": "double",
        "geolocation_city": "string",
        "geolocation_state": "string",
    },
}

# The two misspelled source headers and what staging calls them.
RENAMED = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}

# Columns that the model cannot do without: natural keys, references, and the date of purchase.
REQUIRED_RAW: dict[str, list[str]] = {
    "orders": ["order_id", "customer_id", "order_purchase_timestamp"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"],
    "customers": ["customer_id", "customer_unique_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
}

# What tells the rows of an entity apart in the ledger of lost values.
ROW_KEYS: dict[str, list[str]] = {
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"],
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
}


def raw_types(entity: str) -> dict[str, str]:
    """The declared type of every raw column, under its raw name."""
    types = STAGING_TYPES[entity]
    return {c: types[RENAMED.get(c, c)] for c in RAW_COLUMNS[entity]}


# Text that the usual CSV readers of the data take for a missing value.
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Entities with free text, whose fields may hold line breaks. Only these pay the
# price of putting records together from lines.
FREE_TEXT_ENTITIES = {"order_reviews"}


def raw_ddl(entity: str) -> str:
    return ", ".join(f"{c} string" for c in RAW_COLUMNS[entity])
