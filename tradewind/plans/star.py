"""Star schema: four dimensions and four facts, each fact at its own grain."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import date_key, month_key
from tradewind.operators.calendar import calendar_for
from tradewind.operators.cleaning import lookup
from tradewind.operators.keys import with_dense_key

# Facts are stored by purchase month. The column repeats what purchase_date_key says,
# at the granularity that files are pruned by.
MONTH_PARTITION = "purchase_month"

# Tables stored in buckets of the order id: those for questions by order, which meet without a
# shuffle, and the items that the items' fact and the lines are both made of.
ORDER_LAYOUT = ["order_items", "order_lines", "order_outcomes"]

# Those that a join on the order id ends with; its partitions are the buckets.
JOINED_BY_ORDER = ["order_items", "order_outcomes"]

# Surrogate key and natural key of the dimensions that have both.
DIMENSION_KEYS = {
    "dim_customer": ("customer_key", "customer_id"),
    "dim_seller": ("seller_key", "seller_id"),
    "dim_product": ("product_key", "product_id"),
}

FACT_KEYS = {
    "fact_orders": "order_key",
    "fact_order_items": "order_item_key",
    "fact_payments": "payment_key",
    "fact_reviews": "review_key",
}

FACT_GRAIN = {
    "fact_orders": ["order_id"],
    "fact_order_items": ["order_id", "order_item_id"],
    "fact_payments": ["order_id", "payment_sequential"],
    "fact_reviews": ["order_id"],
}


def build_dimension(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Number the rows of a stored staging table and rename its columns (new name to old name)."""
    keyed = with_dense_key(df.select(*columns.values()), key)
    return keyed.select(key, *[F.col(old).alias(new) for new, old in columns.items()])


def locate(df: DataFrame, geo: DataFrame) -> DataFrame:
    """Coordinates of the zip prefix; the job fails if ``geo`` holds a prefix twice."""
    points = geo.select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").alias("latitude"),
        F.col("geolocation_lng").alias("longitude"),
    )
    return lookup(df, points, "zip_code_prefix", {"latitude": None, "longitude": None})


def build_dim_date(stg_orders: DataFrame, stg_reviews: DataFrame) -> DataFrame:
    """Whole years covering every purchase, delivery, estimate and review date."""
    columns = ["order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"]
    bounds = stg_orders.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)])
    reviews = stg_reviews.agg(F.min("review_creation_date").alias("a"), F.max("review_creation_date").alias("b"))
    days = bounds.select(F.explode(F.array(*bounds.columns)).alias("day")).unionByName(
        reviews.select(F.explode(F.array("a", "b")).alias("day"))
    )
    return calendar_for(days, "day")


def build_dim_customer(stg_customers: DataFrame, geo: DataFrame) -> DataFrame:
    customers = build_dimension(
        stg_customers,
        "customer_key",
        {
            "customer_id": "customer_id",
            "customer_unique_id": "customer_unique_id",
            "zip_code_prefix": "customer_zip_code_prefix",
            "city": "customer_city",
            "state": "customer_state",
        },
    )
    return locate(customers, geo)


def build_dim_seller(stg_sellers: DataFrame, geo: DataFrame) -> DataFrame:
    sellers = build_dimension(
        stg_sellers,
        "seller_key",
        {
            "seller_id": "seller_id",
            "zip_code_prefix": "seller_zip_code_prefix",
            "city": "seller_city",
            "state": "seller_state",
        },
    )
    return locate(sellers, geo)


def build_dim_product(stg_products: DataFrame) -> DataFrame:
    return build_dimension(
        stg_products,
        "product_key",
        {
            "product_id": "product_id",
            "category_name": "product_category_name",
            "category_name_english": "product_category_name_english",
            "weight_g": "product_weight_g",
            "length_cm": "product_length_cm",
            "height_cm": "product_height_cm",
            "width_cm": "product_width_cm",
            "photos_qty": "product_photos_qty",
        },
    )


def build_fact_orders(stg_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    customers = dim_customer.select("customer_id", "customer_key")
    purchase = F.col("order_purchase_timestamp")
    # Dates that only their keys are needed of become keys before they are shuffled.
    orders = stg_orders.withColumns(
        {
            "delivered_date_key": date_key(F.col("order_delivered_customer_date")),
            "estimated_date_key": date_key(F.col("order_estimated_delivery_date")),
        }
    )
    return orders.join(customers, "customer_id").select(
        "order_id",
        "customer_key",
        date_key(purchase).alias("purchase_date_key"),
        "delivered_date_key",
        "estimated_date_key",
        "order_status",
        purchase.alias("purchase_timestamp"),
        "delivery_days",
        "estimated_days",
        "delivery_delay_days",
        "is_delivered",
        "is_cancelled",
        "is_late",
        month_key(purchase).alias(MONTH_PARTITION),
    )


def conform(df: DataFrame, fact_orders: DataFrame, *carried: str, shuffled: bool = False) -> DataFrame:
    """Add customer key, purchase date and further order columns to rows that only know their order.

    One join with the order fact brings everything, as that fact has met the
    customer dimension already. It is a shuffle join whatever the sizes if the rows
    are to lie by order.
    """
    order = fact_orders.select("order_id", "customer_key", "purchase_date_key", MONTH_PARTITION, *carried)
    return df.join(order.hint("merge") if shuffled else order, "order_id")


def build_order_items(
    stg_items: DataFrame, fact_orders: DataFrame, dim_product: DataFrame, dim_seller: DataFrame
) -> DataFrame:
    """Items with all keys and the category of their product, by order: the last join is on the order.

    The fact and the lines are both made of these rows, so items meet products and orders once.
    """
    items = stg_items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    items = items.join(dim_seller.select("seller_id", "seller_key"), "seller_id")
    products = dim_product.select("product_id", "product_key", F.col("category_name_english").alias("category"))
    items = items.join(products, "product_id")
    return conform(items, fact_orders, "order_status", shuffled=True).select(
        "order_id",
        "order_item_id",
        "customer_key",
        "product_key",
        "seller_key",
        "purchase_date_key",
        "order_status",
        "price",
        "freight_value",
        MONTH_PARTITION,
        "category",
    )


def build_fact_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.drop("category")


def build_fact_payments(stg_payments: DataFrame, fact_orders: DataFrame) -> DataFrame:
    return conform(stg_payments, fact_orders, "order_status").select(
        "order_id",
        "payment_sequential",
        "customer_key",
        "purchase_date_key",
        "order_status",
        "payment_type",
        "payment_installments",
        "payment_value",
        MONTH_PARTITION,
    )


def build_fact_reviews(stg_reviews: DataFrame, fact_orders: DataFrame) -> DataFrame:
    score: Column = F.col("review_score")
    reviews = stg_reviews.select(
        "review_id",
        "order_id",
        date_key(F.col("review_creation_date")).alias("review_date_key"),
        "review_score",
        F.col("review_comment_message").isNotNull().alias("has_comment"),
        (score <= 2).alias("is_negative"),
        (score >= 4).alias("is_positive"),
    )
    return conform(reviews, fact_orders).select(
        "review_id",
        "order_id",
        "customer_key",
        "purchase_date_key",
        "review_date_key",
        "review_score",
        "has_comment",
        "is_negative",
        "is_positive",
        MONTH_PARTITION,
    )


def build_order_lines(items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """One row per order, product and seller, from the items' fact or from ``order_items``.

    Items that lie in buckets of the order are summed where they are. Others are combined on the map
    side and dealt by all keys, so an order with very many items is split before it is ever stored
    as one; then it has a row for each product it holds. A product has one category, which
    ``order_items`` already hold. Money travels as whole cents, half as wide as a decimal sum, and is
    a decimal again when stored.
    """
    cents = [(F.col(c) * 100).cast("long").alias(c) for c in ("price", "freight_value")]
    keys = ["order_id", "product_key", "seller_key", *[c for c in items.columns if c == "category"]]
    lines = items.select(*keys, *cents)
    lines = lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("items"), F.sum("price").alias("price"), F.sum("freight_value").alias("freight_value")
    )
    if "category" not in keys:
        products = dim_product.select("product_key", F.col("category_name_english").alias("category"))
        lines = lines.join(products, "product_key")
    money = [(F.col(c).cast("decimal(20,0)") / 100).cast("decimal(22,2)").alias(c) for c in ("price", "freight_value")]
    return lines.select("order_id", "product_key", "seller_key", "category", "items", *money)


def build_order_outcomes(fact_orders: DataFrame, fact_reviews: DataFrame) -> DataFrame:
    """One row per order: how it was delivered and how it was reviewed, by order, as a shuffle join leaves them."""
    reviews = fact_reviews.select(
        "order_id", F.lit(True).alias("is_reviewed"), "review_score", "is_negative", "is_positive"
    )
    orders = fact_orders.select("order_id", "is_late", "delivery_days", "delivery_delay_days")
    joined = orders.join(reviews.hint("merge"), "order_id", "left")
    return joined.withColumn("is_reviewed", F.coalesce("is_reviewed", F.lit(False)))
