"""Checks of the built model against staging, and reconciliation from raw to model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators import quality
from tradewind.operators.profiling import union_all
from tradewind.operators.reconcile import reconcile, stage_metrics
from tradewind.plans import star
from tradewind.plans.warehouse import Warehouse
from tradewind.session import small_tasks

# Entity: staging table, model table.
LOADED = {
    "orders": ("orders", "fact_orders"),
    "order_items": ("order_items", "fact_order_items"),
    "payments": ("order_payments", "fact_payments"),
    "reviews": ("order_reviews", "fact_reviews"),
    "customers": ("customers", "dim_customer"),
    "sellers": ("sellers", "dim_seller"),
    "products": ("products", "dim_product"),
}

DATE_COLUMNS = [
    *("date_key", "full_date", "year", "quarter", "quarter_label", "month", "month_name", "month_short"),
    *("year_month", "day_of_month", "day_of_week", "day_name", "is_weekend"),
]
REQUIRED = {
    "dim_date": DATE_COLUMNS,
    "dim_customer": ["customer_key", "customer_id", "customer_unique_id"],
    "dim_seller": ["seller_key", "seller_id"],
    "dim_product": ["product_key", "product_id", "category_name", "category_name_english"],
    "fact_orders": [
        "order_id",
        "purchase_date_key",
        "order_status",
        "purchase_timestamp",
        "is_delivered",
        "is_cancelled",
        "customer_key",
    ],
    "fact_order_items": [
        "order_id",
        "order_item_id",
        "purchase_date_key",
        "order_status",
        "price",
        "freight_value",
        "customer_key",
        "product_key",
        "seller_key",
    ],
    "fact_payments": [
        "order_id",
        "payment_sequential",
        "purchase_date_key",
        "payment_type",
        "payment_installments",
        "payment_value",
        "customer_key",
    ],
    "fact_reviews": [
        "review_id",
        "order_id",
        "purchase_date_key",
        "review_score",
        "has_comment",
        "is_negative",
        "is_positive",
        "customer_key",
    ],
}
UNIQUE = (
    {"dim_date": [["date_key"], ["full_date"]]}
    | {table: [[natural], [key]] for table, (key, natural) in star.DIMENSION_KEYS.items()}
    | {fact: [grain] for fact, grain in star.FACT_GRAIN.items()}
)
DATE_REFERENCES = {
    "fact_orders": ["purchase_date_key", "delivered_date_key", "estimated_date_key"],
    "fact_order_items": ["purchase_date_key"],
    "fact_payments": ["purchase_date_key"],
    "fact_reviews": ["purchase_date_key", "review_date_key"],
}
KEY_REFERENCES = {
    "fact_orders": ["customer_key"],
    "fact_order_items": ["customer_key", "product_key", "seller_key"],
    "fact_payments": ["customer_key"],
    "fact_reviews": ["customer_key"],
}

EXPLANATIONS = {
    "Total reviews": "Only the latest review of an order is kept, so that reviews meet orders one to one.",
}


def row_counts(wh: Warehouse) -> DataFrame:
    return quality.compare_counts({e: (wh.staged(s), wh.table(m)) for e, (s, m) in LOADED.items()})


def money_totals(wh: Warehouse) -> DataFrame:
    return quality.compare_sums(
        {
            ("price", "freight_value"): (wh.staged("order_items"), wh.fact_order_items),
            ("payment_value",): (wh.staged("order_payments"), wh.fact_payments),
        }
    )


def _found(verdicts: DataFrame) -> DataFrame:
    """The verdicts, one row a rule, found in tasks that stay small however large the tables are.

    Groups of keys take more memory than rows on their way to a file, so their tasks are smaller still.
    """
    with small_tasks(verdicts.sparkSession, task_bytes=4 << 20, partitions=800):
        rows = verdicts.collect()
    return verdicts.sparkSession.createDataFrame(rows, verdicts.schema)


def grain(wh: Warehouse) -> DataFrame:
    return _found(quality.check_grain({f: (wh.table(f), keys) for f, keys in star.FACT_GRAIN.items()}))


def identity(wh: Warehouse) -> DataFrame:
    return quality.check_identity(wh.dim_customer, "customer_key", "customer_unique_id")


def fanout(wh: Warehouse) -> DataFrame:
    return quality.fanout(wh.fact_order_items, wh.fact_payments, "order_id", "price")


def constraints(wh: Warehouse) -> DataFrame:
    parents = {c: (wh.dim_date, "date_key") for columns in DATE_REFERENCES.values() for c in columns}
    parents |= {key: (wh.table(table), key) for table, (key, _) in star.DIMENSION_KEYS.items()}
    verdicts = union_all(
        [
            quality.check_constraints(
                table,
                wh.table(table),
                not_null=REQUIRED[table],
                unique=UNIQUE[table],
                references={
                    c: parents[c] for c in [*DATE_REFERENCES.get(table, []), *KEY_REFERENCES.get(table, [])]
                },
            )
            for table in REQUIRED
        ]
    )
    return _found(verdicts)


# The metric names below are those of the published reconciliation.
def _totals(orders, items, payments, reviews, customers, sellers, products) -> DataFrame:
    status = F.col("order_status")
    rows = F.count(F.lit(1))

    def total(c: str):
        return F.sum(F.col(c).cast("decimal(12,2)"))

    return stage_metrics(
        {
            "orders": (
                orders,
                {
                    "Total orders": F.count_distinct("order_id"),
                    "Delivered orders": F.count_if(status == "delivered"),
                    "Cancelled orders": F.count_if(status == "canceled"),
                },
            ),
            "items": (
                items,
                {
                    "Total order items": rows,
                    "Merchandise value": total("price"),
                    "Freight value": total("freight_value"),
                },
            ),
            "payments": (payments, {"Total payment records": rows, "Payment value": total("payment_value")}),
            "reviews": (reviews, {"Total reviews": rows}),
            "customers": (customers, {"Total customers (unique people)": F.count_distinct("customer_unique_id")}),
            "sellers": (sellers, {"Total sellers": F.count_distinct("seller_id")}),
            "products": (products, {"Total products": F.count_distinct("product_id")}),
        }
    )


def reconciliation(wh: Warehouse) -> DataFrame:
    """Twelve totals over raw, cleaned and model tables."""
    staged = [s for s, _ in LOADED.values()]
    return reconcile(
        {
            "raw": _totals(*[wh.raw(e) for e in staged]),
            "cleaned": _totals(*[wh.staged(e) for e in staged]),
            "model": _totals(*[wh.table(m) for _, m in LOADED.values()]),
        },
        EXPLANATIONS,
    )
