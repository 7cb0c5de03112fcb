"""Report layer: one filter over all facts, filter propagation by order, seller detail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import ratio
from tradewind.operators.profiling import union_all
from tradewind.plans.questions import order_lines, order_outcomes
from tradewind.plans.slicing import Where, condition, month_bounds
from tradewind.plans.star import MONTH_PARTITION

# What each fact contributes to the filtered totals.
FACT_MEASURES = {
    "fact_orders": None,
    "fact_order_items": "price",
    "fact_payments": "payment_value",
    "fact_reviews": "review_score",
}


def conformed_filter(model, dates: Where | None = None, customers: Where | None = None) -> dict[str, DataFrame]:
    """All four facts under one date and one customer filter, without joining facts.

    Every fact carries the customer and purchase date keys, so each is semi-joined
    with the filtered dimensions. The month is part of the date join, which prunes
    the files of the facts to the months that are left.
    """
    dates, customers = dict(dates or {}), dict(customers or {})
    month = (F.col("year") * 100 + F.col("month")).alias(MONTH_PARTITION)
    days = model.dim_date.select(F.col("date_key").alias("purchase_date_key"), month, "*")
    for name, wanted in dates.items():
        days = days.filter(condition(F.col(name), wanted))
    people = model.dim_customer
    for name, wanted in customers.items():
        people = people.filter(condition(F.col(name), wanted))
    bounds = month_bounds(dates)
    result = {}
    for fact in FACT_MEASURES:
        df = getattr(model, fact)
        if bounds is not None:
            df = df.filter(bounds & condition(F.col("purchase_date_key"), dates["purchase_date_key"]))
        if dates:
            day = ["purchase_date_key", MONTH_PARTITION]
            df = df.join(days.select(*day), day, "left_semi")
        if customers:
            df = df.join(people.select("customer_key"), "customer_key", "left_semi")
        result[fact] = df
    return result


def conformed_totals(model, dates: Where | None = None, customers: Where | None = None) -> DataFrame:
    """Rows, orders and own measure of every fact under the common filter."""
    parts = []
    for fact, df in conformed_filter(model, dates, customers).items():
        measure = FACT_MEASURES[fact]
        value = F.sum(measure) if measure else F.lit(None)
        parts.append(
            df.agg(
                F.count(F.lit(1)).alias("fact_rows"),
                F.count_distinct("order_id").alias("orders"),
                value.cast("decimal(22,2)").alias("measure_total"),
            ).select(F.lit(fact).alias("fact"), "fact_rows", "orders", "measure_total")
        )
    return union_all(parts)


def propagate(items: DataFrame, group: Sequence[str], order_fact: DataFrame) -> DataFrame:
    """Order-level rows once per group that sold something in the order.

    The order ids of a group filter the order fact; items never multiply it. Pairs are made
    distinct on the map side; where both tables lie in buckets of the order, no row moves.
    """
    return items.select(*group, "order_id").distinct().join(order_fact, "order_id")


def scores_by_category(model) -> DataFrame:
    """Reviews and lateness of the orders of each product category, every order once."""
    outcomes = order_outcomes(model).select("order_id", "is_late", "review_score")
    return (
        propagate(order_lines(model), ["category"], outcomes)
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count("review_score").alias("reviewed_orders"),
            ratio(F.sum("review_score"), F.count("review_score")).alias("avg_review_score"),
            ratio(F.count_if(F.col("is_late")), F.count("is_late"), 2, 100).alias("late_pct"),
        )
    )


def seller_detail(model, seller_id: str) -> DataFrame:
    """All measures of one seller: value from its items, the rest from the orders it took part in."""
    seller = model.dim_seller.filter(F.col("seller_id") == seller_id).select("seller_key", "seller_id", "state")
    per_order = (
        order_lines(model)
        .join(seller, "seller_key")
        .groupBy("seller_id", "state", "order_id")
        .agg(
            F.sum("items").alias("_items"),
            F.sum("price").alias("_price"),
            F.sum("freight_value").alias("_freight"),
        )
    )
    return (
        per_order.join(order_outcomes(model), "order_id")
        .groupBy("seller_id", "state")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("_items").alias("items"),
            F.sum("_price").alias("merchandise_value"),
            F.sum("_freight").alias("freight_value"),
            ratio(F.sum("_price"), F.count(F.lit(1))).alias("average_order_value"),
            ratio(F.sum("_freight"), F.sum("_price"), 2, 100).alias("freight_pct"),
            F.count("is_late").alias("delivered_orders"),
            ratio(F.count_if(F.col("is_late")), F.count("is_late"), 2, 100).alias("late_pct"),
            ratio(F.sum("delivery_delay_days"), F.count("delivery_delay_days")).alias("avg_delay_days"),
            ratio(F.sum("delivery_days"), F.count("delivery_days")).alias("avg_delivery_days"),
            F.count("review_score").alias("reviewed_orders"),
            ratio(F.sum("review_score"), F.count("review_score")).alias("avg_review_score"),
            F.count_if(F.col("is_negative")).alias("negative_reviews"),
            F.count_if(F.col("is_positive")).alias("positive_reviews"),
        )
    )
