"""The sixteen business questions, asked of the star schema.

Every function takes a model (any object with the dimension and fact tables as
attributes) and returns a lazy DataFrame. Thresholds are parameters. Measures are
summed from their own fact; facts meet only where one side has one row per order.
Results with a limit carry a unique last sort column, so ties are settled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions import ratio, share
from tradewind.operators.keys import tile_summary
from tradewind.plans.star import MONTH_PARTITION, build_order_lines, build_order_outcomes

# Upper bounds in days and labels of the report buckets; the last has no bound.
GAP_BUCKETS = [
    (0, "1. Same day"),
    (30, "2. 1-30 days"),
    (90, "3. 31-90 days"),
    (180, "4. 91-180 days"),
    (None, "5. Over 180 days"),
]
DELAY_BUCKETS = [
    (-10, "1. 10+ days early"),
    (-1, "2. 1-9 days early"),
    (0, "3. On estimated day"),
    (7, "4. 1-7 days late"),
    (14, "5. 8-14 days late"),
    (None, "6. 15+ days late"),
]


def _bucket(days: Column, buckets: list[tuple[int | None, str]]) -> Column:
    """Label of the first bucket whose bound is not exceeded."""
    label = F.lit(buckets[-1][1])
    for bound, text in reversed(buckets[:-1]):
        label = F.when(days <= bound, text).otherwise(label)
    return label


def _n(condition: Column | None = None) -> Column:
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def _mean(c: str, places: int = 2) -> Column:
    return ratio(F.sum(c), F.count(c), places)


def order_lines(model) -> DataFrame:
    """The stored lines by order where the model has them, else the same rows from its tables."""
    stored = getattr(model, "order_lines", None)
    return build_order_lines(model.fact_order_items, model.dim_product) if stored is None else stored


def order_outcomes(model) -> DataFrame:
    stored = getattr(model, "order_outcomes", None)
    return build_order_outcomes(model.fact_orders, model.fact_reviews) if stored is None else stored


def _by_category(model, items: DataFrame | None = None) -> DataFrame:
    products = model.dim_product.select("product_key", F.col("category_name_english").alias("category"))
    return (model.fact_order_items if items is None else items).join(products, "product_key")


def _with_state(model, fact: DataFrame) -> DataFrame:
    return fact.join(model.dim_customer.select("customer_key", "state"), "customer_key")


def _with_day(model, fact: DataFrame, *attributes: str) -> DataFrame:
    days = model.dim_date.select(F.col("date_key").alias("purchase_date_key"), *attributes)
    return fact.join(days, "purchase_date_key")


def _spend_per_person(model, value: str) -> DataFrame:
    """Merchandise value per person.

    Items are added up per customer key first; the customer join then reuses that
    partitioning and sees one row per order instead of one per item.
    """
    per_key = model.fact_order_items.groupBy("customer_key").agg(F.sum("price").alias("_value"))
    people = model.dim_customer.select("customer_key", "customer_unique_id")
    return per_key.join(people, "customer_key").groupBy("customer_unique_id").agg(F.sum("_value").alias(value))


def monthly_growth(model) -> DataFrame:
    monthly = (
        _with_day(model, model.fact_order_items, "year_month")
        .groupBy("year_month")
        .agg(F.count_distinct("order_id").alias("orders"), F.sum("price").alias("merchandise_value"))
    )
    # One row per month: an unpartitioned window is fine here.
    previous = F.lag("merchandise_value").over(Window.orderBy("year_month"))
    return (
        monthly.withColumn("prev_month_value", previous)
        .withColumn(
            "mom_growth_pct",
            ratio(F.col("merchandise_value") - F.col("prev_month_value"), F.col("prev_month_value"), 2, 100),
        )
        .orderBy("year_month")
    )


def ytd_revenue(model) -> DataFrame:
    monthly = (
        _with_day(model, model.fact_order_items, "year", "month", "year_month")
        .groupBy("year", "month", "year_month")
        .agg(F.sum("price").alias("merchandise_value"))
    )
    so_far = Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select(
        "year",
        "year_month",
        "merchandise_value",
        F.sum("merchandise_value").over(so_far).alias("ytd_merchandise_value"),
    ).orderBy("year", "year_month")


def top_categories(model, top: int = 10) -> DataFrame:
    totals = (
        _by_category(model)
        .groupBy("category")
        .agg(F.count_distinct("order_id").alias("orders"), F.sum("price").alias("merchandise_value"))
    )
    return (
        totals.withColumn("contribution_pct", share(F.col("merchandise_value")))
        .orderBy(F.desc("merchandise_value"), "category")
        .limit(top)
    )


def top_sellers_by_state(model, top: int = 3) -> DataFrame:
    per_seller = model.fact_order_items.groupBy("seller_key").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("price").alias("merchandise_value")
    )
    sellers = per_seller.join(model.dim_seller.select("seller_key", "seller_id", "state"), "seller_key")
    rank = F.dense_rank().over(Window.partitionBy("state").orderBy(F.desc("merchandise_value")))
    return (
        sellers.withColumn("state_rank", rank)
        .filter(F.col("state_rank") <= top)
        .select("state", "state_rank", "seller_id", "orders", "merchandise_value")
        .orderBy("state", "state_rank", "seller_id")
    )


def repeat_customers(model) -> DataFrame:
    people = model.dim_customer.select("customer_key", "customer_unique_id")
    orders = model.fact_orders.groupBy("customer_key").agg(F.count_distinct("order_id").alias("_orders"))
    value = model.fact_order_items.groupBy("customer_key").agg(F.sum("price").alias("_value"))
    # Orders belong to one customer key each, so distinct orders add up over the keys of a
    # person. All three sides are partitioned by customer key and meet without further shuffles.
    per_person = (
        orders.join(people, "customer_key")
        .join(value, "customer_key", "left")
        .groupBy("customer_unique_id")
        .agg(F.sum("_orders").alias("_orders"), F.coalesce(F.sum("_value"), F.lit(0)).alias("_value"))
    )
    kind = F.when(F.col("_orders") > 1, "Repeat").otherwise("One-time")
    totals = per_person.groupBy(kind.alias("customer_type")).agg(
        _n().alias("customers"), F.sum("_value").alias("merchandise_value")
    )
    return totals.select(
        "customer_type",
        "customers",
        share(F.col("customers")).alias("pct_of_customers"),
        "merchandise_value",
        share(F.col("merchandise_value")).alias("pct_of_revenue"),
        ratio(F.col("merchandise_value"), F.col("customers")).alias("revenue_per_customer"),
    ).orderBy("customer_type")


def second_order_gap(model) -> DataFrame:
    people = model.dim_customer.select("customer_key", "customer_unique_id")
    purchases = model.fact_orders.select("customer_key", "order_id", "purchase_timestamp").join(people, "customer_key")
    earliest = Window.partitionBy("customer_unique_id").orderBy("purchase_timestamp", "order_id")
    # Only the first two orders matter. The rank filter runs before the shuffle as well, so a
    # person with very many orders sends two rows per task.
    first_two = purchases.withColumn("_seq", F.row_number().over(earliest)).filter("_seq <= 2")
    gaps = (
        first_two.groupBy("customer_unique_id")
        .agg(F.min("purchase_timestamp").alias("_first"), F.max("purchase_timestamp").alias("_second"), _n().alias("_n"))
        .filter("_n = 2")
        .select(F.datediff(F.col("_second").cast("date"), F.col("_first").cast("date")).alias("_days"))
    )
    bucket = _bucket(F.col("_days"), GAP_BUCKETS).alias("gap_bucket")
    counts = gaps.groupBy(bucket).agg(_n().alias("customers"))
    return counts.withColumn("pct", share(F.col("customers"))).orderBy("gap_bucket")


def state_delivery(model) -> DataFrame:
    delivered = model.fact_orders.filter("delivery_days IS NOT NULL").select(
        "order_id", "customer_key", "delivery_days", "is_late"
    )
    scores = model.fact_reviews.select("order_id", "review_score")
    return (
        _with_state(model, delivered.join(scores, "order_id", "left"))
        .groupBy("state")
        .agg(
            _n().alias("delivered_orders"),
            _mean("delivery_days").alias("avg_delivery_days"),
            ratio(_n(F.col("is_late")), _n(), 2, 100).alias("late_pct"),
            _mean("review_score").alias("avg_review_score"),
        )
        .orderBy(F.desc("late_pct"), "state")
    )


def delay_vs_score(model) -> DataFrame:
    delay = F.col("delivery_delay_days")
    bucket = _bucket(delay, DELAY_BUCKETS).alias("delay_bucket")
    return (
        order_outcomes(model)
        .filter(delay.isNotNull() & F.col("is_reviewed"))
        .select(bucket, "review_score", "is_negative")
        .groupBy("delay_bucket")
        .agg(
            _n().alias("reviewed_orders"),
            _mean("review_score").alias("avg_review_score"),
            ratio(_n(F.col("is_negative")), _n(), 2, 100).alias("negative_review_pct"),
        )
        .orderBy("delay_bucket")
    )


def at_risk_categories(model) -> DataFrame:
    # One row per order and category: a review counts once for every category in its order.
    # Both tables lie in buckets of the order, so the sum and the join move no row.
    lines = order_lines(model).groupBy("order_id", "category").agg(F.sum("price").alias("_value"))
    scores = order_outcomes(model).select("order_id", "is_reviewed", "review_score")
    per_category = (
        lines.join(scores, "order_id", "left")
        .groupBy("category")
        .agg(
            F.sum("_value").alias("merchandise_value"),
            F.count_if("is_reviewed").alias("reviewed_orders"),
            F.sum("review_score").alias("_score"),
            F.count("review_score").alias("_scored"),
        )
    )
    # One row per category from here on: unpartitioned windows are fine.
    everything = Window.partitionBy()
    above_mean = F.col("merchandise_value") * F.col("_n").cast("decimal(12,0)") > F.col("_sum")
    overall = model.fact_reviews.agg(F.avg("review_score")).scalar()
    return (
        per_category.withColumns(
            {
                "revenue_rank": F.rank().over(Window.orderBy(F.desc("merchandise_value"))),
                "_sum": F.sum("merchandise_value").over(everything),
                "_n": F.count("merchandise_value").over(everything),
            }
        )
        .filter(above_mean & (F.col("_score") / F.col("_scored") < overall))
        .select(
            "revenue_rank",
            "category",
            "merchandise_value",
            "reviewed_orders",
            ratio(F.col("_score"), F.col("_scored")).alias("avg_review_score"),
        )
        .orderBy("revenue_rank", "category")
    )


def freight_burden(model, min_items: int = 100, top: int = 15) -> DataFrame:
    # Items are summed per product before they meet the dimension.
    items = model.fact_order_items.groupBy("product_key").agg(
        _n().alias("_items"),
        F.count("price").alias("_prices"),
        F.count("freight_value").alias("_freights"),
        F.sum("price").alias("_price"),
        F.sum("freight_value").alias("_freight"),
    )
    products = model.dim_product.select("product_key", F.col("category_name_english").alias("category"))
    return (
        items.join(products, "product_key")
        .groupBy("category")
        .agg(
            F.sum("_items").alias("items_sold"),
            ratio(F.sum("_price"), F.sum("_prices")).alias("avg_price"),
            ratio(F.sum("_freight"), F.sum("_freights")).alias("avg_freight"),
            ratio(F.sum("_freight"), F.sum("_price"), 2, 100).alias("freight_pct"),
        )
        .filter(F.col("items_sold") >= min_items)
        .orderBy(F.desc("freight_pct"), "category")
        .limit(top)
    )


def payment_mix(model) -> DataFrame:
    totals = model.fact_payments.groupBy("payment_type").agg(
        F.count_distinct("order_id").alias("orders"),
        _n().alias("transactions"),
        F.sum("payment_value").alias("payment_value"),
        _mean("payment_value").alias("avg_transaction_value"),
        _mean("payment_installments").alias("avg_installments"),
    )
    return totals.select(
        "payment_type",
        "orders",
        "transactions",
        "payment_value",
        share(F.col("payment_value")).alias("pct_of_payment_value"),
        "avg_transaction_value",
        "avg_installments",
    ).orderBy(F.desc("payment_value"), "payment_type")


def seller_watchlist(model, min_orders: int = 30, top: int = 20) -> DataFrame:
    # One row per seller and order, summed and joined within the buckets of the order. Where sellers are
    # many, a bucket's sums by seller are nearly as many as its rows: they travel as whole cents.
    cents = (F.col("price") * 100).cast("long")
    lines = order_lines(model).groupBy("order_id", "seller_key").agg(F.sum(cents).alias("_cents"))
    outcomes = order_outcomes(model).select("order_id", "is_late", "review_score")
    performance = (
        lines.join(outcomes, "order_id")
        .groupBy("seller_key")
        .agg(
            _n().alias("orders"),
            (F.sum("_cents").cast("decimal(20,0)") / 100).cast("decimal(38,2)").alias("merchandise_value"),
            ratio(_n(F.col("is_late")), F.count("is_late"), 2, 100).alias("late_pct"),
            _mean("review_score").alias("avg_review_score"),
        )
        .filter(F.col("orders") >= min_orders)
    )
    return (
        performance.join(model.dim_seller.select("seller_key", "seller_id", "state"), "seller_key")
        .select("seller_id", "state", "orders", "merchandise_value", "late_pct", "avg_review_score")
        .orderBy(F.desc_nulls_last("late_pct"), "seller_id")
        .limit(top)
    )


def cancellation_trend(model) -> DataFrame:
    return (
        _with_day(model, model.fact_orders, "year_month")
        .groupBy("year_month")
        .agg(
            _n().alias("orders"),
            _n(F.col("is_cancelled")).alias("cancelled"),
            _n(F.col("order_status") == "unavailable").alias("unavailable"),
            ratio(_n(F.col("is_cancelled")), _n(), 2, 100).alias("cancellation_pct"),
        )
        .orderBy("year_month")
    )


def spend_quartiles(model, tiles: int = 4) -> DataFrame:
    parts = tile_summary(_spend_per_person(model, "total_spend"), "total_spend", tiles)
    return parts.select(
        F.col("tile").alias("spend_quartile"),
        F.col("n").alias("customers"),
        F.col("min_value").alias("min_spend"),
        F.col("max_value").alias("max_spend"),
        ratio(F.col("total"), F.col("n_valued")).alias("avg_spend"),
        share(F.col("total")).alias("pct_of_revenue"),
    ).orderBy("spend_quartile")


def estimate_accuracy(model, min_orders: int = 500) -> DataFrame:
    measured = model.fact_orders.filter("delivery_days IS NOT NULL AND estimated_days IS NOT NULL").select(
        "customer_key",
        "estimated_days",
        "delivery_days",
        (F.col("estimated_days") - F.col("delivery_days")).alias("_buffer"),
        "delivery_delay_days",
    )
    return (
        _with_state(model, measured)
        .groupBy("state")
        .agg(
            _n().alias("delivered_orders"),
            _mean("estimated_days").alias("avg_promised_days"),
            _mean("delivery_days").alias("avg_actual_days"),
            _mean("_buffer").alias("avg_buffer_days"),
            ratio(_n(F.col("delivery_delay_days") <= -10), _n(), 2, 100).alias("pct_10plus_days_early"),
        )
        .filter(F.col("delivered_orders") >= min_orders)
        .orderBy(F.desc("avg_buffer_days"), "state")
    )


def filtered_category_revenue(model, first_day: int, last_day: int, state: str) -> DataFrame:
    """Category revenue of one customer state between two date keys.

    The month bounds restate the date bounds on the partition column, so only the
    files of those months are opened.
    """
    items = model.fact_order_items.filter(
        F.col(MONTH_PARTITION).between(first_day // 100, last_day // 100)
        & F.col("purchase_date_key").between(first_day, last_day)
    )
    of_state = _with_state(model, items).filter(F.col("state") == state)
    return (
        _by_category(model, of_state)
        .groupBy("category")
        .agg(F.count_distinct("order_id").alias("orders"), F.sum("price").alias("merchandise_value"))
        .orderBy(F.desc("merchandise_value"), "category")
    )
