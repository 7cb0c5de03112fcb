"""Metric layer: named measures over the facts, by any dimension attributes.

Each function takes a model, ``by`` (group attributes) and ``where`` (filters, see
``slicing``) and returns one row per group, or one row without groups. Measures of
different facts are aggregated on their own and meet as groups.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions import ratio
from tradewind.plans.slicing import By, Where, slice_fact


def _n(condition: Column | None = None) -> Column:
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def _pct(part: Column, whole: Column) -> Column:
    return ratio(part, whole, 2, 100)


def _mean(c: str) -> Column:
    return ratio(F.sum(c), F.count(c))


def _total(c: str) -> Column:
    """Sum of money in the type of a single sum, also where the column already holds sums."""
    return F.sum(c).cast("decimal(22,2)")


def _meet(frames: list[DataFrame], by: By) -> DataFrame:
    """Full outer meeting of aggregates on their groups; a null group meets a null group.

    Groups are gathered by union and one more aggregate, so a group missing from
    one side keeps null there.
    """
    columns = [c for df in frames for c in df.columns if c not in by]
    padded = [
        df.select(*by, *[F.col(c) if c in df.columns else F.lit(None).cast(dict(other.dtypes)[c]).alias(c) for other in frames for c in other.columns if c not in by])
        for df in frames
    ]
    stacked = reduce(DataFrame.unionByName, padded)
    return stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in columns])


def order_status_mix(model, by: By = (), where: Where | None = None) -> DataFrame:
    """Orders by outcome. In progress is whatever is neither delivered nor cancelled."""
    done, cancelled = F.col("is_delivered"), F.col("is_cancelled")
    return (
        slice_fact(model, "fact_orders", by, where)
        .groupBy(*by)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            _n(done).alias("completed_orders"),
            _n(cancelled).alias("cancelled_orders"),
            _n(~done & ~cancelled).alias("in_progress_orders"),
        )
    )


def customers(model, by: By = (), where: Where | None = None) -> DataFrame:
    """People, and those with more than one order within the group."""
    per_person = (
        slice_fact(model, "fact_orders", [*by, "customer_unique_id"], where)
        .groupBy(*by, "customer_unique_id")
        .agg(F.count_distinct("order_id").alias("_orders"))
    )
    repeat = _n(F.col("_orders") > 1)
    return per_person.groupBy(*by).agg(
        F.count("customer_unique_id").alias("customers"),
        repeat.alias("repeat_customers"),
        _pct(repeat, F.count("customer_unique_id")).alias("repeat_customer_pct"),
    )


def new_customers(model, period: str = "year_month", by: By = (), where: Where | None = None) -> DataFrame:
    """People by the period of their first order. ``period`` is a calendar attribute.

    With ``by``, a person is new in a group at their first order within it; ``where`` filters the
    orders that are looked at.
    """
    first = (
        slice_fact(model, "fact_orders", [*by, "customer_unique_id"], where)
        .groupBy(*by, "customer_unique_id")
        .agg(F.min("purchase_date_key").alias("date_key"))
    )
    return (
        first.join(model.dim_date.select("date_key", period), "date_key")
        .groupBy(*by, period)
        .agg(_n().alias("new_customers"))
    )


def merchandise(model, by: By = (), where: Where | None = None) -> DataFrame:
    values = ["price", "freight_value"]
    return (
        slice_fact(model, "fact_order_items", by, where, sums=values)
        .groupBy(*by)
        .agg(*[_total(c).alias(n) for c, n in zip(values, ("merchandise_value", "freight_value"), strict=True)])
    )


def financials(model, by: By = (), where: Where | None = None) -> DataFrame:
    """Merchandise, freight and payment value, each from its own fact, never added up."""
    value = "payment_value"
    paid = slice_fact(model, "fact_payments", by, where, sums=[value]).groupBy(*by).agg(_total(value).alias(value))
    return _meet([merchandise(model, by, where), paid], by)


def average_order_value(model, by: By = (), where: Where | None = None) -> DataFrame:
    """Merchandise value over all orders, those without items included."""
    orders = (
        slice_fact(model, "fact_orders", by, where)
        .groupBy(*by)
        .agg(F.count_distinct("order_id").alias("total_orders"))
    )
    both = _meet([orders, merchandise(model, by, where).drop("freight_value")], by)
    return both.withColumn("average_order_value", ratio(F.col("merchandise_value"), F.col("total_orders")))


def freight_pct(model, by: By = (), where: Where | None = None) -> DataFrame:
    values = merchandise(model, by, where)
    return values.withColumn("freight_pct", _pct(F.col("freight_value"), F.col("merchandise_value")))


def contribution_pct(model, by: By, where: Where | None = None) -> DataFrame:
    """Share of each group in the merchandise value of all groups.

    The total is a scalar subquery, so groups as many as sellers or products stay distributed.
    """
    values = merchandise(model, by, where).drop("freight_value")
    total = values.agg(F.sum("merchandise_value")).scalar()
    return values.withColumn("contribution_pct", _pct(F.col("merchandise_value"), total))


def delivery_rates(model, by: By = (), where: Where | None = None) -> DataFrame:
    """On-time and late percentages and mean day counts, over orders with a delivery date."""
    delay = F.col("delivery_delay_days")
    delivered = slice_fact(model, "fact_orders", by, where).filter(F.col("delivered_date_key").isNotNull())
    return delivered.groupBy(*by).agg(
        _n().alias("delivered_orders"),
        _pct(_n(delay <= 0), _n()).alias("on_time_pct"),
        _pct(_n(delay > 0), _n()).alias("late_pct"),
        _mean("delivery_delay_days").alias("avg_delay_days"),
        _mean("delivery_days").alias("avg_delivery_days"),
        _mean("estimated_days").alias("avg_estimated_days"),
    )


def reviews(model, by: By = (), where: Where | None = None) -> DataFrame:
    """Scores over reviewed orders only."""
    return (
        slice_fact(model, "fact_reviews", by, where)
        .groupBy(*by)
        .agg(
            F.count_distinct("order_id").alias("reviewed_orders"),
            _mean("review_score").alias("avg_review_score"),
            _n(F.col("is_negative")).alias("negative_reviews"),
            _n(F.col("is_positive")).alias("positive_reviews"),
        )
    )


# Time intelligence. The input of these has one row per group and month: the group attributes,
# year_month and one measure. Without one it is the merchandise value by ``by``, filtered by ``where``.


def monthly_merchandise(model, by: By = (), where: Where | None = None) -> DataFrame:
    return merchandise(model, [*by, "year_month"], where).drop("freight_value")


def _number(month: Column) -> Column:
    """A running number of months from ``yyyy-mm``."""
    return F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int") - 1


def _label(number: Column) -> Column:
    return F.format_string("%04d-%02d", F.floor(number / 12).cast("int"), (number % 12 + 1).cast("int"))


def shifted(monthly: DataFrame, value: str, months: Mapping[str, int], by: By = ()) -> DataFrame:
    """The measure of every group and month next to its values some calendar months earlier.

    ``months`` gives the names and distances of the earlier values. Months are shifted on the
    calendar, not by row, so a month without data gives null to the months after it instead of the
    value of an older one. With groups, each has a row for every month from the first to the last of
    the input, so that groups line up; without, a month without data has no row.

    Months of a group are gathered into one row, as many values as months, and looked up there. All
    parts of the plan start from these rows, so the input is read and summed once. Without groups each
    row is written out at its own month and at the later ones that look back on it, and one aggregate
    by month gathers them.
    """
    dated = monthly.select(*by, _number(F.col("year_month")).alias("_no"), F.col(value).alias("_value"))
    kind = monthly.schema[value].dataType
    if by:
        sums = dated.filter("_no IS NOT NULL").groupBy(*by, "_no").agg(F.max("_value").alias("_value"))
        groups = sums.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_no", "_value"))).alias("_months"))
        numbers = F.map_keys("_months")
        span = groups.agg(F.struct(F.min(F.array_min(numbers)), F.max(F.array_max(numbers))).alias("_span")).scalar()
        rows = groups.withColumn("_no", F.explode(F.sequence(span["col1"], span["col2"])))
        looked = [F.element_at("_months", F.col("_no") - k).cast(kind).alias(n) for n, k in {value: 0, **months}.items()]
        return rows.select(*by, _label(F.col("_no")).alias("year_month"), *looked)
    names = [value, *months]
    places = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("later")) for n, k in {value: 0, **months}.items()])
    spread = dated.select("_no", "_value", F.inline(places)).select((F.col("_no") + F.col("later")).alias("_no"), "name", "_value")
    values = [F.max(F.when(F.col("name") == n, F.col("_value"))).cast(kind).alias(n) for n in names]
    gathered = spread.groupBy("_no").agg(*values, F.count_if(F.col("name") == value).alias("_rows")).filter("_rows > 0")
    return gathered.select(_label(F.col("_no")).alias("year_month"), *names)


def _monthly(model, monthly: DataFrame | None, by: By, where: Where | None) -> DataFrame:
    return monthly_merchandise(model, by, where) if monthly is None else monthly


def prev_month(
    model, monthly: DataFrame | None = None, value: str = "merchandise_value", by: By = (), where: Where | None = None
) -> DataFrame:
    return shifted(_monthly(model, monthly, by, where), value, {"prev_month_value": 1}, by)


def prev_year(
    model, monthly: DataFrame | None = None, value: str = "merchandise_value", by: By = (), where: Where | None = None
) -> DataFrame:
    return shifted(_monthly(model, monthly, by, where), value, {"prev_year_value": 12}, by)


def _growth(df: DataFrame, value: str, base: str, name: str) -> DataFrame:
    return df.withColumn(name, _pct(F.col(value) - F.col(base), F.col(base)))


def mom_growth(
    model, monthly: DataFrame | None = None, value: str = "merchandise_value", by: By = (), where: Where | None = None
) -> DataFrame:
    return _growth(prev_month(model, monthly, value, by, where), value, "prev_month_value", "mom_growth_pct")


def yoy_growth(
    model, monthly: DataFrame | None = None, value: str = "merchandise_value", by: By = (), where: Where | None = None
) -> DataFrame:
    return _growth(prev_year(model, monthly, value, by, where), value, "prev_year_value", "yoy_growth_pct")


def year_to_date(
    model, monthly: DataFrame | None = None, value: str = "merchandise_value", by: By = (), where: Where | None = None
) -> DataFrame:
    """Running sum within group and year; a month without data repeats the sum so far."""
    dense = shifted(_monthly(model, monthly, by, where), value, {}, by)
    year = F.substring("year_month", 1, 4)
    so_far = Window.partitionBy(*by, year).orderBy("year_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dense.select(*by, "year_month", value, F.sum(value).over(so_far).alias("ytd_value"))


def complete_months(
    model, monthly: DataFrame | None = None, by: By = (), where: Where | None = None
) -> DataFrame:
    """Drop months that the data does not cover from first to last day."""
    monthly = _monthly(model, monthly, by, where)
    covered = model.fact_orders.agg(
        F.min("purchase_date_key").alias("first_day"), F.max("purchase_date_key").alias("last_day")
    )
    days = model.dim_date.groupBy("year_month").agg(
        F.min("date_key").alias("_month_first"), F.max("date_key").alias("_month_last")
    )
    inside = (F.col("_month_first") >= covered.select("first_day").scalar()) & (
        F.col("_month_last") <= covered.select("last_day").scalar()
    )
    return monthly.join(days.filter(inside).select("year_month"), "year_month")
