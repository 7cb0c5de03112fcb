"""Group and filter facts by dimension attributes, joining only the dimensions that are named."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.plans.star import MONTH_PARTITION


@dataclass(frozen=True)
class Between:
    """Inclusive range, for use as a filter value."""

    low: Any
    high: Any


@dataclass(frozen=True)
class _Link:
    table: str
    key: str
    fact_key: str
    attributes: Mapping[str, str]


LINKS = [
    _Link(
        "dim_date",
        "date_key",
        "purchase_date_key",
        {
            a: a
            for a in (
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
            )
        },
    ),
    _Link(
        "dim_customer",
        "customer_key",
        "customer_key",
        {
            "customer_unique_id": "customer_unique_id",
            "customer_zip": "zip_code_prefix",
            "customer_city": "city",
            "customer_state": "state",
        },
    ),
    _Link(
        "dim_product",
        "product_key",
        "product_key",
        {"category": "category_name_english", "category_name": "category_name"},
    ),
    _Link(
        "dim_seller",
        "seller_key",
        "seller_key",
        {
            "seller_id": "seller_id",
            "seller_zip": "zip_code_prefix",
            "seller_city": "city",
            "seller_state": "state",
        },
    ),
]

By = Sequence[str]
Where = Mapping[str, Any]


def condition(column: Column, wanted: Any) -> Column:
    """Equality, membership (list) or range (``Between``)."""
    if isinstance(wanted, Between):
        return column.between(wanted.low, wanted.high)
    if isinstance(wanted, (list, tuple, set)):
        return column.isin(list(wanted))
    return column == F.lit(wanted)


def month_bounds(where: Where) -> Column | None:
    """What a filter on the purchase date says about the month partition."""
    wanted = where.get("purchase_date_key")
    if isinstance(wanted, Between):
        return F.col(MONTH_PARTITION).between(wanted.low // 100, wanted.high // 100)
    if isinstance(wanted, int):
        return F.col(MONTH_PARTITION) == wanted // 100
    return None


def slice_fact(model, fact: str, by: By = (), where: Where | None = None, sums: Sequence[str] = ()) -> DataFrame:
    """The fact with the attributes in ``by``, filtered by ``where``.

    Names are attributes of a dimension or columns of the fact itself. A filter on
    a dimension goes to that dimension before the join. The calendar is joined on
    the month as well as the day: the month is the partition column, so a filter on
    any calendar attribute prunes the files of the fact.

    ``sums`` names the measures of a caller that only adds them up. They are then summed per
    key before the join, so that a large dimension meets a row per key instead of the raw
    rows. With two dimensions, the calendar among them or not, pairs of keys are nearly as many as
    rows and the sum would only be a further shuffle: rows are joined as they are.
    """
    where = dict(where or {})
    df: DataFrame = getattr(model, fact)
    known = set(df.columns)
    bounds = month_bounds(where) if MONTH_PARTITION in known else None
    if bounds is not None:
        df = df.filter(bounds)
    for name in [n for n in where if n in known]:
        df = df.filter(condition(F.col(name), where.pop(name)))
    missing = [n for n in dict.fromkeys([*by, *where]) if n not in known]
    joined = [link for link in LINKS if link.fact_key in known and not link.attributes.keys().isdisjoint(missing)]
    if sums and len(joined) == 1:
        keys = [link.fact_key for link in joined]
        if MONTH_PARTITION in known and "purchase_date_key" in keys:
            keys.append(MONTH_PARTITION)
        keys = dict.fromkeys([*keys, *[n for n in by if n in known]])
        df = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    for link in LINKS:
        wanted = [n for n in missing if n in link.attributes]
        if not wanted:
            continue
        if link.fact_key not in known:
            raise ValueError(f"{fact} has no {link.fact_key}: cannot use {', '.join(wanted)}")
        dim = getattr(model, link.table)
        on = {link.fact_key: F.col(link.key)}
        if link.table == "dim_date" and MONTH_PARTITION in known:
            on[MONTH_PARTITION] = F.col("year") * 100 + F.col("month")
        dim = dim.select(
            *[c.alias(n) for n, c in on.items()], *[F.col(link.attributes[n]).alias(n) for n in wanted]
        )
        for name in wanted:
            if name in where:
                dim = dim.filter(condition(F.col(name), where.pop(name)))
        df = df.join(dim, list(on))
        missing = [n for n in missing if n not in wanted]
    if missing:
        raise ValueError(f"unknown attributes: {', '.join(missing)}")
    return df
