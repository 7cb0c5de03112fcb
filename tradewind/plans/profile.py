"""Profile of the raw entities: columns, duplicates, keys, relations, dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tradewind.operators import profiling as P
from tradewind.operators.cleaning import parse_timestamps
from tradewind.plans.prepare import Raw
from tradewind.sources.schemas import RAW_COLUMNS

SINGLE_KEYS = [
    ("orders", ["order_id"]),
    ("customers", ["customer_id"]),
    ("products", ["product_id"]),
    ("sellers", ["seller_id"]),
    ("order_reviews", ["review_id"]),
    ("order_reviews", ["order_id"]),
]
COMPOSITE_KEYS = [
    ("order_items", ["order_id", "order_item_id"]),
    ("order_payments", ["order_id", "payment_sequential"]),
]

# Relation, child, parent, key.
ORPHANS = [
    ("items with no order", "order_items", "orders", "order_id"),
    ("payments with no order", "order_payments", "orders", "order_id"),
    ("reviews with no order", "order_reviews", "orders", "order_id"),
    ("items with no product", "order_items", "products", "product_id"),
    ("items with no seller", "order_items", "sellers", "seller_id"),
    ("orders with no customer", "orders", "customers", "customer_id"),
]
COVERAGE = [
    ("orders with no payment", "orders", "order_payments", "order_id"),
    ("orders with no review", "orders", "order_reviews", "order_id"),
    ("orders with no items", "orders", "order_items", "order_id"),
]


def column_report(raw: Raw) -> DataFrame:
    return P.union_all([P.profile_table(raw(e), e) for e in sorted(RAW_COLUMNS)])


def duplicate_report(raw: Raw) -> DataFrame:
    return P.union_all([P.duplicate_rows(raw(e), e) for e in sorted(RAW_COLUMNS)])


def key_report(raw: Raw, keys: Sequence[tuple[str, list[str]]]) -> DataFrame:
    sets: dict[str, list[list[str]]] = {}
    for entity, columns in keys:
        sets.setdefault(entity, []).append(columns)
    return P.union_all([P.key_profiles(raw(e), columns, e) for e, columns in sets.items()])


def relation_report(raw: Raw, relations: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Rows without a partner, each child read once for all of its relations."""
    children: dict[str, list[P.Relation]] = {}
    for label, child, parent, key in relations:
        children.setdefault(child, []).append((label, key, raw(parent), key))
    return P.union_all([P.orphan_counts(raw(child), mine) for child, mine in children.items()])


def date_report(raw: Raw) -> DataFrame:
    purchase = "order_purchase_timestamp"
    return P.value_range(parse_timestamps(raw("orders").select(purchase), [purchase]), purchase)


def status_report(raw: Raw) -> DataFrame:
    return P.value_counts(raw("orders"), "order_status")
