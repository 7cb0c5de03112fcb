"""Staging and model tables, each written once, on first use, as Parquet."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tradewind.operators.keys import with_dense_key
from tradewind.plans import star
from tradewind.plans.prepare import PREPARE, Raw, ledger_of, stage
from tradewind.sources.files import CODEC, read_bucketed, read_even, read_table, write_bucketed, write_table
from tradewind.sources.versions import Versions

DIMENSIONS = ["dim_date", "dim_customer", "dim_seller", "dim_product"]
FACTS = list(star.FACT_KEYS)


# Tables with a row per order or more, besides those in buckets.
PER_ORDER = [*FACTS, "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews"]

# What a table is partitioned and then sorted by.
PARTITIONS = {fact: (star.MONTH_PARTITION, "purchase_date_key") for fact in FACTS} | {"dim_customer": ("state", "customer_key")}


class ChecksFailed(RuntimeError):
    """A model that did not pass its checks, and so was not published."""

    def __init__(self, failed: Sequence[str]):
        super().__init__("not published, failed: " + "; ".join(failed))
        self.failed = list(failed)


class Warehouse:
    """Model of one raw data set, stored below ``root``.

    A table is written when it is first asked for, together with what it is built
    from, and read from its files afterwards: queries see pruned scans of stored
    tables, not the lineage of the build, and lost executors cost a re-read.
    Tables are attributes: ``warehouse.fact_orders``.

    A stored table is never written over. A rebuild goes to a folder of its own, and only a whole
    model that passed its checks becomes the current one, for this object and for ``open``.
    """

    def __init__(self, spark: SparkSession, raw: Raw, root: str, staging: Warehouse | None = None):
        """``staging`` lends the staging tables of another warehouse instead of writing its own."""
        self.spark = spark
        self.raw = raw
        self.root = root.rstrip("/")
        self.model_root = self.root
        self._staging = staging
        self._complete = False
        self._tables: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    @classmethod
    def open(cls, spark: SparkSession, root: str, raw: Raw | None = None) -> Warehouse:
        """The version that is current below ``root``: all tables as stored, nothing is built."""
        folders = Versions(spark, root).current()
        if folders is None:
            raise LookupError(f"nothing is published below {root}")
        landed = f"{folders['staging']}/raw"
        wh = cls(spark, raw or (lambda e: spark.read.parquet(f"{landed}/{e}")), folders["staging"])
        wh.model_root, wh._complete = folders["model"], True
        return wh

    def staged(self, entity: str) -> DataFrame:
        if self._staging is not None:
            return self._staging.staged(entity)
        return self._stored(f"stg_{entity}", lambda: stage(self.raw, entity))

    @property
    def ledger(self) -> DataFrame:
        """Every raw value that staging could not keep."""
        if self._staging is not None:
            return self._staging.ledger
        return self._stored("ledger", lambda: ledger_of(self.raw))

    def __getattr__(self, name: str) -> DataFrame:
        if name in DIMENSIONS or name in FACTS or name in star.ORDER_LAYOUT:
            return self.table(name)
        raise AttributeError(name)

    def table(self, name: str) -> DataFrame:
        """Facts lie by purchase month, customers by state: filters on these open only the files they need."""
        return self._stored(name, lambda: self._build(name), *PARTITIONS.get(name, (None, None)))

    def with_key(self, fact: str) -> DataFrame:
        """The fact with its dense integer key, derived from file positions on read."""
        return with_dense_key(self.table(fact), star.FACT_KEYS[fact])

    def register_views(self) -> None:
        """Make dimensions and facts available to ``spark.sql`` under their names."""
        for name in DIMENSIONS + FACTS:
            self.table(name).createOrReplaceTempView(name)

    def build(self) -> None:
        for entity in PREPARE:
            self.staged(entity)
        self.build_model()

    def build_model(self) -> None:
        for name in DIMENSIONS + FACTS + star.ORDER_LAYOUT:
            self.table(name)

    def rebuild_model(
        self, check: Callable[[Warehouse], Sequence[str]] | None = None, versions: Versions | None = None
    ) -> None:
        """Build dimensions and facts anew from staging, next to what is there, and then switch.

        ``check`` gives the names of the checks that the new model fails; any stops the switch. Until
        the last table is written and checked, this object and readers of ``versions`` keep the old
        model whole; a rebuild that dies leaves only a folder that no version names.
        """
        versions = versions or Versions(self.spark, self.root)
        new = Warehouse(self.spark, self.raw, versions.new_folder(), self._staging or self)
        new.build_model()
        if failed := list(check(new)) if check else []:
            raise ChecksFailed(failed)
        versions.publish({"staging": (self._staging or self).root, "model": new.root})
        with self._lock:
            self._tables.update(new._tables)
            self.model_root = new.root

    def _build(self, name: str) -> DataFrame:
        if name == "dim_date":
            return star.build_dim_date(self.staged("orders"), self.staged("order_reviews")).coalesce(1)
        if name == "dim_customer":
            return star.build_dim_customer(self.staged("customers"), self.staged("geolocation"))
        if name == "dim_seller":
            return star.build_dim_seller(self.staged("sellers"), self.staged("geolocation"))
        if name == "dim_product":
            return star.build_dim_product(self.staged("products"))
        if name == "fact_orders":
            return star.build_fact_orders(self.staged("orders"), self.dim_customer)
        if name == "order_items":
            return star.build_order_items(
                self.staged("order_items"), self.fact_orders, self.dim_product, self.dim_seller
            )
        if name == "fact_order_items":
            return star.build_fact_order_items(self.order_items)
        if name == "fact_payments":
            return star.build_fact_payments(self.staged("order_payments"), self.fact_orders)
        if name == "fact_reviews":
            return star.build_fact_reviews(self.staged("order_reviews"), self.fact_orders)
        if name == "order_lines":
            self.table("order_items")
            items = read_even(self.spark, f"{self.model_root}/order_items", "order_id")
            return star.build_order_lines(items, self.dim_product)
        if name == "order_outcomes":
            return star.build_order_outcomes(self.fact_orders, self.fact_reviews)
        raise KeyError(name)

    def _stored(
        self, name: str, build: Callable[[], DataFrame], partition_by: str | None = None, sort_by: str | None = None
    ) -> DataFrame:
        with self._lock:
            if name not in self._tables:
                of_model = name in DIMENSIONS or name in FACTS or name in star.ORDER_LAYOUT
                path = f"{self.model_root if of_model else self.root}/{name}"
                bucketed, text = name in star.ORDER_LAYOUT, partition_by if name in DIMENSIONS else None
                if self._complete:
                    table = read_bucketed(self.spark, path, "order_id") if bucketed else read_table(self.spark, path, text_partition=text)
                elif bucketed:
                    # One number of buckets for all, from the row count in the footers of the largest fact
                    # or of what it is made from.
                    rows = (self.staged("order_items") if name == "order_items" else self.fact_order_items).count()
                    table = write_bucketed(build(), path, "order_id", rows, joined=name in star.JOINED_BY_ORDER)
                else:
                    codec = CODEC if name in PER_ORDER else None
                    table = write_table(build(), path, partition_by, [sort_by] if sort_by else [], codec)
                self._tables[name] = table
            return self._tables[name]
