"""Raw entities derived from the test tables.

The test tables have no reviews, payments, delivery dates or places, so these are
computed from the keys by rules that ``oracle.py`` repeats in SQL. Values arrive
the way raw files hold them: dates and numbers as text, padded lower-case places,
missing categories, repeated points, two reviews on some orders, zero installments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.sources.schemas import RAW_COLUMNS


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    zero = F.lit(0)
    return ts + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def _plus_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days.cast("int"))


def _money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(12,2)").cast("string")


# Faults planted on request: entity, column, condition in SQL on the base table's key, and the text in its place.
FLAWS = [
    ("orders", "order_purchase_timestamp", "CAST(order_id AS BIGINT) % 83 = 12", "1997-13-45"),
    ("orders", "order_purchase_timestamp", "CAST(order_id AS BIGINT) % 211 = 5", None),
    ("orders", "order_approved_at", "CAST(order_id AS BIGINT) % 97 = 8", "soon"),
    ("order_items", "price", "CAST(order_id AS BIGINT) % 101 = 7", "12,50"),
    ("order_items", "order_item_id", "CAST(order_id AS BIGINT) % 103 = 9", "first"),
    ("order_payments", "payment_installments", "CAST(order_id AS BIGINT) % 89 = 4", "two"),
    ("order_payments", "payment_value", "CAST(order_id AS BIGINT) % 107 = 6", "10 euros"),
    ("order_reviews", "review_score", "CAST(order_id AS BIGINT) % 71 = 3", "five"),
    ("customers", "customer_zip_code_prefix", "CAST(customer_id AS BIGINT) % 109 = 2", "10x2"),
    ("products", "product_weight_g", "CAST(product_id AS BIGINT) % 61 = 1", "1 kg"),
    ("geolocation", "geolocation_lat", "CAST(geolocation_zip_code_prefix AS BIGINT) % 53 = 9", "-23,5"),
    ("geolocation", "geolocation_zip_code_prefix", "CAST(geolocation_zip_code_prefix AS BIGINT) % 59 = 11", "10x2"),
    ("geolocation", "geolocation_zip_code_prefix", "CAST(geolocation_zip_code_prefix AS BIGINT) % 83 = 7", None),
]


class RawTables:
    """Lazy raw frames of one test data folder, by entity name; ``flawed`` ones hold values that do not fit."""

    def __init__(self, spark: SparkSession, folder: str, flawed: bool = False):
        self.spark = spark
        self.folder = folder
        self.flawed = flawed

    def __call__(self, entity: str) -> DataFrame:
        build: Callable[[], DataFrame] = getattr(self, f"_{entity}")
        rows = build().select(*RAW_COLUMNS[entity])
        changed: dict[str, Column] = {}
        for of, column, where, text in FLAWS if self.flawed else ():
            if of == entity:
                now = changed.get(column, F.col(column).cast("string"))
                changed[column] = F.when(F.expr(where), F.lit(text)).otherwise(now)
        return rows.withColumns(changed)

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def _orders(self) -> DataFrame:
        k = F.col("o_orderkey")
        status = (
            F.when(k % 40 == 0, "canceled")
            .when(k % 40 == 1, "unavailable")
            .when(F.col("o_orderstatus") == "P", "shipped")
            .otherwise("delivered")
        )
        purchase = _plus_seconds(F.col("o_orderdate"), (k * 37) % 86400)
        travel = (k * 7919) % 3000000
        df = self._read("orders").select(k, "o_orderdate", status.alias("order_status"), purchase.alias("p"), travel.alias("t"))
        arrived = (F.col("order_status") == "delivered") & (k % 1000 != 7)
        sent = F.col("order_status").isin("delivered", "shipped")
        carrier = _plus_seconds(F.col("p"), F.floor(F.col("t") / 2)).cast("string")
        return df.select(
            k.cast("string").alias("order_id"),
            k.cast("string").alias("customer_id"),
            "order_status",
            F.col("p").cast("string").alias("order_purchase_timestamp"),
            F.when(k % 600 != 11, _plus_seconds(F.col("p"), (k * 13) % 7200).cast("string")).alias("order_approved_at"),
            F.when(k % 700 == 5, F.lit("not a date")).when(sent, carrier).alias("order_delivered_carrier_date"),
            F.when(arrived, _plus_seconds(F.col("p"), F.col("t")).cast("string")).alias("order_delivered_customer_date"),
            _plus_days(F.col("o_orderdate"), 20 + k % 11).cast("string").alias("order_estimated_delivery_date"),
        )

    def _order_items(self) -> DataFrame:
        return self._read("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").cast("string").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            F.col("l_shipdate").cast("string").alias("shipping_limit_date"),
            _money("l_extendedprice").alias("price"),
            _money("l_quantity").alias("freight_value"),
        )

    def _order_payments(self) -> DataFrame:
        k = F.col("o_orderkey")
        second = F.col("n") == 2
        kind = F.when(k % 5000 == 3, "not_defined").otherwise(F.lower(F.substring("o_orderpriority", 3, 100)))
        parts = self._read("orders").withColumn("n", F.explode(F.sequence(F.lit(1), F.when(k % 3 == 0, 2).otherwise(1))))
        return parts.select(
            k.cast("string").alias("order_id"),
            F.col("n").cast("string").alias("payment_sequential"),
            F.when(second, "voucher").otherwise(kind).alias("payment_type"),
            F.when(second, "1").otherwise((k % 13).cast("string")).alias("payment_installments"),
            F.when(second, "10.00").otherwise(_money("o_totalprice")).alias("payment_value"),
        )

    def _order_reviews(self) -> DataFrame:
        k = F.col("o_orderkey")
        second = F.col("n") == 2
        number = F.when(k % 50 == 3, 0).when(k % 20 == 1, 2).otherwise(1)
        parts = self._read("orders").withColumn("n", F.explode(F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), number)))
        promised = _plus_days(F.col("o_orderdate"), 20 + k % 11)
        later = F.when(second & (k % 200 != 1), 1).otherwise(0)
        created = _plus_days(promised, later)
        message = F.concat(F.lit('says "fine", order '), k.cast("string"), F.lit("\nthanks"))
        return parts.select(
            F.concat(F.lit("r"), k.cast("string"), F.when(second, "b").otherwise("")).alias("review_id"),
            k.cast("string").alias("order_id"),
            F.when(second, "1").otherwise((1 + (k * 31) % 97 % 5).cast("string")).alias("review_score"),
            F.when(~second & (k % 2 == 1), F.concat(F.lit("title "), k.cast("string"))).alias("review_comment_title"),
            F.when(~second & (k % 3 != 0), message).alias("review_comment_message"),
            created.cast("string").alias("review_creation_date"),
            _plus_days(created, F.lit(2)).cast("string").alias("review_answer_timestamp"),
        )

    def _customers(self) -> DataFrame:
        orders = self._read("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
        people = self._read("customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
        nations = self._read("nation").select("n_nationkey", "n_name")
        joined = orders.join(people, "c_custkey").join(nations, "n_nationkey")
        return joined.select(
            F.col("o_orderkey").cast("string").alias("customer_id"),
            F.col("c_custkey").cast("string").alias("customer_unique_id"),
            (F.col("c_custkey") % 500).cast("string").alias("customer_zip_code_prefix"),
            F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit("-mirim d'oeste \t")).alias("customer_city"),
            F.concat(F.lower("n_name"), F.lit(" ")).alias("customer_state"),
        )

    def _sellers(self) -> DataFrame:
        sellers = self._read("supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
        nations = self._read("nation").select("n_nationkey", "n_name")
        return sellers.join(nations, "n_nationkey").select(
            F.col("s_suppkey").cast("string").alias("seller_id"),
            (F.col("s_suppkey") % 500).cast("string").alias("seller_zip_code_prefix"),
            F.concat(F.lit(" "), F.lower("s_name")).alias("seller_city"),
            F.lower("n_name").alias("seller_state"),
        )

    def _products(self) -> DataFrame:
        k = F.col("p_partkey")
        size = F.when(k % 97 != 5, F.col("p_size"))
        return self._read("part").select(
            k.cast("string").alias("product_id"),
            F.when(k % 50 != 0, F.lower("p_brand")).alias("product_category_name"),
            F.length("p_name").cast("string").alias("product_name_lenght"),
            F.length("p_type").cast("string").alias("product_description_lenght"),
            (F.col("p_size") % 7).cast("string").alias("product_photos_qty"),
            (size * 100).cast("string").alias("product_weight_g"),
            size.cast("string").alias("product_length_cm"),
            (size + 1).cast("string").alias("product_height_cm"),
            (size + 2).cast("string").alias("product_width_cm"),
        )

    def _product_category_name_translation(self) -> DataFrame:
        brands = self._read("part").select("p_brand").distinct().filter(F.col("p_brand") != "Brand#13")
        return brands.select(
            F.lower("p_brand").alias("product_category_name"),
            F.col("p_brand").alias("product_category_name_english"),
        )

    def _geolocation(self) -> DataFrame:
        k = F.col("c_custkey")
        people = self._read("customer").withColumnRenamed("c_nationkey", "n_nationkey")
        nations = self._read("nation").select("n_nationkey", "n_name")
        points = people.join(nations, "n_nationkey").withColumn(
            "n", F.explode(F.sequence(F.lit(1), F.when(k % 7 == 0, 2).otherwise(1)))
        )
        return points.select(
            (k % 500).cast("string").alias("geolocation_zip_code_prefix"),
            (F.col("c_acctbal") / 100).alias("geolocation_lat"),
            (-F.col("c_acctbal") / 200).alias("geolocation_lng"),
            F.lower("c_mktsegment").alias("geolocation_city"),
            F.lower("n_name").alias("geolocation_state"),
        )
