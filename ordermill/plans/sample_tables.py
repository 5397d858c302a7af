"""Staging tables seen through the TPC-H-like Parquet tables of a scale folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Category labels. STANDARD has none, so that unmatched rows occur.
CATEGORY_LABELS = [
    ("ECONOMY", "economy_goods"),
    ("LARGE", "large_goods"),
    ("MEDIUM", "medium_goods"),
    ("PROMO", "promotional_goods"),
    ("SMALL", "small_goods"),
]


class SampleTables:
    """Each method returns one staging table; nothing is read before it is used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def places(self) -> DataFrame:
        nation, region = self.source("nation"), self.source("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("place"), F.col("n_name").alias("city"),
            F.col("r_name").alias("state"))

    def customers(self) -> DataFrame:
        return (self.source("customer").withColumnRenamed("c_nationkey", "place")
                .join(self.places(), "place")
                .select(F.col("c_custkey").alias("customer_id"),
                        F.col("c_name").alias("customer_unique_id"),
                        F.col("city").alias("customer_city"),
                        F.col("state").alias("customer_state")))

    def sellers(self) -> DataFrame:
        return (self.source("supplier").withColumnRenamed("s_nationkey", "place")
                .join(self.places(), "place")
                .select(F.col("s_suppkey").alias("seller_id"),
                        F.col("city").alias("seller_city"),
                        F.col("state").alias("seller_state")))

    def products(self) -> DataFrame:
        size = F.col("p_size")
        return self.source("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            (F.length("p_name") + F.length("p_brand")).alias("product_description_lenght"),
            (size % 5).alias("product_photos_qty"),
            F.col("p_retailprice").alias("product_weight_g"),
            size.alias("product_length_cm"),
            (size + 1).alias("product_height_cm"),
            (size + 2).alias("product_width_cm"))

    def translation(self) -> DataFrame:
        return self.spark.createDataFrame(
            CATEGORY_LABELS, "product_category_name string, product_category_name_english string")

    def orders(self) -> DataFrame:
        return self.source("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").cast("string").alias("order_purchase_timestamp"))

    def items(self) -> DataFrame:
        return self.item_rows(self.source("lineitem"))

    @staticmethod
    def item_rows(lineitem: DataFrame) -> DataFrame:
        return lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("freight_value"))

    def payments(self) -> DataFrame:
        return self.source("events").where("event_type = 'purchase'").select(
            F.expr("event_id div 10").alias("order_id"),
            F.col("value").alias("payment_value"))

    def reviews(self) -> DataFrame:
        return self.source("events").where("event_type = 'click'").select(
            F.expr("event_id div 10").alias("order_id"),
            (F.col("event_id") % 5 + 1).alias("review_score"))

    def order_tables(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        return self.orders(), self.items(), self.payments(), self.reviews()
