"""Which extracts make up a refresh, and what their staging tables are called."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The file names of the nine extracts.
CUSTOMERS = "olist_customers_dataset.csv"
GEOLOCATION = "olist_geolocation_dataset.csv"
ITEMS = "olist_order_items_dataset.csv"
PAYMENTS = "olist_order_payments_dataset.csv"
REVIEWS = "olist_order_reviews_dataset.csv"
ORDERS = "olist_orders_dataset.csv"
PRODUCTS = "olist_products_dataset.csv"
SELLERS = "olist_sellers_dataset.csv"
TRANSLATION = "product_category_name_translation.csv"

MANIFEST = (CUSTOMERS, GEOLOCATION, ITEMS, PAYMENTS, REVIEWS, ORDERS, PRODUCTS, SELLERS,
            TRANSLATION)


def staging_name(file_name: str) -> str:
    """``stg_`` and the file name in lower case, without any ``.csv`` in it."""
    return f"stg_{file_name.replace('.csv', '').lower()}"


def list_extracts(spark: SparkSession, folder: str, suffix: str = ".csv") -> DataFrame:
    """Extracts of a folder that end in ``suffix``, case-sensitive: files, and folders of files.

    Only the listing is read, never the content. A file of zero bytes is not listed.
    """
    base = folder.rstrip("/")
    steps = F.split("path", "/")
    parent = F.element_at(steps, -2)
    inside = parent != base.rsplit("/", 1)[-1]  # a file of an extract that is a folder
    listing = spark.read.format("binaryFile").load(f"{base}/*{suffix}").select(
        F.when(inside, parent).otherwise(F.element_at(steps, -1)).alias("file_name"),
        F.when(inside, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.col("path"))
        .alias("path"), "length", "modificationTime")
    stem = F.lower(F.replace("file_name", F.lit(suffix), F.lit("")))
    return listing.groupBy("file_name", "path").agg(
        F.sum("length").alias("length"), F.max("modificationTime").alias("modificationTime")
    ).withColumn("staging_table", F.concat(F.lit("stg_"), stem))
