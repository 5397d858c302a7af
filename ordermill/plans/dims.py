"""The four dimension tables, as DataFrame to DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates

CUSTOMER_COLUMNS = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]
SELLER_COLUMNS = ["seller_id", "seller_city", "seller_state"]
PRODUCT_MEASURES = [  # the misspelt names are the source's
    "product_name_lenght", "product_description_lenght", "product_photos_qty",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
]


def dim_customers(customers: DataFrame) -> DataFrame:
    """One row per staging row; copies are kept."""
    return customers.select(*CUSTOMER_COLUMNS)


def dim_sellers(sellers: DataFrame) -> DataFrame:
    """One row per staging row; copies are kept."""
    return sellers.select(*SELLER_COLUMNS)


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name, NULL where none is known.

    No broadcast hint: the lookup is broadcast when Spark's own size check
    (``autoBroadcastJoinThreshold``, then adaptive execution on real sizes) passes.
    Beyond that it is a sort-merge join fed by two plain shuffles, the shape in which
    adaptive execution splits a hot category, or the NULL category, over many tasks.
    """
    category = "product_category_name"
    names = translation.select(category, "product_category_name_english")
    return products.join(names, category, "left").select(
        "product_id", category, "product_category_name_english", *PRODUCT_MEASURES)


def dim_dates(orders: DataFrame) -> DataFrame:
    """One row per purchase date; one NULL row if a timestamp is missing.

    All columns depend on the date alone, so copies are removed on the bare date:
    the map side leaves one row per date and task, whatever the number of orders.
    """
    day = F.col("date")
    purchase_days = orders.select(
        dates.purchase_date(F.col("order_purchase_timestamp")).alias("date")).distinct()
    return purchase_days.select(
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        dates.month_name(day).alias("month_name"),
        F.year(day).alias("year"),
        dates.weekday_number(day).alias("weekday"),
        dates.weekday_name(day).alias("weekday_name"),
        dates.is_weekend(day).alias("is_weekend"),
    )
