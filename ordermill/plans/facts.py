"""The order fact table, in its join-faithful and its per-branch exact form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import purchase_date
from ..operators.branch_totals import COPIES, Branch, with_branch_totals

KEY = "order_id"
ORDER_COLUMNS = [KEY, "customer_id", "order_status", "order_purchase_timestamp"]


def item_branch(items: DataFrame) -> Branch:
    rows = items.select(KEY, "order_item_id",
                        (F.col("price") + F.col("freight_value")).alias("item_value"))
    return Branch(rows, "item_value", rows="item_rows", sum="order_value",
                  counted="order_item_id", distinct="items")


def payment_branch(payments: DataFrame) -> Branch:
    return Branch(payments, "payment_value", rows="payment_rows", sum="paid")


def review_branch(reviews: DataFrame) -> Branch:
    return Branch(reviews, "review_score", rows="review_rows", mean="mean_score")


def _order_totals(orders: DataFrame, items: DataFrame, payments: DataFrame,
                  reviews: DataFrame) -> DataFrame:
    branches = [item_branch(items), payment_branch(payments), review_branch(reviews)]
    return with_branch_totals(orders.select(*ORDER_COLUMNS), KEY, branches)


def _fact_columns(totals: DataFrame, order_value: Column, paid: Column) -> DataFrame:
    return totals.select(
        KEY, "customer_id", "order_status",
        purchase_date(F.col("order_purchase_timestamp")).alias("order_date"),
        F.coalesce("items", F.lit(0)).alias("total_items"),
        order_value.alias("total_order_value"),
        paid.alias("total_payment_value"),
        F.col("mean_score").alias("avg_review_score"),
    )


def _repeats(rows: str) -> Column:
    """How often a left join on this branch repeats the other side's rows.

    As a double: the product of three counts may be beyond 64 bits.
    """
    return F.greatest(F.coalesce(rows, F.lit(0)), F.lit(1)).cast("double")


def repeated_value(value: str, *others: str) -> Column:
    """A branch total times the order's copies and the rows of the other branches."""
    product = F.col(value) * F.col(COPIES).cast("double")
    for rows in others:
        product = product * _repeats(rows)
    return product


def fact_orders(orders: DataFrame, items: DataFrame, payments: DataFrame,
                reviews: DataFrame) -> DataFrame:
    """One row per order, status and purchase time, with join-multiplied totals.

    The totals are those of items, payments and reviews left-joined to the order in
    one go: the sum over items counts each item once per payment and review, the sum
    over payments each payment once per item and review. Distinct items and the mean
    score are not affected. NULL sums stay NULL.
    """
    return _fact_columns(_order_totals(orders, items, payments, reviews),
                         repeated_value("order_value", "payment_rows", "review_rows"),
                         repeated_value("paid", "item_rows", "review_rows"))


def fact_orders_exact(orders: DataFrame, items: DataFrame, payments: DataFrame,
                      reviews: DataFrame) -> DataFrame:
    """The same rows with every item and payment counted once."""
    return _fact_columns(_order_totals(orders, items, payments, reviews),
                         F.col("order_value"), F.col("paid"))


def _one_branch(orders: DataFrame, branch: Branch) -> DataFrame:
    return with_branch_totals(orders.select(*ORDER_COLUMNS), KEY, [branch])


def order_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders left-joined to their items alone: distinct items and their value."""
    return _one_branch(orders, item_branch(items)).select(
        KEY, F.coalesce("items", F.lit(0)).alias("total_items"),
        repeated_value("order_value").alias("total_order_value"))


def order_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders left-joined to their payments alone."""
    return _one_branch(orders, payment_branch(payments)).select(
        KEY, repeated_value("paid").alias("total_payment_value"))


def order_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders left-joined to their reviews alone."""
    return _one_branch(orders, review_branch(reviews)).select(
        KEY, F.col("mean_score").alias("avg_review_score"))
