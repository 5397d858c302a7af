"""Dimension tables on hand-made rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from ordermill.plans import dims

ORDERS = "order_purchase_timestamp string"


def dates_of(spark, *texts):
    return dims.dim_dates(spark.createDataFrame([(t,) for t in texts], ORDERS)).collect()


def test_sunday(spark):
    [row] = dates_of(spark, "2017-10-01 10:00:00", "2017-10-01 23:59:59", "2017-10-01 00:00:00")
    assert tuple(row) == (datetime.date(2017, 10, 1), 1, 10, "October  ", 2017, 0, "Sunday   ", True)


def test_week(spark):
    rows = dates_of(spark, *[f"2017-10-0{d} 12:00:00" for d in range(1, 8)])
    assert {r.date.day: (r.weekday, r.is_weekend) for r in rows} == {
        d: (d - 1, d in (1, 7)) for d in range(1, 8)}
    assert {len(r.weekday_name) for r in rows} == {9}


def test_long_name_is_not_cut(spark):
    [row] = dates_of(spark, "2018-09-05 00:00:00")
    assert (row.month_name, row.weekday_name) == ("September", "Wednesday")


def test_missing_timestamp(spark):
    rows = dates_of(spark, None, None, "2017-10-02 10:56:33")
    assert len(rows) == 2
    [missing] = [r for r in rows if r.date is None]
    assert tuple(missing) == (None,) * 7 + (False,)


def test_bad_timestamp_is_an_error(spark):
    with pytest.raises(Exception, match="not a timestamp"):
        dates_of(spark, "bad")


def test_clock_changes_do_not_move_dates(spark):
    """00:30 on 2017-10-15 does not exist in this zone."""
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        [row] = dates_of(spark, "2017-10-15 00:30:00")
        assert tuple(row) == (datetime.date(2017, 10, 15), 15, 10, "October  ", 2017, 0,
                              "Sunday   ", True)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_types(spark):
    table = dims.dim_dates(spark.createDataFrame([("2017-10-01 10:00:00",)], ORDERS))
    assert table.dtypes == [
        ("date", "date"), ("day", "int"), ("month", "int"), ("month_name", "string"),
        ("year", "int"), ("weekday", "int"), ("weekday_name", "string"),
        ("is_weekend", "boolean")]


def products(spark, *categories):
    columns = ["product_id", "product_category_name", *dims.PRODUCT_MEASURES]
    rows = [(f"p{i}", c, *range(7)) for i, c in enumerate(categories)]
    return spark.createDataFrame(
        rows, ", ".join(f"{c} {'string' if i < 2 else 'bigint'}" for i, c in enumerate(columns)))


def labels(spark, *pairs):
    return spark.createDataFrame(
        list(pairs), "product_category_name string, product_category_name_english string")


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_products(spark, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        table = dims.dim_products(products(spark, "a", "b", None, "c", "a"),
                                  labels(spark, ("a", "A"), ("b", "B1"), ("b", "B2"), (None, "N")))
        assert table.columns == ["product_id", "product_category_name",
                                 "product_category_name_english", *dims.PRODUCT_MEASURES]
        found = sorted((r[0], r[2]) for r in table.collect() if r[2]) + sorted(
            r[0] for r in table.collect() if not r[2])
        assert found == [("p0", "A"), ("p1", "B1"), ("p1", "B2"), ("p4", "A"), "p2", "p3"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_category_is_split(spark, tmp_path):
    """A lookup too large to broadcast; a third of the products in one category, a third
    without any."""
    ids = spark.range(0, 300_000, numPartitions=8)
    category = F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE concat('c', id) END")
    measures = [F.col("id").alias(c) for c in dims.PRODUCT_MEASURES]
    ids.select(F.col("id").alias("product_id"), category.alias("product_category_name"),
               *measures).write.parquet(str(tmp_path / "products"))
    name = F.expr("IF(id = 0, 'hot', concat('c', id))")
    ids.select(name.alias("product_category_name"),
               F.upper(name).alias("product_category_name_english")).write.parquet(
                   str(tmp_path / "labels"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        table = dims.dim_products(spark.read.parquet(str(tmp_path / "products")),
                                  spark.read.parquet(str(tmp_path / "labels")))
        rows = table.select("product_category_name", "product_category_name_english").collect()
        assert len(rows) == 300_000
        assert all(r[1] == (r[0].upper() if r[0] else None) for r in rows)
        table = table.select("product_id", "product_category_name_english")
        table.write.format("noop").mode("overwrite").save()
        table.collect()
        assert "skew=true" in table._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_copies_are_kept(spark):
    customers = spark.createDataFrame(
        [("c1", "u1", "x", "y", 1)] * 2,
        "customer_id string, customer_unique_id string, customer_city string, "
        "customer_state string, more int")
    table = dims.dim_customers(customers)
    assert table.columns == dims.CUSTOMER_COLUMNS and table.count() == 2
    sellers = spark.createDataFrame([("s1", "x", "y")] * 3,
                                    "seller_id string, seller_city string, seller_state string")
    assert dims.dim_sellers(sellers).count() == 3
