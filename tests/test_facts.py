"""The fact table against the row-by-row join it stands for, and its plan."""

import random

import pytest

from ordermill.operators.branch_totals import _per_group
from ordermill.plans import facts

ORDERS = "order_id string, customer_id string, order_status string, order_purchase_timestamp string"
ITEMS = "order_id string, order_item_id bigint, price double, freight_value double"
PAYMENTS = "order_id string, payment_value double"
REVIEWS = "order_id string, review_score bigint"
T1, T2 = "2017-10-02 10:56:33", "2017-10-02 10:56:34"


def frames(spark, orders, items=(), payments=(), reviews=()):
    return (spark.createDataFrame(list(orders), ORDERS), spark.createDataFrame(list(items), ITEMS),
            spark.createDataFrame(list(payments), PAYMENTS),
            spark.createDataFrame(list(reviews), REVIEWS))


def joined_row_by_row(spark, orders, items, payments, reviews):
    """What the fact table means: everything joined first, then grouped."""
    views = {"o_": orders, "i_": items, "p_": payments, "r_": reviews}
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return spark.sql("""
        SELECT o_.order_id, customer_id, order_status,
               cast(order_purchase_timestamp AS date) AS order_date,
               count(DISTINCT order_item_id) AS total_items,
               sum(price + freight_value) AS total_order_value,
               sum(payment_value) AS total_payment_value,
               avg(cast(review_score AS double)) AS avg_review_score
        FROM o_ LEFT JOIN i_ ON i_.order_id = o_.order_id
                LEFT JOIN p_ ON p_.order_id = o_.order_id
                LEFT JOIN r_ ON r_.order_id = o_.order_id
        GROUP BY o_.order_id, customer_id, order_status, order_purchase_timestamp""")


def rows(table):
    def plain(value):
        return round(value, 6) if isinstance(value, float) else value
    return sorted((tuple(plain(v) for v in r) for r in table.collect()),
                  key=lambda r: [(v is not None, str(v)) for v in r])


FAN_OUT = dict(
    orders=[("o1", "c1", "delivered", T1)],
    items=[("o1", 1, 10.0, 1.0), ("o1", 2, 20.0, 2.0)],
    payments=[("o1", 7.0), ("o1", 26.0)],
    reviews=[("o1", 5), ("o1", 2), ("o1", 3)])


def test_fan_out(spark):
    fact = facts.fact_orders(*frames(spark, **FAN_OUT)).first()
    assert fact.total_items == 2
    assert (fact.total_order_value, fact.total_payment_value) == (198.0, 198.0)
    assert fact.avg_review_score == pytest.approx(10 / 3)
    assert str(fact.order_date) == "2017-10-02"


def test_exact(spark):
    fact = facts.fact_orders_exact(*frames(spark, **FAN_OUT)).first()
    assert (fact.total_items, fact.total_order_value, fact.total_payment_value) == (2, 33.0, 33.0)


def test_copies_of_an_order_add_up(spark):
    twice = dict(FAN_OUT, orders=FAN_OUT["orders"] * 2)
    [fact] = facts.fact_orders(*frames(spark, **twice)).collect()
    assert (fact.total_order_value, fact.total_payment_value) == (396.0, 396.0)
    assert fact.total_items == 2 and fact.avg_review_score == pytest.approx(10 / 3)
    [exact] = facts.fact_orders_exact(*frames(spark, **twice)).collect()
    assert exact.total_order_value == 33.0


def test_missing_measures(spark):
    fact = facts.fact_orders(*frames(
        spark, [("o2", "c", "s", T1), ("o3", "c", "s", T1)],
        items=[("o2", 1, 5.0, None)], payments=[("o2", 5.0)]))
    assert rows(fact.drop("customer_id", "order_status", "order_date")) == [
        ("o2", 1, None, 5.0, None), ("o3", 0, None, None, None)]


def test_one_row_per_timestamp_text(spark):
    fact = facts.fact_orders(*frames(spark, [("o1", "c", "s", T1), ("o1", "c", "s", T2)],
                                     FAN_OUT["items"]))
    assert [r.total_order_value for r in fact.collect()] == [33.0, 33.0]


def test_null_keys_match_nothing(spark):
    fact = facts.fact_orders(*frames(
        spark, [(None, "c", "s", T1), (None, "c", "s", T1), (None, None, None, None)],
        [(None, 1, 1.0, 1.0)], [(None, 1.0)], [(None, 1)]))
    assert rows(fact.select("customer_id", "total_items", "total_order_value",
                            "total_payment_value", "avg_review_score")) == [
        (None, 0, None, None, None), ("c", 0, None, None, None)]


@pytest.mark.parametrize("text", ["2017", "2017-10"])
def test_part_of_a_date_is_an_error(spark, text):
    with pytest.raises(Exception, match=f"not a timestamp: {text}"):
        facts.fact_orders(*frames(spark, [("o1", "c", "s", text)])).collect()


def test_bad_timestamp_is_an_error(spark):
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="not a timestamp: bad"):
                facts.fact_orders(*frames(spark, [("o1", "c", "s", "bad")])).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def random_frames(spark, seed):
    """A third of the rows of every table belongs to one order, another part to NULL."""
    rng = random.Random(seed)

    def key():
        return "hot" if rng.random() < 1 / 3 else rng.choice([None, *"abcdefgh"])

    def maybe(value):
        return None if rng.random() < 0.1 else value

    return frames(
        spark,
        [(key(), rng.choice(["c1", "c2", None]), rng.choice(["s1", "s2"]),
          maybe(rng.choice([T1, T2, "2018-01-01 00:00:00"]))) for _ in range(60)],
        [(key(), maybe(rng.randint(1, 9)), maybe(rng.randint(1, 99) / 4), maybe(1.5))
         for _ in range(60)],
        [(key(), maybe(rng.randint(1, 99) / 4)) for _ in range(40)],
        [(key(), maybe(rng.randint(1, 5))) for _ in range(30)])


@pytest.mark.parametrize("seed", range(4))
def test_equals_row_by_row_join(spark, seed):
    tables = random_frames(spark, seed)
    assert rows(facts.fact_orders(*tables)) == rows(joined_row_by_row(spark, *tables))


def test_single_branches(spark):
    orders, items, payments, reviews = random_frames(spark, 9)
    none = [frame.limit(0) for frame in (items, payments, reviews)]
    for got, wanted in [
        (facts.order_items(orders, items), (orders, items, none[1], none[2])),
        (facts.order_payments(orders, payments), (orders, none[0], payments, none[2])),
        (facts.order_reviews(orders, reviews), (orders, none[0], none[1], reviews)),
    ]:
        assert rows(got) == rows(joined_row_by_row(spark, *wanted).select(*got.columns))


def test_products_beyond_64_bits(spark):
    """4e9 payments and 4e9 reviews of one order, as counts."""
    counts = spark.createDataFrame(
        [(2.5, 1, 4_000_000_000, 4_000_000_000)],
        "order_value double, copies bigint, payment_rows bigint, review_rows bigint")
    value = counts.select(facts.repeated_value("order_value", "payment_rows", "review_rows"))
    assert value.first()[0] == 2.5 * 1.6e19


def plan_of(table):
    return table._jdf.queryExecution().executedPlan().toString()


def test_all_is_combined_before_it_is_shuffled(spark, tmp_path):
    """No broadcast possible: under every shuffle is an aggregation, so that of a hot key one row
    per task (and item) moves."""
    tables = []
    for i, frame in enumerate(random_frames(spark, 1)):
        frame.write.parquet(str(tmp_path / str(i)))
        tables.append(spark.read.parquet(str(tmp_path / str(i))))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(facts.fact_orders(*tables))
        assert plan.count("SortMergeJoin") == 1 and "Cartesian" not in plan
        lines = plan.splitlines()
        exchanges = [i for i, line in enumerate(lines) if "Exchange" in line]
        assert len(exchanges) == 5 and "Broadcast" not in plan
        assert all("Aggregate" in lines[i + 1] for i in exchanges)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("item", ["bigint", "int", "double", "string"])
def test_distinct_items_of_any_type(spark, item):
    """Whole numbers are counted as bits of groups of 64, others as they are."""
    ids = [0, 1, 1, 63, 64, 65, -1, -64, -65, 2 ** 31 - 1, -2 ** 31, None, None]
    ids += [2 ** 63 - 1, -2 ** 63] if item == "bigint" else []
    items = spark.createDataFrame([("o1", None if i is None else str(i)) for i in ids],
                                  "order_id string, order_item_id string").selectExpr(
        "order_id", f"CAST(order_item_id AS {item}) AS order_item_id",
        "1.5D AS price", "CAST(NULL AS double) AS freight_value")
    orders, _, payments, reviews = frames(spark, [("o1", "c", "s", T1)], payments=[("o1", 2.0)])
    tables = orders, items, payments, reviews
    assert rows(facts.fact_orders(*tables)) == rows(joined_row_by_row(spark, *tables))
    assert facts.fact_orders(*tables).first().total_items == len(set(ids)) - 1


def test_a_task_holds_one_narrow_row_per_order(spark, tmp_path):
    """Before the first shuffle: neither a row per item, nor columns for each branch."""
    tables = frames(spark, [("o1", "c", "s", T1)],
                    [(f"o{i % 100}", i % 50, 1.0, 2.0) for i in range(10_000)], [("o1", 1.0)])
    for i, frame in enumerate(tables):
        frame.coalesce(1).write.parquet(str(tmp_path / str(i)))
    fact = facts.fact_orders(*[spark.read.parquet(str(tmp_path / str(i))) for i in range(4)])
    lines = [line for line in plan_of(fact).splitlines() if "HashAggregate" in line]
    widest = max(line.count("partial_") for line in lines if "group" in line)
    assert 0 < widest <= 10
    branch = facts.item_branch(spark.read.parquet(str(tmp_path / "1")))
    assert _per_group(branch.details("order_id", 0), "order_id").count() == 100
