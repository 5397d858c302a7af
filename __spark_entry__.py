
from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions import dates
from ordermill.operators.quality import FACT_ORDERS_SUITE, QualityError, Suite, between
from ordermill.plans import dims, facts
from ordermill.plans.refresh import run_refresh
from ordermill.plans.sample_extracts import new_folder, write_extract, write_manifest
from ordermill.plans.sample_tables import CATEGORY_LABELS, SampleTables
from ordermill.scratch import Scratch
from ordermill.sources.column_types import KINDS, MISSING_TOKENS, kind_counts
from ordermill.sources.manifest import staging_name
from ordermill.sources.publish import Published, ensure_database, publish
from ordermill.sources.staging import passes_gate, typed_extract

try:
    import corpus_pipeline
    import ordermill.llm.queries as llm
except ModuleNotFoundError as absent:  # the rest works without them
    if absent.name not in ("corpus_pipeline", "ordermill.llm", "ordermill.llm.queries"):
        raise
    llm = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

TIGHT_SUITE = Suite("tight", [between("total_items", 1, 6), between("avg_review_score", 0, 4)])
FACT_COLUMNS = ["order_id", "customer_id", "order_status", "order_date", "total_items",
                "total_order_value", "total_payment_value", "avg_review_score"]


def entry(spark: SparkSession) -> DataFrame:
    return _rounded(facts.fact_orders(
        *SampleTables(spark, "/root/testdata/sf0.001").order_tables()))


def _rounded(table: DataFrame) -> DataFrame:
    """Sums to 2 and averages to 6 decimals: double sums depend on their order."""
    digits = {"total_order_value": 2, "total_payment_value": 2, "avg_review_score": 6}
    return table.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c)
                          for c in table.columns])


def _on(plan: Callable[[SampleTables], DataFrame]) -> Query:
    return lambda spark, folder: plan(SampleTables(spark, folder))


def _stg_orders_typed(t: SampleTables) -> DataFrame:
    text = F.col("order_purchase_timestamp")
    return t.orders().select("order_id", dates.purchase_timestamp(text).alias("purchase_ts"),
                             dates.purchase_date(text).alias("order_date"))


def _profiled(t: SampleTables) -> dict[str, DataFrame]:
    return {"customers": t.customers(), "sellers": t.sellers(), "products": t.products(),
            "orders": t.orders(), "items": t.items(), "payments": t.payments(),
            "reviews": t.reviews()}


def _stg_type_profile(t: SampleTables) -> DataFrame:
    def profile(name: str, table: DataFrame) -> DataFrame:
        texts = table.select(*[F.col(c).cast("string").alias(c) for c in table.columns])
        return kind_counts(texts, table.columns).select(
            F.lit(name).alias("table_name"), "column_name", "rows",
            *[F.col(kind).alias(f"{kind}_values") for kind in KINDS])
    return reduce(DataFrame.unionAll, [profile(n, d) for n, d in _profiled(t).items()])


def _stg_row_gate(t: SampleTables) -> DataFrame:
    return reduce(DataFrame.unionAll, [
        passes_gate(d).select(F.lit(n).alias("table_name"), "*")
        for n, d in _profiled(t).items()])


def _ingested(source: Callable[[SampleTables], DataFrame]) -> Query:
    """Write a table as CSV with Spark, and read it back through the ingest."""
    def run(t: SampleTables) -> DataFrame:
        path = write_extract(source(t), f"{new_folder(t)}/extract.csv")
        return typed_extract(t.spark, path).table
    return _on(run)


def _fact_orders_hot(t: SampleTables) -> DataFrame:
    """A third of all items belongs to one order."""
    order = F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_orderkey"))
    items = t.source("lineitem").withColumn("l_orderkey", order)
    return _rounded(facts.fact_orders(t.orders(), t.item_rows(items), t.payments(), t.reviews()))


_REFRESHED: dict[tuple[str, str], tuple[str, list[Published]]] = {}


def _refreshed(t: SampleTables) -> tuple[str, list[Published]]:
    """Extracts, staging, dimensions and fact, in a database of their own.

    One refresh serves all queries of a session on the same folder; its files go when the driver ends.
    """
    key = t.spark.sparkContext.applicationId, t.folder
    if key not in _REFRESHED:
        database = f"ordermill_{uuid.uuid4().hex}"
        ensure_database(t.spark, database, Scratch(t.spark, "database").path(database))
        _REFRESHED[key] = database, run_refresh(t.spark, write_manifest(t), database)
    return _REFRESHED[key]


def _refresh_fact_orders(t: SampleTables) -> DataFrame:
    database, _ = _refreshed(t)
    return _rounded(t.spark.table(f"{database}.fact_orders"))


def _refresh_dim_products(t: SampleTables) -> DataFrame:
    database, _ = _refreshed(t)
    return t.spark.table(f"{database}.dim_products")


def _refresh_row_counts(t: SampleTables) -> DataFrame:
    _, published = _refreshed(t)
    return reduce(DataFrame.unionAll, [
        t.spark.table(p.name).agg(F.lit(p.name.split(".")[1]).alias("table_name"),
                                  F.count(F.lit(1)).alias("rows")) for p in published])


def _refresh_refused(t: SampleTables) -> DataFrame:
    """A build that breaks its rules: the report, what is still published, and the broken rows kept."""
    database, _ = _refreshed(t)
    fact = t.spark.table(f"{database}.fact_orders")
    try:
        publish(fact.where("total_items > 0"), database, "fact_orders", TIGHT_SUITE)
    except QualityError as error:
        report, rows = error.report, error.rows
    kept = t.spark.read.parquet(rows).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    lines = t.spark.table(f"{database}.fact_orders").agg(
        F.count(F.lit(1)).alias("published_rows")).select("published_rows", F.inline(F.array(*[
            F.struct(F.lit(line["rule"]).alias("rule"),
                     F.lit(line["element_count"]).cast("bigint").alias("element_count"),
                     F.lit(line["unexpected_count"]).cast("bigint").alias("unexpected_count"),
                     F.lit(line["success"]).alias("success")) for line in report])))
    return lines.join(kept, "rule", "left").select(
        *lines.columns, F.coalesce("n", F.lit(0)).alias("kept_rows"))


def queries() -> dict[str, Query]:
    """All queries: those of the order tables, and those of the text operators if present."""
    if llm is None:
        return order_queries()
    return {**order_queries(), **llm.queries(), "pipeline": corpus_pipeline.run}


def order_queries() -> dict[str, Query]:
    return {
        "ingest_customers": _ingested(SampleTables.customers),
        "ingest_orders": _ingested(SampleTables.orders),
        "ingest_items": _ingested(SampleTables.items),
        "ingest_documents": _ingested(lambda t: t.source("documents")),
        "ingest_pages": _ingested(lambda t: t.source("pages")),
        "stg_orders_typed": _on(_stg_orders_typed),
        "stg_type_profile": _on(_stg_type_profile),
        "stg_row_gate": _on(_stg_row_gate),
        "dim_customers": _on(lambda t: dims.dim_customers(t.customers())),
        "dim_sellers": _on(lambda t: dims.dim_sellers(t.sellers())),
        "dim_products": _on(lambda t: dims.dim_products(t.products(), t.translation())),
        "dim_dates": _on(lambda t: dims.dim_dates(t.orders())),
        "order_items": _on(lambda t: _rounded(facts.order_items(t.orders(), t.items()))),
        "order_payments": _on(lambda t: _rounded(facts.order_payments(t.orders(), t.payments()))),
        "order_reviews": _on(lambda t: _rounded(facts.order_reviews(t.orders(), t.reviews()))),
        "fact_orders": _on(lambda t: _rounded(facts.fact_orders(*t.order_tables()))),
        "fact_orders_exact": _on(lambda t: _rounded(facts.fact_orders_exact(*t.order_tables()))),
        "fact_orders_hot": _on(_fact_orders_hot),
        "dq_fact_orders": _on(
            lambda t: FACT_ORDERS_SUITE.evaluate(facts.fact_orders(*t.order_tables()))),
        "dq_fact_orders_violations": _on(
            lambda t: TIGHT_SUITE.violations(_rounded(facts.fact_orders(*t.order_tables())))),
        "refresh_fact_orders": _on(_refresh_fact_orders),
        "refresh_dim_products": _on(_refresh_dim_products),
        "refresh_row_counts": _on(_refresh_row_counts),
        "refresh_refused": _on(_refresh_refused),
    }


# --- the same in SQL ---------------------------------------------------------------

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Staging tables as common table expressions over the registered views.
STAGING = {
    "stg_places": """SELECT n_nationkey AS place, n_name AS city, r_name AS state
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "stg_customers": """SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
        city AS customer_city, state AS customer_state
        FROM customer JOIN stg_places ON place = c_nationkey""",
    "stg_sellers": """SELECT s_suppkey AS seller_id, city AS seller_city, state AS seller_state
        FROM supplier JOIN stg_places ON place = s_nationkey""",
    "stg_products": """SELECT p_partkey AS product_id, p_type AS product_category_name,
        CAST(length(p_name) AS INTEGER) AS product_name_lenght,
        CAST(length(p_name) + length(p_brand) AS INTEGER) AS product_description_lenght,
        p_size % 5 AS product_photos_qty, p_retailprice AS product_weight_g,
        p_size AS product_length_cm, p_size + 1 AS product_height_cm,
        p_size + 2 AS product_width_cm FROM part""",
    "stg_translation": "SELECT * FROM (VALUES {}) v(category, label)".format(
        ", ".join(f"('{name}', '{label}')" for name, label in CATEGORY_LABELS)),
    "stg_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        o_orderstatus AS order_status, CAST(o_orderdate AS VARCHAR) AS order_purchase_timestamp
        FROM orders""",
    "stg_items": """SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
        l_extendedprice AS price, l_quantity AS freight_value FROM lineitem""",
    "stg_payments": """SELECT event_id // 10 AS order_id, value AS payment_value
        FROM events WHERE event_type = 'purchase'""",
    "stg_reviews": """SELECT event_id // 10 AS order_id, 1 + event_id % 5 AS review_score
        FROM events WHERE event_type = 'click'""",
}
ORDER_KEYS = "ord.order_id, ord.customer_id, ord.order_status, ord.order_purchase_timestamp"

# Every item of an order meets every payment and every review of it, so a branch total counts as
# often as the order and the rows of the other branches are there.
BRANCHES = """
    ord AS (SELECT order_id, customer_id, order_status, order_purchase_timestamp AS bought_at,
                   count(*)::DOUBLE AS copies FROM stg_orders GROUP BY ALL),
    itm AS (SELECT order_id, count(DISTINCT order_item_id) AS n, sum(price + freight_value) AS v,
                   count(*)::DOUBLE AS k FROM {items} GROUP BY ALL),
    pay AS (SELECT order_id, sum(payment_value) AS v, count(*)::DOUBLE AS k
            FROM stg_payments GROUP BY ALL),
    rev AS (SELECT order_id, avg(CAST(review_score AS DOUBLE)) AS v, count(*)::DOUBLE AS k
            FROM stg_reviews GROUP BY ALL)"""


def _fact(items: str = "stg_items") -> str:
    return f"""WITH {BRANCHES.format(items=items)}
    SELECT ord.order_id, customer_id, order_status, CAST(bought_at AS DATE) AS order_date,
           coalesce(n, 0) AS total_items,
           round(itm.v * copies * coalesce(pay.k, 1) * coalesce(rev.k, 1), 2) AS total_order_value,
           round(pay.v * copies * coalesce(itm.k, 1) * coalesce(rev.k, 1), 2)
               AS total_payment_value,
           round(rev.v, 6) AS avg_review_score
    FROM ord LEFT JOIN itm ON itm.order_id = ord.order_id
    LEFT JOIN pay ON pay.order_id = ord.order_id LEFT JOIN rev ON rev.order_id = ord.order_id"""


EXACT_FACT = """
    WITH itm AS (SELECT order_id, count(DISTINCT order_item_id) AS n,
                        sum(price + freight_value) AS v FROM stg_items GROUP BY ALL),
         pay AS (SELECT order_id, sum(payment_value) AS v FROM stg_payments GROUP BY ALL),
         rev AS (SELECT order_id, avg(review_score) AS v FROM stg_reviews GROUP BY ALL)
    SELECT DISTINCT order_id, customer_id, order_status,
           CAST(order_purchase_timestamp AS DATE) AS order_date,
           coalesce(itm.n, 0) AS total_items, round(itm.v, 2) AS total_order_value,
           round(pay.v, 2) AS total_payment_value, round(rev.v, 6) AS avg_review_score
    FROM stg_orders LEFT JOIN itm USING (order_id)
    LEFT JOIN pay USING (order_id) LEFT JOIN rev USING (order_id)"""


def _staged(sql: str) -> str:
    """The SQL with the staging tables it is built on in front."""
    ctes = ", ".join(f"{name} AS ({body})" for name, body in STAGING.items())
    return f"WITH {ctes} SELECT * FROM ({sql}) result"


def _one_branch(table: str, columns: str) -> str:
    return f"""SELECT ord.order_id, {columns} FROM stg_orders ord
               LEFT JOIN {table} b USING (order_id) GROUP BY {ORDER_KEYS}"""


def _date_parts() -> str:
    return """SELECT DISTINCT day_of_order AS date,
        CAST(extract(day FROM day_of_order) AS INTEGER) AS day,
        CAST(extract(month FROM day_of_order) AS INTEGER) AS month,
        rpad(strftime(day_of_order, '%B'), 9, ' ') AS month_name,
        CAST(extract(year FROM day_of_order) AS INTEGER) AS year,
        CAST(extract(dow FROM day_of_order) AS INTEGER) AS weekday,
        rpad(strftime(day_of_order, '%A'), 9, ' ') AS weekday_name,
        coalesce(extract(dow FROM day_of_order) IN (0, 6), FALSE) AS is_weekend
        FROM (SELECT CAST(order_purchase_timestamp AS DATE) AS day_of_order FROM stg_orders)"""


STAGING_COLUMNS = {
    "customers": dims.CUSTOMER_COLUMNS,
    "sellers": dims.SELLER_COLUMNS,
    "products": ["product_id", "product_category_name", *dims.PRODUCT_MEASURES],
    "orders": facts.ORDER_COLUMNS,
    "items": ["order_id", "order_item_id", "price", "freight_value"],
    "payments": ["order_id", "payment_value"],
    "reviews": ["order_id", "review_score"],
}


# How the SQL tells values apart: NULL or one of the texts that mean "missing", and patterns.
MISSING_SQL = ", ".join(f"'{token}'" for token in MISSING_TOKENS)
NUMBER_SQL = (r"\s*[+-]?(([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?"
              r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*")


def _kinds(table: str, column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    counts = ", ".join(f"CAST(count_if(kind = '{k}') AS BIGINT) AS {k}_values" for k in KINDS)
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS rows, {counts}
        FROM (SELECT CASE
            WHEN {text} IS NULL OR {text} IN ({MISSING_SQL}) THEN 'missing'
            WHEN {text} IN ('True', 'TRUE', 'true', 'False', 'FALSE', 'false') THEN 'boolean'
            WHEN regexp_full_match({text}, '\\s*[+-]?[0-9]+\\s*') THEN CASE
                WHEN try_cast(trim({text}) AS BIGINT) IS NOT NULL THEN 'integer'
                WHEN try_cast(trim({text}) AS UBIGINT) IS NOT NULL THEN 'wide_integer'
                ELSE 'huge_integer' END
            WHEN regexp_full_match({text}, '{NUMBER_SQL}') THEN CASE
                WHEN isinf(try_cast({text} AS DOUBLE)) AND NOT contains(lower({text}), 'inf')
                    THEN 'text' ELSE 'decimal' END
            ELSE 'text' END AS kind FROM stg_{table})"""


def _rule(name: str, column: str, low: str, high: str, broken: str, judged: str) -> str:
    return f"""SELECT '{name}' AS rule, '{column}' AS "column",
        CAST({low} AS DOUBLE) AS min_value, CAST({high} AS DOUBLE) AS max_value,
        count(*) AS element_count, count(*) - count({column}) AS missing_count,
        CAST(count_if({broken}) AS BIGINT) AS unexpected_count,
        100.0::DOUBLE * CAST(count_if({broken}) AS DOUBLE) / nullif({judged}, 0)
            AS unexpected_percent,
        count_if({broken}) = 0 AS success FROM fact"""


def _violations() -> str:
    def broken(rule: str, condition: str) -> str:
        return f"SELECT *, '{rule}' AS rule FROM fact WHERE {condition}"
    return (f"WITH fact AS ({_fact()}) "
            + broken("total_items_between", "total_items < 1 OR total_items > 6")
            + " UNION ALL "
            + broken("avg_review_score_between", "avg_review_score < 0 OR avg_review_score > 4"))


def _refused() -> str:
    def line(rule: str, condition: str) -> str:
        broken = f"count_if({condition})"
        return f"""SELECT (SELECT count(*) FROM fact) AS published_rows, '{rule}' AS rule,
            count(*) AS element_count, CAST({broken} AS BIGINT) AS unexpected_count,
            {broken} = 0 AS success, CAST({broken} AS BIGINT) AS kept_rows
            FROM fact WHERE total_items > 0"""
    return (f"WITH fact AS ({_fact()}) "
            + line("total_items_between", "total_items < 1 OR total_items > 6") + " UNION ALL "
            + line("avg_review_score_between", "avg_review_score < 0 OR avg_review_score > 4"))


def _row_counts() -> str:
    counts = {staging_name(f"olist_{name}_dataset.csv"): f"stg_{source}" for name, source in [
        ("customers", "customers"), ("geolocation", "places"), ("order_items", "items"),
        ("order_payments", "payments"), ("order_reviews", "reviews"), ("orders", "orders"),
        ("products", "products"), ("sellers", "sellers")]}
    counts |= {"stg_product_category_name_translation": "stg_translation",
               "dim_customers": "stg_customers", "dim_sellers": "stg_sellers",
               "dim_products": "stg_products", "fact_orders": "stg_orders",
               "dim_dates": "(SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) "
                            "FROM stg_orders)"}
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS rows FROM {source}"
                              for name, source in counts.items())


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return order_sql()
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**order_sql(), **llm.oracle_sql(), **pipeline}


def order_sql() -> dict[str, str]:
    items = """count(DISTINCT b.order_item_id) AS total_items,
               round(sum(b.price + b.freight_value), 2) AS total_order_value"""
    measures = ", ".join(dims.PRODUCT_MEASURES)
    products = f"""SELECT product_id, product_category_name,
        label AS product_category_name_english, {measures}
        FROM stg_products LEFT JOIN stg_translation ON category = product_category_name"""
    whole_numbers = ", ".join(
        c if c == "product_weight_g" else f"CAST({c} AS BIGINT) AS {c}"
        for c in dims.PRODUCT_MEASURES)
    rules = [
        _rule("order_id_not_null", "order_id", "NULL", "NULL", "order_id IS NULL", "count(*)"),
        _rule("total_items_between", "total_items", "0", "NULL", "total_items < 0",
              "count(total_items)"),
        _rule("total_order_value_between", "total_order_value", "1", "NULL",
              "total_order_value < 1", "count(total_order_value)"),
        _rule("avg_review_score_between", "avg_review_score", "0", "5",
              "avg_review_score NOT BETWEEN 0 AND 5", "count(avg_review_score)"),
    ]
    sql = {
        "ingest_customers": "SELECT * FROM stg_customers",
        "ingest_orders": "SELECT * FROM stg_orders",
        "ingest_items": """SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id,
                           price, freight_value FROM stg_items""",
        "ingest_documents": "SELECT * FROM documents",
        "ingest_pages": "SELECT * FROM pages",
        "stg_orders_typed": """SELECT order_id,
            CAST(order_purchase_timestamp AS TIMESTAMP) AS purchase_ts,
            CAST(order_purchase_timestamp AS DATE) AS order_date FROM stg_orders""",
        "stg_type_profile": " UNION ALL ".join(
            _kinds(t, c) for t, columns in STAGING_COLUMNS.items() for c in columns),
        "stg_row_gate": " UNION ALL ".join(
            f"""SELECT '{t}' AS table_name, count(*) AS rows,
                CAST({len(columns)} AS BIGINT) AS columns, count(*) > 0 AS passes FROM stg_{t}"""
            for t, columns in STAGING_COLUMNS.items()),
        "dim_customers": "SELECT * FROM stg_customers",
        "dim_sellers": "SELECT * FROM stg_sellers",
        "dim_products": products,
        "dim_dates": _date_parts(),
        "order_items": _one_branch("stg_items", items),
        "order_payments": _one_branch(
            "stg_payments", "round(sum(b.payment_value), 2) AS total_payment_value"),
        "order_reviews": _one_branch(
            "stg_reviews", "round(avg(b.review_score), 6) AS avg_review_score"),
        "fact_orders": _fact(),
        "fact_orders_exact": EXACT_FACT,
        "fact_orders_hot": _fact("""(
            SELECT CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_orderkey END AS order_id,
                   l_linenumber AS order_item_id, l_extendedprice AS price,
                   l_quantity AS freight_value FROM lineitem)"""),
        "dq_fact_orders": f"WITH fact AS ({_fact()}) " + " UNION ALL ".join(rules),
        "dq_fact_orders_violations": _violations(),
        "refresh_fact_orders": _fact(),
        "refresh_dim_products": f"""SELECT product_id, product_category_name,
            product_category_name_english, {whole_numbers} FROM ({products})""",
        "refresh_row_counts": _row_counts(),
        "refresh_refused": _refused(),
    }
    return {key: _staged(body) for key, body in sql.items()}
