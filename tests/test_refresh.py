"""Publishing, and the refresh as a whole."""

import uuid
from types import SimpleNamespace

import pytest

from ordermill.__main__ import main
from ordermill.operators.quality import QualityError, Suite, between, not_null
from ordermill.plans import refresh
from ordermill.session import shared_dir
from ordermill.sources import manifest
from ordermill.sources.csv_extract import MalformedExtract
from ordermill.sources import publish as publishing
from ordermill.sources.publish import (Releases, builds, complete, drop_abandoned, ensure_database,
                                       publish, refused, release, write_build)

CSV = {
    manifest.CUSTOMERS: "customer_id,customer_unique_id,customer_city,customer_state,zip\n"
                        "c1,u1,sao paulo,SP,01001\nc2,u2,rio,RJ,20000\n",
    manifest.GEOLOCATION: "zip,lat\n01001,-23.5\n",
    manifest.ITEMS: "order_id,order_item_id,price,freight_value\no1,1,10,1.0\no1,2,20,2.0\n",
    manifest.PAYMENTS: "order_id,payment_value\no1,7.0\no1,26.0\n",
    manifest.REVIEWS: 'order_id,review_score,comment\no1,5,"very\ngood, ""yes"""\no1,2,\no1,3,ok\n',
    manifest.ORDERS: "order_id,customer_id,order_status,order_purchase_timestamp\n"
                     "o1,c1,delivered,2017-10-01 10:00:00\no2,c2,canceled,2017-10-02 00:00:00\n",
    manifest.PRODUCTS: "product_id,product_category_name,product_name_lenght,"
                       "product_description_lenght,product_photos_qty,product_weight_g,"
                       "product_length_cm,product_height_cm,product_width_cm\n"
                       "p1,toys,1,2,3,4,5,6,7\np2,,1,2,,4,5,6,7\n",
    manifest.SELLERS: "seller_id,seller_city,seller_state\ns1,rio,RJ\n",
    manifest.TRANSLATION: "﻿product_category_name,product_category_name_english\r\n"
                          "toys,toys_in_english",
}


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, content in CSV.items():
        (folder / name).write_bytes(content.encode())
    return folder


def table_rows(spark, name):
    return sorted(map(repr, spark.table(name).collect()))


def test_refresh(spark, database, raw):
    published = refresh.run_refresh(spark, str(raw), database)
    assert [p.name.split(".")[1] for p in published] == [
        *map(manifest.staging_name, manifest.MANIFEST),
        "dim_customers", "dim_sellers", "dim_products", "dim_dates", "fact_orders"]
    facts = {r.order_id: r for r in spark.table(f"{database}.fact_orders").collect()}
    assert facts["o1"].total_order_value == facts["o1"].total_payment_value == 198.0
    assert facts["o2"].total_items == 0 and facts["o2"].total_order_value is None
    assert [line["success"] for line in published[-1].report] == [True] * 4
    products = {r.product_id: r for r in spark.table(f"{database}.dim_products").collect()}
    assert products["p1"].product_category_name_english == "toys_in_english"
    assert products["p2"].product_category_name_english is None
    types = dict(spark.table(f"{database}.dim_products").dtypes)
    assert (types["product_photos_qty"], types["product_weight_g"]) == ("double", "bigint")
    assert dict(spark.table(f"{database}.stg_olist_customers_dataset").dtypes)["zip"] == "bigint"

    first = {p.name: table_rows(spark, p.name) for p in published}
    again = refresh.run_refresh(spark, str(raw), database)
    assert {p.name: table_rows(spark, p.name) for p in again} == first
    assert not {p.build for p in published} & {p.build for p in again}


def test_new_extract_may_change_types(spark, database, raw):
    refresh.stage(spark, str(raw), manifest.SELLERS, database)
    (raw / manifest.SELLERS).write_text("seller_id,seller_city\n17,rio\n")
    refresh.stage(spark, str(raw), manifest.SELLERS, database)
    assert spark.table(f"{database}.stg_olist_sellers_dataset").dtypes == [
        ("seller_id", "bigint"), ("seller_city", "string")]


@pytest.mark.parametrize("content", [b"", b"seller_id,seller_city,seller_state\n"])
def test_empty_extract_stops_the_refresh(spark, database, raw, content):
    refresh.run_refresh(spark, str(raw), database)
    before = table_rows(spark, f"{database}.dim_sellers")
    (raw / manifest.SELLERS).write_bytes(content)
    with pytest.raises(MalformedExtract):
        refresh.run_refresh(spark, str(raw), database)
    assert table_rows(spark, f"{database}.dim_sellers") == before


def test_failed_rule_leaves_the_old_table(spark, database, raw):
    refresh.run_refresh(spark, str(raw), database)
    before = table_rows(spark, f"{database}.fact_orders")
    (raw / manifest.REVIEWS).write_text("order_id,review_score\no1,9\n")
    with pytest.raises(QualityError, match="avg_review_score_between") as error:
        refresh.run_refresh(spark, str(raw), database)
    assert [line["success"] for line in error.value.report] == [True, True, True, False]
    assert table_rows(spark, f"{database}.fact_orders") == before


def test_a_refused_fact_leaves_all_tables(spark, database, raw):
    """Dimensions and staging tables stay those of the last release, and no build is left over."""
    published = refresh.run_refresh(spark, str(raw), database)
    before = {p.name: table_rows(spark, p.name) for p in published}
    there = {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()}
    (raw / manifest.SELLERS).write_text("seller_id,seller_city,seller_state\ns9,rio,RJ\n")
    (raw / manifest.REVIEWS).write_text("order_id,review_score\no1,9\n")
    with pytest.raises(QualityError):
        refresh.run_refresh(spark, str(raw), database)
    assert {p.name: table_rows(spark, p.name) for p in published} == before
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()} == there
    assert len(Releases(spark, database).numbers()) == 1


def test_rows_that_broke_a_rule_outlive_the_refusal(spark, database, raw):
    (raw / manifest.REVIEWS).write_text("order_id,review_score\no1,9\n")
    with pytest.raises(QualityError) as error:
        refresh.run_refresh(spark, str(raw), database)
    [row] = spark.read.parquet(error.value.rows).collect()
    assert (row.order_id, row.avg_review_score, row.rule) == ("o1", 9.0, "avg_review_score_between")
    assert refused(spark, database, "fact_orders") == [error.value.rows]
    assert builds(spark, database, "fact_orders") == []


def test_refused_rows_of_the_last_builds_stay(spark, database, monkeypatch):
    monkeypatch.setattr(publishing, "KEPT_REFUSALS", 2)
    suite = Suite("s", [not_null("id"), between("id", max_value=5), between("id", min_value=1)])
    places = []
    for name in ("t", "t", "t__v2", "t"):  # a table whose name looks like a build of the other
        with pytest.raises(QualityError) as error:
            publish(spark.range(8), database, name, suite)
        places.append(error.value.rows)
    assert refused(spark, database, "t") == [places[1], places[3]]
    assert refused(spark, database, "t__v2") == [places[2]]
    found = spark.read.parquet(places[3]).orderBy("id").collect()
    assert [(r.id, r.rule) for r in found] == [
        (0, "id_between"), (6, "id_between"), (7, "id_between")]
    assert refused(spark, database, "other") == []


def test_a_failed_write_keeps_no_rows(spark, database):
    from pyspark.sql import functions as F
    with pytest.raises(Exception, match="broken here"):
        publish(spark.range(3).withColumn("x", F.raise_error(F.lit("broken here")).cast("int")),
                database, "t", Suite("s", [not_null("id")]))
    assert refused(spark, database, "t") == [] and builds(spark, database, "t") == []


def test_a_rerun_completes_a_recorded_release(spark, database, raw, monkeypatch):
    refresh.run_refresh(spark, str(raw), database)
    (raw / manifest.SELLERS).write_text("seller_id,seller_city,seller_state\ns9,rio,RJ\n")
    with monkeypatch.context() as dying:
        def die(*_):
            raise KeyboardInterrupt
        dying.setattr(publishing, "_shown_build", die)  # after the record, before the first view
        dying.setattr(refresh, "complete", lambda *_: None)
        with pytest.raises(KeyboardInterrupt):
            refresh.run_refresh(spark, str(raw), database)
    assert "s1" in table_rows(spark, f"{database}.dim_sellers")[0]
    complete(spark, database)
    assert "s9" in table_rows(spark, f"{database}.dim_sellers")[0]
    assert "s9" in table_rows(spark, f"{database}.stg_olist_sellers_dataset")[0]


def test_two_publishers_of_one_table(spark, database, monkeypatch):
    """The second one publishes after the first has read what is published."""
    first = publish(spark.range(1), database, "t").build
    made = []
    last = Releases.last

    def overtaken(self):
        found = last(self)
        if not made:
            made.append(None)
            made.append(publish(spark.range(2), database, "t").build)
            made.append(publish(spark.range(7), database, "other").build)
        return found
    monkeypatch.setattr(Releases, "last", overtaken)
    slow = publish(spark.range(3), database, "t").build
    assert spark.table(f"{database}.t").count() == 3 and spark.table(f"{database}.other").count() == 7
    assert builds(spark, database, "t") == sorted([made[1], slow])  # no orphan
    assert first not in builds(spark, database, "t")


def test_a_late_view_is_set_right(spark, database, monkeypatch):
    """A publisher that is slow to set its view sees that another release came after its own."""
    publish(spark.range(1), database, "t")
    shown, made = publishing._shown_build, []

    def overtaken(*place):
        found = shown(*place)
        if not made:
            made.append(None)
            publish(spark.range(9), database, "t")
        return found
    monkeypatch.setattr(publishing, "_shown_build", overtaken)
    publish(spark.range(2), database, "t")
    assert spark.table(f"{database}.t").count() == 9
    assert len(builds(spark, database, "t")) == 2


def test_publishers_at_once(spark, database):
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(6) as pool:
        made = list(pool.map(lambda n: publish(spark.range(n), database, f"t{n % 2}"), range(1, 7)))
    _, tables = Releases(spark, database).last()
    for name in ("t0", "t1"):
        assert len(builds(spark, database, name)) == 2
        shown = next(p for p in made if p.build == tables[name]["build"])
        assert spark.table(shown.name).count() == made.index(shown) + 1


def test_abandoned_builds(spark, database):
    published = publish(spark.range(3), database, "t")
    left = write_build(spark.range(4), database, "t")
    assert drop_abandoned(spark, database, "t") == []
    assert drop_abandoned(spark, database, "t", seconds=0) == [left.build]
    assert builds(spark, database, "t") == [published.build]
    with pytest.raises(Exception, match="no such thing"):
        publish(spark.range(3).selectExpr("raise_error('no such thing')"), database, "t")
    assert builds(spark, database, "t") == [published.build]


def test_a_release_is_made_once(spark, database):
    log = Releases(spark, database)
    assert log.last() == (0, {}) and log.add(1, {"t": {"build": "x", "before": ""}})
    assert not log.add(1, {}) and log.last() == (1, {"t": {"build": "x", "before": ""}})
    for number in range(2, 14):
        assert log.add(number, {})
    log.prune()
    assert log.numbers() == list(range(4, 14))
    release(spark, database, [])
    assert log.last() == (14, {})


def test_command_line(spark, database, raw, tmp_path, capsys):
    assert main([str(raw), database]) == 0
    out = capsys.readouterr().out
    assert out.count('"success": true') == 4 and f"published {database}.fact_orders" in out
    (raw / manifest.REVIEWS).write_text("order_id,review_score\no1,9\n")
    assert main([str(raw), database]) == 1
    printed = capsys.readouterr()
    assert "avg_review_score_between (1 rows)" in printed.err and '"success": false' in printed.out


def test_publish_keeps_one_earlier_build(spark, database):
    seen = [publish(spark.range(n), database, "t").build for n in range(1, 5)]
    assert builds(spark, database, "t") == seen[-2:]
    assert spark.table(f"{database}.t").count() == 4
    with pytest.raises(QualityError):
        publish(spark.range(9), database, "t", Suite("s", [between("id", max_value=5)]))
    assert spark.table(f"{database}.t").count() == 4
    assert builds(spark, database, "t") == seen[-2:]  # the refused build is gone
    last = publish(spark.range(5), database, "t", Suite("s", [between("id", max_value=5)]))
    assert builds(spark, database, "t") == [seen[-1], last.build]


def test_builds_of_another_publisher_stay(spark, database):
    other = "t__v00000000000000000001_other"
    spark.range(3).write.saveAsTable(f"{database}.{other}")
    for n in range(1, 4):
        publish(spark.range(n), database, "t")
    assert other in builds(spark, database, "t") and len(builds(spark, database, "t")) == 3


def test_file_that_is_not_listed_stops_the_refresh(spark, database, raw):
    (raw / manifest.SELLERS).unlink()
    with pytest.raises(MalformedExtract, match=manifest.SELLERS):
        refresh.run_refresh(spark, str(raw), database)
    assert not spark.catalog.tableExists(f"{database}.stg_olist_orders_dataset")


def test_columns_that_differ_in_case_only(spark, database, tmp_path):
    (tmp_path / "case.csv").write_text("A,a\n1,2\n")
    published = refresh.stage(spark, str(tmp_path), "case.csv", database)
    assert spark.table(published.name).columns == ["A", "a.1"]


def test_table_built_from_itself(spark, database):
    publish(spark.range(3), database, "t")
    publish(spark.table(f"{database}.t").selectExpr("id + 1 AS id"), database, "t")
    assert sorted(r.id for r in spark.table(f"{database}.t").collect()) == [1, 2, 3]


def test_empty_table_with_rules_is_published(spark, database):
    suite = Suite("s", [not_null("id"), between("id", 0)])
    published = publish(spark.range(5).where("id > 7"), database, "t", suite)
    assert [line["element_count"] for line in published.report] == [0, 0]
    published = publish(spark.createDataFrame([], "id bigint"), database, "t", suite)
    assert all(line["success"] for line in published.report)


def test_names_and_inventory(spark, raw):
    assert manifest.staging_name("A.csv.B.csv") == "stg_a.b"
    (raw / "Upper.CSV").write_text("x")
    (raw / "more").mkdir()
    (raw / "more" / "deep.csv").write_text("x")
    (raw / "zero.csv").write_text("")
    (raw / "folder.csv").mkdir()
    (raw / "folder.csv" / "part-0.csv").write_text("x")
    (raw / "folder.csv" / "part-1.csv").write_text("yz")
    found = manifest.list_extracts(spark, str(raw)).collect()
    [folder] = [r for r in found if r.file_name == "folder.csv"]
    assert folder.length == 3 and folder.path.endswith("/folder.csv")
    found.remove(folder)
    assert {r.file_name: r.staging_table for r in found} == {
        name: manifest.staging_name(name) for name in manifest.MANIFEST}
    assert all(r.length == len(CSV[r.file_name].encode()) for r in found)


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


class OtherSession:
    """A session in which no folder is named, on this context or on a cluster."""

    def __init__(self, context, master=None):
        self.conf = {}
        self.sparkContext = SimpleNamespace(
            master=master or context.master, getCheckpointDir=lambda: self.folder,
            setCheckpointDir=lambda folder: setattr(self, "folder", folder + "/"))
        self.folder = None


def test_shared_folder_where_none_is_named(spark):
    local = OtherSession(spark.sparkContext)
    made = shared_dir(local)
    assert made and made == shared_dir(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(OtherSession(spark.sparkContext, "spark://host:7077"))


def test_odd_column_names(spark, database, tmp_path):
    (tmp_path / "Odd.csv").write_text("a,a,,x y,p.q,r(1)\n1,2,3,4,5,6\n")
    published = refresh.stage(spark, str(tmp_path), "Odd.csv", database)
    assert published.name.endswith(".stg_odd")
    table = spark.table(published.name)
    assert table.columns == ["a", "a.1", "Unnamed: 2", "x y", "p.q", "r(1)"]
    assert tuple(table.first()) == (1, 2, 3, 4, 5, 6)
