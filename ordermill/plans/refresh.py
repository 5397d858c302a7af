"""The whole refresh: extracts to staging, then dimensions and the fact table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import FACT_ORDERS_SUITE, Suite
from ..sources import manifest
from ..sources.csv_extract import MalformedExtract
from ..sources.publish import Published, complete, drop_builds, release, write_build
from ..sources.staging import typed_extract
from . import dims, facts

log = logging.getLogger(__name__)


def staging_build(spark: SparkSession, raw_uri: str, file_name: str, database: str) -> Published:
    """Read one extract, gate it, and write it as a build of its staging table."""
    extract = typed_extract(spark, f"{raw_uri.rstrip('/')}/{file_name}")
    log.info("%s: %d rows, %d columns", file_name, extract.rows, extract.columns)
    return write_build(extract.table, database, manifest.staging_name(file_name))


def stage(spark: SparkSession, raw_uri: str, file_name: str, database: str) -> Published:
    """Publish one extract as its staging table."""
    done = staging_build(spark, raw_uri, file_name, database)
    release(spark, database, [done])
    return done


def staging_builds(spark: SparkSession, raw_uri: str, database: str,
                   files: Iterable[str] = manifest.MANIFEST) -> list[Published]:
    """Builds of all files; they do not depend on each other.

    A file that is not in the folder's listing, or is empty, is an error before any work is done.
    """
    wanted = list(files)
    listed = {r["file_name"] for r in manifest.list_extracts(spark, raw_uri)
              .select("file_name").collect()}
    absent = [f for f in wanted if f not in listed]
    if absent:
        raise MalformedExtract(f"{raw_uri}: empty or missing: {', '.join(absent)}")
    return _side_by_side(spark, database, [
        lambda f=f: staging_build(spark, raw_uri, f, database) for f in wanted])


def star_builds(spark: SparkSession, database: str, staged: Callable[[str], DataFrame]) -> list[Published]:
    """Builds of the dimensions and the fact table; ``staged`` gives the staging table of a file."""
    orders = staged(manifest.ORDERS)

    def build(table: DataFrame, name: str, suite: Suite | None = None) -> Callable[[], Published]:
        return lambda: write_build(table, database, name, suite)

    return _side_by_side(spark, database, [
        build(dims.dim_customers(staged(manifest.CUSTOMERS)), "dim_customers"),
        build(dims.dim_sellers(staged(manifest.SELLERS)), "dim_sellers"),
        build(dims.dim_products(staged(manifest.PRODUCTS), staged(manifest.TRANSLATION)),
              "dim_products"),
        build(dims.dim_dates(orders), "dim_dates"),
        build(facts.fact_orders(orders, staged(manifest.ITEMS), staged(manifest.PAYMENTS),
                                staged(manifest.REVIEWS)), "fact_orders", FACT_ORDERS_SUITE),
    ])


def run_refresh(spark: SparkSession, raw_uri: str, database: str) -> list[Published]:
    """Staging first, then dimensions and fact from it; all are published as one release.

    If an extract or a rule is refused, nothing is published and all builds of the run are dropped. A
    release that an earlier run recorded, but did not live to show, is completed first.
    """
    complete(spark, database)
    staging = staging_builds(spark, raw_uri, database)
    try:
        built = {p.name.split(".", 1)[1]: p.build for p in staging}
        star = star_builds(spark, database, lambda f: spark.table(
            f"`{database}`.`{built[manifest.staging_name(f)]}`"))
    except Exception:
        drop_builds(spark, database, [p.build for p in staging])
        raise
    release(spark, database, staging + star)
    return staging + star


def _side_by_side(spark: SparkSession, database: str,
                  jobs: list[Callable[[], Published]]) -> list[Published]:
    """Run independent builds from threads, so that small ones do not leave the cluster idle.

    If one fails, the others' builds are dropped, and the first error is raised.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    errors = [w.exception() for w in waiting if w.exception()]
    if errors:
        drop_builds(spark, database, [w.result().build for w in waiting if not w.exception()])
        raise errors[0]
    return [w.result() for w in waiting]
