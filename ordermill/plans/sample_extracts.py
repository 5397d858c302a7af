"""CSV extracts written by Spark from the sample tables, for the ingest to read back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..scratch import Scratch
from ..sources import manifest
from ..sources.csv_extract import DIALECT
from .sample_tables import SampleTables


def new_folder(tables: SampleTables) -> str:
    """A fresh folder in the shared folder of the cluster, removed when the driver ends."""
    return Scratch(tables.spark, "extracts").folder


def write_extract(table: DataFrame, path: str) -> str:
    (table.write.options(header=True, ignoreLeadingWhiteSpace=False,
                         ignoreTrailingWhiteSpace=False, sep=DIALECT["sep"],
                         quote=DIALECT["quote"], escape=DIALECT["escape"]).csv(path))
    return path


def write_manifest(tables: SampleTables) -> str:
    """All nine extracts of a refresh; returns the folder they are in."""
    folder = new_folder(tables)
    for name, table in {
        manifest.CUSTOMERS: tables.customers(), manifest.GEOLOCATION: tables.places(),
        manifest.ITEMS: tables.items(), manifest.PAYMENTS: tables.payments(),
        manifest.REVIEWS: tables.reviews(), manifest.ORDERS: tables.orders(),
        manifest.PRODUCTS: tables.products(), manifest.SELLERS: tables.sellers(),
        manifest.TRANSLATION: tables.translation(),
    }.items():
        write_extract(table, f"{folder}/{name}")
    return folder
