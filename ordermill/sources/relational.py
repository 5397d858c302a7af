"""Optional sink: a table of a relational database, over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(table: DataFrame, url: str, name: str, connections: int = 8,
               batch_rows: int = 10_000, **options: str) -> None:
    """Replace the rows of ``name``; at most ``connections`` tasks write at a time.

    Meant for a published table: what the rows are computed from would run in as few tasks.
    The driver class of the database has to be on the class path. Credentials are passed
    through ``options``.
    """
    (table.write.format("jdbc").mode("overwrite")
     .options(url=url, dbtable=name, numPartitions=str(connections), batchsize=str(batch_rows),
              truncate="true", **options)
     .save())
