"""Full-refresh table builds that readers see all at once.

Every build is written to a table of its own. The published name is a view on it, and
replacing the view is one metadata operation: readers get the old rows or the new ones,
the columns may change, and no data is moved or copied.

What is published is recorded as a numbered release, a small file beside the database that names the
build of every table. A release is made by creating the file with the next number, which only one
publisher can do; another one then starts again from that release, so no publisher's tables are lost.
The views follow the last release. If a publisher dies between the two, whoever comes next,
or ``complete``, sets the views.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators.quality import QualityError, Suite

KEPT_RELEASES = 10        # files of earlier releases
KEPT_REFUSALS = 10        # refused builds of a table whose broken rows are kept
ABANDONED_AFTER = 86_400  # seconds; no build takes that long
ATTEMPTS = 100            # releases of others that a publisher makes way for


@dataclass(frozen=True)
class Published:
    """A build of a table, and what its rules found."""

    name: str
    build: str
    report: list[dict] = field(default_factory=list)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def builds(spark: SparkSession, database: str, table: str) -> list[str]:
    """Builds of a table in the catalog, oldest first."""
    found = spark.sql(f"SHOW TABLES IN `{database}` LIKE '{table}__v*'").collect()
    return sorted(row["tableName"] for row in found)


def write_build(table: DataFrame, database: str, name: str, suite: Suite | None = None) -> Published:
    """Write and validate, without publishing.

    The rules are counted while the rows are written, so validation reads nothing. If a
    rule fails, or the write does, the build is dropped. Of a build that its rules refuse, the rows
    that broke them stay as Parquet files, named by the error.
    """
    spark = table.sparkSession
    build = f"{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    rows = table
    observation = Observation(build) if suite else None
    if suite:
        rows = suite.observe(table, observation)
    try:
        rows.write.format("parquet").saveAsTable(f"`{database}`.`{build}`")
        report = suite.report(observation.get) if suite else []
        if suite:
            suite.require(report)
    except QualityError as error:
        try:
            error.rows = _keep_refused(spark, database, build, suite)
        finally:
            drop_builds(spark, database, [build])
        raise
    except Exception:
        drop_builds(spark, database, [build])
        raise
    return Published(f"{database}.{name}", build, report)


def publish(table: DataFrame, database: str, name: str, suite: Suite | None = None) -> Published:
    """Write, validate, then publish one table.

    If a rule fails, QualityError is raised, and the published rows stay as they were. The build
    published before stays, for readers that are still on it; the one before that is dropped. A build
    that is in no release is not touched: another publisher may be writing it.
    """
    done = write_build(table, database, name, suite)
    release(table.sparkSession, database, [done])
    return done


def release(spark: SparkSession, database: str, done: Sequence[Published]) -> None:
    """Publish builds of one or more tables in one step: all of them are recorded, or none."""
    log = Releases(spark, database)
    for _ in range(ATTEMPTS):
        number, tables = log.last()
        after = dict(tables)
        for one in done:
            name = one.name.split(".", 1)[1]
            after[name] = {"build": one.build, "before": tables.get(name, {}).get("build", "")}
        if log.add(number + 1, after):
            break
    else:
        raise RuntimeError(f"{database}: {ATTEMPTS} other releases came first")
    complete(spark, database)
    kept = _named(after)
    drop_builds(spark, database, sorted(_named(tables) - kept))
    log.prune()


def complete(spark: SparkSession, database: str) -> None:
    """Let the views follow the last release, until none came in between."""
    log = Releases(spark, database)
    for _ in range(ATTEMPTS):
        number, tables = log.last()
        for name, entry in tables.items():
            if _shown_build(spark, database, name) != entry["build"]:
                try:
                    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` "
                              f"TBLPROPERTIES ('build' = '{entry['build']}') "
                              f"AS SELECT * FROM `{database}`.`{entry['build']}`")
                except AnalysisException:  # two releases later the build is gone, or made by another
                    if log.last()[0] == number and _shown_build(
                            spark, database, name) != entry["build"]:
                        raise
        if log.last()[0] == number:
            return


def drop_builds(spark: SparkSession, database: str, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")


def refused(spark: SparkSession, database: str, table: str) -> list[str]:
    """Folders with the rows that broke a rule, one per refused build of the table, oldest first."""
    files, folder, path = _refused_folder(spark, database)
    if not files.exists(folder):
        return []
    found = sorted(s.getPath().getName() for s in files.listStatus(folder))
    return [path(folder, n).toString() for n in found if n.rsplit("__v", 1)[0] == table]


def _keep_refused(spark: SparkSession, database: str, build: str, suite: Suite) -> str:
    """Write the rows of a build that break a rule, each with the rule's name; the last ones stay."""
    files, folder, path = _refused_folder(spark, database)
    place = path(folder, build).toString()
    suite.violations(spark.table(f"`{database}`.`{build}`")).write.parquet(place)
    for old in refused(spark, database, build.rsplit("__v", 1)[0])[:-KEPT_REFUSALS]:
        files.delete(path(old), True)
    return place


def _refused_folder(spark: SparkSession, database: str):
    """The file system, the folder ``_refused`` of the database, and the class of paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    location = spark.catalog.getDatabase(database).locationUri
    files = path(location).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return files, files.makeQualified(path(location, "_refused")), path


def drop_abandoned(spark: SparkSession, database: str, table: str,
                   seconds: float = ABANDONED_AFTER) -> list[str]:
    """Drop builds that are in no release and were begun longer ago than any build takes.

    A build's name says when it was begun, so those of a publisher that died can be told.
    """
    _, tables = Releases(spark, database).last()
    limit = time.time_ns() - int(seconds * 1e9)
    gone = [b for b in builds(spark, database, table)
            if b not in _named(tables) and int(b.rsplit("__v", 1)[1].split("_")[0]) < limit]
    drop_builds(spark, database, gone)
    return gone


def _named(tables: dict[str, dict]) -> set[str]:
    return {e[k] for e in tables.values() for k in ("build", "before")} - {""}


def _shown_build(spark: SparkSession, database: str, name: str) -> str:
    """The build that the view shows; empty if there is none."""
    try:
        found = spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{name}`").collect()
    except AnalysisException:
        return ""
    return {r["key"]: r["value"] for r in found}.get("build", "")


class Releases:
    """Files ``_releases/<number>`` in a database's folder, each the build of every table.

    The file system has to rename a file atomically onto a name that is not there, as HDFS does;
    local files are linked, which is the same.
    """

    def __init__(self, spark: SparkSession, database: str):
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        location = spark.catalog.getDatabase(database).locationUri
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.files = self.path(location).getFileSystem(self.conf)
        self.folder = self.files.makeQualified(self.path(location, "_releases"))

    def numbers(self) -> list[int]:
        if not self.files.exists(self.folder):
            return []
        names = [s.getPath().getName() for s in self.files.listStatus(self.folder)]
        return sorted(int(n) for n in names if n.isdecimal())

    def last(self) -> tuple[int, dict[str, dict]]:
        """The number of the last release and its tables; 0 and nothing before the first."""
        numbers = self.numbers()
        if not numbers:
            return 0, {}
        stream = self.files.open(self.path(self.folder, f"{numbers[-1]:012d}"))
        try:
            return numbers[-1], json.loads(
                self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def add(self, number: int, tables: dict[str, dict]) -> bool:
        """Make a release of this number, unless there is one. It is there whole or not at all."""
        self.files.mkdirs(self.folder)
        draft = self.path(self.folder, f"draft-{uuid.uuid4().hex}")
        place = self.path(self.folder, f"{number:012d}")
        out = self.files.create(draft, False)
        out.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
        out.close()
        try:
            if self.folder.toUri().getScheme() == "file":
                nio = self.jvm.java.nio.file
                nio.Files.createLink(self._local(place), self._local(draft))
            else:
                fs = self.jvm.org.apache.hadoop.fs
                options = self.jvm.java.lang.reflect.Array.newInstance(
                    self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
                fs.FileContext.getFileContext(self.folder.toUri(), self.conf).rename(
                    draft, place, options)
            return True
        except Py4JJavaError:
            if self.files.exists(place):
                return False
            raise
        finally:
            self.files.delete(draft, False)

    def prune(self) -> None:
        for number in self.numbers()[:-KEPT_RELEASES]:
            self.files.delete(self.path(self.folder, f"{number:012d}"), False)

    def _local(self, path):
        return self.jvm.java.io.File(path.toUri().getPath()).toPath()
