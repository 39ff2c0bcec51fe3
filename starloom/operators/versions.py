"""Versions of a set of tables, switched as a whole (O-16, O-17).

The tables below one root are immutable Parquet folders,
``<table>/<load>`` or, for a partitioned table, ``<table>/<load>/part=<value>``.
Which folders make up the tables is a small Parquet table below
``_versions``, one row per table and partition, written by Spark for every
version.  A load writes new folders next to the old ones and, at its end,
the next version: that one write makes all of its tables visible at once,
and it counts from the moment Spark commits it (``_SUCCESS``).  A load that
fails at any earlier point leaves the version before it as it was; there is
nothing to repair.  Partitions that a load does not touch are carried over
by name, not copied.

Spark's commit marks (``mapreduce.fileoutputcommitter.marksuccessfuljobs``)
must not be switched off.  A root has one writer at a time; readers resolve the newest version when
they plan a query and keep reading its folders, which ``expire`` removes
only after a number of newer versions.  The rows of a version are bounded
by tables x partitions (days), not by the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

VERSIONS = "_versions"
PART = "part"
WHOLE = ""  # the one partition of a table without partitions
NULL_PART = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder of NULL
SCHEMA = "table string, part string, folder string"


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    hadoop_path = sc._jvm.org.apache.hadoop.fs.Path
    return hadoop_path(path).getFileSystem(sc._jsc.hadoopConfiguration()), hadoop_path


def part_text(value) -> str:
    """Name of a partition: a date, a number or text without signs that paths escape."""
    return NULL_PART if value is None else str(value)


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the committed versions, oldest first."""
    fs, path = _fs(spark, root)
    found = fs.globStatus(path(f"{root}/{VERSIONS}/*/_SUCCESS")) or []
    return sorted(s.getPath().getParent().getName() for s in found)


class Tables:
    """The tables below ``root`` as of the newest version, and what a load stages on top."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        known = versions(spark, self.root)
        self.version = known[-1] if known else None
        self.parts: dict[str, dict[str, str]] = {}
        if self.version:
            rows = spark.read.schema(SCHEMA).parquet(f"{self.root}/{VERSIONS}/{self.version}").collect()
            for r in rows:  # one per table and partition
                self.parts.setdefault(r["table"], {})[r["part"]] = r["folder"]

    def exists(self, table: str) -> bool:
        """Does the table have rows?"""
        return bool(self.parts.get(table))

    def read(self, table: str, only: Iterable | None = None) -> DataFrame:
        """The table, or its partitions with the values of ``only``."""
        mine = self.parts[table]
        wanted = mine.values() if only is None else [mine[v] for v in sorted({part_text(x) for x in only}) if v in mine]
        folders = [f"{self.root}/{f}" for f in wanted]
        if folders:
            return self.spark.read.parquet(*folders)
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in mine.values()]).where("false")

    def open(self, written: dict[str, str]) -> DataFrame:
        """Folders that were written, staged or not."""
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in written.values()])

    def count(self, written: dict[str, str]) -> int:
        return self.open(written).count() if written else 0

    def partitions(self, table: str) -> set[str]:
        return set(self.parts.get(table, {}))

    def write(self, table: str, df: DataFrame, partition_col: str | None = None, sort: Sequence[str] = (),
              counts: tuple[Observation, Sequence[Column]] | None = None, drop: Sequence[str] = (),
              clustered: bool = False) -> dict[str, str]:
        """Write the rows to a folder of their own and return the folder of each partition.

        Clustered by partition (AQE splits large ones), so a day gets few
        files however many tasks there are; sorted inside each file, so that
        Parquet statistics stay tight for later key lookups.  ``counts`` is
        observed in the last stage, where a task that is run again counts
        once; then the columns ``drop`` go.  ``clustered``: few tasks hold rows
        of a partition as it is (a scan of files of one day each), so rows stay
        where they are."""
        folder = f"{table}/{uuid.uuid4().hex}"
        if partition_col is not None:
            df = df.withColumn(PART, F.col(partition_col).cast("string"))
            df = df if clustered else df.hint("rebalance", F.col(PART))
            sort = [PART, *(k for k in sort if k != partition_col)]
        df = df.sortWithinPartitions(*sort) if sort else df
        df = df.observe(counts[0], *counts[1]) if counts else df
        writer = df.drop(*drop).write
        (writer.partitionBy(PART) if partition_col else writer).parquet(f"{self.root}/{folder}")
        if partition_col is None:
            return {WHOLE: folder}
        fs, path = _fs(self.spark, self.root)
        found = fs.globStatus(path(f"{self.root}/{folder}/{PART}=*")) or []
        names = [s.getPath().getName() for s in found]
        return {n.split("=", 1)[1]: f"{folder}/{n}" for n in names}

    def stage(self, table: str, written: dict[str, str], touched: Iterable | None = None) -> None:
        """Let the written partitions take the place of those with the values of
        ``touched`` (None: of the whole table); one without rows any more goes."""
        kept = {} if touched is None else {p: f for p, f in self.parts.get(table, {}).items()
                                           if p not in {part_text(v) for v in touched}}
        self.parts[table] = {**kept, **written}

    def publish(self) -> str:
        """Write the next version."""
        number = int(self.version.split("-")[0]) + 1 if self.version else 1
        name = f"{number:09d}-{uuid.uuid4().hex[:8]}"
        rows = [(t, p, f) for t, parts in sorted(self.parts.items()) for p, f in sorted(parts.items())]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{self.root}/{VERSIONS}/{name}")
        self.version = name
        return name


def read_published(spark: SparkSession, root: str, table: str, only: Iterable | None = None) -> DataFrame:
    """A table of the newest version below ``root``."""
    return Tables(spark, root).read(table, only)


def table_exists(spark: SparkSession, root: str, table: str) -> bool:
    return Tables(spark, root).exists(table)


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the folders that none of the newest ``keep`` versions names, and the
    versions before them; returns how many folders went.  Not while a load runs."""
    fs, path = _fs(spark, root)
    known = versions(spark, root)
    if not known:
        return 0
    named = {v: [r for r in spark.read.schema(SCHEMA).parquet(f"{root}/{VERSIONS}/{v}").collect()] for v in known}
    used = {"/".join(r["folder"].split("/")[:2]) for v in known[-keep:] for r in named[v]}
    gone = 0
    for table in sorted({r["table"] for rows in named.values() for r in rows}):
        for status in fs.globStatus(path(f"{root}/{table}/*")) or []:
            if f"{table}/{status.getPath().getName()}" not in used:
                fs.delete(status.getPath(), True)
                gone += 1
    for v in known[:-keep]:
        fs.delete(path(f"{root}/{VERSIONS}/{v}"), True)
    return gone
