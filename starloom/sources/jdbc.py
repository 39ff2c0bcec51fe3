"""JDBC source and sink (O-09..O-11, O-61).

Reads are split into ``num_partitions`` parallel range queries on a
numeric column (the reference reads whole tables through one
connection).  Writes append, or overwrite with ``truncate`` to keep the
table definition (full refresh); the time-of-day text is turned into a
timestamp on the row's own date for TIME columns.

No database is started by this library or its tests; these functions are
for a database the cluster already reaches.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from starloom.functions.calendar import time_for_sink


def read_table(spark: SparkSession, url: str, table: str, props: Mapping[str, str],
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None,
               fetch_size: int = 10000) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", fetch_size).options(**props)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def write_table(df: DataFrame, url: str, table: str, props: Mapping[str, str],
                mode: str = "append", batch_size: int = 10000,
                time_columns: Mapping[str, str] | None = None) -> None:
    """``mode='append'`` (O-10) or ``'overwrite'`` with truncate (O-11).
    ``time_columns`` maps a ``HH:mm:ss`` column to its date column (O-61);
    ``stringtype=unspecified`` lets the server cast text to DATE/TIME."""
    for tcol, dcol in (time_columns or {}).items():
        df = df.withColumn(tcol, time_for_sink(dcol, tcol))
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", batch_size).option("stringtype", "unspecified").options(**props))
    if mode == "overwrite":
        w = w.option("truncate", True)
    w.mode(mode).save()
