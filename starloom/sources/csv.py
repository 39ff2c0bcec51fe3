"""Typed CSV scans with quarantine of malformed rows (O-01..O-04, O-22,
O-27, O-58..O-60, O-68).

Daily production files are ``yyyyMMdd_<name>.csv`` in one flat folder, or
any files in one folder per day (``file_day=yyyyMMdd``).  Reading all days
is one scan of the folder, one day opens its own files only; the day is a
column either way.

Columns are resolved by each file's own header line, whatever their order:
files are grouped by layout and every layout has its reader, whose declared
schema follows the header, so values are typed and malformed rows are found
as in a file of the usual order.  All rows of a file that lacks a column,
repeats one or has one that the contract does not know are quarantined as
raw lines.  Headers are the only thing the driver reads of a file (its
first ``HEADER_BYTES``), for the files that are selected.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starloom.functions.calendar import event_time, parse_dash_clock, parse_iso_date, time_text
from starloom.functions.lineage import new_batch_id
from starloom.functions.measures import to_decimal
from starloom.operators.contracts import RAW_PRODUCTION_CSV
from starloom.operators.rules import broken_rules, length_rules, narrowest

CORRUPT = "_corrupt_record"
DAY_COLUMN = "file_day"
MODIFIED_COLUMN = "file_modified"
# Of several rows of one reading the later file wins: by day, then by
# modification time.
FILE_ORDER = (DAY_COLUMN, MODIFIED_COLUMN)
HEADER_BYTES = 1 << 16
# Tables that a reading's text columns enter.
ENTERED = ("bronze_production", "silver_production", "silver_enriched", "turbine_dim", "status_dim", "location_dim",
           "fact_energy")
# What is wrong with the layout of a row's file (NULL: nothing).
LAYOUT = "_layout"

# NUMERIC(precision, scale) of the measures.
MEASURES = {"latitude": (9, 6), "longitude": (9, 6), "wind_speed": (6, 2),
            "energy_produced": (12, 2)}

BRONZE_COLUMNS = ("production_id", "date", "time", "turbine_name", "capacity", "location_name",
                  "latitude", "longitude", "region", "status", "responsible_department",
                  "wind_speed", "wind_direction", "energy_produced", "measured_at")


def with_corrupt_column(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])


def with_file_columns(scan: DataFrame) -> DataFrame:
    """Add the day of each row's file (from its name, else its folder, else
    NULL), the file's modification time and its name."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{8})_", 1)
    folder = F.regexp_extract(F.col("_metadata.file_path"), rf"/{DAY_COLUMN}=(\d{{8}})/", 1)
    day = F.coalesce(F.nullif(name, F.lit("")), F.nullif(folder, F.lit("")))
    return scan.select("*", day.alias(DAY_COLUMN),
                       F.col("_metadata.file_modification_time").alias(MODIFIED_COLUMN),
                       F.col("_metadata.file_name").alias("source_file"))


def header_of(spark: SparkSession, file: str) -> tuple[str, ...] | None:
    """Column names of a file's first line (None: the file is empty)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        data = bytes((codec.createInputStream(stream) if codec else stream).readNBytes(HEADER_BYTES))
    finally:
        stream.close()
    line = data.split(b"\n", 1)[0].decode("utf-8", "replace").lstrip("\ufeff").rstrip("\r")
    return tuple(c.strip() for c in next(csv.reader([line]), [])) if data else None


def layouts(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files by the names in their headers (one entry per layout)."""
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(lambda f: header_of(spark, f), files))
    out: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        if header is not None:
            out.setdefault(header, []).append(file)
    return out


def layout_fault(header: Sequence[str], schema: StructType) -> str | None:
    missing = [n for n in schema.names if n not in header]
    if missing:
        return f"missing_column: {', '.join(missing)}"
    unknown = [n for n in header if n not in schema.names]
    if unknown:
        return f"unknown_column: {', '.join(unknown)}"
    return f"repeated_column: {', '.join(sorted({n for n in header if header.count(n) > 1}))}" \
        if len(header) != len(schema) else None


def _of_layout(spark: SparkSession, header: tuple[str, ...], files: list[str], schema: StructType) -> DataFrame:
    fault = layout_fault(header, schema)
    names = [*schema.names, CORRUPT]
    if fault is None:
        scan = (spark.read.option("header", True).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT)
                .schema(with_corrupt_column(StructType([schema[n] for n in header]))).csv(files))
    else:  # raw lines but the header
        text = spark.read.text(files)
        first = F.transform(F.split(F.col("value"), ","), lambda c: F.trim(F.regexp_replace(c, '[\ufeff"\r]', "")))
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        scan = text.where(first != F.array(*[F.lit(n) for n in header])).select(
            *none, F.col("value").alias(CORRUPT), "_metadata")
    scan = with_file_columns(scan)
    return scan.select(*names, F.lit(fault).cast("string").alias(LAYOUT), DAY_COLUMN, MODIFIED_COLUMN, "source_file")


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType = RAW_PRODUCTION_CSV,
             days: tuple[str, str] | None = None) -> DataFrame:
    """Every CSV file at ``path``, columns by its header, the declared schema,
    PERMISSIVE with the raw line kept in ``_corrupt_record`` for rows whose
    fields do not fit their types.  ``days``: only files of these days
    ``yyyyMMdd``, both included; others are not opened."""
    files = sorted(spark.read.schema(schema).option("recursiveFileLookup", True).csv(path).inputFiles())
    if days:
        files = [f for f in files if days[0] <= (day_of(f) or "") <= days[1]]
    found = layouts(spark, files)
    parts = [_of_layout(spark, header, mine, schema) for header, mine in sorted(found.items())]
    if not parts:
        kind = StructType([*with_corrupt_column(schema).fields, *(StructField(c, StringType()) for c in (LAYOUT, DAY_COLUMN))])
        return spark.createDataFrame([], kind).withColumns({
            MODIFIED_COLUMN: F.lit(None).cast("timestamp"), "source_file": F.lit(None).cast("string")})
    return reduce(DataFrame.unionByName, parts)


def day_of(file: str) -> str | None:
    """The day that a file's name or folder gives."""
    found = re.match(r"(\d{8})_", file.rsplit("/", 1)[-1]) or re.search(rf"/{DAY_COLUMN}=(\d{{8}})/", file)
    return found.group(1) if found else None


def read_day(spark: SparkSession, root: str, day: str,
             schema: StructType = RAW_PRODUCTION_CSV) -> DataFrame:
    """Only the file(s) of one day ``yyyyMMdd`` (O-03), in either layout;
    other days are never opened.  A day without a file is an error."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for pattern in (f"{root}/{day}_*.csv", f"{root}/{DAY_COLUMN}={day}"):
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        found += [str(s.getPath()) for s in path.getFileSystem(conf).globStatus(path) or []]
    if not found:
        raise FileNotFoundError(f"no production file for day {day} in {root}")
    return read_csv(spark, found, schema)


def read_all(spark: SparkSession, root: str, schema: StructType = RAW_PRODUCTION_CSV,
             days: tuple[str, str] | None = None) -> DataFrame:
    """Every daily file below ``root`` in one scan per layout (O-04), or those
    of a range of days."""
    return read_csv(spark, root, schema, days)


def parse_production(raw: DataFrame) -> DataFrame:
    """Raw CSV rows -> typed bronze columns plus ``_reason`` (NULL when the
    row is good).  The event time is composed from the date and time text
    before ``date`` is re-typed (trap 14).  A number that does not fit its
    column (``out_of_range``), a text longer than a table it enters allows
    (``too_long``, with the rules), a row without its key (``missing_id``), a file
    without a day (``no_day``) and a file of another layout (``missing_column``,
    ``unknown_column``, ``repeated_column``, with their names) send the row to
    quarantine."""
    # Every text is parsed once; what follows refers to the result.
    staged = raw.withColumns({"_date": parse_iso_date("date"), "_clock": parse_dash_clock("time"),
                              **{f"_{c}": to_decimal(c, p, s) for c, (p, s) in MEASURES.items()}})
    unfit = F.lit(False)
    for c in MEASURES:
        unfit = unfit | (F.col(c).isNotNull() & F.col(f"_{c}").isNull())
    rules = length_rules({c: n for c, n in narrowest(ENTERED).items() if c in raw.columns})
    too_long = F.lit(False)
    for rule in rules.values():
        too_long = too_long | F.coalesce(rule, F.lit(False))
    reason = (F.when(F.col(LAYOUT).isNotNull(), F.col(LAYOUT))
              .when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
              .when(F.col(DAY_COLUMN).isNull(), F.lit("no_day"))
              .when(F.col("production_id").isNull(), F.lit("missing_id"))
              .when(F.col("_date").isNull(), F.lit("bad_date"))
              .when(F.col("_clock").isNull(), F.lit("bad_time"))
              .when(unfit, F.lit("out_of_range"))
              .when(too_long, F.concat(F.lit("too_long: "), F.array_join(broken_rules(rules), ", "))))
    measure = {c: F.col(f"_{c}").alias(c) for c in MEASURES}
    return staged.select(
        F.col("production_id").cast("bigint").alias("production_id"),
        F.col("_date").alias("date"),
        time_text("_clock").alias("time"),
        "turbine_name", "capacity", "location_name",
        measure["latitude"], measure["longitude"],
        "region", "status", "responsible_department",
        measure["wind_speed"], "wind_direction", measure["energy_produced"],
        event_time("_date", "_clock").alias("measured_at"),
        DAY_COLUMN, MODIFIED_COLUMN, "source_file",
        F.col(CORRUPT), reason.alias("_reason"))


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows).  The quarantine keeps the raw line
    and the reason; nothing is dropped silently."""
    good = parsed.filter(F.col("_reason").isNull()).drop("_reason", CORRUPT)
    bad = parsed.filter(F.col("_reason").isNotNull())
    return good, bad


def to_bronze(good: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Good rows in table order with lineage columns (O-22, O-27):
    ``source_file``, the file's day and modification time (captured from the
    scan; they order the corrections of a reading), ``ingested_at``,
    ``batch_id``."""
    df = good.select(*BRONZE_COLUMNS, "source_file", *FILE_ORDER)
    return df.withColumns({"ingested_at": F.current_timestamp(),
                           "batch_id": F.lit(batch_id or new_batch_id())})
