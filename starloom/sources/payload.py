"""Recorded hourly weather payloads -> long rows (O-05..O-08, O-50, O-53,
O-62).

A payload holds, for one region and day, an epoch start / end / interval
and one array per variable.  Rows come from ``inline(arrays_zip(...))``
over the time axis; a variable missing from the payload becomes an
all-NULL column of the axis length, NaN becomes NULL, and failed or empty
payloads are dropped (and can be reported with ``lost_regions``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from starloom.functions.calendar import to_local
from starloom.functions.measures import nan_to_null
from starloom.operators.timeseries import hourly_axis

VARIABLES = ("wind_gusts_10m", "temperature_2m", "cloud_cover")
OK_STATUS = "ok"

HOURLY_SCHEMA = StructType([
    StructField("time", LongType()), StructField("time_end", LongType()),
    StructField("interval", IntegerType()),
    *[StructField(v, ArrayType(DoubleType())) for v in VARIABLES],
])
PAYLOAD_SCHEMA = StructType([
    StructField("region", StringType(), False), StructField("region_name", StringType()),
    StructField("timezone", StringType()), StructField("date", StringType()),
    StructField("status", StringType()), StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()), StructField("hourly", HOURLY_SCHEMA),
])


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the declared payload schema (O-08)."""
    return spark.read.schema(PAYLOAD_SCHEMA).json(path)


def usable(payloads: DataFrame) -> DataFrame:
    """Payloads that succeeded and carry a non-empty time axis (O-06)."""
    h = F.col("hourly")
    n = F.size(hourly_axis(h["time"], h["time_end"], h["interval"]))
    return payloads.filter((F.col("status") == OK_STATUS) & h.isNotNull() & (n > 0))


def payload_rows(payloads: DataFrame, variables: Sequence[str] = VARIABLES) -> DataFrame:
    """One row per region and sample hour: UTC time, local time, values."""
    h = F.col("hourly")
    axis = hourly_axis(h["time"], h["time_end"], h["interval"])
    p = usable(payloads).withColumn("_axis", axis)
    n = F.size("_axis")
    arrays = [F.coalesce(h[v], F.array_repeat(F.lit(None).cast("double"), n)).alias(v)
              for v in variables]
    zipped = F.arrays_zip(F.col("_axis").alias("ts_utc"), *arrays)
    rows = p.select("region", "region_name", "timezone", "latitude", "longitude",
                    F.inline(zipped))
    rows = rows.withColumn("ts", to_local("ts_utc", "timezone"))
    return rows.select(
        "region", "region_name", "timezone", "latitude", "longitude", "ts_utc", "ts",
        F.to_date("ts").alias("date"),
        *[nan_to_null(v).alias(v) for v in variables])


def lost_regions(expected: DataFrame, payloads: DataFrame,
                 keys: Sequence[str] = ("region", "date")) -> DataFrame:
    """Expected region-days without a usable payload (left anti join)."""
    got = usable(payloads).select(*keys).distinct()
    return expected.select(*keys).distinct().join(got, list(keys), "left_anti")
