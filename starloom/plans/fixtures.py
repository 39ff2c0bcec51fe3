"""File fixtures derived from the driver tables, written by the queries
themselves below the shared folder (``spark.checkpoint.dir``).

* daily production CSV files in the raw 14-column layout, one folder per
  day, optionally with rows broken by data-driven rules;
* recorded hourly weather payloads (JSON), one per region-day, as the
  archive API would return them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans import standins as st
from starloom.session import scratch_path
from starloom.sources.csv import DAY_COLUMN

# Rules that break rows in the "broken" fixture.
#  - readings of region 'error' get a non-numeric production id ('E' + id)
#  - readings with k = 0 get the impossible time '24-00-00'
#  - readings with k = 99 get the short time form 'H-m-s' (valid)
BROKEN_ID_REGION = "error"
BAD_TIME_K = 0
SHORT_TIME_K = 99


def production_csv_rows(spark: SparkSession, sf_dir: str, broken: bool) -> DataFrame:
    r = st.readings(spark, sf_dir)
    r = r.withColumn("_k", (F.col("wind_speed") * 10).cast("int"))  # wind speed is k / 10
    # Readings sit on the 10-minute grid, as the daily files do.
    slot = F.to_timestamp_ntz(F.concat_ws(" ", F.col("date").cast("string"), F.col("time")))
    pid = F.col("production_id").cast("string")
    tm = F.date_format(slot, "HH-mm-ss")
    if broken:
        pid = F.when(F.col("region") == BROKEN_ID_REGION, F.concat(F.lit("E"), pid)).otherwise(pid)
        tm = (F.when(F.col("_k") == BAD_TIME_K, F.lit("24-00-00"))
               .when(F.col("_k") == SHORT_TIME_K, F.date_format(slot, "H-m-s"))
               .otherwise(tm))
    return r.select(
        pid.alias("production_id"),
        F.date_format("date", "yyyy-MM-dd").alias("date"), tm.alias("time"),
        "turbine_name", "capacity", "location_name", "latitude", "longitude", "region",
        "status", "responsible_department", "wind_speed", "wind_direction", "energy_produced",
        F.date_format("date", "yyyyMMdd").alias(DAY_COLUMN))


# Corrections by k.  Readings with k = 7 are corrected after the
# first load (an hour earlier, 50 more energy), those with k = 8 arrive late.
MOVED_K, LATE_K = 7, 8
MOVED_ENERGY = 50


def write_corrected_csv(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Daily files of two loads: all readings but the late ones, then the late and
    the corrected ones.  A correction stands in the file of its old day."""
    rows = production_csv_rows(spark, sf_dir, broken=False)
    k = F.round(F.col("wind_speed") * 10).cast("int")
    at = F.to_timestamp_ntz(F.concat_ws(" ", "date", "time"), F.lit("yyyy-MM-dd HH-mm-ss")) - F.expr("INTERVAL 1 HOUR")
    moved = rows.where(k == MOVED_K).withColumns({
        "date": F.date_format(at, "yyyy-MM-dd"), "time": F.date_format(at, "HH-mm-ss"),
        "energy_produced": (F.col("energy_produced") + MOVED_ENERGY).cast("decimal(12,2)")})
    out = []
    for part in (rows.where(k != LATE_K), rows.where(k == LATE_K).unionByName(moved)):
        out.append(scratch_path(spark, "corrected-csv"))
        (part.hint("rebalance", F.col(DAY_COLUMN)).write.partitionBy(DAY_COLUMN)
         .option("header", True).mode("errorifexists").csv(out[-1]))
    return out[0], out[1]


# Layouts of the daily files by day of month modulo 4.  1: the
# columns in reverse order, 2: without ``capacity``, 3: with a column ``note``.
REVERSED, NO_CAPACITY, WITH_NOTE = 1, 2, 3


def write_layouts_csv(spark: SparkSession, sf_dir: str) -> str:
    """Daily files whose columns differ in order and number, each with its header."""
    out = scratch_path(spark, "layouts-csv")
    rows = production_csv_rows(spark, sf_dir, broken=False)
    columns = [c for c in rows.columns if c != DAY_COLUMN]
    kinds = {0: columns, REVERSED: columns[::-1], NO_CAPACITY: [c for c in columns if c != "capacity"],
             WITH_NOTE: [*columns, "note"]}
    rows = rows.withColumn("note", F.lit("n"))
    for kind, names in kinds.items():
        (rows.where(F.dayofmonth(F.to_date(DAY_COLUMN, "yyyyMMdd")) % 4 == kind).select(*names, DAY_COLUMN)
         .hint("rebalance", F.col(DAY_COLUMN)).write.partitionBy(DAY_COLUMN).option("header", True).mode("append").csv(out))
    return out


def write_production_csv(spark: SparkSession, sf_dir: str, broken: bool = False,
                         flat: bool = False) -> str:
    """One folder per day, or (``flat``) files named by their day in one
    folder, renamed into it one by one."""
    out = scratch_path(spark, "production-csv")
    (production_csv_rows(spark, sf_dir, broken).hint("rebalance", F.col(DAY_COLUMN))
     .write.partitionBy(DAY_COLUMN).option("header", True).mode("errorifexists").csv(out))
    if not flat:
        return out
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    into = scratch_path(spark, "production-flat")
    fs.mkdirs(path(into))
    for folder in fs.globStatus(path(f"{out}/{DAY_COLUMN}=*")):
        day = folder.getPath().getName().split("=")[1]
        for i, f in enumerate(fs.globStatus(path(f"{out}/{DAY_COLUMN}={day}/*.csv"))):
            name = f"{day}_wind_power_data.csv" if i == 0 else f"{day}_wind_power_data_{i}.csv"
            fs.rename(f.getPath(), path(f"{into}/{name}"))
    return into


# Payload rules.  Region 'error' payloads carry no cloud
# cover series; region 'signup' payloads of day-of-month 13 failed.
NO_CLOUD_REGION = "error"
FAILED_REGION, FAILED_DAY_OF_MONTH = "signup", 13


def payload_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recorded payload per region-day with samples.  Each group holds
    at most 24 hourly samples, so collecting them is bounded."""
    hw = st.hourly_weather(spark, sf_dir).withColumn("_h", F.hour("ts"))
    vals = F.struct(*[F.col(v).cast("double").alias(v) for v in st.WEATHER_VARS])
    g = hw.groupBy("region", "region_name", "date").agg(
        F.map_from_entries(F.collect_list(F.struct("_h", vals))).alias("_m"))
    hours = F.sequence(F.lit(0), F.lit(23))
    def hour_values(v: str):
        return F.transform(hours, lambda h: F.try_element_at(F.col("_m"), h).getField(v))

    series = {v: hour_values(v) for v in st.WEATHER_VARS}
    failed = (F.col("region") == FAILED_REGION) & (F.dayofmonth("date") == FAILED_DAY_OF_MONTH)
    start = F.unix_timestamp(F.col("date").cast("timestamp"))
    hourly = F.struct(
        start.alias("time"), (start + 86400).alias("time_end"), F.lit(3600).alias("interval"),
        series["wind_gusts_10m"].alias("wind_gusts_10m"),
        series["temperature_2m"].alias("temperature_2m"),
        F.when(F.col("region") != NO_CLOUD_REGION, series["cloud_cover"]).alias("cloud_cover"))
    return g.select(
        "region", "region_name", F.lit("UTC").alias("timezone"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.when(failed, "failed").otherwise("ok").alias("status"),
        F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"),
        F.when(~failed, hourly).alias("hourly"))


def write_payloads(spark: SparkSession, sf_dir: str) -> str:
    out = scratch_path(spark, "payloads")
    payload_frame(spark, sf_dir).write.mode("errorifexists").json(out)
    return out
