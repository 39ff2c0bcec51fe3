"""Stand-in inputs: the reference's roles played by the driver's tables.

=====================  ==============================================
reference role         driver stand-in
=====================  ==============================================
production reading     one ``events`` row (production_id = event_id)
date, time slot        ``events.ts`` floored to 10 minutes
region                 ``events.event_type``
region_name            upper-case event type
turbine                user (``'U' || user_id``) within a region
capacity, coordinates  the user's ``customer`` row (nation key, balance)
location name          the customer's nation name
status / department    customer market segment / customer's region name
energy_produced        ``events.value``
wind_speed             ``k`` of ``events.props`` / 10
wind_direction         compass point ``k mod 8``
hourly weather         hourly aggregates of ``events`` per event type
=====================  ==============================================

Every function reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.calendar import floor_to_minutes, time_text, with_time_attributes
from starloom.functions.keys import stable_key
from starloom.functions.measures import half_away_sql, units_to_decimal_sql
from starloom.operators.enrich import enrich
from starloom.operators.timeseries import interpolate_day_grid
from starloom.sources.tables import read_table

# Compass points indexed by k mod 8.
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
WEATHER_VARS = ("wind_gusts_10m", "temperature_2m", "cloud_cover")
WEATHER_PRECISION = {"wind_gusts_10m": (6, 2), "temperature_2m": (5, 2), "cloud_cover": (5, 2)}
CLOUDY_VALUE = 25.0


def turbine_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> nation -> region; the planner broadcasts a side whose
    size is under the threshold."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nr = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return c.join(nr, c.c_nationkey == nr.n_nationkey, "left").selectExpr(
        "c_custkey AS user_id",
        "CAST(1000 + 100 * c_nationkey AS INT) AS capacity",
        "n_name AS location_name",
        "CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 0.01BD AS DECIMAL(9,6)) AS latitude",
        "CAST(-c_nationkey AS DECIMAL(9,6)) AS longitude",
        "c_mktsegment AS status",
        "r_name AS responsible_department",
    )


_K = "CAST(get_json_object(props, '$.k') AS INT)"


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned production rows (silver contract + ``measured_at``)."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", F.expr(_K).alias("_k"))
    reg = turbine_register(spark, sf_dir)
    j = ev.join(reg, "user_id", "left")
    compass = ", ".join(f"'{c}'" for c in COMPASS)
    df = j.selectExpr(
        "event_id AS production_id",
        "ts AS measured_at",
        "make_timestamp_ntz(year(ts), month(ts), dayofmonth(ts), hour(ts), "
        "minute(ts) - minute(ts) % 10, 0) AS _slot",
        "concat('U', CAST(user_id AS STRING)) AS turbine_name",
        "capacity", "location_name", "latitude", "longitude",
        "event_type AS region", "status", "responsible_department",
        "CAST(CAST(_k AS DECIMAL(6,2)) * 0.1BD AS DECIMAL(6,2)) AS wind_speed",
        f"element_at(array({compass}), pmod(_k, 8) + 1) AS wind_direction",
        "CAST(value AS DECIMAL(12,2)) AS energy_produced",
    )
    return with_time_attributes(df, "_slot").drop("_slot")


def hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly samples per region (event type): mean value, mean k and the
    share of values at or above 25, each held at 2 decimals exactly
    (integer sums, division rounded half away from zero).

    A partial aggregate: the output has one row per region-hour."""
    ev = read_table(spark, sf_dir, "events").select("ts", "event_type", "value", "props")
    hour = floor_to_minutes("ts", 60)
    agg = ev.groupBy(F.col("event_type").alias("region"), hour.alias("ts")).agg(
        F.expr("sum(CAST(round(value * 100) AS BIGINT))").alias("_v"),
        F.expr(f"sum(CAST({_K} AS BIGINT))").alias("_k"),
        F.expr(f"CAST(sum(CASE WHEN value >= {CLOUDY_VALUE} THEN 1 ELSE 0 END) AS BIGINT)")
        .alias("_c"),
        F.count(F.lit(1)).alias("_n"),
    )
    return agg.selectExpr(
        "region", "upper(region) AS region_name", "ts", "to_date(ts) AS date",
        f"{units_to_decimal_sql(half_away_sql('_v', '_n'), 6, 2)} AS wind_gusts_10m",
        f"{units_to_decimal_sql(half_away_sql('_k * 100', '_n'), 5, 2)} AS temperature_2m",
        f"{units_to_decimal_sql(half_away_sql('_c * 10000', '_n'), 5, 2)} AS cloud_cover",
    )


def weather_10min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly samples interpolated onto the 10-minute grid of every
    region-day that has samples (bronze weather rows)."""
    hourly = hourly_weather(spark, sf_dir)
    keys = ["region", "region_name", "date"]
    w = interpolate_day_grid(hourly, keys, "date", "ts", WEATHER_VARS, 10, scale=2)
    casts = [F.col(v).cast(f"decimal({p},{s})").alias(v) for v, (p, s) in WEATHER_PRECISION.items()]
    return w.select(
        "date", time_text("ts").alias("time"),
        F.lit(0).cast("decimal(9,6)").alias("latitude"),
        F.lit(0).cast("decimal(9,6)").alias("longitude"),
        "region", "region_name", *casts, "ts")


def silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather with calendar/clock attributes and a stable ``weather_id``."""
    w = weather_10min(spark, sf_dir)
    w = with_time_attributes(w, "ts").drop("ts")
    return w.withColumn("weather_id", stable_key("date", "time", "region", "region_name"))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(readings(spark, sf_dir), silver_weather(spark, sf_dir))


# --- upsert batches ---------------------------------------------------------
# The history loaded so far ends before HISTORY_END; the new
# batch restates every order from BATCH_START (revision 1) and, later,
# orders from CORRECTION_START again (revision 2), so the batch overlaps
# the history (updates), extends it (inserts) and repeats keys (avoided).
HISTORY_END = "1999-01-01"
BATCH_START = "1998-07-01"
CORRECTION_START = "2000-01-01"
LOW_PRIORITY = "5-LOW"
# Weather history ends on WEATHER_HISTORY_END; the restated batch starts on
# WEATHER_BATCH_START (both inclusive).
WEATHER_HISTORY_END = "2024-01-20"
WEATHER_BATCH_START = "2024-01-15"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
                    F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority",
                    F.col("o_orderdate").alias("_ts"))


def _before(col: str, day: str) -> F.Column:
    return F.col(col) < F.lit(day).cast("timestamp_ntz")


def orders_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert target: orders placed before HISTORY_END."""
    return _orders(spark, sf_dir).filter(_before("_ts", HISTORY_END)).drop("_ts")


def orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert source with a ``revision`` column: revision 1 closes and
    re-prices every order from BATCH_START, revision 2 escalates the
    priority of orders from CORRECTION_START."""
    o = _orders(spark, sf_dir)
    r1 = o.filter(~_before("_ts", BATCH_START)).select(
        "o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"),
        (F.col("o_totalprice") + F.lit(1)).cast("decimal(12,2)").alias("o_totalprice"),
        "o_orderdate", "o_orderpriority", F.lit(1).alias("revision"))
    r2 = o.filter(~_before("_ts", CORRECTION_START)).select(
        "o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"),
        (F.col("o_totalprice") + F.lit(2)).cast("decimal(12,2)").alias("o_totalprice"),
        "o_orderdate", F.lit("1-URGENT").alias("o_orderpriority"), F.lit(2).alias("revision"))
    return r1.unionByName(r2)


def with_priority_key(df: DataFrame) -> DataFrame:
    """Composite key part that is NULL for low-priority orders."""
    return df.withColumn("priority_key", F.nullif(F.col("o_orderpriority"), F.lit(LOW_PRIORITY)))


# --- region reference data --------------------------------------------------
# Fixed value: stand-in regions report in UTC.
STANDIN_TIMEZONE = "UTC"


def region_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region lookup (O-07): one row per region with its display name and
    time zone."""
    ev = read_table(spark, sf_dir, "events").select("event_type").distinct()
    return ev.select(F.col("event_type").alias("region"),
                     F.upper("event_type").alias("region_name"),
                     F.lit(STANDIN_TIMEZONE).alias("timezone"))
