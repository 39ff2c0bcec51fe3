"""Declared table contracts (O-54) and casting to them.

One StructType per table of the three layers.  Time of day is text
``HH:mm:ss`` (see functions.calendar); every id is a bigint.  VARCHAR
limits are kept next to the schema so the length check (O-73) can use
them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)


def _schema(*fields: tuple[str, DataType, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


S, I, L, D = StringType(), IntegerType(), LongType(), DateType()
TS, TSN = TimestampType(), TimestampNTZType()
DBL, FLT = DoubleType(), FloatType()


def dec(p: int, s: int) -> DecimalType:
    return DecimalType(p, s)


TIME_ATTRS = (("day", I, True), ("month", I, True), ("quarter", I, True), ("year", I, True),
              ("hour_of_day", I, True), ("minute_of_hour", I, True),
              ("second_of_minute", I, True), ("time_period", S, True))

# Raw daily production file: all columns nullable, read as declared.
RAW_PRODUCTION_CSV = _schema(
    ("production_id", I, True), ("date", S, True), ("time", S, True),
    ("turbine_name", S, True), ("capacity", I, True), ("location_name", S, True),
    ("latitude", DBL, True), ("longitude", DBL, True),
    ("region", S, True), ("status", S, True), ("responsible_department", S, True),
    ("wind_speed", FLT, True), ("wind_direction", S, True), ("energy_produced", FLT, True),
)

BRONZE_PRODUCTION = _schema(
    ("production_id", L, True), ("date", D, True), ("time", S, True),
    ("turbine_name", S, True), ("capacity", I, True), ("location_name", S, True),
    ("latitude", dec(9, 6), True), ("longitude", dec(9, 6), True), ("region", S, True),
    ("status", S, True), ("responsible_department", S, True), ("wind_speed", dec(6, 2), True),
    ("wind_direction", S, True), ("energy_produced", dec(12, 2), True),
    ("measured_at", TSN, True), ("ingested_at", TS, True), ("source_file", S, True),
    ("batch_id", S, True),
)

BRONZE_WEATHER = _schema(
    ("date", D, False), ("time", S, False), ("latitude", dec(9, 6), False),
    ("longitude", dec(9, 6), False), ("region", S, False), ("region_name", S, False),
    ("wind_gusts_10m", dec(6, 2), True), ("temperature_2m", dec(5, 2), True),
    ("cloud_cover", dec(5, 2), True), ("ingested_at", TS, True), ("source_api", S, True),
)

SILVER_PRODUCTION = _schema(
    ("production_id", L, False), ("date", D, True), ("time", S, True),
    ("turbine_name", S, True), ("capacity", I, True), ("location_name", S, True),
    ("latitude", dec(9, 6), True), ("longitude", dec(9, 6), True), ("region", S, True),
    ("status", S, True), ("responsible_department", S, True), ("wind_speed", dec(6, 2), True),
    ("wind_direction", S, True), ("energy_produced", dec(12, 2), True), *TIME_ATTRS,
)

SILVER_WEATHER = _schema(
    ("weather_id", L, False), ("date", D, False), ("time", S, False),
    ("latitude", dec(9, 6), False), ("longitude", dec(9, 6), False), ("region", S, False),
    ("region_name", S, False), ("wind_gusts_10m", dec(6, 2), True),
    ("temperature_2m", dec(5, 2), True), ("cloud_cover", dec(5, 2), True), *TIME_ATTRS,
)

SILVER_ENRICHED = _schema(
    ("prod_enriched_id", L, False), ("production_id", L, True), ("weather_id", L, True),
    ("date", D, True), ("time", S, True), ("latitude", dec(9, 6), True),
    ("longitude", dec(9, 6), True), ("region", S, True), ("region_name", S, True),
    ("turbine_name", S, True), ("capacity", I, True), ("status", S, True),
    ("responsible_department", S, True), ("energy_produced", dec(12, 2), True),
    ("wind_speed", dec(6, 2), True), ("wind_gust_10m", dec(6, 2), True),
    ("wind_direction", S, True), ("temperature_2m", dec(5, 2), True),
    ("cloud_cover", dec(5, 2), True), *TIME_ATTRS,
)

DATE_DIM = _schema(("date_id", D, False), ("day", I, False), ("month", I, False),
                   ("quarter", I, False), ("year", I, False))
TIME_DIM = _schema(("time_id", S, False), ("hour_of_day", I, False), ("minute_of_hour", I, False),
                   ("second_of_minute", I, False), ("time_period", S, False))
TURBINE_DIM = _schema(("turbine_id", L, False), ("turbine_name", S, False), ("capacity", I, True),
                      ("latitude", dec(9, 6), True), ("longitude", dec(9, 6), True),
                      ("region", S, True), ("region_name", S, True))
STATUS_DIM = _schema(("status_id", L, False), ("status", S, False),
                     ("responsible_department", S, True))
LOCATION_DIM = _schema(("location_id", L, False), ("latitude", dec(9, 6), True),
                       ("longitude", dec(9, 6), True), ("region", S, True),
                       ("region_name", S, True))
FACT_ENERGY = _schema(("fact_production_id", L, False), ("date_id", D, False),
                      ("time_id", S, False), ("turbine_id", L, False), ("status_id", L, False),
                      ("energy_produced", dec(12, 2), True), ("wind_speed", dec(6, 2), True),
                      ("wind_direction", S, True))
FACT_WEATHER = _schema(("fact_weather_id", L, False), ("date_id", D, False),
                       ("time_id", S, False), ("location_id", L, False),
                       ("temperature_2m", dec(5, 2), True), ("cloud_cover", dec(5, 2), True),
                       ("wind_gust_10m", dec(6, 2), True), ("wind_speed", dec(6, 2), True))

# VARCHAR limits of the declared tables.
VARCHAR_LIMITS = {
    "bronze_production": {"turbine_name": 100, "location_name": 100, "region": 100, "status": 50,
                          "responsible_department": 100, "wind_direction": 10, "source_file": 255,
                          "batch_id": 100},
    "bronze_weather": {"region": 100, "region_name": 255, "source_api": 100},
    "silver_production": {"turbine_name": 100, "location_name": 100, "region": 100,
                          "status": 50, "responsible_department": 100,
                          "wind_direction": 50, "time_period": 20},
    "silver_weather": {"region": 100, "region_name": 255, "time_period": 20},
    "silver_enriched": {"region": 100, "region_name": 255, "turbine_name": 100, "status": 50,
                        "responsible_department": 100, "wind_direction": 50, "time_period": 20},
    "turbine_dim": {"turbine_name": 100, "region": 50, "region_name": 200},
    "status_dim": {"status": 100, "responsible_department": 100},
    "location_dim": {"region": 50, "region_name": 200},
    "time_dim": {"time_period": 20},
    "fact_energy": {"wind_direction": 10},
}

PRIMARY_KEYS = {
    "bronze_weather": ("region", "date", "time"),
    "silver_production": ("production_id",),
    "silver_weather": ("date", "time", "region", "region_name"),
    "silver_enriched": ("production_id", "date", "time"),
    "date_dim": ("date_id",), "time_dim": ("time_id",), "turbine_dim": ("turbine_id",),
    "status_dim": ("status_id",), "location_dim": ("location_id",),
    "fact_energy": ("fact_production_id",), "fact_weather": ("fact_weather_id",),
}

CONTRACTS = {
    "bronze_production": BRONZE_PRODUCTION, "bronze_weather": BRONZE_WEATHER,
    "silver_production": SILVER_PRODUCTION, "silver_weather": SILVER_WEATHER,
    "silver_enriched": SILVER_ENRICHED, "date_dim": DATE_DIM, "time_dim": TIME_DIM,
    "turbine_dim": TURBINE_DIM, "status_dim": STATUS_DIM, "location_dim": LOCATION_DIM,
    "fact_energy": FACT_ENERGY, "fact_weather": FACT_WEATHER,
}


def cast_to_contract(df: DataFrame, schema: StructType, strict: bool = False,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Select the contract's columns in order, cast to its types, and the
    columns named by ``keep`` as they are.

    ``try_cast`` is used so that a value outside a DECIMAL's precision
    becomes NULL instead of failing the job; the loads run
    ``operators.load.contract_violations`` on the rows *before* the cast,
    which reports every such value.  ``strict`` uses plain casts."""
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        src = F.col(f.name) if f.name in present else F.lit(None)
        cast = src.cast(f.dataType) if strict else src.try_cast(f.dataType)
        cols.append(cast.alias(f.name))
    return df.select(*cols, *keep)
