"""Enrichment of production readings with the weather grid (O-23..O-25,
O-32).

The join is a left equi join on (date, time, region).  The weather side
grows with regions x days x 144 slots, not with the readings, so AQE
normally turns it into a broadcast hash join at runtime; when it does not
fit the threshold the sort-merge fallback splits skewed reading partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom.functions.keys import stable_key
from starloom.operators.contracts import SILVER_ENRICHED, SILVER_PRODUCTION, SILVER_WEATHER

JOIN_KEYS = ("date", "time", "region")

RENAMED = {"wind_gusts_10m": "wind_gust_10m"}
ENRICHED_ORDER = tuple(SILVER_ENRICHED.names)
# What the enriched table takes from either side.
READING_COLS = tuple(c for c in SILVER_PRODUCTION.names if c in ENRICHED_ORDER)
WEATHER_COLS = tuple(c for c in SILVER_WEATHER.names if c in JOIN_KEYS
                     or RENAMED.get(c, c) in ENRICHED_ORDER and c not in READING_COLS)


def enrich(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Readings LEFT JOIN weather on (date, time, region).

    Both sides are pruned first (O-24); the result takes the turbine's
    coordinates and the weather's region_name, renames the gust column
    (O-25) and gets a stable surrogate ``prod_enriched_id`` (O-21)."""
    r = readings.select(*READING_COLS)
    w = weather.select(*WEATHER_COLS).withColumnsRenamed(RENAMED)
    j = r.join(w, list(JOIN_KEYS), "left")
    return j.select(stable_key("production_id", "date", "time").alias("prod_enriched_id"),
                    *[c for c in ENRICHED_ORDER if c != "prod_enriched_id"])
