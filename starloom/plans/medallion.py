"""The whole day load, bronze -> silver -> gold, on files derived from the
driver tables.

1. bronze production: daily CSV files, typed, malformed rows quarantined;
   each file day is a partition replaced on reload (full refresh, O-11).
2. bronze weather: recorded payloads -> hourly rows -> 10-minute grid by
   interpolation; one partition per date, replaced on reload.
3. silver production / weather: cleaned, keyed upserts (O-12, O-13), the
   weather keeping its generated id.
4. silver enriched: production LEFT JOIN weather of the touched dates,
   unique on (production_id, date, time) (O-14, trap 15).
5. gold: dimensions, foreign-key gate, facts (O-16, O-17).
6. the reports' mergeable states per date (O-75, O-76).

A reading that a correction moves to another slot or date leaves its old
one in every layer: steps 4 and 5 compute the touched dates anew, and a
touched date is one that any changed row is in or was in.

Every step writes new folders and the next step reads them back, so a lost
executor costs at most the current step.  All layers become visible with
one new version at the end; a load that fails before leaves none of them
changed.  Only the file days and dates of this load are read and written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.calendar import with_time_attributes
from starloom.functions.keys import stable_key
from starloom.functions.lineage import new_batch_id
from starloom.operators import star
from starloom.operators.cleanse import silver_production
from starloom.operators.contracts import BRONZE_WEATHER, SILVER_WEATHER, cast_to_contract
from starloom.operators.enrich import JOIN_KEYS, enrich
from starloom.operators.load import (LoadResult, at_once, require_unique, stage_days, stage_replacement,
                                     stage_star, stage_upsert)
from starloom.operators.registry import assign_ids
from starloom.operators.report_state import IMPACT_KEYS, TOTAL_KEYS, daily_total_state, impact_state
from starloom.operators.rules import contract_rules, length_rules, narrowest, split_rows
from starloom.operators.timeseries import interpolate, with_wall_clock, zoned_spine
from starloom.operators.versions import Tables
from starloom.session import cut_lineage
from starloom.sources.csv import (DAY_COLUMN, FILE_ORDER, parse_production, read_all,
                                  split_quarantine, to_bronze)
from starloom.sources.payload import VARIABLES, payload_rows, read_payloads

# Natural key of a weather slot.
SLOT = ["date", "time", "region", "region_name"]
# Fixed value: label of the weather source in bronze.
SOURCE_LABEL = "weather-archive"


def bronze_weather(payloads: DataFrame) -> DataFrame:
    """Weather grid rows, not yet cast to the bronze contract.

    Samples meet the grid on the UTC axis, so values are linear in time also
    on a day on which the zone changes its offset.  Such a day has fewer slots,
    or a wall-clock time twice: its first one is kept, as slots are named by
    their wall clock."""
    hourly = payload_rows(payloads)
    keys = ["region", "region_name", "latitude", "longitude", "timezone", "date"]
    grid = zoned_spine(hourly.select(*keys).distinct(), "timezone")
    w = interpolate(hourly, grid, keys, "ts_utc", VARIABLES, scale=2)
    w = with_wall_clock(w, "timezone").where(~F.col("again"))
    return w.drop("ts_utc", "timezone", "again").withColumns(
        {"ingested_at": F.current_timestamp(), "source_api": F.lit(SOURCE_LABEL)})


def silver_weather(bronze: DataFrame) -> DataFrame:
    ts = F.to_timestamp_ntz(F.concat_ws(" ", F.col("date").cast("string"), F.col("time")))
    w = with_time_attributes(bronze.withColumn("_ts", ts), "_ts").drop("_ts")
    w = w.withColumn("weather_id", stable_key("date", "time", "region", "region_name"))
    return cast_to_contract(w, SILVER_WEATHER)


def run_day_load(spark: SparkSession, csv_root: str, payload_root: str, root: str,
                 batch_id: str | None = None,
                 date_range: tuple[str, str] | None = None) -> list[LoadResult]:
    """Load every file day below ``csv_root`` (and the payloads of the same
    days), or only the days of ``date_range`` (inclusive ISO dates, O-29):
    files of other days are never read.  Files read twice by different loads
    give the same tables as when they are read once, in any order."""
    batch_id = batch_id or new_batch_id()
    tables = Tables(spark, root)
    out: list[LoadResult] = []

    # 1. bronze production + quarantine
    days = tuple(d.replace("-", "") for d in date_range) if date_range else None
    raw = read_all(spark, csv_root, days=days)
    payloads = read_payloads(spark, payload_root)
    if date_range:
        payloads = payloads.filter(F.col("date").between(*date_range))
    parsed = cut_lineage(parse_production(raw), "parsed")
    good, bad = split_quarantine(parsed)
    days = [r[0] for r in parsed.select(DAY_COLUMN).distinct().collect()]  # one per file day
    grid, *_ = at_once(
        lambda: cut_lineage(bronze_weather(payloads), "weather-grid"),
        lambda: stage_days(tables, "quarantine", bad, DAY_COLUMN, days, clustered=True),
        lambda: stage_days(tables, "bronze_production", to_bronze(good, batch_id), DAY_COLUMN, days, clustered=True))
    bronze = tables.read("bronze_production", days) if tables.exists("bronze_production") else to_bronze(good, batch_id)

    # 2. bronze weather
    weather_days = [r[0] for r in grid.select("date").distinct().collect()]  # one per day
    limits = narrowest(("silver_weather", "turbine_dim", "location_dim"))
    grid, unfit = split_rows(grid, contract_rules("bronze_weather", grid)
                             | length_rules({c: n for c, n in limits.items() if c in grid.columns}))
    stage_days(tables, "quarantine_weather", unfit, "date", weather_days)
    stage_days(tables, "bronze_weather", cast_to_contract(grid, BRONZE_WEATHER), "date", weather_days)

    # 3. silver
    def stage_production() -> LoadResult:
        return stage_upsert(tables, "silver_production", silver_production(bronze, keep=FILE_ORDER),
                            ["production_id"], FILE_ORDER, partition_col="date", newer_only=True,
                            contract="silver_production")

    slots = silver_weather(cast_to_contract(grid, BRONZE_WEATHER))

    def stage_weather() -> LoadResult:
        known = tables.read("silver_weather").select(*SLOT, "weather_id") if tables.exists("silver_weather") else None
        ids = assign_ids(slots, SLOT, "weather_id", known)
        return stage_upsert(tables, "silver_weather", slots.drop("weather_id").join(ids, SLOT), SLOT,
                            partition_col="date", keep_from_target=["weather_id"], contract="silver_weather")

    production, weather = at_once(stage_production, stage_weather)
    out += [production, weather]
    if not tables.exists("silver_production"):
        tables.publish()
        return out

    # 4. enriched: every date whose readings or weather changed, also those a
    # reading was moved away from, is computed anew from the whole silver
    # content of that date.  A weather slot that would double a reading stops
    # the load (trap 13).
    dates = sorted((set(production.touched) | set(weather.touched))
                   & (tables.partitions("silver_production") | tables.partitions("silver_enriched")))
    readings = tables.read("silver_production", dates)
    if tables.exists("silver_weather"):
        slots = tables.read("silver_weather", dates)
        require_unique({"silver_weather": (slots, JOIN_KEYS)})
    else:
        slots = spark.createDataFrame([], SILVER_WEATHER)
    out.append(stage_replacement(tables, "silver_enriched", enrich(readings, slots),
                                 ["production_id", "date", "time"], "date", dates, contract="silver_enriched"))

    # 5. gold: the facts of those dates are their whole new content
    e = tables.read("silver_enriched", dates)
    things = cut_lineage(star.distinct_things(e), "things")
    # and 6. the reports' states of those dates
    loaded, bare, *_ = at_once(
        lambda: stage_star(tables, star.build_dimensions(e, things=things), star.build_facts(e, for_load=True), dates),
        lambda: e.where("weather_id is null").count(),
        lambda: stage_replacement(tables, "report_totals", daily_total_state(e), TOTAL_KEYS, "date", dates),
        lambda: stage_replacement(tables, "report_impact", impact_state(e), IMPACT_KEYS, "date", dates))
    out += loaded
    # Readings without weather are in the energy fact only.
    next(r for r in out if r.table == "fact_weather").dropped = bare
    tables.publish()
    return out
