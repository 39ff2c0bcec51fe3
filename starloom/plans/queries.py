"""Registered queries: one per operator group of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.calendar import calendar_columns, clock_columns, day_part, time_text
from starloom.functions.keys import murmur_key
from starloom.operators import reports, star
from starloom.operators.timeseries import spine, tagged_union
from starloom.plans import standins as st
from starloom.session import configure
from starloom.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# The status counted as "available" by the availability report.
AVAILABLE_STATUS = "BUILDING"


def measures_as_double(df: DataFrame) -> DataFrame:
    """Registered outputs carry DECIMAL measures as DOUBLE (exact decimal
    -> nearest double in both engines), so the cross-engine comparison does
    not depend on how each client library renders decimals.  The operators
    themselves keep the contract's DECIMAL types."""
    from pyspark.sql.types import DecimalType
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        def query(spark: SparkSession, sf: str) -> DataFrame:
            configure(spark)
            return measures_as_double(fn(spark, sf))
        query.__doc__ = fn.__doc__
        query.__name__ = fn.__name__
        REGISTRY[name] = query
        return fn
    return deco


# --- scalar functions -----------------------------------------------------

@register("calendar_attributes")
def calendar_attributes(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", d.alias("date"),
                    *[c.alias(n) for n, c in calendar_columns(d).items()])


@register("clock_attributes")
def clock_attributes(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    return e.select("event_id", time_text("ts").alias("time"),
                    *[c.alias(n) for n, c in clock_columns("ts").items()])


@register("day_part")
def day_part_q(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    return e.select("event_id", F.hour("ts").alias("hour_of_day"),
                    day_part(F.hour("ts")).alias("time_period"))


# --- time series ----------------------------------------------------------

@register("ten_minute_spine")
def ten_minute_spine(spark: SparkSession, sf: str) -> DataFrame:
    days = st.hourly_weather(spark, sf).select("region", "date").distinct()
    g = spine(days, "date", "ts", 10)
    return g.select("region", "date", "ts", time_text("ts").alias("time"))


@register("series_union")
def series_union(spark: SparkSession, sf: str) -> DataFrame:
    hourly = st.hourly_weather(spark, sf)
    grid = spine(hourly.select("region", "date").distinct(), "date", "ts", 10)
    return tagged_union(hourly, grid, "ts", ["region", "date"])


@register("series_union_distinct")
def series_union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    hourly = st.hourly_weather(spark, sf)
    grid = spine(hourly.select("region", "date").distinct(), "date", "ts", 10)
    return tagged_union(hourly, grid, "ts", ["region", "date"], distinct=True)


@register("interpolate_10min")
def interpolate_10min(spark: SparkSession, sf: str) -> DataFrame:
    return st.weather_10min(spark, sf).drop("ts")


@register("enrich_left")
def enrich_left(spark: SparkSession, sf: str) -> DataFrame:
    return st.enriched(spark, sf)


# --- star schema ------------------------------------------------------------

@register("dim_date")
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return star.date_dim(st.enriched(spark, sf))


@register("dim_time")
def dim_time(spark: SparkSession, sf: str) -> DataFrame:
    return star.time_dim(st.enriched(spark, sf))


@register("dim_unit")
def dim_unit(spark: SparkSession, sf: str) -> DataFrame:
    return star.turbine_dim(st.enriched(spark, sf))


@register("dim_status")
def dim_status(spark: SparkSession, sf: str) -> DataFrame:
    return star.status_dim(st.enriched(spark, sf))


@register("dim_location")
def dim_location(spark: SparkSession, sf: str) -> DataFrame:
    return star.location_dim(st.enriched(spark, sf))


@register("key_murmur")
def key_murmur(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", "c_name", "c_mktsegment",
                    murmur_key("c_name", "c_mktsegment").alias("customer_key"))


@register("fact_production")
def fact_production(spark: SparkSession, sf: str) -> DataFrame:
    return star.build_facts(st.enriched(spark, sf))["fact_energy"]


@register("fact_production_lookup")
def fact_production_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The energy fact with all three keys looked up in the dimensions."""
    from starloom.session import cut_lineage
    e = cut_lineage(st.enriched(spark, sf), "enriched")  # read by every dimension
    keyed = star.with_fact_keys(e, dims=star.build_dimensions(e))
    return star.fact_energy(keyed, "location_id")


@register("fact_conditions")
def fact_conditions(spark: SparkSession, sf: str) -> DataFrame:
    return star.build_facts(st.enriched(spark, sf))["fact_weather"]


# --- reports ----------------------------------------------------------------

@register("daily_totals")
def daily_totals(spark: SparkSession, sf: str) -> DataFrame:
    keyed = star.with_fact_keys(st.enriched(spark, sf))
    return reports.daily_totals(star.fact_energy(keyed, *star.TURBINE_KEY))


@register("condition_impact")
def condition_impact(spark: SparkSession, sf: str) -> DataFrame:
    return reports.condition_impact(st.enriched(spark, sf))


@register("availability")
def availability(spark: SparkSession, sf: str) -> DataFrame:
    keyed = star.with_fact_keys(st.enriched(spark, sf))
    return reports.availability(star.fact_energy(keyed, *star.TURBINE_KEY, "status"), AVAILABLE_STATUS)


# --- keyed upserts ----------------------------------------------------------

def _upsert_single(spark: SparkSession, sf: str):
    from starloom.operators.upsert import merge_upsert
    src = st.orders_batch(spark, sf)
    return src, merge_upsert(st.orders_history(spark, sf), src, ["o_orderkey"], ["revision"])


@register("upsert_single")
def upsert_single(spark: SparkSession, sf: str) -> DataFrame:
    return _upsert_single(spark, sf)[1]


@register("upsert_actions")
def upsert_actions(spark: SparkSession, sf: str) -> DataFrame:
    from starloom.operators.upsert import merge_actions
    return merge_actions(_upsert_single(spark, sf)[1], ["o_orderkey"])


@register("upsert_metrics")
def upsert_metrics_q(spark: SparkSession, sf: str) -> DataFrame:
    from starloom.operators.upsert import upsert_metrics
    src, merged = _upsert_single(spark, sf)
    return upsert_metrics(src, merged)


@register("upsert_nullkey")
def upsert_nullkey(spark: SparkSession, sf: str) -> DataFrame:
    from starloom.operators.upsert import merge_upsert
    tgt = st.with_priority_key(st.orders_history(spark, sf))
    src = st.with_priority_key(st.orders_batch(spark, sf))
    return merge_upsert(tgt, src, ["o_orderkey", "priority_key"], ["revision"])


@register("upsert_composite")
def upsert_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Weather upsert on (date, time, region, region_name) keeping the
    target's generated weather_id on update (O-13, O-21)."""
    from starloom.functions.keys import stable_key
    from starloom.operators.upsert import merge_upsert
    w = st.silver_weather(spark, sf)
    tgt = w.filter(F.col("date") <= F.lit(st.WEATHER_HISTORY_END).cast("date"))
    src = (w.filter(F.col("date") >= F.lit(st.WEATHER_BATCH_START).cast("date"))
           .withColumn("wind_gusts_10m", (F.col("wind_gusts_10m") + F.lit(1)).cast("decimal(6,2)"))
           .withColumn("weather_id", stable_key("date", "time", "region", "region_name",
                                                F.lit("batch"))))
    return merge_upsert(tgt, src, ["date", "time", "region", "region_name"],
                        keep_from_target=["weather_id"])


# --- integrity checks -------------------------------------------------------

@register("check_unique")
def check_unique_q(spark: SparkSession, sf: str) -> DataFrame:
    from starloom.operators.checks import check_unique
    li = read_table(spark, sf, "lineitem")
    return check_unique(li, ["l_orderkey", "l_linenumber"])


@register("check_not_null")
def check_not_null_q(spark: SparkSession, sf: str) -> DataFrame:
    from starloom.operators.checks import null_counts
    o = st.with_priority_key(read_table(spark, sf, "orders"))
    return null_counts(o, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                           "o_orderdate", "priority_key"])


@register("check_fk")
def check_fk_q(spark: SparkSession, sf: str) -> DataFrame:
    from starloom.operators.checks import fk_summary
    t = {n: read_table(spark, sf, n) for n in
         ("lineitem", "orders", "customer", "part", "supplier", "nation")}
    return fk_summary({
        "lineitem.l_orderkey": (t["lineitem"], ["l_orderkey"], t["orders"], ["o_orderkey"]),
        "lineitem.l_partkey": (t["lineitem"], ["l_partkey"], t["part"], ["p_partkey"]),
        "lineitem.l_suppkey": (t["lineitem"], ["l_suppkey"], t["supplier"], ["s_suppkey"]),
        "orders.o_custkey": (t["orders"], ["o_custkey"], t["customer"], ["c_custkey"]),
        "customer.c_nationkey": (t["customer"], ["c_nationkey"], t["nation"], ["n_nationkey"]),
    })


@register("check_fk_star")
def check_fk_star(spark: SparkSession, sf: str) -> DataFrame:
    """Foreign keys of both facts against the five dimensions."""
    from starloom.operators.checks import fk_summary
    from starloom.session import cut_lineage
    e = cut_lineage(st.enriched(spark, sf), "enriched")  # read by every key
    dims = star.build_dimensions(e)
    facts = star.build_facts(e)
    fe, fw = facts["fact_energy"], facts["fact_weather"]
    return fk_summary({
        "fact_energy.date_id": (fe, ["date_id"], dims["date_dim"], ["date_id"]),
        "fact_energy.time_id": (fe, ["time_id"], dims["time_dim"], ["time_id"]),
        "fact_energy.turbine_id": (fe, ["turbine_id"], dims["turbine_dim"], ["turbine_id"]),
        "fact_energy.status_id": (fe, ["status_id"], dims["status_dim"], ["status_id"]),
        "fact_weather.date_id": (fw, ["date_id"], dims["date_dim"], ["date_id"]),
        "fact_weather.time_id": (fw, ["time_id"], dims["time_dim"], ["time_id"]),
        "fact_weather.location_id": (fw, ["location_id"], dims["location_dim"],
                                     ["location_id"]),
    })


@register("check_limits")
def check_limits_q(spark: SparkSession, sf: str) -> DataFrame:
    from starloom.operators.checks import limit_violations
    c = read_table(spark, sf, "customer")
    o = read_table(spark, sf, "orders")
    a = limit_violations(c, {"c_name": 18, "c_mktsegment": 9}, {"c_acctbal": (6, 2)})
    b = limit_violations(o, {"o_orderpriority": 10}, {"o_totalprice": (7, 2)})
    return a.unionByName(b)


@register("contract_rows")
def contract_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that break a rule with the names of all rules they break, from
    one projection over one scan."""
    from starloom.operators.rules import BROKEN, column_rules, split_rows
    o = st.with_priority_key(read_table(spark, sf, "orders"))
    rules = column_rules(["priority_key"], {"o_orderpriority": 8, "o_orderstatus": 1}, {"o_totalprice": (7, 2)})
    return split_rows(o, rules)[1].select("o_orderkey", F.array_join(BROKEN, ", ").alias("broken"))


@register("date_gate")
def date_gate_q(spark: SparkSession, sf: str) -> DataFrame:
    from starloom.operators.checks import date_gate
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return date_gate(o, "o_orderdate", "1996-01-01", "1996-12-31")


@register("date_completeness")
def date_completeness(spark: SparkSession, sf: str) -> DataFrame:
    from starloom.operators.checks import missing_dates
    return missing_dates(read_table(spark, sf, "orders"), "o_orderdate")


@register("slot_completeness")
def slot_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """Per region-day: 144 expected reading slots, how many have readings."""
    from starloom.operators.checks import grid_completeness
    r = st.readings(spark, sf)
    days = r.select("region", "date").distinct()
    expected = spine(days, "date", "ts", 10).withColumn("time", time_text("ts"))
    return grid_completeness(r, expected, ["region", "date", "time"], ["region", "date"])


# Zones of the zoned spine; states counted as available by time.
SPINE_ZONES = ("America/New_York", "Europe/Berlin")
RUNNING_STATES = ("click", "purchase", "view")


@register("zoned_spine")
def zoned_spine_q(spark: SparkSession, sf: str) -> DataFrame:
    """Per zone and order date: the points of the local day's 10-minute grid, its
    first and last instant and how many wall-clock times come twice."""
    from starloom.operators.timeseries import zoned_spine
    days = read_table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).distinct() \
        .withColumn("zone", F.explode(F.array(*[F.lit(z) for z in SPINE_ZONES])))
    return zoned_spine(days, "zone").groupBy("zone", "date").agg(
        F.count(F.lit(1)).alias("slots"), F.min("ts_utc").alias("first_utc"), F.max("ts_utc").alias("last_utc"),
        F.countDistinct("time").alias("times"), F.count(F.when(F.col("again"), 1)).alias("repeated"))


@register("slot_gaps")
def slot_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Per region the runs of 10-minute slots without a reading."""
    from starloom.functions.calendar import floor_to_minutes
    from starloom.operators.intervals import gap_intervals
    e = read_table(spark, sf, "events")
    return gap_intervals(e.select(F.col("event_type").alias("region"), floor_to_minutes("ts", 10).alias("slot")),
                         ["region"], "slot", 10)


@register("state_runs")
def state_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Per user the runs of equal event types, from the first event of a run to
    the first of the next."""
    from starloom.operators.intervals import state_intervals
    e = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return state_intervals(e, ["user_id"], "ts", "event_type", ["event_id"])


@register("availability_by_time")
def availability_by_time(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the observed time that each user was in a running state."""
    from starloom.operators.intervals import time_weighted_share
    return time_weighted_share(state_runs(spark, sf), ["user_id"], RUNNING_STATES)


# --- contracts, measures, previews, lineage --------------------------------

@register("contract_cast")
def contract_cast(spark: SparkSession, sf: str) -> DataFrame:
    """orders cast to a declared contract (id bigint, price NUMERIC(8,2),
    date DATE, text columns)."""
    from pyspark.sql.types import DateType, DecimalType, LongType, StringType, StructField, StructType
    from starloom.operators.contracts import cast_to_contract
    contract = StructType([
        StructField("o_orderkey", LongType(), False), StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()), StructField("o_totalprice", DecimalType(8, 2)),
        StructField("o_orderdate", DateType()), StructField("o_orderpriority", StringType()),
        StructField("o_comment", StringType())])
    return cast_to_contract(read_table(spark, sf, "orders"), contract)


@register("contract_types")
def contract_types(spark: SparkSession, sf: str) -> DataFrame:
    """The declared types that measures have after the cast, with their exact
    text, for readings and orders (the other queries show measures as DOUBLE)."""
    from starloom.operators.contracts import SILVER_PRODUCTION, cast_to_contract
    r = cast_to_contract(st.readings(spark, sf), SILVER_PRODUCTION)
    measures = ("energy_produced", "wind_speed", "latitude", "longitude", "capacity", "production_id", "date")
    return r.select(F.col("production_id").alias("id"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.expr(f"typeof({c})").alias("type"), F.col(c).cast("string").alias("text"))
        for c in measures])))


@register("measures_rounded")
def measures_rounded(spark: SparkSession, sf: str) -> DataFrame:
    from starloom.functions.measures import to_decimal
    li = read_table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        to_decimal("l_extendedprice", 12, 2).alias("extendedprice"),
        to_decimal(F.col("l_extendedprice") * (1 - F.col("l_discount")), 12, 2).alias("net_price"),
        to_decimal("l_discount", 5, 2).alias("discount"),
        to_decimal(F.col("l_quantity") / 7, 8, 2).alias("quantity_per_week"))


@register("ordered_preview")
def ordered_preview(spark: SparkSession, sf: str) -> DataFrame:
    """Top 20 orders by date (latest first), ties by key: a top-n report."""
    o = read_table(spark, sf, "orders")
    return (o.select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
             .orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey")).limit(20))


@register("lineage_columns")
def lineage_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Lineage added on entry: source file name, an injected batch id and a
    constant source label (ingested_at is run-dependent and is checked in
    the unit tests instead)."""
    from starloom.functions.lineage import with_lineage
    e = read_table(spark, sf, "events").select("event_id", "event_type")
    return with_lineage(e, batch_id=LINEAGE_BATCH, source_api=SOURCE_LABEL).drop("ingested_at")


# Fixed values for the lineage demonstration.
LINEAGE_BATCH = "batch-0001"
SOURCE_LABEL = "weather-archive"


# --- CSV sources --------------------------------------------------------------

def _bronze_view(df: DataFrame) -> DataFrame:
    from starloom.sources.csv import BRONZE_COLUMNS
    return df.select(*BRONZE_COLUMNS)


@register("csv_typed_scan")
def csv_typed_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Daily CSV files -> typed bronze rows (run-dependent lineage columns
    are left out of the comparison)."""
    from starloom.plans.fixtures import write_production_csv
    from starloom.sources.csv import parse_production, read_all, split_quarantine
    path = write_production_csv(spark, sf)
    good, _ = split_quarantine(parse_production(read_all(spark, path)))
    return _bronze_view(good)


@register("csv_quarantine")
def csv_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rows broken by rule end in quarantine with their reason and the
    production id text of the raw line."""
    from starloom.plans.fixtures import write_production_csv
    from starloom.sources.csv import CORRUPT, parse_production, read_all, split_quarantine
    path = write_production_csv(spark, sf, broken=True)
    _, bad = split_quarantine(parse_production(read_all(spark, path)))
    pid = F.coalesce(F.col("production_id").cast("string"),
                     F.regexp_extract(F.col(CORRUPT), r"^([^,]*)", 1))
    return bad.select(pid.alias("production_id_text"), F.col("_reason").alias("reason"))


@register("csv_good_rows")
def csv_good_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The good side of the broken fixture, incl. short 'H-m-s' times."""
    from starloom.plans.fixtures import write_production_csv
    from starloom.sources.csv import parse_production, read_all, split_quarantine
    path = write_production_csv(spark, sf, broken=True)
    good, _ = split_quarantine(parse_production(read_all(spark, path)))
    return good.select("production_id", "date", "time", "measured_at")


@register("csv_header_layouts")
def csv_header_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Files with reversed, missing and extra columns: values by the names of
    each file's header, files of an unknown layout in quarantine."""
    from starloom.plans.fixtures import write_layouts_csv
    from starloom.sources.csv import CORRUPT, parse_production, read_all
    parsed = parse_production(read_all(spark, write_layouts_csv(spark, sf)))
    pid = F.coalesce(F.col("production_id").cast("string"), F.regexp_extract(CORRUPT, r"^([^,]*)", 1))
    return parsed.select(pid.alias("production_id_text"), F.col("_reason").alias("reason"), "capacity", "latitude",
                         "longitude", "turbine_name", "wind_speed", "energy_produced", "measured_at")


@register("daily_file_select")
def daily_file_select(spark: SparkSession, sf: str) -> DataFrame:
    from starloom.plans.fixtures import write_production_csv
    from starloom.sources.csv import parse_production, read_day, split_quarantine
    path = write_production_csv(spark, sf, flat=True)
    good, _ = split_quarantine(parse_production(read_day(spark, path, DAILY_FILE_DAY)))
    return good.select("production_id", "date", "time", "region", "energy_produced")


@register("all_files_scan")
def all_files_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Every daily file in one scan; rows per file day."""
    from starloom.plans.fixtures import write_production_csv
    from starloom.sources.csv import DAY_COLUMN, read_all
    path = write_production_csv(spark, sf)
    return (read_all(spark, path).groupBy(F.col(DAY_COLUMN).cast("string").alias("file_day"))
            .agg(F.count(F.lit(1)).alias("rows")))


# The day selected by daily_file_select.
DAILY_FILE_DAY = "20240115"


# --- recorded weather payloads --------------------------------------------------

@register("payload_rows")
def payload_rows_q(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly rows of every usable payload: 24 per region-day, NULL where
    the hour had no sample, cloud cover all NULL where the series is
    missing."""
    from starloom.plans.fixtures import write_payloads
    from starloom.sources.payload import payload_rows, read_payloads
    rows = payload_rows(read_payloads(spark, write_payloads(spark, sf)))
    return rows.select("region", "region_name", "date", "ts",
                       *[F.col(v).cast(f"decimal({p},{s})").alias(v)
                         for v, (p, s) in st.WEATHER_PRECISION.items()])


@register("payload_lost_regions")
def payload_lost_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Region-days whose payload failed, found by anti join against the
    expected region-days (region lookup x days with readings)."""
    from starloom.plans.fixtures import write_payloads
    from starloom.sources.payload import lost_regions, read_payloads
    expected = st.readings(spark, sf).select("region", F.col("date").cast("string").alias("date"))
    return lost_regions(expected, read_payloads(spark, write_payloads(spark, sf)))


# --- loading --------------------------------------------------------------------

@register("load_star")
def load_star_q(spark: SparkSession, sf: str) -> DataFrame:
    """Load the star twice into a fresh folder: the first run inserts every
    row, the second (same input) updates them all and inserts none."""
    from starloom.operators.load import load_star, results_frame
    from starloom.session import cut_lineage, scratch_path
    e = cut_lineage(st.enriched(spark, sf))
    dims, facts = star.build_dimensions(e), star.build_facts(e, for_load=True)
    root = scratch_path(spark, "star")
    results = []
    for run in (1, 2):
        results += [(run, r) for r in load_star(spark, root, dims, facts)]
    return results_frame(spark, results)


@register("load_star_rows")
def load_star_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of the published energy fact after two loads of the same
    input."""
    from starloom.operators.load import load_star
    from starloom.operators.versions import read_published
    from starloom.session import cut_lineage, scratch_path
    e = cut_lineage(st.enriched(spark, sf))
    dims, facts = star.build_dimensions(e), star.build_facts(e, for_load=True)
    root = scratch_path(spark, "star")
    for _ in range(2):
        load_star(spark, root, dims, facts)
    return read_published(spark, root, "fact_energy").select(
        "fact_production_id", "date_id", "time_id", "turbine_id", "status_id", "energy_produced",
        "wind_speed", "wind_direction")


# --- streaming ------------------------------------------------------------------

@register("stream_daily_load")
def stream_daily_load(spark: SparkSession, sf: str) -> DataFrame:
    """Daily files land in a folder; a file stream upserts them into the
    silver production table a few files per micro-batch."""
    from starloom.plans.fixtures import write_production_csv
    from starloom.operators.versions import read_published
    from starloom.session import scratch_path
    from starloom.streaming.daily_load import start_daily_load
    landing = write_production_csv(spark, sf, broken=True)
    root = scratch_path(spark, "stream")
    q = start_daily_load(spark, landing, f"{root}/tables", f"{root}/quarantine",
                         f"{root}/_checkpoint", max_files_per_trigger=STREAM_FILES_PER_BATCH)
    q.awaitTermination()
    return read_published(spark, f"{root}/tables", "silver_production").select(
        "production_id", "date", "time", "turbine_name", "region", "energy_produced",
        "wind_speed", "hour_of_day", "time_period")


# Files per micro-batch in the streaming demonstration.
STREAM_FILES_PER_BATCH = 40


# --- the whole day load -----------------------------------------------------------

@register("medallion_load")
def medallion_load(spark: SparkSession, sf: str) -> DataFrame:
    """bronze -> silver -> gold over every day of the files; counters per
    table (processed, inserted, updated, avoided)."""
    from starloom.operators.load import at_once, results_frame
    from starloom.plans.fixtures import write_payloads, write_production_csv
    from starloom.plans.medallion import run_day_load
    from starloom.session import scratch_path
    csv_root, payload_root = at_once(lambda: write_production_csv(spark, sf, broken=True),
                                     lambda: write_payloads(spark, sf))
    res = run_day_load(spark, csv_root, payload_root, scratch_path(spark, "medallion"))
    return results_frame(spark, [(1, r) for r in res])


# What the rows of each table show in ``medallion_incremental``: id, date, time,
# four measures, two keys, a name.
INCREMENTAL_ROWS = {
    "silver_production": ("production_id", "date", "time", "energy_produced", "wind_speed", "latitude", "longitude",
                          None, None, "turbine_name"),
    "silver_enriched": ("production_id", "date", "time", "energy_produced", "temperature_2m", "cloud_cover",
                        "wind_gust_10m", "weather_id", "prod_enriched_id", "region_name"),
    "fact_energy": ("fact_production_id", "date_id", "time_id", "energy_produced", "wind_speed", None, None,
                    "turbine_id", "status_id", "wind_direction"),
    "fact_weather": ("fact_weather_id", "date_id", "time_id", "temperature_2m", "cloud_cover", "wind_gust_10m",
                     "wind_speed", "location_id", None, None),
    "time_dim": (None, None, "time_id", "hour_of_day", "minute_of_hour", "second_of_minute", None, None, None,
                 "time_period"),
}


def _corrected_loads(spark: SparkSession, sf: str):
    """The tables after two loads: the second brings late readings and
    corrections that move readings to other slots and dates."""
    from starloom.operators.versions import Tables
    from starloom.plans.fixtures import write_corrected_csv, write_payloads
    from starloom.plans.medallion import run_day_load
    from starloom.session import scratch_path
    payloads, root = write_payloads(spark, sf), scratch_path(spark, "medallion")
    for csv_root in write_corrected_csv(spark, sf):
        run_day_load(spark, csv_root, payloads, root)
    return Tables(spark, root)


@register("reports_incremental")
def reports_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The weather impact from the per-date states that two loads left."""
    from starloom.operators.report_state import merged_impact
    return merged_impact(_corrected_loads(spark, sf).read("report_impact"))


@register("medallion_incremental")
def medallion_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every layer after two loads with late and corrected readings."""
    tables, out = _corrected_loads(spark, sf), None
    kinds = {"id": "bigint", "date": "date", "time": "string", **{c: "double" for c in "abcd"},
             "key_1": "bigint", "key_2": "bigint", "name": "string"}
    for table, columns in INCREMENTAL_ROWS.items():
        rows = tables.read(table).select(F.lit(table).alias("table_name"), *[
            (F.col(c) if c else F.lit(None)).cast(k).alias(n) for c, (n, k) in zip(columns, kinds.items(), strict=True)])
        out = rows if out is None else out.unionByName(rows)
    return out


@register("region_lookup")
def region_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Weather grid rows with the region's name and time zone from the
    region reference (AQE picks the join by the measured size)."""
    w = st.weather_10min(spark, sf).select("region", "date", "time", "wind_gusts_10m")
    return w.join(st.region_reference(spark, sf), "region", "left")


@register("star_counts")
def star_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Row count of every star table (O-37): the enrichment is written once
    to the shared folder, then one job counts all seven tables from it."""
    from starloom.session import cut_lineage
    e = cut_lineage(st.enriched(spark, sf), "enriched")
    tables = {**star.build_dimensions(e), **star.build_facts(e)}
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = c if out is None else out.unionByName(c)
    return out
