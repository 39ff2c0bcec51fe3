"""DuckDB oracle SQL for the registered queries (same column names)."""

from __future__ import annotations

from starloom.plans.oracle_base import (CTES, TIME_ATTRS_SQL, half_away, stable_key_sql, units_to_dec,
                                         with_ctes)

ORACLE: dict[str, str] = {}

ORACLE["calendar_attributes"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders"""

ORACLE["clock_attributes"] = """
SELECT event_id, strftime(ts, '%H:%M:%S') AS time,
       CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(minute(ts) AS INTEGER) AS minute_of_hour,
       CAST(second(ts) AS INTEGER) AS second_of_minute
FROM events"""

ORACLE["day_part"] = """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day,
       CASE WHEN hour(ts) >= 5 AND hour(ts) < 12 THEN 'Morning'
            WHEN hour(ts) >= 12 AND hour(ts) < 17 THEN 'Afternoon'
            WHEN hour(ts) >= 17 AND hour(ts) < 21 THEN 'Evening'
            ELSE 'Night' END AS time_period
FROM events"""

ORACLE["ten_minute_spine"] = with_ctes(["grid"], """
SELECT region, date, ts, strftime(ts, '%H:%M:%S') AS time FROM grid""")

ORACLE["series_union"] = with_ctes(["grid"], """
SELECT region, date, ts, 'hourly' AS source FROM hourly
UNION ALL
SELECT region, date, ts, 'interpolated' AS source FROM grid""")

ORACLE["series_union_distinct"] = with_ctes(["grid"], """
SELECT region, date, ts FROM hourly
UNION
SELECT region, date, ts FROM grid""")

ORACLE["interpolate_10min"] = with_ctes(["weather_10min"], """
SELECT date, time, latitude, longitude, region, region_name,
       wind_gusts_10m, temperature_2m, cloud_cover
FROM weather_10min""")

ORACLE["enrich_left"] = with_ctes(["enriched"], "SELECT * FROM enriched")

ORACLE["dim_date"] = with_ctes(["enriched"], """
SELECT DISTINCT date AS date_id, day, month, quarter, year FROM enriched""")

ORACLE["dim_time"] = with_ctes(["enriched"], """
SELECT DISTINCT time AS time_id, hour_of_day, minute_of_hour, second_of_minute, time_period
FROM enriched""")

_TURBINE_KEY = stable_key_sql("turbine_name", "region")
_STATUS_KEY = stable_key_sql("status", "responsible_department")
_LOCATION_KEY = stable_key_sql("region", "latitude", "longitude")

_TURBINE_DIM = f"""
    SELECT DISTINCT ON (turbine_id) *
    FROM (SELECT DISTINCT {_TURBINE_KEY} AS turbine_id, turbine_name, capacity, latitude,
                 longitude, region, region_name FROM enriched)
    ORDER BY turbine_id, turbine_name DESC, capacity DESC, latitude DESC, longitude DESC,
             region DESC, region_name DESC"""
_STATUS_DIM = f"""
    SELECT DISTINCT {_STATUS_KEY} AS status_id, status, responsible_department FROM enriched"""
_LOCATION_DIM = f"""
    SELECT DISTINCT ON (location_id) *
    FROM (SELECT DISTINCT {_LOCATION_KEY} AS location_id, latitude, longitude, region,
                 region_name FROM enriched)
    ORDER BY location_id, latitude DESC, longitude DESC, region DESC, region_name DESC"""

ORACLE["dim_unit"] = with_ctes(["enriched"], "SELECT * FROM turbine_dim",
                               [("turbine_dim", _TURBINE_DIM)])
ORACLE["dim_status"] = with_ctes(["enriched"], _STATUS_DIM)
ORACLE["dim_location"] = with_ctes(["enriched"], "SELECT * FROM location_dim",
                                   [("location_dim", _LOCATION_DIM)])

# No Murmur3 in DuckDB: compared on rows only.

_FACT_ENERGY = f"""
    SELECT production_id AS fact_production_id, date AS date_id, time AS time_id,
           {_TURBINE_KEY} AS turbine_id, {_STATUS_KEY} AS status_id,
           energy_produced, wind_speed, wind_direction
    FROM enriched"""

ORACLE["fact_production"] = with_ctes(["enriched"], _FACT_ENERGY)
ORACLE["fact_production_lookup"] = with_ctes(["enriched"], f"""
SELECT production_id AS fact_production_id, date AS date_id, time AS time_id,
       {_TURBINE_KEY} AS turbine_id, {_STATUS_KEY} AS status_id,
       energy_produced, wind_speed, wind_direction, {_LOCATION_KEY} AS location_id
FROM enriched""")

ORACLE["fact_conditions"] = with_ctes(["enriched"], f"""
SELECT DISTINCT weather_id AS fact_weather_id, date AS date_id, time AS time_id,
       {_LOCATION_KEY} AS location_id, temperature_2m, cloud_cover, wind_gust_10m, wind_speed
FROM enriched""")

ORACLE["daily_totals"] = with_ctes(["enriched"], """
SELECT f.date_id, f.turbine_id, t.turbine_name, t.region,
       CAST(sum(f.energy_produced) AS DECIMAL(18,2)) AS total_energy,
       count(*) AS readings
FROM fact_energy f LEFT JOIN turbine_dim t ON f.turbine_id = t.turbine_id
GROUP BY f.date_id, f.turbine_id, t.turbine_name, t.region""",
    [("fact_energy", _FACT_ENERGY), ("turbine_dim", _TURBINE_DIM)])

_IMPACT = f"""
SELECT region, gust_band, time_period, readings,
       CASE WHEN ne > 0 THEN {units_to_dec(half_away('se', 'ne'), 12, 2)} END AS avg_energy,
       CASE WHEN nt > 0 THEN {units_to_dec(half_away('st', 'nt'), 12, 2)} END AS avg_temperature,
       round(CASE WHEN sx * sy > 0 THEN cv / (sx * sy) END, 6) AS corr_energy_gust
FROM (
  SELECT region, CAST(floor(wind_gust_10m / 50) * 50 AS INTEGER) AS gust_band, time_period,
         count(*) AS readings,
         sum(CAST(energy_produced * 100 AS BIGINT)) AS se, count(energy_produced) AS ne,
         sum(CAST(temperature_2m * 100 AS BIGINT)) AS st, count(temperature_2m) AS nt,
         covar_samp(CAST(energy_produced AS DOUBLE), CAST(wind_gust_10m AS DOUBLE)) AS cv,
         stddev_samp(CAST(energy_produced AS DOUBLE)) AS sx,
         stddev_samp(CAST(wind_gust_10m AS DOUBLE)) AS sy
  FROM enriched GROUP BY ALL)"""
ORACLE["condition_impact"] = with_ctes(["enriched"], _IMPACT)

ORACLE["availability"] = with_ctes(["enriched"], f"""
SELECT f.turbine_id, t.turbine_name, t.region, count(*) AS readings,
       CAST(sum(CASE WHEN s.status = 'BUILDING' THEN 1 ELSE 0 END) AS BIGINT) AS available_readings,
       {units_to_dec(half_away("CAST(sum(CASE WHEN s.status = 'BUILDING' THEN 1 ELSE 0 END) AS BIGINT) * 10000", 'count(*)'), 7, 4)} AS availability
FROM fact_energy f
LEFT JOIN status_dim s ON f.status_id = s.status_id
LEFT JOIN turbine_dim t ON f.turbine_id = t.turbine_id
GROUP BY f.turbine_id, t.turbine_name, t.region""",
    [("fact_energy", _FACT_ENERGY), ("turbine_dim", _TURBINE_DIM), ("status_dim", _STATUS_DIM)])


# --- keyed upserts ----------------------------------------------------------

def merge_sql(target: str, source: str, cols: list[str], keys: list[str],
              order: list[str], keep_from_target: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """CTEs ``dedup`` and ``merged`` for an upsert of ``source`` into ``target``."""
    rest = [c for c in cols if c not in keys]
    has_key = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    order_by = ", ".join(keys + [f"{c} DESC" for c in order + rest])
    col_list = ", ".join(cols)
    dedup = f"""
    SELECT {col_list} FROM (
      SELECT DISTINCT ON ({', '.join(keys)}) * FROM {source} WHERE {has_key}
      ORDER BY {order_by})
    UNION ALL
    SELECT {col_list} FROM {source} WHERE NOT ({has_key})"""
    sel = []
    for c in cols:
        if c in keep_from_target:
            sel.append(f"CASE WHEN t._in IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN s._in IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    merged = f"""
    SELECT {', '.join(sel)},
           CASE WHEN s._in IS NOT NULL AND t._in IS NOT NULL THEN 'update'
                WHEN s._in IS NOT NULL THEN 'insert' ELSE 'keep' END AS merge_action
    FROM (SELECT *, 1 AS _in FROM {target}) t
    FULL OUTER JOIN (SELECT *, 1 AS _in FROM dedup) s ON {on}"""
    return [("dedup", dedup), ("merged", merged)]


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]
_ORDERS_HISTORY = """
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
    FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"""
_ORDERS_BATCH = """
    SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2)) AS o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority, 1 AS revision
    FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01'
    UNION ALL
    SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 2 AS DECIMAL(12,2)) AS o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate, '1-URGENT' AS o_orderpriority, 2 AS revision
    FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'"""

_SINGLE = [("tgt", _ORDERS_HISTORY), ("src", _ORDERS_BATCH)] + merge_sql(
    "tgt", "src", _ORDER_COLS, ["o_orderkey"], ["revision"])

ORACLE["upsert_single"] = with_ctes([], "SELECT * FROM merged", _SINGLE)
ORACLE["upsert_actions"] = with_ctes(
    [], "SELECT o_orderkey, merge_action FROM merged WHERE merge_action <> 'keep'", _SINGLE)
ORACLE["upsert_metrics"] = with_ctes([], """
SELECT p.processed, m.inserted, m.updated, p.processed - m.inserted AS avoided, m.total_after
FROM (SELECT count(*) AS processed FROM src) p,
     (SELECT count(*) FILTER (WHERE merge_action = 'insert') AS inserted,
             count(*) FILTER (WHERE merge_action = 'update') AS updated,
             count(*) AS total_after FROM merged) m""", _SINGLE)

_PK = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority_key"
ORACLE["upsert_nullkey"] = with_ctes([], "SELECT * FROM merged", [
    ("tgt", f"SELECT *, {_PK} FROM ({_ORDERS_HISTORY})"),
    ("src", f"SELECT *, {_PK} FROM ({_ORDERS_BATCH})"),
] + merge_sql("tgt", "src", _ORDER_COLS + ["priority_key"], ["o_orderkey", "priority_key"],
              ["revision"]))

_WEATHER_COLS = ["date", "time", "latitude", "longitude", "region", "region_name",
                 "wind_gusts_10m", "temperature_2m", "cloud_cover", "day", "month", "quarter",
                 "year", "hour_of_day", "minute_of_hour", "second_of_minute", "time_period",
                 "weather_id"]
_WEATHER_KEYS = ["date", "time", "region", "region_name"]
ORACLE["upsert_composite"] = with_ctes(["silver_weather"], "SELECT * FROM merged", [
    ("tgt", f"SELECT {', '.join(_WEATHER_COLS)} FROM silver_weather WHERE date <= DATE '2024-01-20'"),
    ("src", f"""
    SELECT {', '.join(c for c in _WEATHER_COLS if c not in ('wind_gusts_10m', 'weather_id'))},
           CAST(wind_gusts_10m + 1 AS DECIMAL(6,2)) AS wind_gusts_10m,
           {stable_key_sql('date', 'time', 'region', 'region_name', "'batch'")} AS weather_id
    FROM silver_weather WHERE date >= DATE '2024-01-15'"""),
] + merge_sql("tgt", "src", _WEATHER_COLS, _WEATHER_KEYS, [], ("weather_id",)))


# --- integrity checks -------------------------------------------------------

ORACLE["check_unique"] = """
SELECT l_orderkey, l_linenumber, count(*) AS rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

ORACLE["check_not_null"] = """
WITH o AS (SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END
                       AS priority_key FROM orders)
SELECT 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS null_rows FROM o
UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM o
UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM o
UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM o
UNION ALL SELECT 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM o
UNION ALL SELECT 'priority_key', count(*) FILTER (WHERE priority_key IS NULL) FROM o"""


def _fk(name: str, fact: str, fk: str, dim: str, pk: str) -> str:
    return f"""
SELECT '{name}' AS foreign_key, count(*) AS orphan_keys,
       CAST(coalesce(sum(rows), 0) AS BIGINT) AS orphan_rows
FROM (SELECT {fk} AS k, count(*) AS rows FROM {fact} WHERE {fk} IS NOT NULL GROUP BY {fk}) f
WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.k)"""


ORACLE["check_fk"] = "\nUNION ALL".join([
    _fk("lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    _fk("lineitem.l_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
    _fk("lineitem.l_suppkey", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    _fk("orders.o_custkey", "orders", "o_custkey", "customer", "c_custkey"),
    _fk("customer.c_nationkey", "customer", "c_nationkey", "nation", "n_nationkey"),
])

_FACT_WEATHER = f"""
    SELECT DISTINCT weather_id AS fact_weather_id, date AS date_id, time AS time_id,
           {_LOCATION_KEY} AS location_id, temperature_2m, cloud_cover, wind_gust_10m, wind_speed
    FROM enriched"""

ORACLE["check_fk_star"] = with_ctes(["enriched"], "\nUNION ALL".join([
    _fk("fact_energy.date_id", "fact_energy", "date_id", "date_dim", "date_id"),
    _fk("fact_energy.time_id", "fact_energy", "time_id", "time_dim", "time_id"),
    _fk("fact_energy.turbine_id", "fact_energy", "turbine_id", "turbine_dim", "turbine_id"),
    _fk("fact_energy.status_id", "fact_energy", "status_id", "status_dim", "status_id"),
    _fk("fact_weather.date_id", "fact_weather", "date_id", "date_dim", "date_id"),
    _fk("fact_weather.time_id", "fact_weather", "time_id", "time_dim", "time_id"),
    _fk("fact_weather.location_id", "fact_weather", "location_id", "location_dim", "location_id"),
]), [("fact_energy", _FACT_ENERGY), ("fact_weather", _FACT_WEATHER),
     ("date_dim", "SELECT DISTINCT date AS date_id FROM enriched"),
     ("time_dim", "SELECT DISTINCT time AS time_id FROM enriched"),
     ("turbine_dim", _TURBINE_DIM), ("status_dim", _STATUS_DIM),
     ("location_dim", _LOCATION_DIM)])

ORACLE["check_limits"] = """
SELECT 'c_name' AS column_name, 'varchar(18)' AS rule,
       count(*) FILTER (WHERE length(c_name) > 18) AS violations FROM customer
UNION ALL SELECT 'c_mktsegment', 'varchar(9)', count(*) FILTER (WHERE length(c_mktsegment) > 9) FROM customer
UNION ALL SELECT 'c_acctbal', 'decimal(6,2)',
       count(*) FILTER (WHERE c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DECIMAL(6,2)) IS NULL) FROM customer
UNION ALL SELECT 'o_orderpriority', 'varchar(10)', count(*) FILTER (WHERE length(o_orderpriority) > 10) FROM orders
UNION ALL SELECT 'o_totalprice', 'decimal(7,2)',
       count(*) FILTER (WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL) FROM orders"""

ORACLE["date_gate"] = """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'"""

ORACLE["date_completeness"] = """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
cal AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM d)
SELECT date FROM cal WHERE date NOT IN (SELECT date FROM d)"""

ORACLE["slot_completeness"] = with_ctes(["readings"], """
SELECT g.region, g.date, count(*) AS expected, count(h.time) AS present,
       count(*) FILTER (WHERE h.time IS NULL) AS missing
FROM (SELECT region, date, strftime(unnest(generate_series(CAST(date AS TIMESTAMP),
        CAST(date AS TIMESTAMP) + INTERVAL 1430 MINUTE, INTERVAL 10 MINUTE)), '%H:%M:%S') AS time
      FROM (SELECT DISTINCT region, date FROM readings)) g
LEFT JOIN (SELECT DISTINCT region, date, time FROM readings) h
  ON g.region = h.region AND g.date = h.date AND g.time = h.time
GROUP BY g.region, g.date""")

# --- contracts, measures, previews, lineage --------------------------------

ORACLE["contract_cast"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, TRY_CAST(o_totalprice AS DECIMAL(8,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority, CAST(NULL AS VARCHAR) AS o_comment
FROM orders"""

ORACLE["measures_rounded"] = """
SELECT l_orderkey, l_linenumber, l_partkey,
       -- exact decimals of the shortest text of each number, rounded once
       round(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,18)), 2) AS extendedprice,
       round(CAST(CAST(l_extendedprice * (1 - l_discount) AS VARCHAR) AS DECIMAL(38,18)), 2) AS net_price,
       round(CAST(CAST(l_discount AS VARCHAR) AS DECIMAL(38,18)), 2) AS discount,
       round(CAST(CAST(l_quantity / 7 AS VARCHAR) AS DECIMAL(38,18)), 2) AS quantity_per_week
FROM lineitem"""

ORACLE["ordered_preview"] = """
SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus FROM orders
ORDER BY o_orderdate DESC, o_orderkey LIMIT 20"""

ORACLE["lineage_columns"] = """
SELECT event_id, event_type, 'events.parquet' AS source_file, 'batch-0001' AS batch_id,
       'weather-archive' AS source_api
FROM events"""


# --- CSV sources --------------------------------------------------------------

ORACLE["csv_typed_scan"] = with_ctes(["readings"], """
SELECT production_id, date, time, turbine_name, capacity,
       location_name, latitude, longitude, region, status, responsible_department, wind_speed,
       wind_direction, energy_produced, slot AS measured_at
FROM readings""")

ORACLE["csv_quarantine"] = with_ctes(["readings", "ev"], """
SELECT CASE WHEN r.region = 'error' THEN 'E' || CAST(r.production_id AS VARCHAR)
            ELSE CAST(r.production_id AS VARCHAR) END AS production_id_text,
       CASE WHEN r.region = 'error' THEN 'malformed' ELSE 'bad_time' END AS reason
FROM readings r JOIN ev ON ev.event_id = r.production_id
WHERE r.region = 'error' OR ev.k = 0""")

ORACLE["csv_good_rows"] = with_ctes(["readings", "ev"], """
SELECT r.production_id, r.date, r.time, r.slot AS measured_at
FROM readings r JOIN ev ON ev.event_id = r.production_id
WHERE r.region <> 'error' AND ev.k <> 0""")

ORACLE["csv_header_layouts"] = with_ctes(["readings"], """
SELECT CAST(production_id AS VARCHAR) AS production_id_text, NULL AS reason, capacity, latitude, longitude,
       turbine_name, wind_speed, energy_produced, slot AS measured_at
FROM readings WHERE day(date) % 4 IN (0, 1)
UNION ALL
SELECT CAST(production_id AS VARCHAR), CASE WHEN day(date) % 4 = 2 THEN 'missing_column: capacity'
       ELSE 'unknown_column: note' END, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM readings WHERE day(date) % 4 IN (2, 3)""")

ORACLE["daily_file_select"] = with_ctes(["readings"], """
SELECT production_id, date, time, region, energy_produced
FROM readings WHERE date = DATE '2024-01-15'""")

ORACLE["all_files_scan"] = """
SELECT strftime(ts, '%Y%m%d') AS file_day, count(*) AS rows FROM events GROUP BY 1"""


# --- recorded weather payloads --------------------------------------------------

ORACLE["payload_rows"] = with_ctes(["hourly"], """
SELECT d.region, d.region_name, d.date, d.ts, h.wind_gusts_10m, h.temperature_2m,
       CASE WHEN d.region = 'error' THEN NULL ELSE h.cloud_cover END AS cloud_cover
FROM (SELECT region, region_name, date,
             unnest(generate_series(CAST(date AS TIMESTAMP),
                                    CAST(date AS TIMESTAMP) + INTERVAL 23 HOUR,
                                    INTERVAL 1 HOUR)) AS ts
      FROM (SELECT DISTINCT region, region_name, date FROM hourly)
      WHERE NOT (region = 'signup' AND day(date) = 13)) d
LEFT JOIN hourly h ON h.region = d.region AND h.ts = d.ts""")

ORACLE["payload_lost_regions"] = """
SELECT DISTINCT event_type AS region, strftime(ts, '%Y-%m-%d') AS date
FROM events WHERE event_type = 'signup' AND day(ts) = 13"""


# --- loading --------------------------------------------------------------------

ORACLE["load_star"] = with_ctes(["enriched"], """
SELECT r.run, t."table", t.processed,
       CASE WHEN r.run = 1 THEN t.keys ELSE 0 END AS inserted,
       CASE WHEN r.run = 1 THEN 0 ELSE t.keys END AS updated,
       t.processed - CASE WHEN r.run = 1 THEN t.keys ELSE 0 END AS avoided
FROM (
  SELECT 'date_dim' AS "table", count(*) AS processed, count(*) AS keys FROM date_dim
  UNION ALL SELECT 'time_dim', count(*), count(*) FROM time_dim
  UNION ALL SELECT 'turbine_dim', count(*), count(*) FROM turbine_dim
  UNION ALL SELECT 'status_dim', count(*), count(*) FROM status_dim
  UNION ALL SELECT 'location_dim', count(*), count(*) FROM location_dim
  UNION ALL SELECT 'fact_energy', count(*), count(DISTINCT fact_production_id) FROM fact_energy
  UNION ALL SELECT 'fact_weather', count(DISTINCT fact_weather_id), count(DISTINCT fact_weather_id)
            FROM fact_weather
) t, (SELECT 1 AS run UNION ALL SELECT 2) r""",
    [("date_dim", "SELECT DISTINCT date, day, month, quarter, year FROM enriched"),
     ("time_dim", "SELECT DISTINCT time, hour_of_day, minute_of_hour, second_of_minute, time_period FROM enriched"),
     ("turbine_dim", _TURBINE_DIM), ("status_dim", _STATUS_DIM), ("location_dim", _LOCATION_DIM),
     ("fact_energy", _FACT_ENERGY), ("fact_weather", _FACT_WEATHER)])


ORACLE["load_star_rows"] = ORACLE["fact_production"]

# --- streaming ------------------------------------------------------------------

ORACLE["stream_daily_load"] = with_ctes(["readings", "ev"], """
SELECT r.production_id, r.date, r.time, r.turbine_name, r.region,
       r.energy_produced, r.wind_speed, r.hour_of_day, r.time_period
FROM readings r JOIN ev ON ev.event_id = r.production_id
WHERE r.region <> 'error' AND ev.k <> 0""")


# --- the whole day load -----------------------------------------------------------

ORACLE["medallion_load"] = with_ctes(["readings", "ev", "hourly"], """
SELECT 1 AS run, t."table", t.n AS processed, t.n AS inserted, CAST(0 AS BIGINT) AS updated,
       CAST(0 AS BIGINT) AS avoided
FROM (
  SELECT 'silver_production' AS "table", count(*) AS n FROM g
  UNION ALL SELECT 'silver_weather', count(*) * 144 FROM w
  UNION ALL SELECT 'silver_enriched', count(*) FROM g
  UNION ALL SELECT 'date_dim', count(DISTINCT date) FROM g
  UNION ALL SELECT 'time_dim', count(DISTINCT time) FROM g
  UNION ALL SELECT 'turbine_dim', count(DISTINCT (turbine_name, region)) FROM g
  UNION ALL SELECT 'status_dim', count(DISTINCT (status, responsible_department)) FROM g
  UNION ALL SELECT 'location_dim', count(DISTINCT (region, latitude, longitude)) FROM g
  UNION ALL SELECT 'fact_energy', count(*) FROM g
  UNION ALL SELECT 'fact_weather', count(DISTINCT (date, time, region)) FROM g
            WHERE NOT (region = 'signup' AND day(date) = 13)
) t""", [
    ("g", """
    SELECT r.* FROM readings r JOIN ev ON ev.event_id = r.production_id
    WHERE r.region <> 'error' AND ev.k <> 0"""),
    ("w", """
    SELECT DISTINCT region, date FROM hourly WHERE NOT (region = 'signup' AND day(date) = 13)"""),
])


ORACLE["zoned_spine"] = """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
z AS (SELECT unnest(['America/New_York', 'Europe/Berlin']) AS zone),
b AS (SELECT zone, date, timezone('UTC', timezone(zone, CAST(date AS TIMESTAMP))) AS lo,
      timezone('UTC', timezone(zone, CAST(date + 1 AS TIMESTAMP))) AS hi FROM d, z),
g AS (SELECT zone, date, unnest(generate_series(lo, hi - INTERVAL 10 MINUTE, INTERVAL 10 MINUTE)) AS u FROM b),
t AS (SELECT zone, date, u, timezone(zone, timezone('UTC', u)) AS ts FROM g),
r AS (SELECT *, row_number() OVER (PARTITION BY zone, date, ts ORDER BY u) AS k FROM t)
SELECT zone, date, count(*) AS slots, min(u) AS first_utc, max(u) AS last_utc, count(DISTINCT ts) AS times,
       count(*) FILTER (k > 1) AS repeated
FROM r GROUP BY zone, date"""

ORACLE["slot_gaps"] = """
WITH s AS (SELECT DISTINCT event_type AS region, time_bucket(INTERVAL 10 MINUTE, ts) AS slot FROM events),
b AS (SELECT region, date_trunc('day', min(slot)) AS lo, date_trunc('day', max(slot)) + INTERVAL 1430 MINUTE AS hi
      FROM s GROUP BY region),
e AS (SELECT region, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 10 MINUTE)) AS slot FROM b),
m AS (SELECT *, slot - row_number() OVER (PARTITION BY region ORDER BY slot) * INTERVAL 10 MINUTE AS island
      FROM e ANTI JOIN s USING (region, slot))
SELECT region, min(slot) AS first_missing, max(slot) AS last_missing, count(*) AS missing
FROM m GROUP BY region, island"""

_RUNS = """
WITH u AS (SELECT DISTINCT ON (user_id, ts) user_id, ts, event_type AS state FROM events ORDER BY user_id, ts, event_id DESC),
c AS (SELECT *, lag(state) OVER w IS DISTINCT FROM state AS opens, max(ts) OVER (PARTITION BY user_id) AS last
      FROM u WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
runs AS (SELECT user_id, state, ts AS start, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), last) AS stop
      FROM c WHERE opens)
"""
ORACLE["state_runs"] = _RUNS + "SELECT * FROM runs"
ORACLE["availability_by_time"] = _RUNS + f"""
, s AS (SELECT user_id, sum(d)::BIGINT AS seconds, (coalesce(sum(d) FILTER (state IN ('click', 'purchase', 'view')), 0))::BIGINT
        AS seconds_in, count(*) AS runs
        FROM (SELECT *, date_diff('second', start, stop) AS d FROM runs) GROUP BY user_id)
SELECT *, CASE WHEN seconds > 0 THEN {units_to_dec(half_away('(seconds_in * 10000)', 'seconds'), 7, 4)} END AS share FROM s"""

# Murmur3 (32 bits, seed 42) of ASCII text, word by word, in whole numbers below 2**32.
_K1 = "((k * 3432918353) % 4294967296)"
_K2 = f"((((({_K1} * 32768) % 4294967296) + {_K1} // 131072) * 461845907) % 4294967296)"
_X = f"xor(h::BIGINT, ({_K2})::BIGINT)::HUGEINT"
_STEP = f"((((({_X} * 8192) % 4294967296) + {_X} // 524288) * 5 + 3864292196) % 4294967296)::HUGEINT"
ORACLE["key_murmur"] = f"""
WITH t AS (SELECT c_custkey, c_name, c_mktsegment, concat_ws('_', c_name, c_mktsegment) AS s FROM customer),
b AS (SELECT *, list_transform(string_split(s, ''), lambda c: ord(c)::HUGEINT) AS b FROM t),
w AS (SELECT *, list_concat(list_transform(range(len(b) // 4), lambda i: b[4 * i + 1] + 256 * b[4 * i + 2]
      + 65536 * b[4 * i + 3] + 16777216 * b[4 * i + 4]), b[len(b) // 4 * 4 + 1:]) AS w FROM b),
m AS (SELECT *, xor(list_reduce(list_concat([42::HUGEINT], w), lambda h, k: {_STEP})::BIGINT, len(b)::BIGINT) AS h0 FROM w),
f1 AS (SELECT *, (xor(h0, h0 >> 16)::HUGEINT * 2246822507 % 4294967296)::BIGINT AS h1 FROM m),
f2 AS (SELECT *, (xor(h1, h1 >> 13)::HUGEINT * 3266489909 % 4294967296)::BIGINT AS h2 FROM f1),
f3 AS (SELECT *, xor(h2, h2 >> 16) AS h3 FROM f2)
SELECT c_custkey, c_name, c_mktsegment, abs(CASE WHEN h3 >= 2147483648 THEN h3 - 4294967296 ELSE h3 END) AS customer_key
FROM f3"""

_SHIFTED_SLOT = "CASE WHEN ev.k = 7 THEN r.slot - INTERVAL 1 HOUR ELSE r.slot END"

_CORRECTED = [("final", f"""
    SELECT r.* EXCLUDE (measured_at, slot, energy_produced, date, time, day, month, quarter, year, hour_of_day,
                        minute_of_hour, second_of_minute, time_period),
           r.energy_produced + CASE WHEN ev.k = 7 THEN 50 ELSE 0 END AS energy_produced,
           {TIME_ATTRS_SQL.format(ts=f"({_SHIFTED_SLOT})")}
    FROM readings r JOIN ev ON ev.event_id = r.production_id"""),
     ("weather", """
    SELECT * REPLACE (CASE WHEN region = 'error' THEN NULL ELSE cloud_cover END AS cloud_cover)
    FROM silver_weather WHERE NOT (region = 'signup' AND day(date) = 13)"""),
     ("enriched", CTES["enriched"].replace("FROM readings r", "FROM final r").replace("silver_weather w", "weather w"))]

ORACLE["medallion_incremental"] = with_ctes(["readings", "ev", "silver_weather"], """
SELECT 'silver_production' AS table_name, production_id AS id, date, time, energy_produced::DOUBLE AS a,
       wind_speed::DOUBLE AS b, latitude::DOUBLE AS c, longitude::DOUBLE AS d, NULL::BIGINT AS key_1,
       NULL::BIGINT AS key_2, turbine_name AS name FROM final
UNION ALL SELECT 'silver_enriched', production_id, date, time, energy_produced, temperature_2m, cloud_cover,
       wind_gust_10m, weather_id, prod_enriched_id, region_name FROM enriched
UNION ALL SELECT 'fact_energy', fact_production_id, date_id, time_id, energy_produced, wind_speed, NULL, NULL,
       turbine_id, status_id, wind_direction FROM fact_energy
UNION ALL SELECT 'fact_weather', fact_weather_id, date_id, time_id, temperature_2m, cloud_cover, wind_gust_10m,
       wind_speed, location_id, NULL, NULL FROM
       (SELECT DISTINCT ON (fact_weather_id) * FROM fact_weather WHERE fact_weather_id IS NOT NULL
        ORDER BY fact_weather_id, location_id DESC, wind_speed DESC)
UNION ALL SELECT DISTINCT 'time_dim', NULL, NULL, time, hour_of_day, minute_of_hour, second_of_minute, NULL, NULL,
       NULL, time_period FROM (SELECT * FROM final UNION ALL BY NAME
       SELECT r.* EXCLUDE (measured_at, slot) FROM readings r JOIN ev ON ev.event_id = r.production_id WHERE ev.k <> 8)""",
    [*_CORRECTED, ("fact_energy", _FACT_ENERGY), ("fact_weather", _FACT_WEATHER)])

ORACLE["reports_incremental"] = with_ctes(["readings", "ev", "silver_weather"], _IMPACT, _CORRECTED)

ORACLE["contract_rows"] = """
SELECT o_orderkey, concat_ws(', ', CASE WHEN o_orderpriority = '5-LOW' THEN 'priority_key not null' END,
       CASE WHEN length(o_orderpriority) > 8 THEN 'o_orderpriority varchar(8)' END,
       CASE WHEN length(o_orderstatus) > 1 THEN 'o_orderstatus varchar(1)' END,
       CASE WHEN TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL THEN 'o_totalprice fits decimal(7,2)' END) AS broken
FROM orders WHERE broken <> ''"""

_TYPES = {"energy_produced": "DECIMAL(12,2)", "wind_speed": "DECIMAL(6,2)", "latitude": "DECIMAL(9,6)",
          "longitude": "DECIMAL(9,6)", "capacity": "INTEGER", "production_id": "BIGINT", "date": "DATE"}
ORACLE["contract_types"] = with_ctes(["readings"], "\nUNION ALL ".join(
    f"SELECT production_id AS id, '{c}' AS column_name, "
    f"CASE lower(typeof({c}::{t})) WHEN 'integer' THEN 'int' ELSE lower(typeof({c}::{t})) END AS type, "
    f"({c}::{t})::VARCHAR AS text FROM readings" for c, t in _TYPES.items()))


# --- output types -------------------------------------------------------------
# Decimal output columns of each query; the registered Spark queries return
# them as DOUBLE (see plans.queries.measures_as_double) and so do the oracles.
DECIMAL_COLUMNS = {
    'availability': ('availability',),
    'availability_by_time': ('share',),
    'condition_impact': ('avg_energy', 'avg_temperature'),
    'reports_incremental': ('avg_energy', 'avg_temperature'),
    'contract_cast': ('o_totalprice',),
    'csv_header_layouts': ('latitude', 'longitude', 'wind_speed', 'energy_produced'),
    'csv_typed_scan': ('latitude', 'longitude', 'wind_speed', 'energy_produced'),
    'daily_file_select': ('energy_produced',),
    'daily_totals': ('total_energy',),
    'dim_location': ('latitude', 'longitude'),
    'dim_unit': ('latitude', 'longitude'),
    'enrich_left': ('latitude', 'longitude', 'energy_produced', 'wind_speed', 'wind_gust_10m', 'temperature_2m', 'cloud_cover'),
    'fact_conditions': ('temperature_2m', 'cloud_cover', 'wind_gust_10m', 'wind_speed'),
    'fact_production': ('energy_produced', 'wind_speed'),
    'fact_production_lookup': ('energy_produced', 'wind_speed'),
    'interpolate_10min': ('latitude', 'longitude', 'wind_gusts_10m', 'temperature_2m', 'cloud_cover'),
    'load_star_rows': ('energy_produced', 'wind_speed'),
    'measures_rounded': ('extendedprice', 'net_price', 'discount', 'quantity_per_week'),
    'payload_rows': ('wind_gusts_10m', 'temperature_2m', 'cloud_cover'),
    'stream_daily_load': ('energy_produced', 'wind_speed'),
    'upsert_composite': ('latitude', 'longitude', 'wind_gusts_10m', 'temperature_2m', 'cloud_cover'),
    'upsert_nullkey': ('o_totalprice',),
    'upsert_single': ('o_totalprice',),
}


def _as_double(sql: str, cols: tuple[str, ...]) -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({casts}) FROM ({sql}\n)"


for _name, _cols in DECIMAL_COLUMNS.items():
    if _name in ORACLE:
        ORACLE[_name] = _as_double(ORACLE[_name], _cols)

ORACLE["region_lookup"] = with_ctes(["weather_10min"], """
SELECT w.region, w.date, w.time, CAST(w.wind_gusts_10m AS DOUBLE) AS wind_gusts_10m,
       r.region_name, r.timezone
FROM weather_10min w
LEFT JOIN (SELECT DISTINCT event_type AS region, upper(event_type) AS region_name,
                  'UTC' AS timezone FROM events) r ON w.region = r.region""")

ORACLE["star_counts"] = with_ctes(["enriched"], """
SELECT 'date_dim' AS table_name, count(*) AS rows FROM (SELECT DISTINCT date, day, month, quarter, year FROM enriched)
UNION ALL SELECT 'time_dim', count(*) FROM (SELECT DISTINCT time, hour_of_day, minute_of_hour, second_of_minute, time_period FROM enriched)
UNION ALL SELECT 'turbine_dim', count(*) FROM turbine_dim
UNION ALL SELECT 'status_dim', count(*) FROM status_dim
UNION ALL SELECT 'location_dim', count(*) FROM location_dim
UNION ALL SELECT 'fact_energy', count(*) FROM fact_energy
UNION ALL SELECT 'fact_weather', count(*) FROM fact_weather""",
    [("turbine_dim", _TURBINE_DIM), ("status_dim", _STATUS_DIM), ("location_dim", _LOCATION_DIM),
     ("fact_energy", _FACT_ENERGY), ("fact_weather", _FACT_WEATHER)])
