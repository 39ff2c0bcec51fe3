"""DuckDB SQL twins of the stand-in inputs, as named common table
expressions.  Query oracles are built from these with ``with_ctes``.

They restate the stand-in definitions independently in SQL (same fixed
values, same exact integer arithmetic) so the value hash can match."""

from __future__ import annotations

# Fixed values shared with plans.standins: compass points by k mod 8 and
# the "cloudy" value threshold.
COMPASS_SQL = "['N','NE','E','SE','S','SW','W','NW']"
CLOUDY_VALUE = "25.0"


def half_away(num: str, den: str) -> str:
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def units_to_dec(units: str, p: int, s: int) -> str:
    return f"CAST(CAST({units} AS DECIMAL(20,0)) * {10 ** -s:.{s}f} AS DECIMAL({p},{s}))"


TIME_ATTRS_SQL = """
    CAST({ts} AS DATE) AS date,
    strftime({ts}, '%H:%M:%S') AS time,
    CAST(day({ts}) AS INTEGER) AS day, CAST(month({ts}) AS INTEGER) AS month,
    CAST(quarter({ts}) AS INTEGER) AS quarter, CAST(year({ts}) AS INTEGER) AS year,
    CAST(hour({ts}) AS INTEGER) AS hour_of_day, CAST(minute({ts}) AS INTEGER) AS minute_of_hour,
    CAST(second({ts}) AS INTEGER) AS second_of_minute,
    CASE WHEN hour({ts}) >= 5 AND hour({ts}) < 12 THEN 'Morning'
         WHEN hour({ts}) >= 12 AND hour({ts}) < 17 THEN 'Afternoon'
         WHEN hour({ts}) >= 17 AND hour({ts}) < 21 THEN 'Evening'
         ELSE 'Night' END AS time_period"""


def stable_key_sql(*parts: str) -> str:
    txt = " || '_' || ".join(
        f"coalesce(length(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR), 'N')" for p in parts)
    return f"CAST(('0x' || substr(md5({txt}), 1, 15)) AS BIGINT)"


def _interp(v: str, p: int, s: int) -> str:
    pu = f"CAST(pv_{v} * {10 ** s} AS BIGINT)"
    nu = f"CAST(nv_{v} * {10 ** s} AS BIGINT)"
    dt = f"date_diff('second', pt_{v}, ts)"
    span = f"date_diff('second', pt_{v}, nt_{v})"
    tot = f"({pu} * {span} + ({nu} - {pu}) * {dt})"
    return (f"CASE WHEN pt_{v} IS NULL THEN NULL "
            f"WHEN {dt} = 0 OR nt_{v} IS NULL OR {span} = 0 THEN CAST(pv_{v} AS DECIMAL({p},{s})) "
            f"ELSE {units_to_dec(half_away(tot, span), p, s)} END AS {v}")


WEATHER_VARS = (("wind_gusts_10m", 6, 2), ("temperature_2m", 5, 2), ("cloud_cover", 5, 2))


def _neighbours() -> str:
    cols = []
    for v, _, _ in WEATHER_VARS:
        cols.append(f"last_value({v} IGNORE NULLS) OVER wp AS pv_{v}")
        cols.append(f"last_value(CASE WHEN {v} IS NOT NULL THEN ts END IGNORE NULLS) OVER wp AS pt_{v}")
        cols.append(f"first_value({v} IGNORE NULLS) OVER wn AS nv_{v}")
        cols.append(f"first_value(CASE WHEN {v} IS NOT NULL THEN ts END IGNORE NULLS) OVER wn AS nt_{v}")
    return ",\n        ".join(cols)


CTES: dict[str, str] = {
    "turbine_register": """
    SELECT c.c_custkey AS user_id,
           CAST(1000 + 100 * c.c_nationkey AS INTEGER) AS capacity,
           n.n_name AS location_name,
           CAST(CAST(c.c_acctbal AS DECIMAL(12,2)) * 0.01 AS DECIMAL(9,6)) AS latitude,
           CAST(-c.c_nationkey AS DECIMAL(9,6)) AS longitude,
           c.c_mktsegment AS status, r.r_name AS responsible_department
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "ev": """
    SELECT e.*, CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
           time_bucket(INTERVAL 10 MINUTE, e.ts) AS slot
    FROM events e""",
    "readings": f"""
    SELECT ev.event_id AS production_id, ev.ts AS measured_at, ev.slot AS slot,
           'U' || CAST(ev.user_id AS VARCHAR) AS turbine_name,
           tr.capacity, tr.location_name, tr.latitude, tr.longitude,
           ev.event_type AS region, tr.status, tr.responsible_department,
           CAST(CAST(ev.k AS DECIMAL(6,2)) * 0.1 AS DECIMAL(6,2)) AS wind_speed,
           list_extract({COMPASS_SQL}, (ev.k % 8) + 1) AS wind_direction,
           CAST(ev.value AS DECIMAL(12,2)) AS energy_produced,
           {TIME_ATTRS_SQL.format(ts='ev.slot')}
    FROM ev LEFT JOIN turbine_register tr ON ev.user_id = tr.user_id""",
    "hourly_agg": f"""
    SELECT event_type AS region, upper(event_type) AS region_name,
           date_trunc('hour', ts) AS ts, CAST(date_trunc('hour', ts) AS DATE) AS date,
           sum(CAST(round(value * 100) AS BIGINT)) AS sv,
           sum(CAST(k AS BIGINT)) AS sk,
           CAST(sum(CASE WHEN value >= {CLOUDY_VALUE} THEN 1 ELSE 0 END) AS BIGINT) AS sc,
           count(*) AS n
    FROM ev GROUP BY ALL""",
    "hourly": f"""
    SELECT region, region_name, ts, date,
           {units_to_dec(half_away('sv', 'n'), 6, 2)} AS wind_gusts_10m,
           {units_to_dec(half_away('sk * 100', 'n'), 5, 2)} AS temperature_2m,
           {units_to_dec(half_away('sc * 10000', 'n'), 5, 2)} AS cloud_cover
    FROM hourly_agg""",
    "grid": """
    SELECT region, region_name, date,
           unnest(generate_series(CAST(date AS TIMESTAMP),
                                  CAST(date AS TIMESTAMP) + INTERVAL 1430 MINUTE,
                                  INTERVAL 10 MINUTE)) AS ts
    FROM (SELECT DISTINCT region, region_name, date FROM hourly)""",
    "wx_union": """
    SELECT region, region_name, date, ts, wind_gusts_10m, temperature_2m, cloud_cover, 0 AS is_grid
    FROM hourly
    UNION ALL
    SELECT region, region_name, date, ts, NULL, NULL, NULL, 1 FROM grid""",
    "wx_nb": f"""
    SELECT *,
        {_neighbours()}
    FROM wx_union
    WINDOW wp AS (PARTITION BY region, region_name, date ORDER BY ts, is_grid
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           wn AS (PARTITION BY region, region_name, date ORDER BY ts, is_grid
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "weather_10min": f"""
    SELECT date, strftime(ts, '%H:%M:%S') AS time,
           CAST(0 AS DECIMAL(9,6)) AS latitude, CAST(0 AS DECIMAL(9,6)) AS longitude,
           region, region_name,
           {', '.join(_interp(v, p, s) for v, p, s in WEATHER_VARS)},
           ts
    FROM wx_nb WHERE is_grid = 1""",
    "silver_weather": f"""
    SELECT {stable_key_sql('date', 'time', 'region', 'region_name')} AS weather_id,
           latitude, longitude, region, region_name,
           wind_gusts_10m, temperature_2m, cloud_cover,
           {TIME_ATTRS_SQL.format(ts='ts')}
    FROM weather_10min""",
    "enriched": f"""
    SELECT {stable_key_sql('r.production_id', 'r.date', 'r.time')} AS prod_enriched_id,
           r.production_id, w.weather_id, r.date, r.time, r.latitude, r.longitude,
           r.region, w.region_name, r.turbine_name, r.capacity, r.status,
           r.responsible_department, r.energy_produced, r.wind_speed,
           w.wind_gusts_10m AS wind_gust_10m, r.wind_direction, w.temperature_2m,
           w.cloud_cover, r.day, r.month, r.quarter, r.year, r.hour_of_day,
           r.minute_of_hour, r.second_of_minute, r.time_period
    FROM readings r
    LEFT JOIN silver_weather w
      ON r.date = w.date AND r.time = w.time AND r.region = w.region""",
}

# Each CTE with the CTEs it reads (in dependency order).
DEPS: dict[str, tuple[str, ...]] = {
    "turbine_register": (),
    "ev": (),
    "readings": ("ev", "turbine_register"),
    "hourly_agg": ("ev",),
    "hourly": ("hourly_agg",),
    "grid": ("hourly",),
    "wx_union": ("hourly", "grid"),
    "wx_nb": ("wx_union",),
    "weather_10min": ("wx_nb",),
    "silver_weather": ("weather_10min",),
    "enriched": ("readings", "silver_weather"),
}


def _closure(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(names: tuple[str, ...] | list[str], body: str,
              extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <needed base CTEs>, <extra CTEs> <body>``."""
    parts = [f"{n} AS ({CTES[n]}\n)" for n in _closure(tuple(names))]
    parts += [f"{n} AS ({sql}\n)" for n, sql in (extra or [])]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
