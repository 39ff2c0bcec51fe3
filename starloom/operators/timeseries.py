"""Time-series operators: 10-minute spine, hourly axis, tagged unions and
linear interpolation of sparse samples onto a grid (O-31, O-36, O-39b,
O-39c, O-47..O-53).

Interpolation is a window computation partitioned by the series key plus
the local date, so a window never holds more than one day of one series
(144 grid points + 24 samples) whatever the data volume, and the three
variables share one window spec, hence one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.calendar import day_start, epoch_to_timestamp, time_text, to_local
from starloom.functions.measures import half_away_sql


def spine(days: DataFrame, date_col: str = "date", ts_col: str = "ts",
          step_minutes: int = 10) -> DataFrame:
    """One row per grid point from local midnight to the last slot before
    the next midnight (00:00 .. 23:50 for 10 minutes), for every row of
    ``days`` (O-49).  Other columns of ``days`` are carried along."""
    start = day_start(F.col(date_col))
    stop = start + F.expr(f"INTERVAL {24 * 60 - step_minutes} MINUTES")
    return days.withColumn(
        ts_col, F.explode(F.sequence(start, stop, F.expr(f"INTERVAL {step_minutes} MINUTES"))))


def zoned_spine(days: DataFrame, zone_col: str, date_col: str = "date", step_minutes: int = 10) -> DataFrame:
    """The grid of local days on the UTC axis (O-49, O-51): one row per step
    from local midnight to the last step before the next one, so a day on
    which the zone changes its offset has fewer or more points (138 or 150 for
    an hour and 10 minutes).  Adds ``ts_utc``, ``ts`` (local wall clock),
    ``time`` and ``again`` (the wall clock shows this time for the second time
    that day)."""
    step = F.expr(f"INTERVAL {step_minutes} MINUTES")
    grid = days.withColumn("ts_utc", F.explode(F.sequence(
        day_start_utc(date_col, zone_col), day_start_utc(F.date_add(F.col(date_col), 1), zone_col) - step, step)))
    return with_wall_clock(grid, zone_col, date_col)


def day_start_utc(date: Column | str, zone_col: str) -> Column:
    """The instant at which a local day begins."""
    return F.to_timestamp_ntz(F.to_utc_timestamp(day_start(date).cast("timestamp"), F.col(zone_col)))


def with_wall_clock(grid: DataFrame, zone_col: str, date_col: str = "date") -> DataFrame:
    """Adds ``ts``, ``time`` and ``again`` (see ``zoned_spine``) to points ``ts_utc`` of local days."""
    grid = grid.withColumn("ts", to_local("ts_utc", zone_col))
    # Repeated: the offset is smaller than at the day's beginning and the clock
    # has been set back over this time.
    ahead = F.timestamp_diff("MINUTE", F.col("ts_utc"), F.col("ts"))
    start = day_start_utc(date_col, zone_col)
    first = F.timestamp_diff("MINUTE", start, to_local(start, zone_col))
    earlier = to_local(F.timestamp_add("MINUTE", ahead - first, F.col("ts_utc")), zone_col)
    return grid.withColumns({"time": time_text("ts"), "again": (ahead < first) & (earlier == F.col("ts"))})


def hourly_axis(start_epoch: Column | str, end_epoch: Column | str,
                interval_s: Column | str) -> Column:
    """Array of sample timestamps from start to end, end excluded (O-50,
    O-62); empty when end <= start, a bound is NULL or the interval is 0."""
    s = F.col(start_epoch) if isinstance(start_epoch, str) else start_epoch
    e = F.col(end_epoch) if isinstance(end_epoch, str) else end_epoch
    i = F.col(interval_s) if isinstance(interval_s, str) else interval_s
    n = F.greatest(F.ceil(F.try_divide(e - s, i)).cast("int"), F.lit(0))
    # sequence(0, -1) would count down, so it always holds one element
    # and the slice takes none of it for an empty axis.
    axis = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1),
                       lambda k: epoch_to_timestamp(s + k.cast("bigint") * i))
    return F.slice(axis, F.lit(1), n)


def tagged_union(samples: DataFrame, grid: DataFrame, ts_col: str, keys: Sequence[str],
                 distinct: bool = False) -> DataFrame:
    """Sample and grid timestamps in one frame tagged with ``source``
    (UNION ALL, O-39b) or without the tag and duplicates (UNION, O-39c)."""
    cols = [*keys, ts_col]
    a = samples.select(*cols, F.lit("hourly").alias("source"))
    b = grid.select(*cols, F.lit("interpolated").alias("source"))
    if distinct:
        return a.drop("source").unionByName(b.drop("source")).distinct()
    return a.unionByName(b)


def _q(name: str) -> str:
    return f"`{name}`"


def interpolate(samples: DataFrame, grid: DataFrame, keys: Sequence[str], ts_col: str,
                value_cols: Sequence[str], scale: int | None = 2,
                precision: int = 12) -> DataFrame:
    """Linear interpolation of each value column onto the grid timestamps.

    * Every variable has its own neighbours (nulls are independent).
    * Before the first sample of a partition the value stays NULL; after the
      last one the last value is held (O-48); on a sample the sample wins.
    * ``keys`` must include the day so that days are never bridged.
    * With ``scale`` the values are snapped to fixed point first and the
      result is computed exactly in integers and rounded half away from zero
      to that scale, the way a NUMERIC(p, scale) column stores it; with
      ``scale=None`` it is plain double arithmetic.

    Returns the grid rows (``keys``, ``ts_col``) plus one column per value.
    The expressions are written as SQL text: one parse on the JVM instead
    of thousands of small Column calls while the plan is built.
    """
    keys = list(keys)
    s = samples.select(*keys, ts_col, *[F.col(v).cast("double").alias(v) for v in value_cols],
                       F.lit(0).alias("_grid"))
    g = grid.select(*keys, ts_col, *[F.lit(None).cast("double").alias(v) for v in value_cols],
                    F.lit(1).alias("_grid"))
    u = s.unionByName(g)
    part = ", ".join(_q(k) for k in keys)
    t = _q(ts_col)
    # Both neighbours use running frames (unbounded preceding .. current
    # row), which are evaluated incrementally; the next sample is the last
    # one seen in descending time order.  Same partitioning, so the second
    # ordering costs a sort, not a shuffle.
    prev = (f"OVER (PARTITION BY {part} ORDER BY {t}, _grid "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    nxt = (f"OVER (PARTITION BY {part} ORDER BY {t} DESC, _grid DESC "
           f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    neighbours = []
    for v in value_cols:
        x = _q(v)
        seen = f"CASE WHEN {x} IS NOT NULL THEN {t} END"
        neighbours += [f"last({x}, true) {prev} AS `_pv_{v}`",
                       f"last({seen}, true) {prev} AS `_pt_{v}`",
                       f"last({x}, true) {nxt} AS `_nv_{v}`",
                       f"last({seen}, true) {nxt} AS `_nt_{v}`"]
    u = u.selectExpr(*[_q(k) for k in keys], t, "_grid", *neighbours).filter("_grid = 1")

    out = [_interp_sql(v, f"`_pv_{v}`", f"`_pt_{v}`", f"`_nv_{v}`", f"`_nt_{v}`", t,
                       scale, precision) for v in value_cols]
    return u.selectExpr(*[_q(k) for k in keys], t, *out)


def _interp_sql(v: str, pv: str, pt: str, nv: str, nt: str, t: str,
                scale: int | None, precision: int) -> str:
    """Value at ``t`` from the previous (pv at pt) and next (nv at nt)
    samples: NULL before the first sample, held after the last one."""
    dt = f"timestampdiff(SECOND, {pt}, {t})"
    span = f"timestampdiff(SECOND, {pt}, {nt})"
    if scale is None:
        inner = f"{pv} + ({nv} - {pv}) * CAST({dt} AS DOUBLE) / CAST({span} AS DOUBLE)"
        hold = pv
    else:
        unit = 10 ** scale
        dec = f"DECIMAL({precision},{scale})"
        pu = f"CAST(round({pv} * {unit}) AS BIGINT)"
        nu = f"CAST(round({nv} * {unit}) AS BIGINT)"
        total = f"({pu} * {span} + ({nu} - {pu}) * {dt})"
        inner = f"CAST(CAST({half_away_sql(total, span)} AS DECIMAL(20,0)) / {unit} AS {dec})"
        hold = f"CAST(CAST({pu} AS DECIMAL(20,0)) / {unit} AS {dec})"
    return (f"CASE WHEN {pt} IS NULL THEN NULL "
            f"WHEN {dt} = 0 OR {nt} IS NULL OR {span} = 0 THEN {hold} "
            f"ELSE {inner} END AS {_q(v)}")


def interpolate_day_grid(samples: DataFrame, keys: Sequence[str], date_col: str, ts_col: str,
                         value_cols: Sequence[str], step_minutes: int = 10,
                         scale: int | None = 2, precision: int = 12) -> DataFrame:
    """``interpolate`` onto the whole-day grid (``spine``) of every key-day
    that has samples, computed from the samples alone.

    One window over the day's samples (at most one per sample time, so 24
    for hourly data) finds, per variable, the last value up to each sample
    and the first value after it; each sample row then expands into the
    grid points up to the next sample (the first row also covers the
    points from midnight).  No grid of days is aggregated separately and
    nothing is unioned, so the input is scanned once and the window sorts
    24 rows per day instead of 168.  ``keys`` must include ``date_col``;
    sample times must lie on the grid's day, on its points or between them.
    """
    keys = list(keys)
    part = ", ".join(_q(k) for k in keys)
    t = _q(ts_col)
    upto = (f"OVER (PARTITION BY {part} ORDER BY {t} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    after = (f"OVER (PARTITION BY {part} ORDER BY {t} DESC "
             f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    day0 = f"CAST({_q(date_col)} AS TIMESTAMP_NTZ)"
    cols = [*[_q(k) for k in keys], f"{t} AS _st",
            f"lead({t}) OVER (PARTITION BY {part} ORDER BY {t}) AS _next",
            f"row_number() OVER (PARTITION BY {part} ORDER BY {t}) = 1 AS _first"]
    for v in value_cols:
        x = f"CAST({_q(v)} AS DOUBLE)"
        seen = f"CASE WHEN {_q(v)} IS NOT NULL THEN {t} END"
        cols += [f"{x} AS `_v_{v}`",
                 f"last({x}, true) {upto} AS `_pv_{v}`",
                 f"last({seen}, true) {upto} AS `_pt_{v}`",
                 f"last({x}, true) {after} AS `_av_{v}`",
                 f"last({seen}, true) {after} AS `_at_{v}`"]
    w = samples.selectExpr(*cols)
    # Numbers of the first grid point at or after this sample and of the last
    # one before the next, so samples may lie between the grid points.
    us = step_minutes * 60_000_000
    def slot_from(ts: str) -> str:
        return f"((timestampdiff(MICROSECOND, {day0}, {ts}) + {us - 1}) div {us})"

    lo = f"CASE WHEN _first THEN 0L ELSE {slot_from('_st')} END"
    hi = f"({slot_from(f'coalesce(_next, {day0} + INTERVAL 1 DAY)')} - 1)"
    slots = f"explode(CASE WHEN {lo} <= {hi} THEN sequence({lo}, {hi}) ELSE array() END) AS _slot"
    g = w.selectExpr("*", slots).selectExpr(
        "*", f"timestampadd(MINUTE, CAST(_slot * {step_minutes} AS INT), {day0}) AS {t}")
    out = []
    for v in value_cols:
        # before this sample (first row only): no previous value; the next
        # one is this sample if it has the variable, else the one after it
        before = f"{t} < _st"
        pv = f"CASE WHEN {before} THEN NULL ELSE `_pv_{v}` END"
        pt = f"CASE WHEN {before} THEN NULL ELSE `_pt_{v}` END"
        nv = f"CASE WHEN {before} AND `_v_{v}` IS NOT NULL THEN `_v_{v}` ELSE `_av_{v}` END"
        nt = f"CASE WHEN {before} AND `_v_{v}` IS NOT NULL THEN _st ELSE `_at_{v}` END"
        out.append(_interp_sql(v, f"({pv})", f"({pt})", f"({nv})", f"({nt})", t, scale, precision))
    return g.selectExpr(*[_q(k) for k in keys], t, *out)
