"""Intervals over time series: gaps of a grid (O-30, O-74) and runs of equal
states with shares weighted by time (O-77).

Gaps are found among the distinct slots of a series.  These are a partial
aggregate bounded by the calendar (52,560 ten-minute slots a year), not by
the readings, so one window pass per series holds them.

States are compared inside buckets of one unit and hour.  What buckets tell
their neighbours (last state, first change) are rows of a summary, one per
unit and hour, so no window holds a unit's whole history of readings and a
unit with a third of all readings is spread over its hours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.measures import div_half_away, from_units


def gap_intervals(readings: DataFrame, series: Sequence[str], ts_col: str, step_minutes: int,
                  bounds: DataFrame | None = None) -> DataFrame:
    """``series..., first_missing, last_missing, missing``: the longest runs of
    slots without a reading.

    ``ts_col`` lies on the grid.  ``bounds`` (series..., lo, hi; both slots
    included) says where each series is expected, also series without any
    reading; without it, from its first slot's midnight to its last slot's
    day's end."""
    series = list(series)
    step = F.expr(f"INTERVAL {step_minutes} MINUTES")
    slots = readings.select(*series, F.col(ts_col).alias("slot")).where("slot is not null").distinct()
    if bounds is None:
        bounds = slots.groupBy(*series).agg(
            F.date_trunc("day", F.min("slot")).cast("timestamp_ntz").alias("lo"),
            (F.date_trunc("day", F.max("slot")).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY") - step).alias("hi"))
    # A slot before the first expected one and one after the last close the edges.
    edges = bounds.select(*series, F.explode(F.array(F.col("lo") - step, F.col("hi") + step)).alias("slot"), "lo", "hi")
    inside = slots.join(bounds, series).where("slot between lo and hi").select(*series, "slot", "lo", "hi")
    before = F.lag("slot").over(Window.partitionBy(*series).orderBy("slot"))
    return inside.unionByName(edges).withColumn("before", before).where(F.col("slot") > F.col("before") + step).select(
        *series, (F.col("before") + step).alias("first_missing"), (F.col("slot") - step).alias("last_missing"),
        (F.timestamp_diff("MINUTE", F.col("before"), F.col("slot")) / step_minutes - 1).cast("long").alias("missing"))


def state_intervals(rows: DataFrame, unit: Sequence[str], ts_col: str, state_col: str,
                    tie_break: Sequence[str] = ()) -> DataFrame:
    """``unit..., state, start, stop``: the longest runs of equal states.

    A state holds until the unit's next row; the last run ends at the unit's
    last row.  Of rows with one time the last by ``tie_break`` and state counts."""
    unit = list(unit)
    tie = [*tie_break, state_col]
    rows = rows.where(F.col(ts_col).isNotNull()).groupBy(*unit, F.col(ts_col).alias("at")).agg(
        F.max(F.struct(*tie)).getField(state_col).alias("state")).withColumn("hour", F.date_trunc("hour", "at"))
    hour = Window.partitionBy(*unit, "hour").orderBy("at")
    seen = rows.withColumn("before", F.lag(F.struct("state")).over(hour))
    # Per hour: its first and last state and its first change after the first row.
    changed = F.col("before").isNotNull() & ~F.col("before.state").eqNullSafe(F.col("state"))
    summary = rows.select(*unit, "hour", "at", "state").groupBy(*unit, "hour").agg(
        F.min(F.struct("at", "state")).alias("first"), F.max(F.struct("at", "state")).alias("last"))
    hours = Window.partitionBy(*unit).orderBy("hour")  # one row per hour
    summary = summary.withColumn("carried", F.lag("last").over(hours)).withColumn(
        "last_at", F.max("last.at").over(Window.partitionBy(*unit)))
    opens = F.col("carried").isNull() | ~F.col("carried.state").eqNullSafe(F.col("first.state"))
    starts = seen.where(changed).select(*unit, "hour", "at", "state").unionByName(
        summary.where(opens).select(*unit, "hour", "first.at", "first.state"))
    # The next start: in the hour, else the first one of a later hour.
    firsts = starts.groupBy(*unit, "hour").agg(F.min("at").alias("start"))
    after = F.min("start").over(hours.rowsBetween(1, Window.unboundedFollowing))
    later = summary.select(*unit, "hour", "last_at").join(firsts, [*unit, "hour"], "left").withColumn("after", after)
    inside = starts.withColumn("next", F.lead("at").over(hour))
    return inside.join(later.select(*unit, "hour", "after", "last_at"), [*unit, "hour"]).select(
        *unit, "state", F.col("at").alias("start"), F.coalesce("next", "after", "last_at").alias("stop"))


def time_weighted_share(intervals: DataFrame, unit: Sequence[str], states: Sequence[str]) -> DataFrame:
    """``unit..., seconds, seconds_in, runs, share``: the part of the observed time
    that the unit was in one of the states (whole seconds, 4 digits, half away
    from zero; NULL for a unit observed at one moment)."""
    length = F.timestamp_diff("SECOND", F.date_trunc("second", "start"), F.date_trunc("second", "stop"))
    hit = F.coalesce(F.col("state").isin(list(states)), F.lit(False))
    agg = intervals.groupBy(*unit).agg(
        F.sum(length).alias("seconds"), F.sum(F.when(hit, length).otherwise(0)).alias("seconds_in"),
        F.count(F.lit(1)).alias("runs"))
    return agg.select(*unit, "seconds", "seconds_in", "runs", F.when(
        F.col("seconds") > 0, from_units(div_half_away(F.col("seconds_in") * 10000, F.col("seconds")), 7, 4)).alias("share"))
