"""Date and time-of-day column functions (Column -> Column).

Time of day is carried as ``HH:mm:ss`` text: the TIME type is not enabled
by default in Spark 4.1.  Clock attributes are always taken from a
timestamp, never by re-parsing the text (which would put it on today's
date in the session zone).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-part buckets on the hour of day, [start, end).
# Morning 5-12, Afternoon 12-17, Evening 17-21, everything else Night
# (a NULL hour falls into Night as well).
DAY_PARTS = (("Morning", 5, 12), ("Afternoon", 12, 17), ("Evening", 17, 21))
DAY_PART_DEFAULT = "Night"

TIME_TEXT = "HH:mm:ss"
DASH_TIME = "H-m-s"
ISO_DATE = "yyyy-MM-dd"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_columns(date: Column | str) -> dict[str, Column]:
    """day, month, quarter, year of a date (O-55)."""
    d = _c(date)
    return {
        "day": F.dayofmonth(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
    }


def clock_columns(ts: Column | str) -> dict[str, Column]:
    """hour_of_day, minute_of_hour, second_of_minute of a timestamp (O-56).

    Seconds are whole seconds (fractions are dropped, as an int column)."""
    t = _c(ts)
    return {
        "hour_of_day": F.hour(t),
        "minute_of_hour": F.minute(t),
        "second_of_minute": F.floor(F.second(t)).cast("int"),
    }


def time_text(ts: Column | str) -> Column:
    """Time of day as ``HH:mm:ss`` text (O-57)."""
    return F.date_format(_c(ts), TIME_TEXT)


def day_part_sql(hour_sql: str) -> str:
    """SQL text of the day-part bucket of an hour expression."""
    cases = " ".join(f"WHEN {hour_sql} >= {lo} AND {hour_sql} < {hi} THEN '{label}'"
                     for label, lo, hi in DAY_PARTS)
    return f"CASE {cases} ELSE '{DAY_PART_DEFAULT}' END"


def day_part(hour: Column | str) -> Column:
    """Morning / Afternoon / Evening / Night bucket of an hour (O-65)."""
    if isinstance(hour, str):
        return F.expr(day_part_sql(f"`{hour}`"))
    expr = None
    for label, lo, hi in DAY_PARTS:
        cond = (hour >= lo) & (hour < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(DAY_PART_DEFAULT)


def parse_dash_clock(text: Column | str) -> Column:
    """``HH-mm-ss`` (or short ``H-m-s``) text -> a timestamp that shows this
    time; NULL when the text is not a valid time of day, e.g. ``24-00-00`` (O-58)."""
    return F.try_to_timestamp(_c(text), F.lit(DASH_TIME))


def parse_dash_time(text: Column | str) -> Column:
    """``HH-mm-ss`` (or short ``H-m-s``) text -> ``HH:mm:ss`` (O-58)."""
    return time_text(parse_dash_clock(text))


def parse_iso_date(text: Column | str) -> Column:
    """``yyyy-MM-dd`` text -> DATE, NULL when invalid (O-59)."""
    return F.try_to_date(_c(text), ISO_DATE)


def compose_event_time(date_text: Column | str, dash_time_text: Column | str) -> Column:
    """Event timestamp from date text and dash-separated time text (O-60).

    Components are parsed separately so that short forms such as ``7-5-3``
    are accepted and an invalid part gives NULL instead of failing the
    whole file under ANSI mode."""
    return event_time(parse_iso_date(date_text), parse_dash_clock(dash_time_text))


def event_time(date: Column | str, clock: Column | str) -> Column:
    """Event timestamp from a date and a timestamp that shows the time of day;
    NULL when one of them is."""
    t = _c(clock)
    seconds = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return F.timestamp_add("SECOND", seconds, _c(date).cast("timestamp_ntz"))


def time_for_sink(date: Column | str, time_txt: Column | str) -> Column:
    """Timestamp carrying a ``HH:mm:ss`` time for sinks with a TIME column
    (O-61); the date part is the row's own date, not today's."""
    return F.try_to_timestamp(F.concat_ws(" ", F.date_format(_c(date), ISO_DATE), _c(time_txt)),
                              F.lit("yyyy-MM-dd HH:mm:ss"))


def epoch_to_timestamp(seconds: Column | str) -> Column:
    """Epoch seconds -> UTC wall-clock timestamp without zone (O-62);
    independent of the session time zone."""
    return F.timestamp_add("SECOND", _c(seconds), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def to_local(ts_utc: Column | str, tz: Column | str) -> Column:
    """UTC wall clock -> wall clock of the zone in ``tz`` (O-51)."""
    return F.to_timestamp_ntz(F.from_utc_timestamp(_c(ts_utc).cast("timestamp"), _c(tz)))


def floor_to_minutes(ts: Column | str, minutes: int) -> Column:
    """Floor a timestamp to a slot of ``minutes`` (must divide 60)."""
    if isinstance(ts, str):
        t = f"`{ts}`"
        return F.expr(f"make_timestamp_ntz(year({t}), month({t}), dayofmonth({t}), hour({t}), "
                      f"minute({t}) - minute({t}) % {minutes}, 0)")
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.minute(ts) - F.minute(ts) % minutes, F.lit(0))


def day_start(date: Column | str) -> Column:
    d = _c(date)
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.lit(0), F.lit(0), F.lit(0))


def time_attribute_sql(ts: str, date_col: str = "date", time_col: str = "time") -> dict[str, str]:
    """SQL text of the date, time text, calendar, clock and day-part columns
    of one timestamp column."""
    t = f"`{ts}`"
    return {
        date_col: f"to_date({t})",
        time_col: f"date_format({t}, '{TIME_TEXT}')",
        "day": f"dayofmonth({t})", "month": f"month({t})",
        "quarter": f"quarter({t})", "year": f"year({t})",
        "hour_of_day": f"hour({t})", "minute_of_hour": f"minute({t})",
        "second_of_minute": f"CAST(floor(second({t})) AS INT)",
        "time_period": day_part_sql(f"hour({t})"),
    }


def with_time_attributes(df, ts: str, date_col: str = "date", time_col: str = "time"):
    """Add date, time text, calendar, clock and day-part columns from one
    timestamp column (the silver transform of both inputs); written as SQL
    text so the plan is built with a handful of JVM calls."""
    exprs = time_attribute_sql(ts, date_col, time_col)
    return df.withColumns({k: F.expr(v) for k, v in exprs.items()})
