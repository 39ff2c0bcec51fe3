"""Gap intervals, state runs and the zone-aware spine against brute force."""

import datetime as dt
import random
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from starloom.operators.intervals import gap_intervals, state_intervals, time_weighted_share
from starloom.operators.timeseries import zoned_spine

DAY = dt.datetime(2024, 6, 15)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_gaps_with_bounds_and_without(spark):
    rng = random.Random(1)
    rows = [(s, DAY + dt.timedelta(minutes=10 * rng.randrange(200))) for s in ("a", "b") for _ in range(60)]
    rows += [("a", None), (None, DAY), *rows[:5]]
    df = spark.createDataFrame(rows, "series string, slot timestamp_ntz")
    bounds = [("a", DAY, DAY + dt.timedelta(minutes=1990)), ("none", DAY, DAY + dt.timedelta(minutes=20)),
              ("b", DAY - dt.timedelta(minutes=30), DAY + dt.timedelta(minutes=500))]

    def brute(spans):
        out = []
        for s, lo, hi in spans:
            have, run, t = {x for k, x in rows if k == s}, None, lo
            while t <= hi + dt.timedelta(minutes=10):
                if t <= hi and t not in have:
                    run = run or t
                elif run:
                    out.append((s, run, t - dt.timedelta(minutes=10), int((t - run).total_seconds()) // 600))
                    run = None
                t += dt.timedelta(minutes=10)
        return sorted(out, key=repr)

    given = spark.createDataFrame(bounds, "series string, lo timestamp_ntz, hi timestamp_ntz")
    assert _rows(gap_intervals(df, ["series"], "slot", 10, given)) == brute(bounds)
    spans = []
    for s in ("a", "b"):
        mine = [t for k, t in rows if k == s and t]
        spans.append((s, DAY.replace(day=min(mine).day), max(mine).replace(hour=23, minute=50)))
    assert _rows(gap_intervals(df.where("series is not null"), ["series"], "slot", 10)) == brute(spans)
    assert gap_intervals(df.limit(0), ["series"], "slot", 10).collect() == []


def test_state_runs_and_shares(spark):
    rng = random.Random(2)
    rows = []
    for unit, n, span in (("hot", 600, 3), ("slow", 40, 400), ("one", 1, 1)):  # minutes between rows
        t = DAY
        for k in range(n):
            rows.append((unit, t, rng.choice(["on", "on", "off", None]), k))
            t += dt.timedelta(minutes=rng.choice([0, 1, span, span * 7]))
    rows.append(("hot", None, "on", -1))
    df = spark.createDataFrame(rows, "unit string, ts timestamp_ntz, state string, n int").repartition(4)
    want = []
    for unit in ("hot", "slow", "one"):
        last = {}
        for u, t, s, k in rows:
            if u == unit and t is not None and (t not in last or k > last[t][1]):
                last[t] = (s, k)
        times, opens = sorted(last), []
        for i, t in enumerate(times):
            if not i or last[times[i - 1]][0] != last[t][0]:
                opens.append(t)
        want += [(unit, last[t][0], t, (opens + [times[-1]])[i + 1] if i + 1 < len(opens) else times[-1])
                 for i, t in enumerate(opens)]
    runs = state_intervals(df, ["unit"], "ts", "state", ["n"])
    assert _rows(runs) == sorted(want, key=repr)
    got = {r.unit: r for r in time_weighted_share(runs, ["unit"], ["on"]).collect()}
    for unit in ("hot", "slow"):
        mine = [w for w in want if w[0] == unit]
        total = sum((w[3] - w[2]).total_seconds() for w in mine)
        on = sum((w[3] - w[2]).total_seconds() for w in mine if w[1] == "on")
        assert (got[unit].seconds, got[unit].seconds_in, got[unit].runs) == (total, on, len(mine))
        assert abs(float(got[unit].share) - on / total) <= 5.1e-5
    assert got["one"].share is None and got["one"].seconds == 0


def test_zoned_days(spark):
    zones = ["America/New_York", "Europe/Berlin", "America/Havana", "Australia/Lord_Howe", "Asia/Kolkata", "UTC"]
    days = [dt.date(2024, 3, 10), dt.date(2024, 11, 3), dt.date(2024, 3, 31), dt.date(2024, 10, 27), dt.date(2024, 4, 7),
            dt.date(2024, 10, 6), dt.date(2024, 6, 1)]
    df = spark.createDataFrame([(d, z) for d in days for z in zones], "date date, zone string")
    got = {}
    for r in zoned_spine(df, "zone").collect():
        got.setdefault((r.zone, r.date), []).append((r.ts_utc, r.ts, r.time, r.again))
    for (zone, day), rows in got.items():
        z = ZoneInfo(zone)
        now = dt.datetime(day.year, day.month, day.day, tzinfo=z).astimezone(dt.UTC)
        end = (dt.datetime(day.year, day.month, day.day, tzinfo=z) + dt.timedelta(days=1)).astimezone(dt.UTC)
        want = []
        while now < end:
            local = now.astimezone(z)
            want.append((now.replace(tzinfo=None), local.replace(tzinfo=None, fold=0), local.strftime("%H:%M:%S")))
            now += dt.timedelta(minutes=10)
        assert sorted(r[:3] for r in rows) == want, (zone, day)
        seen: set = set()
        for r in sorted(rows):
            assert r[3] == (r[1] in seen), (zone, day, r)
            seen.add(r[1])
    assert len(got[("America/New_York", days[0])]) == 138 and len(got[("America/New_York", days[1])]) == 150
    assert df.count() == len(got)


def test_long_series_are_spread_by_hour(spark):
    df = spark.range(2000).select(F.lit("u").alias("unit"), F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id as int), 0)").alias("ts"),
        F.expr("cast(id % 2 as string)").alias("state"))
    assert state_intervals(df, ["unit"], "ts", "state").count() == 2000


def test_weather_of_days_with_a_clock_change(spark):
    """Hourly payloads of a zone's local days: linear in time, slots named by the wall clock."""
    from starloom.plans.medallion import bronze_weather
    from starloom.sources.payload import PAYLOAD_SCHEMA
    zone, rows = ZoneInfo("America/New_York"), []
    for day in (dt.date(2024, 3, 10), dt.date(2024, 11, 3), dt.date(2024, 6, 1)):
        lo, hi = (int(dt.datetime(d.year, d.month, d.day, tzinfo=zone).timestamp()) for d in (day, day + dt.timedelta(days=1)))
        n = (hi - lo) // 3600
        values = [float(k * 6) for k in range(n)]
        rows.append(("A", "a", zone.key, str(day), "ok", 0.0, 0.0, (lo, hi, 3600, values, values, None)))
    out = bronze_weather(spark.createDataFrame(rows, PAYLOAD_SCHEMA)).collect()
    by = {}
    for r in out:
        by.setdefault(str(r.date), {})[r.time] = r.wind_gusts_10m
    assert {d: len(v) for d, v in by.items()} == {"2024-03-10": 138, "2024-11-03": 144, "2024-06-01": 144}
    assert len(out) == 138 + 144 + 144
    spring, autumn = by["2024-03-10"], by["2024-11-03"]
    # One value a ten minutes since midnight; held after the last sample.
    assert spring["01:50:00"] == 11 and spring["03:00:00"] == 12 and "02:00:00" not in spring
    assert spring["23:00:00"] == 132 == spring["23:50:00"]
    assert autumn["01:30:00"] == 9 and autumn["02:00:00"] == 18 and autumn["23:00:00"] == 144
