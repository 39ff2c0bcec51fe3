"""Level 2: one small hand-made frame per semantic trap."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions.calendar import (clock_columns, compose_event_time, day_part,
                                         parse_dash_time, to_local)
from starloom.functions.keys import murmur_key, stable_key
from starloom.functions.measures import to_decimal
from starloom.operators import star
from starloom.operators.checks import check_unique, orphan_keys
from starloom.operators.timeseries import spine


def test_null_join_keys_strict_vs_null_safe(spark):
    # trap 1: a reading without weather has a NULL region_name
    rows = [("T1", 2500, Decimal("34.052200"), Decimal("-118.243700"), "A", None, "On", "Ops")]
    e = spark.createDataFrame(rows, "turbine_name string, capacity int, latitude decimal(9,6), "
                                    "longitude decimal(9,6), region string, region_name string, "
                                    "status string, responsible_department string")
    dims = {"turbine_dim": star.turbine_dim(e), "status_dim": star.status_dim(e),
            "location_dim": star.location_dim(e)}
    strict = star.with_fact_keys(e, strict=True, dims=dims).first()
    safe = star.with_fact_keys(e, dims=dims).first()
    derived = star.with_fact_keys(e).first()
    assert strict["turbine_id"] is None and strict["location_id"] is None
    assert safe["turbine_id"] is not None and safe["turbine_id"] == derived["turbine_id"]
    assert safe["location_id"] == derived["location_id"]
    # strict derivation reproduces the strict lookup without a join
    assert star.with_fact_keys(e, strict=True).first()["turbine_id"] is None


def test_weather_fact_collapse_is_deterministic(spark):
    # trap 3: distinct rows not unique on fact_weather_id
    rows = [(1, dt.date(2024, 6, 15), "00:10:00", 7, Decimal("5.00")),
            (1, dt.date(2024, 6, 15), "00:10:00", 7, Decimal("6.00"))]
    df = spark.createDataFrame(rows, "fact_weather_id long, date_id date, time_id string, "
                                     "location_id long, wind_speed decimal(6,2)")
    for _ in range(2):
        out = star.collapse_last(df.repartition(3), ["fact_weather_id"],
                                 ["date_id", "time_id", "location_id"]).collect()
        assert len(out) == 1 and out[0]["wind_speed"] == Decimal("6.00")


def test_clock_from_timestamp_not_text(spark):
    # trap 4
    df = spark.createDataFrame([(dt.datetime(2024, 6, 15, 5, 10, 7),)], "ts timestamp_ntz")
    r = df.select(*[c.alias(n) for n, c in clock_columns("ts").items()],
                  day_part(F.hour("ts")).alias("p")).first()
    assert (r["hour_of_day"], r["minute_of_hour"], r["second_of_minute"], r["p"]) == (5, 10, 7, "Morning")


@pytest.mark.parametrize("hour,label", [(4, "Night"), (5, "Morning"), (11, "Morning"),
                                        (12, "Afternoon"), (17, "Evening"), (20, "Evening"),
                                        (21, "Night"), (None, "Night")])
def test_day_part_bounds(spark, hour, label):
    df = spark.createDataFrame([(hour,)], "h int")
    assert df.select(day_part("h").alias("p")).first()["p"] == label


def test_dimension_key_narrower_than_row(spark):
    # trap 5: two capacities of one turbine share an id; one row survives
    rows = [("T1", 2500, "A", "AA"), ("T1", 3000, "A", "AA")]
    e = spark.createDataFrame(rows, "turbine_name string, capacity int, region string, "
                                    "region_name string") \
        .withColumn("latitude", F.lit(None).cast("decimal(9,6)")) \
        .withColumn("longitude", F.lit(None).cast("decimal(9,6)"))
    d = star.turbine_dim(e).collect()
    assert len(d) == 1 and d[0]["capacity"] == 3000
    assert star.turbine_dim(e, collapse=False).count() == 2


def test_key_text_depends_on_decimal_scale(spark):
    # trap 6: cast to the contract's decimal before hashing
    df = spark.createDataFrame([(34.0522,)], "lat double")
    k_dec = df.select(stable_key(F.col("lat").cast("decimal(9,6)")).alias("k")).first()["k"]
    k_txt = df.select(stable_key(F.lit("34.052200")).alias("k")).first()["k"]
    k_dbl = df.select(stable_key("lat").alias("k")).first()["k"]
    assert k_dec == k_txt and k_dec != k_dbl


def test_concat_ws_null_collision(spark):
    # trap 7: the plain form collides, the stable form does not
    df = spark.createDataFrame([("a", None, "b"), ("a_b", None, None)], "x string, y string, z string")
    r = df.select(murmur_key("x", "y", "z").alias("m"), stable_key("x", "y", "z").alias("s")).collect()
    assert r[0]["m"] == r[1]["m"]
    assert r[0]["s"] != r[1]["s"]


def test_murmur_key_is_non_negative_bigint(spark):
    # trap 8: abs over a widened value cannot overflow under ANSI
    df = spark.range(20000).select(murmur_key(F.col("id").cast("string")).alias("k"))
    assert dict(df.dtypes)["k"] == "bigint"
    assert df.filter("k < 0").count() == 0


def test_ansi_safe_time_parsing(spark):
    # traps 10 and 11
    df = spark.createDataFrame([("7-5-3",), ("07-05-03",), ("24-00-00",), ("bad",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_dash_time("t")).collect()]
    assert got == ["07:05:03", "07:05:03", None, None, None]


def test_event_time_from_text_before_retype(spark):
    # trap 14
    df = spark.createDataFrame([("2024-06-15", "00-10-00"), ("2024-13-01", "00-10-00")],
                               "date string, time string")
    got = [r[0] for r in df.select(compose_event_time("date", "time")).collect()]
    assert got == [dt.datetime(2024, 6, 15, 0, 10), None]


def test_rounding_half_up(spark):
    # trap 12 / O-64
    df = spark.createDataFrame([(2.345,), (-2.345,), (1.005,)], "v double")
    got = [r[0] for r in df.select(to_decimal("v", 6, 2)).collect()]
    assert got == [Decimal("2.35"), Decimal("-2.35"), Decimal("1.01")]


def test_fan_out_guard(spark):
    # trap 13: two names for one region would double the join
    rows = [(dt.date(2024, 6, 15), "00:10:00", "A", "Name 1"),
            (dt.date(2024, 6, 15), "00:10:00", "A", "Name 2")]
    w = spark.createDataFrame(rows, "date date, time string, region string, region_name string")
    assert check_unique(w, ["date", "time", "region"]).count() == 1
    assert check_unique(w, ["date", "time", "region", "region_name"]).count() == 0


def test_local_time_and_spine(spark):
    # traps 17/18: region-local wall clock; 144 slots per local day
    df = spark.createDataFrame([(dt.datetime(2024, 6, 15, 7, 0), "America/Los_Angeles")],
                               "ts timestamp_ntz, tz string")
    assert df.select(to_local("ts", "tz")).first()[0] == dt.datetime(2024, 6, 15, 0, 0)
    days = spark.createDataFrame([("A", dt.date(2024, 6, 15))], "region string, date date")
    g = spine(days).orderBy("ts").collect()
    assert len(g) == 144
    assert g[0]["ts"] == dt.datetime(2024, 6, 15, 0, 0)
    assert g[-1]["ts"] == dt.datetime(2024, 6, 15, 23, 50)


def test_orphans_ignore_null_foreign_keys(spark):
    f = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k long")
    d = spark.createDataFrame([(1,)], "k long")
    out = orphan_keys(f, ["k"], d).collect()
    assert [(r["k"], r["rows"]) for r in out] == [(2, 2)]


def test_rounding_is_one_step_and_fits_or_null(spark):
    df = spark.createDataFrame([(2.34499,), (8.004996,), (123456.0,), (float("nan"),)], "v double")
    got = [r[0] for r in df.select(to_decimal("v", 6, 2)).collect()]
    assert got == [Decimal("2.34"), Decimal("8.00"), None, None]


def test_key_text_is_collision_free(spark):
    df = spark.createDataFrame([("A_B", "C"), ("A", "B_C"), ("N", "x"), (None, "x"), ("", "x")],
                               "a string, b string")
    assert df.select(stable_key("a", "b").alias("k")).distinct().count() == 5
    rows = [("A_B", 1, "C"), ("A", 1, "B_C")]
    e = spark.createDataFrame(rows, "turbine_name string, capacity int, region string") \
        .withColumns({"region_name": F.lit("r"), "latitude": F.lit(None).cast("decimal(9,6)"),
                      "longitude": F.lit(None).cast("decimal(9,6)")})
    assert star.turbine_dim(e).count() == 2


def test_empty_axis_has_no_samples(spark):
    from starloom.operators.timeseries import hourly_axis
    df = spark.range(1).select(hourly_axis(F.lit(100), F.lit(100), F.lit(3600)).alias("same"),
                               hourly_axis(F.lit(100), F.lit(50), F.lit(3600)).alias("before"),
                               hourly_axis(F.lit(100), F.lit(200), F.lit(0)).alias("no_step"))
    assert [list(x) for x in df.first()] == [[], [], []]


def test_off_grid_samples_fill_the_grid(spark):
    # quarter-hour zones: samples at :45 still give the 144 points of the day
    from starloom.operators.timeseries import interpolate_day_grid
    day = dt.date(2024, 6, 15)
    rows = [("A", day, dt.datetime(2024, 6, 15, h, 45), float(h)) for h in range(24)]
    s = spark.createDataFrame(rows, "region string, date date, ts timestamp_ntz, v double")
    got = {r["ts"]: r["v"] for r in
           interpolate_day_grid(s, ["region", "date"], "date", "ts", ["v"]).collect()}
    assert sorted(got) == [dt.datetime(2024, 6, 15) + dt.timedelta(minutes=10 * i) for i in range(144)]
    assert got[dt.datetime(2024, 6, 15, 0, 40)] is None
    assert got[dt.datetime(2024, 6, 15, 1, 0)] == Decimal("0.25")
    assert got[dt.datetime(2024, 6, 15, 23, 50)] == Decimal("23.00")


def test_time_for_sink_uses_row_date(spark):
    # O-61: a HH:mm:ss text becomes a timestamp on the row's own date
    from starloom.functions.calendar import time_for_sink
    df = spark.createDataFrame([(dt.date(2024, 6, 15), "23:50:00"), (dt.date(2024, 6, 15), "bad")],
                               "date date, time string")
    got = [r[0] for r in df.select(time_for_sink("date", "time")).collect()]
    assert got == [dt.datetime(2024, 6, 15, 23, 50), None]


def test_date_gate_is_inclusive(spark):
    from starloom.operators.checks import date_gate
    df = spark.createDataFrame([(dt.date(2024, 6, 14),), (dt.date(2024, 6, 15),),
                                (dt.date(2024, 8, 3),), (dt.date(2024, 8, 4),)], "date date")
    got = [r[0] for r in date_gate(df, "date", "2024-06-15", "2024-08-03").orderBy("date").collect()]
    assert got == [dt.date(2024, 6, 15), dt.date(2024, 8, 3)]


def test_allowed_dates_fifty_days(spark):
    # O-30: the reference's loadable window holds 50 days
    from starloom.operators.checks import allowed_dates
    n = spark.range(1).select(F.size(allowed_dates(F.lit("2024-06-15").cast("date"),
                                                   F.lit("2024-08-03").cast("date")))).first()[0]
    assert n == 50


def test_epoch_axis_end_excluded(spark):
    # O-50 / O-62
    from starloom.operators.timeseries import hourly_axis
    start = 1718409600  # 2024-06-15 00:00:00 UTC
    df = spark.range(1).select(hourly_axis(F.lit(start), F.lit(start + 86400), F.lit(3600)).alias("a"))
    a = df.first()["a"]
    assert len(a) == 24 and a[0] == dt.datetime(2024, 6, 15, 0, 0) and a[-1] == dt.datetime(2024, 6, 15, 23, 0)
