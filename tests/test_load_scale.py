"""What a load of many readings must not do: sort or move whole rows to see
that no key repeats, or build each dimension from all readings."""

import datetime as dt
from decimal import Decimal

import pytest

from starloom.functions.calendar import compose_event_time, event_time, parse_dash_clock, parse_iso_date
from starloom.operators import load, star
from starloom.operators.contracts import SILVER_ENRICHED
from starloom.operators.load import IntegrityError, at_once, stage_days, stage_replacement
from starloom.operators.versions import Tables
from starloom.session import cut_lineage, scratch_path

ROWS = "k long, day string, v string"


def test_replacement_checks_keys_without_sorting_rows(spark, monkeypatch):
    def unused(*args, **kw):
        raise AssertionError("whole rows were grouped")

    monkeypatch.setattr(load, "dedupe_last", unused)
    tables = Tables(spark, scratch_path(spark, "replace"))
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (1, "b", "z"), (None, "a", "n"), (None, "a", "m")], ROWS)
    done = stage_replacement(tables, "t", rows, ["k", "day"], "day", ["a", "b"])
    assert (done.processed, done.inserted, done.updated, done.deleted) == (5, 5, 0, 0)
    assert sorted(map(str, tables.read("t").collect())) == sorted(map(str, rows.collect()))
    again = stage_replacement(tables, "t", rows.where("v in ('x', 'z')"), ["k", "day"], "day", ["a", "b"])
    assert (again.processed, again.inserted, again.updated) == (2, 0, 2)
    with pytest.raises(IntegrityError, match="more than once"):
        stage_replacement(tables, "t", rows.unionByName(rows), ["k", "day"], "day", ["a", "b"])
    assert tables.read("t").count() == 2
    assert stage_replacement(tables, "t", rows.where("false"), ["k", "day"], "day", ["a"]).processed == 0


def enriched_rows(spark):
    plain = {"production_id": 1, "turbine_name": "U1", "region": "r", "status": "on", "responsible_department": "d",
             "region_name": "R", "capacity": 1000, "location_name": "here", "latitude": Decimal("1.5"),
             "longitude": Decimal("-2"), "date": dt.date(2024, 1, 1), "time": "00:10:00"}
    variants = [{}, {}, {"turbine_name": "U2"}, {"capacity": 900}, {"capacity": None}, {"turbine_name": None},
                {"region": None}, {"status": None}, {"latitude": None}, {"region_name": None}, {"region_name": "Z"},
                {"date": dt.date(2024, 1, 2)}, {"time": None}]
    schema = "struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in SILVER_ENRICHED) + ">"
    return spark.createDataFrame([tuple((plain | v).get(c) for c in SILVER_ENRICHED.names) for v in variants], schema[7:-1])


def test_dimensions_come_from_the_distinct_attributes(spark):
    e = cut_lineage(enriched_rows(spark))
    things = star.distinct_things(e)
    plan = things._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    want, got = star.build_dimensions(e), star.build_dimensions(e, things=cut_lineage(things))
    for name in want:
        assert got[name].schema.names == want[name].schema.names
        assert sorted(map(str, got[name].collect())) == sorted(map(str, want[name].collect())), name


def test_days_that_are_clustered_stay_where_they_are(spark):
    tables = Tables(spark, scratch_path(spark, "days"))
    rows = spark.createDataFrame([(i, f"d{i % 3}", None if i % 5 else "v") for i in range(40)], ROWS)
    stage_days(tables, "t", rows, "day", ["d0", "d1", "d2"], clustered=True)
    assert tables.partitions("t") == {"d0", "d1", "d2"}
    assert sorted(map(str, tables.read("t").collect())) == sorted(map(str, rows.collect()))


def test_event_time_of_parsed_parts(spark):
    texts = [("2024-02-29", "23-59-59"), ("2024-1-1", "0-0-0"), ("1900-03-01", "7-5-3"), (None, "1-2-3"),
             ("2024-02-30", "1-2-3"), ("2024-02-28", "24-00-00"), ("2024-02-28", None)]
    df = spark.createDataFrame(texts, "d string, t string")
    got = [tuple(r) for r in df.select(event_time(parse_iso_date("d"), parse_dash_clock("t")),
                                       compose_event_time("d", "t")).collect()]
    first = dt.datetime(2024, 2, 29, 23, 59, 59), dt.datetime(1900, 3, 1, 7, 5, 3)
    assert got[0] == (first[0],) * 2 and got[2] == (first[1],) * 2
    assert got[3:] == [(None, None)] * 4 and got[1][0] == got[1][1]


def test_steps_at_once_give_results_in_order_and_their_errors():
    assert at_once(lambda: 1, lambda: 2) == [1, 2]
    with pytest.raises(ZeroDivisionError):
        at_once(lambda: 1, lambda: 1 / 0)
