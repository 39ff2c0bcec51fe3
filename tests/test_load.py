"""Loads: partition-scoped upserts and the incremental file stream."""

import datetime as dt
import os

from pyspark.sql import functions as F

from starloom.operators.contracts import RAW_PRODUCTION_CSV
from starloom.operators.load import upsert_table
from starloom.operators.versions import Tables, expire, read_published, versions
from starloom.session import scratch_path
from starloom.streaming.daily_load import start_daily_load

SF001 = "/root/testdata/sf0.001"


def _files(path):
    out = {}
    for d, _, fs in os.walk(path.replace("file:", "")):
        for f in fs:
            if f.endswith(".parquet"):
                p = os.path.join(d, f)
                out[p] = os.stat(p).st_mtime_ns
    return out


def test_upsert_rewrites_touched_partitions_only(spark):
    root = scratch_path(spark, "t-upsert")
    d1, d2, d3 = dt.date(2024, 6, 15), dt.date(2024, 6, 16), dt.date(2024, 6, 17)
    first = spark.createDataFrame([(1, d1, "a"), (2, d2, "b"), (3, d3, "c")],
                                  "k long, date date, v string")
    r1 = upsert_table(spark, root, "t", first, ["k"], partition_col="date")
    assert (r1.inserted, r1.updated) == (3, 0)
    before, parts = _files(root), dict(Tables(spark, root).parts["t"])
    # key 1 moves from d1 to d2; key 4 is new on d2; d3 is untouched
    batch = spark.createDataFrame([(1, d2, "a2"), (4, d2, "d")], "k long, date date, v string")
    r2 = upsert_table(spark, root, "t", batch, ["k"], partition_col="date")
    assert (r2.processed, r2.inserted, r2.updated) == (2, 1, 1)
    assert r2.touched == ["2024-06-15", "2024-06-16"]
    got = sorted(tuple(r) for r in read_published(spark, root, "t").select("k", "date", "v").collect())
    assert got == [(1, d2, "a2"), (2, d2, "b"), (3, d3, "c"), (4, d2, "d")]
    now = Tables(spark, root).parts["t"]
    assert now.keys() == {"2024-06-16", "2024-06-17"} and now["2024-06-17"] == parts["2024-06-17"]
    after = _files(root)
    assert all(after[p] == before[p] for p in before)  # old folders are immutable
    # idempotent: the same batch again changes nothing
    r3 = upsert_table(spark, root, "t", batch, ["k"], partition_col="date")
    assert (r3.inserted, r3.updated) == (0, 2)
    assert read_published(spark, root, "t").count() == 4
    assert read_published(spark, root, "t", [d3]).count() == 1 and read_published(spark, root, "t", []).count() == 0


def test_empty_source_is_skipped(spark):
    root = scratch_path(spark, "t-empty")
    empty = spark.createDataFrame([], "k long, v string")
    assert upsert_table(spark, root, "t", empty, ["k"]).skipped and versions(spark, root) == []
    upsert_table(spark, root, "t", spark.createDataFrame([(1, "a")], "k long, v string"), ["k"])
    assert upsert_table(spark, root, "t", empty, ["k"]).skipped and len(versions(spark, root)) == 1


def test_a_load_that_fails_at_any_write_changes_nothing(spark, monkeypatch):
    """Every write of a day load in turn fails; readers keep the version before it."""
    import pytest
    from starloom.plans.fixtures import write_payloads
    from starloom.plans.medallion import run_day_load
    root = scratch_path(spark, "t-crash")
    payloads = write_payloads(spark, SF001)
    names = ("silver_production", "silver_enriched", "fact_energy", "fact_weather", "date_dim", "bronze_production")

    def content():
        tables = Tables(spark, f"{root}/out")
        return {n: sorted(map(str, tables.read(n).drop("ingested_at").collect())) for n in names}

    _write_day(spark, f"{root}/a", "2024-01-15", [(1, "10-00-00"), (2, "00-20-00")], region="click")
    run_day_load(spark, f"{root}/a", payloads, f"{root}/out", date_range=("2024-01-15", "2024-01-16"))
    before = content()
    _write_day(spark, f"{root}/b", "2024-01-15", [(1, "09-00-00"), (3, "00-30-00")], region="click")
    plain, calls = Tables.write, []

    def failing(at):
        def write(self, *a, **k):
            calls.append(a[0])
            if len(calls) > at:
                raise IOError("lost")
            return plain(self, *a, **k)
        return write

    writes = 0
    while True:
        calls.clear()
        with monkeypatch.context() as m:
            m.setattr(Tables, "write", failing(writes))
            try:
                run_day_load(spark, f"{root}/b", payloads, f"{root}/out", date_range=("2024-01-15", "2024-01-16"))
                break
            except IOError:
                assert content() == before
        writes += 3
    assert writes >= 12 and content() != before
    with monkeypatch.context() as m:  # the switch itself fails
        now = content()
        m.setattr(Tables, "publish", lambda self: (_ for _ in ()).throw(IOError("lost")))
        with pytest.raises(IOError):
            run_day_load(spark, f"{root}/a", payloads, f"{root}/out", date_range=("2024-01-15", "2024-01-16"))
        assert content() == now
    # A version without Spark's commit mark does not count.
    os.makedirs(f"{root}/out/_versions/000000099-half".replace("file:", ""))
    assert content() == now and len(versions(spark, f"{root}/out")) == 2
    assert expire(spark, f"{root}/out", keep=1) > 0 and content() == now and len(versions(spark, f"{root}/out")) == 1


def test_a_corrected_reading_moves_in_every_layer(spark):
    from starloom.plans.fixtures import write_payloads
    from starloom.plans.medallion import run_day_load
    root = scratch_path(spark, "t-moved")
    payloads = write_payloads(spark, SF001)
    _write_day(spark, f"{root}/a", "2024-01-15", [(1, "10-00-00", 100.0), (2, "10-00-00", 7.0)], region="click")
    _write_day(spark, f"{root}/a", "2024-01-16", [(3, "05-00-00", 5.0)], region="click")
    run_day_load(spark, f"{root}/a", payloads, f"{root}/out")
    # Reading 1 is corrected to 09:00, reading 3 to the day before; both lie in the file of their day.
    _write_day(spark, f"{root}/b", "2024-01-15", [(1, "09-00-00", 50.0)], region="click")
    _write_day(spark, f"{root}/b/file_day=20240116", "2024-01-15", [(3, "23-50-00", 6.0)], folder="moved", region="click")
    done = {r.table: r for r in run_day_load(spark, f"{root}/b", payloads, f"{root}/out")}
    tables = Tables(spark, f"{root}/out")
    want = [(1, "2024-01-15", "09:00:00", 50.0), (2, "2024-01-15", "10:00:00", 7.0), (3, "2024-01-15", "23:50:00", 6.0)]

    def rows(name, *cols):
        return sorted((r[0], str(r[1]), r[2], float(r[3])) for r in tables.read(name).select(*cols).collect())

    assert rows("silver_production", "production_id", "date", "time", "energy_produced") == want
    assert rows("silver_enriched", "production_id", "date", "time", "energy_produced") == want
    assert rows("fact_energy", "fact_production_id", "date_id", "time_id", "energy_produced") == want
    slots = {(str(r[0]), r[1]) for r in tables.read("fact_weather").select("date_id", "time_id").collect()}
    assert slots <= {w[1:3] for w in want}
    assert (done["silver_enriched"].inserted, done["silver_enriched"].updated, done["silver_enriched"].deleted) == (2, 1, 2)
    assert "2024-01-16" not in tables.partitions("fact_energy")


def test_late_weather_reaches_gold(spark):
    from starloom.plans.fixtures import write_payloads
    from starloom.plans.medallion import run_day_load
    root = scratch_path(spark, "t-weather")
    payloads = write_payloads(spark, SF001)
    _write_day(spark, f"{root}/a", "2024-01-15", [(1, "10-00-00")], region="click")
    spark.read.json(payloads).where("date > '2024-01-20'").write.json(f"{root}/early")
    done = {r.table: r for r in run_day_load(spark, f"{root}/a", f"{root}/early", f"{root}/out")}
    assert done["fact_weather"].dropped == 1 and done["fact_energy"].dropped == 0
    tables = Tables(spark, f"{root}/out")
    assert tables.read("silver_enriched").where("weather_id is not null").count() == 0 and not tables.exists("fact_weather")
    _write_day(spark, f"{root}/b", "2024-01-16", [(2, "10-00-00")], region="click")
    done = {r.table: r for r in run_day_load(spark, f"{root}/b", payloads, f"{root}/out")}
    assert done["fact_weather"].dropped == 0
    tables = Tables(spark, f"{root}/out")
    assert tables.read("silver_enriched").where("weather_id is not null").count() == 2
    assert tables.read("fact_weather").count() == 2


def test_batches_do_not_change_the_table(spark):
    from starloom.sources.csv import parse_production, read_day
    from starloom.streaming.daily_load import load_batch
    root = scratch_path(spark, "t-batches")
    _write_day(spark, f"{root}/in", "2024-06-16", [(1, "09-00-00"), (2, "08-00-00")])
    _write_day(spark, f"{root}/in", "2024-06-15", [(1, "10-00-00"), (3, "07-00-00")])
    one, two = (parse_production(read_day(spark, f"{root}/in", d)) for d in ("20240615", "20240616"))
    tables = []
    for name, batches in {"both": [one.unionByName(two)], "up": [one, two], "down": [two, one]}.items():
        for i, b in enumerate(batches):
            load_batch(b, i, f"{root}/{name}", f"{root}/{name}-quarantine")
        tables.append(sorted((r["production_id"], str(r["date"]), r["time"])
                             for r in read_published(spark, f"{root}/{name}", "silver_production").collect()))
    assert tables[0] == tables[1] == tables[2]
    assert tables[0][0] == (1, "2024-06-16", "09:00:00")


def test_absent_day_is_an_error(spark):
    import pytest
    from starloom.sources.csv import read_day
    with pytest.raises(FileNotFoundError):
        read_day(spark, scratch_path(spark, "t-none"), "20240615")


def test_late_row_leaves_the_other_day_alone(spark):
    from starloom.plans.fixtures import write_payloads
    from starloom.plans.medallion import run_day_load
    root = scratch_path(spark, "t-days")
    payloads = write_payloads(spark, SF001)
    _write_day(spark, f"{root}/a", "2024-06-15", [(1, "00-10-00"), (2, "00-20-00"), (9, "24-00-00")])
    run_day_load(spark, f"{root}/a", payloads, f"{root}/out")
    _write_day(spark, f"{root}/b", "2024-06-16", [(3, "00-10-00")])
    _write_day(spark, f"{root}/b/file_day=20240616", "2024-06-15", [(4, "00-30-00")], folder="late")
    done = {r.table: r for r in run_day_load(spark, f"{root}/b", payloads, f"{root}/out")}
    assert done["silver_production"].processed == 2
    bronze = read_published(spark, f"{root}/out", "bronze_production")
    assert {r[0]: r[1] for r in bronze.groupBy("file_day").count().collect()} == {"20240615": 2, "20240616": 2}
    assert read_published(spark, f"{root}/out", "fact_energy").count() == 4
    # the corrected file of the first day has no bad row any more
    _write_day(spark, f"{root}/c", "2024-06-15", [(1, "00-10-00"), (2, "00-20-00"), (9, "00-40-00")])
    run_day_load(spark, f"{root}/c", payloads, f"{root}/out")
    assert "20240615" not in Tables(spark, f"{root}/out").partitions("quarantine")


def _write_day(spark, landing, day, rows, folder=None, region="A"):
    cols = [f.name for f in RAW_PRODUCTION_CSV.fields]
    df = spark.createDataFrame(
        [(str(pid), day, tm, "T1", 2500, "L", 34.0522, -118.2437, region, "On", "Ops", 8.41, "NW",
          float(*energy) if energy else 100.5) for pid, tm, *energy in rows],
        "production_id string, date string, time string, turbine_name string, capacity int, "
        "location_name string, latitude double, longitude double, region string, status string, "
        "responsible_department string, wind_speed double, wind_direction string, "
        "energy_produced double").select(*cols)
    folder = folder or f"file_day={day.replace('-', '')}"
    df.coalesce(1).write.option("header", True).csv(f"{landing}/{folder}")


def test_stream_loads_new_files_only(spark):
    root = scratch_path(spark, "t-stream")
    landing, tables, quar, ck = (f"{root}/landing", f"{root}/tables", f"{root}/quarantine",
                                 f"{root}/_ck")
    _write_day(spark, landing, "2024-06-15", [(1, "00-10-00"), (2, "24-00-00")])
    start_daily_load(spark, landing, tables, quar, ck).awaitTermination()
    assert read_published(spark, tables, "silver_production").count() == 1
    # a new day lands, and a correction of reading 1
    _write_day(spark, landing, "2024-06-16", [(1, "00-20-00"), (3, "7-5-3")])
    start_daily_load(spark, landing, tables, quar, ck).awaitTermination()
    got = sorted((r["production_id"], str(r["date"]), r["time"])
                 for r in read_published(spark, tables, "silver_production").collect())
    assert got == [(1, "2024-06-16", "00:20:00"), (3, "2024-06-16", "07:05:03")]
    q = spark.read.parquet(quar)
    assert q.filter(F.col("_reason") == "bad_time").count() == 1


def test_command_line_load_with_date_gate(spark):
    from starloom.__main__ import main
    from starloom.plans.fixtures import write_payloads, write_production_csv
    csv_root = write_production_csv(spark, SF001)
    payloads = write_payloads(spark, SF001)
    out = scratch_path(spark, "t-cli")
    assert main(["load", "--csv", csv_root, "--payloads", payloads, "--out", out,
                 "--from", "2024-01-10", "--to", "2024-01-12"]) == 0
    dates = {r[0] for r in read_published(spark, out, "silver_production").select("date").distinct().collect()}
    assert dates == {dt.date(2024, 1, 10), dt.date(2024, 1, 11), dt.date(2024, 1, 12)}
    assert main(["report", "daily_totals", "--out", out]) == 0
    rep = spark.read.parquet(f"{out}/reports/daily_totals")
    assert {r[0] for r in rep.select("date_id").distinct().collect()} == dates


def test_replayed_micro_batch_changes_nothing(spark):
    from starloom.sources.csv import parse_production, read_all
    from starloom.streaming.daily_load import load_batch
    root = scratch_path(spark, "t-replay")
    _write_day(spark, f"{root}/landing", "2024-06-15", [(1, "00-10-00"), (2, "bad")])
    batch = parse_production(read_all(spark, f"{root}/landing"))
    load_batch(batch, 0, f"{root}/tables", f"{root}/quarantine")
    first = sorted(tuple(r) for r in read_published(spark, f"{root}/tables", "silver_production").collect())
    load_batch(batch, 0, f"{root}/tables", f"{root}/quarantine")  # replay after a failure
    again = sorted(tuple(r) for r in read_published(spark, f"{root}/tables", "silver_production").collect())
    assert first == again and len(first) == 1
    assert spark.read.parquet(f"{root}/quarantine").count() == 1


def test_contract_gate_rejects_long_text_and_null_keys(spark):
    from starloom.operators.load import contract_violations
    from starloom.operators.contracts import CONTRACTS, cast_to_contract
    d = spark.createDataFrame([(None, "x" * 150, "Ops")],
                              "status_id long, status string, responsible_department string")
    got = contract_violations({"status_dim": cast_to_contract(d, CONTRACTS["status_dim"])})
    assert sorted(got) == [("status_dim", "status varchar(100)", 1),
                           ("status_dim", "status_id not null", 1)]


def test_star_gate_blocks_publication(spark):
    import pytest
    from starloom.operators import star
    from starloom.operators.load import IntegrityError, load_star
    from starloom.plans import standins as st
    e = st.enriched(spark, SF001)
    dims, facts = star.build_dimensions(e), star.build_facts(e, for_load=True)
    # drop one status from its dimension: the energy fact now has orphans
    dims["status_dim"] = dims["status_dim"].filter(F.col("status") != "BUILDING")
    root = scratch_path(spark, "t-gate")
    with pytest.raises(IntegrityError, match="fact_energy.status_id"):
        load_star(spark, root, dims, facts)
    # nothing was published: the step is staged as a whole first
    assert versions(spark, root) == [] and not Tables(spark, root).exists("date_dim")
