"""Ids without collisions, report states, rules per row, NaN payloads, ingestion time, the hot-user join."""

import datetime as dt
import shutil

from pyspark.sql import functions as F

from starloom.operators import reports
from starloom.operators.load import stage_replacement
from starloom.operators.registry import assign_ids
from starloom.operators.report_state import IMPACT_KEYS, daily_total_state, impact_state, merged_impact, period_totals
from starloom.operators.rules import column_rules, split_rows
from starloom.operators.versions import Tables
from starloom.plans import standins as st
from starloom.session import cut_lineage, scratch_path

SF001 = "/root/testdata/sf0.001"


def short_key(*parts, attempt=0):
    """Nine bits: a few hundred keys collide many times."""
    return F.pmod(F.xxhash64(*parts, F.lit(attempt)), F.lit(512))


def test_two_keys_with_one_hash_get_two_ids(spark):
    first = spark.range(150).select(F.concat(F.lit("n"), "id").alias("name"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("region"))
    ids = cut_lineage(assign_ids(first.unionByName(first), ["name", "region"], "key", key_fn=short_key))
    assert ids.count() == 150 == ids.select("key").distinct().count()
    hashed = first.select(short_key("name", "region")).distinct().count()
    assert hashed < 150  # some of them did collide
    # A second load: known ids stay, new ones avoid them.
    more = spark.range(100, 300).select(F.concat(F.lit("n"), "id").alias("name"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("region"))
    again = assign_ids(more, ["name", "region"], "key", ids, key_fn=short_key)
    everything = cut_lineage(again.unionByName(ids).distinct())
    assert again.count() == 200 and everything.count() == 300 == everything.select("key").distinct().count()
    assert assign_ids(more.limit(0), ["name", "region"], "key", ids, key_fn=short_key).collect() == []
    assert assign_ids(more.limit(0), ["name", "region"], "key").collect() == []
    # The same input gives the same ids.
    same = assign_ids(first, ["name", "region"], "key", key_fn=short_key)
    assert sorted(map(str, same.collect())) == sorted(map(str, ids.collect()))


def test_report_states_merge_to_the_full_reports(spark):
    """Three loads of some dates each, one of them corrected, against one computation over all."""
    e = cut_lineage(st.enriched(spark, SF001))
    tables = Tables(spark, scratch_path(spark, "t-state"))
    days = sorted(str(r[0]) for r in e.select("date").distinct().collect())
    wrong = e.withColumn("energy_produced", (F.col("energy_produced") * 2).cast("decimal(12,2)"))
    loads = [(days[:12], e), (days[10:20], wrong), (days[10:], e)]
    for touched, rows in loads:
        kept = dict(tables.parts.get("impact", {}))
        slice_ = rows.where(F.col("date").cast("string").isin(touched))
        stage_replacement(tables, "impact", impact_state(slice_), IMPACT_KEYS, "date", touched)
        assert all(tables.parts["impact"][d] == f for d, f in kept.items() if d not in touched)
    got = merged_impact(tables.read("impact"))
    want = reports.condition_impact(e)
    assert got.columns == want.columns and got.schema["avg_energy"].dataType == want.schema["avg_energy"].dataType
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    month = F.date_trunc("month", "date").alias("month")
    totals = period_totals(daily_total_state(e), month)
    plain = e.groupBy("turbine_name", "region", month).agg(F.count("*").alias("readings"), F.sum("energy_produced").cast("decimal(18,2)").alias("total_energy"))
    assert sorted(map(str, totals.collect())) == sorted(map(str, plain.select(*totals.columns).collect()))


def test_rows_that_break_rules_go_with_all_their_rules(spark):
    df = spark.createDataFrame([(1, "ok", 5.0), (None, "too long", 5.0), (3, None, 1e9), (None, "longest", None)],
                               "id long, name string, v double")
    good, bad = split_rows(df, column_rules(["id"], {"name": 6}, {"v": (4, 1)}))
    assert [tuple(r) for r in good.collect()] == [(1, "ok", 5.0)]
    assert sorted(r._broken for r in bad.collect()) == [
        ["id not null", "name varchar(6)"], ["id not null", "name varchar(6)"], ["v fits decimal(4,1)"]]
    assert split_rows(df, {})[0].count() == 4


def test_long_text_is_quarantined_and_the_load_goes_on(spark):
    from test_load import _write_day
    from starloom.plans.fixtures import write_payloads
    from starloom.plans.medallion import run_day_load
    root = scratch_path(spark, "t-long")
    _write_day(spark, f"{root}/a", "2024-01-15", [(1, "10-00-00")], region="x" * 60)
    _write_day(spark, f"{root}/a/file_day=20240115", "2024-01-15", [(2, "10-00-00")], folder="fine", region="click")
    run_day_load(spark, f"{root}/a", write_payloads(spark, SF001), f"{root}/out")
    tables = Tables(spark, f"{root}/out")
    assert [r[0] for r in tables.read("quarantine").select("_reason").collect()] == ["too_long: region varchar(50)"]
    assert [r[0] for r in tables.read("fact_energy").select("fact_production_id").collect()] == [2]


def test_nan_in_a_payload_is_null(spark, tmp_path):
    from starloom.sources.payload import payload_rows, read_payloads
    day = int(dt.datetime(2024, 6, 15, tzinfo=dt.UTC).timestamp())
    (tmp_path / "p.json").write_text(
        '{"region":"A","region_name":"a","timezone":"UTC","date":"2024-06-15","status":"ok","latitude":0.0,"longitude":0.0,'
        f'"hourly":{{"time":{day},"time_end":{day + 10800},"interval":3600,"wind_gusts_10m":[1.5,NaN,2.5],'
        '"temperature_2m":[NaN,NaN,NaN]}}\n')
    rows = payload_rows(read_payloads(spark, str(tmp_path))).orderBy("ts").collect()
    assert [r.wind_gusts_10m for r in rows] == [1.5, None, 2.5]
    assert [r.temperature_2m for r in rows] == [None] * 3 == [r.cloud_cover for r in rows]


def test_ingestion_time_is_the_time_of_the_load(spark):
    from starloom.functions.lineage import with_lineage
    before = spark.sql("select current_timestamp()").first()[0]
    rows = with_lineage(spark.range(3), "b", source_file=False).select("ingested_at", "batch_id").collect()
    after = spark.sql("select current_timestamp()").first()[0]
    assert len({r.ingested_at for r in rows}) == 1 and before <= rows[0].ingested_at <= after
    assert {r.batch_id for r in rows} == {"b"}


def test_readings_of_a_hot_user_are_split(spark, tmp_path):
    """A user with a third of all readings: the library's own join to the register."""
    for t in ("customer", "nation", "region"):
        shutil.copy(f"{SF001}/{t}.parquet", tmp_path)
    events = spark.read.parquet(f"{SF001}/events.parquet")
    rows = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(29))))
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(1).cast(events.schema["user_id"].dataType)).otherwise(F.col("user_id"))
    rows.select((F.col("event_id") * 100 + F.col("copy")).alias("event_id"), "ts", hot.alias("user_id"), "event_type", "value",
                "props").repartition(8).write.parquet(f"{tmp_path}/events.parquet")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
            "spark.sql.files.maxPartitionBytes": "32KB", "spark.sql.files.openCostInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = st.readings(spark, str(tmp_path))
        assert len(df.collect()) == rows.count()
        joins = [x for x in df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
                 if "SortMergeJoin" in x and "user_id" in x]
        assert joins and all("LeftOuter" in x for x in joins), joins
        assert any("skew=true" in x for x in joins), joins
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_reports_over_the_star_equal_those_over_the_readings(spark):
    from starloom.operators import star
    e = cut_lineage(st.enriched(spark, SF001))
    fact, dims = star.build_facts(e)["fact_energy"], star.build_dimensions(e)
    carried = star.fact_energy(star.with_fact_keys(e), *star.TURBINE_KEY, "status")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(reports.daily_totals(fact, dims["turbine_dim"])) == rows(reports.daily_totals(carried))
    assert rows(reports.availability(fact, "BUILDING", dims["status_dim"], dims["turbine_dim"])) \
        == rows(reports.availability(carried, "BUILDING"))
