"""Command line: the day load and the reports.

    python -m starloom load --csv DIR --payloads DIR --out DIR [--from D --to D]
    python -m starloom report {daily_totals,condition_impact,availability} --out DIR

``load`` runs bronze -> silver -> gold for the daily files (all days, or
the inclusive date range) and prints the counters; ``report`` reads the
gold tables written by ``load`` and writes the report as Parquet next to
them.  The session comes from ``spark-submit`` / the environment; only
missing settings are filled in.
"""

from __future__ import annotations

import argparse
import json
import sys

from starloom.session import get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="starloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--csv", required=True)
    ld.add_argument("--payloads", required=True)
    ld.add_argument("--out", required=True)
    ld.add_argument("--from", dest="lo")
    ld.add_argument("--to", dest="hi")
    rp = sub.add_parser("report")
    rp.add_argument("name", choices=["daily_totals", "condition_impact", "availability"])
    rp.add_argument("--out", required=True)
    rp.add_argument("--available-status", default="BUILDING")
    a = ap.parse_args(argv)
    spark = get_session(app_name=f"starloom-{a.cmd}")

    if a.cmd == "load":
        from starloom.plans.medallion import run_day_load
        if bool(a.lo) != bool(a.hi):
            ap.error("--from and --to go together")
        res = run_day_load(spark, a.csv, a.payloads, a.out,
                           date_range=(a.lo, a.hi) if a.lo else None)
        for r in res:
            print(json.dumps({"table": r.table, "processed": r.processed, "inserted": r.inserted,
                              "updated": r.updated, "avoided": r.avoided, "deleted": r.deleted,
                              "dropped": r.dropped, "skipped": r.skipped}))
        return 0

    from starloom.operators import reports
    from starloom.operators.versions import Tables
    tables = Tables(spark, a.out)
    t = {n: tables.read(n) for n in ("fact_energy", "turbine_dim", "status_dim")}
    if a.name == "daily_totals":
        df = reports.daily_totals(t["fact_energy"], t["turbine_dim"])
    elif a.name == "availability":
        df = reports.availability(t["fact_energy"], a.available_status, t["status_dim"],
                                  t["turbine_dim"])
    else:
        df = reports.condition_impact(tables.read("silver_enriched"))
    df.write.mode("overwrite").parquet(f"{a.out}/reports/{a.name}")
    print(json.dumps({"report": a.name, "path": f"{a.out}/reports/{a.name}"}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
