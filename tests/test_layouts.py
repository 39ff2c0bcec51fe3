"""CSV files whose columns differ in order and number."""

import gzip
import os

from starloom.operators.contracts import RAW_PRODUCTION_CSV
from starloom.sources.csv import CORRUPT, LAYOUT, layouts, parse_production, read_all, read_day, split_quarantine

NAMES = RAW_PRODUCTION_CSV.names
VALUES = dict(zip(NAMES, ["1", "2024-06-15", "10-00-00", "T1", "2500", "L", "34.05", "-118.2", "A", "On", "Ops", "8.4", "NW",
                          "100.5"], strict=True))


def _put(folder, name, columns, rows, header=None, opener=open):
    os.makedirs(folder, exist_ok=True)
    with opener(f"{folder}/{name}", "wt", encoding="utf-8", newline="") as f:
        f.write((header or ",".join(columns)) + "\n")
        for r in rows:
            f.write(",".join((VALUES | r).get(c, "x") for c in columns) + "\n")


def test_columns_go_by_the_header(spark, tmp_path):
    root = str(tmp_path / "in")
    swapped = list(NAMES)
    i, k = swapped.index("latitude"), swapped.index("longitude")
    swapped[i], swapped[k] = swapped[k], swapped[i]
    _put(root, "20240615_a.csv", NAMES, [{"production_id": "1"}, {"production_id": "no"}])
    _put(root, "20240616_b.csv", swapped, [{"production_id": "2"}])
    _put(root, "20240617_c.csv", NAMES[::-1], [{"production_id": "3"}, {"production_id": "4", "latitude": "bad"}],
         header="﻿" + ",".join(f'"{c}"' for c in NAMES[::-1]) + "\r")
    _put(root, "20240618_d.csv.gz", swapped, [{"production_id": "5"}], opener=gzip.open)
    _put(root, "20240619_e.csv", [c for c in NAMES if c != "capacity"], [{"production_id": "6"}, {"production_id": "7"}])
    _put(root, "20240620_f.csv", [*NAMES, "note"], [{"production_id": "8"}])
    _put(root, "20240621_g.csv", [*NAMES, "region"], [{"production_id": "9"}])
    _put(root, "noday.csv", NAMES, [{"production_id": "10"}])
    open(f"{root}/20240622_empty.csv", "w").close()
    _put(root, "20240623_header_only.csv", swapped, [])

    good, bad = split_quarantine(parse_production(read_all(spark, root)))
    assert sorted((r.production_id, float(r.latitude), float(r.longitude), r.capacity, r.file_day) for r in good.collect()) == [
        (1, 34.05, -118.2, 2500, "20240615"), (2, 34.05, -118.2, 2500, "20240616"), (3, 34.05, -118.2, 2500, "20240617"),
        (5, 34.05, -118.2, 2500, "20240618")]
    assert sorted((r._reason, r.file_day) for r in bad.collect()) == [
        ("malformed", "20240615"), ("malformed", "20240617"), ("missing_column: capacity", "20240619"),
        ("missing_column: capacity", "20240619"), ("no_day", None), ("repeated_column: region", "20240621"),
        ("unknown_column: note", "20240620")]
    lines = [r[0] for r in bad.where(bad._reason.startswith("missing")).select(CORRUPT).collect()]
    assert all(x.startswith(("6,2024", "7,2024")) for x in lines)
    one = read_day(spark, root, "20240616").collect()
    assert len(one) == 1 and one[0].latitude == 34.05 and one[0][LAYOUT] is None


def test_only_selected_days_are_opened(spark, tmp_path, monkeypatch):
    from starloom.sources import csv as module
    root = str(tmp_path / "in")
    for day in ("20240615", "20240616", "20240617"):
        _put(f"{root}/file_day={day}", "part.csv", NAMES, [{"production_id": day}])
    opened, plain = [], module.header_of
    monkeypatch.setattr(module, "header_of", lambda s, f: opened.append(f) or plain(s, f))
    got = read_all(spark, root, days=("20240616", "20240616")).collect()
    assert [r.production_id for r in got] == [20240616] and len(opened) == 1
    assert read_all(spark, root, days=("20250101", "20250102")).collect() == []


def test_files_of_one_layout_share_a_reader(spark, tmp_path):
    root = str(tmp_path / "in")
    for n in range(5):
        _put(root, f"2024061{n}_x.csv", NAMES if n < 3 else NAMES[::-1], [{}])
    files = [f"file:{root}/{f}" for f in os.listdir(root)]
    assert sorted(len(v) for v in layouts(spark, files).values()) == [2, 3]
