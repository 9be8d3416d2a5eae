"""Merges into a stored snapshot, and retention that deletes from stored tables."""

import datetime as dt
import os

from pyspark.sql import functions as F

from lunchbox.operators import maintenance
from lunchbox.sources import history, sinks


def stamp(day):
    return F.lit(f"2025-01-{day:02d} 00:00:00").cast("timestamp_ntz")


def files(path):
    return {os.path.join(top, f): os.stat(os.path.join(top, f)).st_mtime_ns for top, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merges_keep_stamps_and_untouched_files(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    rows = [(i, f"name {i}", None if i % 3 else i) for i in range(500)]
    df = lambda r: spark.createDataFrame(r, "id long, name string, value long")
    assert history.merge_snapshot(spark, path, df(rows), "id", stamp(1))["inserted"] == 500
    first = files(path)
    second = [(i, n, v) for i, n, v in rows if i >= 100]  # rows that are missing stay
    second[0] = (100, "changed", None)
    second[1] = (101, rows[101][1], 7)  # a NULL that became a value
    out = history.merge_snapshot(spark, path, df(second + [(900, "new", 1)]), "id", stamp(2))
    assert out["inserted"] == 1 and out["updated"] == 2 and 1 <= out["buckets"] <= 3
    left = files(path)
    assert sum(first.get(f) == t for f, t in left.items()) >= len(first) - out["buckets"]
    third = history.merge_snapshot(spark, path, df([(101, rows[101][1], 8)]), "id", stamp(3))
    assert third == {"inserted": 0, "updated": 1, "buckets": 1}
    assert history.merge_snapshot(spark, path, df([(101, rows[101][1], 8)]), "id", stamp(4)) == {"inserted": 0, "updated": 0, "buckets": 0}
    got = {r.id: (r.name, r.value, r.updated_at.day) for r in history.read_snapshot(spark, path).collect()}
    assert len(got) == 501 and got[100] == ("changed", None, 2) and got[101] == (rows[101][1], 8, 3) and got[900] == ("new", 1, 2)
    assert all(got[i] == (rows[i][1], rows[i][2], 1) for i in range(500) if i not in (100, 101))
    assert not [p for p in os.listdir(tmp_path) if "merge" in p]


def test_old_results_are_deleted(spark, tmp_path):
    path = str(tmp_path / "results")
    results = spark.createDataFrame([(e, y, m, e) for e in range(5) for y, m in ((2023, 12), (2024, 3), (2024, 4), (2025, 1))],
                                    "employee_id long, period_year int, period_month int, calc_days long")
    sinks.write_results(results, path)
    before = files(path)
    assert maintenance.purge_results(spark, path, 2024, 4) == 2
    left = spark.read.parquet(path)
    assert sorted({(r.period_year, r.period_month) for r in left.collect()}) == [(2024, 4), (2025, 1)] and left.count() == 10
    assert all(before[f] == t for f, t in files(path).items())  # nothing that stays is written again
    assert maintenance.purge_results(spark, path, 2024, 4) == 0


def test_old_vacations_are_deleted_from_the_month_of_the_cut_off(spark, tmp_path):
    path = str(tmp_path / "vacations")
    day = lambda m, d: dt.date(2024, m, d)
    rows = [(k, 1, day(m, 1), day(m, d)) for k, (m, d) in enumerate([(3, 5), (5, 9), (5, 10), (5, 31), (6, 1)])]
    vacations = spark.createDataFrame(rows, "vacation_id long, employee_id long, period_start date, period_end date")
    maintenance.write_vacations(vacations, path)
    before = files(path)
    assert maintenance.purge_vacations(spark, path, day(5, 10)) == 2
    left = spark.read.parquet(path)
    assert sorted(r.vacation_id for r in left.collect()) == [2, 3, 4]
    june = [f for f in before if "end_month=6" in f]
    assert june and all(files(path)[f] == before[f] for f in june)
    assert maintenance.purge_vacations(spark, path, day(5, 10)) == 0
    assert maintenance.purge_vacations(spark, path, day(6, 2)) == 2  # a month of which nothing stays
    assert spark.read.schema(vacations.schema).parquet(path).count() == 0 or not files(path)
