"""Streaming runner, sinks and small declared helpers."""

import json
import os

import pytest

from pyspark.sql import functions as F

from lunchbox.operators import agreement, declared
from lunchbox.sources import sinks
from lunchbox.sources.rules import load_rules
from lunchbox.sources.testdata import catalog
from lunchbox.streaming import purchase_requests

SF = "/root/testdata/sf0.001"


def test_request_stream_is_idempotent(spark, tmp_path):
    req, sink, ckpt = tmp_path / "req", tmp_path / "sink", tmp_path / "ckpt"
    req.mkdir()
    (req / "a.json").write_text(json.dumps({"period_start": "1998-04-15", "period_end": "1998-05-15"}) + "\n")
    q = purchase_requests.start(spark, str(req), str(sink), str(ckpt), lambda s: catalog(s, SF))
    q.awaitTermination()
    first = spark.read.parquet(str(sink))
    n = first.count()
    assert n > 0
    assert first.select("sheet").distinct().collect()[0][0] == "VR MENSAL 05.1998"
    # a second request for the same period rewrites the same partition
    (req / "b.json").write_text(json.dumps({"period_start": "1998-04-15", "period_end": "1998-05-15"}) + "\n")
    q = purchase_requests.start(spark, str(req), str(sink), str(ckpt), lambda s: catalog(s, SF))
    q.awaitTermination()
    assert spark.read.parquet(str(sink)).count() == n


def test_export_guard(spark):
    with pytest.raises(ValueError):
        sinks.check_exportable(None)
    empty = spark.createDataFrame([], "a int")
    assert sinks.check_exportable(empty) is False
    assert sinks.check_exportable(spark.range(1)) is True


def test_write_purchase_sheet_partitions(spark, tmp_path):
    from lunchbox.operators import calc
    layout = calc.monthly_purchase(catalog(spark, SF), with_period=True)
    sinks.write_purchase_sheet(layout, str(tmp_path / "out"))
    assert os.path.isdir(tmp_path / "out" / "period_start=1998-04-15" / "period_end=1998-05-15")
    back = spark.read.option("header", "true").csv(str(tmp_path / "out"))
    assert back.count() == layout.count() > 0 and "OBS GERAL" in back.columns
    assert {r.sheet for r in back.select("sheet").distinct().collect()} == {"VR MENSAL 05.1998"}


def test_periods_that_end_in_one_month_are_kept_apart(spark, tmp_path):
    from lunchbox.operators import calc
    from lunchbox.periods import Period
    model = catalog(spark, SF)
    one, two = Period.parse("1998-04-15", "1998-05-15"), Period.parse("1998-05-01", "1998-05-31")
    parts = [calc.monthly_purchase(model, [p], with_period=True) for p in (one, two)]
    for layout in parts:
        sinks.write_purchase_sheet(layout, str(tmp_path / "apart"), "parquet")
    sinks.write_purchase_sheet(calc.monthly_purchase(model, [one, two], with_period=True), str(tmp_path / "together"), "parquet")
    rows = [sorted(map(repr, spark.read.parquet(str(tmp_path / d)).collect())) for d in ("apart", "together")]
    assert rows[0] == rows[1] and len(rows[0]) == sum(p.count() for p in parts)


def test_two_results_for_a_month_are_rejected(spark, tmp_path):
    out = str(tmp_path / "results")
    rows = spark.createDataFrame([(1, 1998, 5, 3), (1, 1998, 5, 4)], "employee_id long, period_year long, period_month long, calc_days long")
    with pytest.raises(Exception, match="two results for employee"):
        sinks.write_results(rows, out)
    sinks.write_results(rows.limit(1), out)
    assert spark.read.parquet(out).count() == 1


def test_two_rules_documents_are_rejected(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text('{"valor_vr_diario_padrao": 10.0}')
    with pytest.raises(ValueError):
        load_rules(spark, str(tmp_path))
    assert load_rules(spark, str(tmp_path / "a.json")).default_value == 10.0


def test_agreement_empty_passes_through(spark):
    rules = load_rules(spark, '{"valor_vr_diario_padrao": 10.0}')
    empty = spark.createDataFrame([], "registration long, union_name string, days int, "
                                      "daily_value decimal(10,2), total decimal(18,2), "
                                      "company_cost decimal(18,2), employee_discount decimal(18,2)")
    out = agreement.apply_effective(empty, rules)
    assert out.count() == 0 and set(empty.columns) <= set(out.columns)


def test_purchase_flag(spark):
    df = spark.createDataFrame([("sim",), ("N",), (None,), (" S ",)], "purchase_flag string")
    assert declared.purchase_flag(df).count() == 2


def test_write_results_replaces_only_its_period(spark, tmp_path):
    import __spark_entry__ as entry
    out = str(tmp_path / "results")
    res = entry.queries()["calc_results"](spark, SF)
    sinks.write_results(res, out)
    other = res.withColumn("period_month", F.lit(4).cast("long"))
    sinks.write_results(other, out)                  # another period: added
    sinks.write_results(res, out)                    # same period again: replaced, not doubled
    back = spark.read.parquet(out)
    assert back.count() == 2 * res.count()
    assert {r[0] for r in back.select("period_month").distinct().collect()} == {4, 5}
