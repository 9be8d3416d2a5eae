"""End-to-end runs: stored model round trip, orchestrated run, CLI."""

import os

from lunchbox.operators import calc
from lunchbox.plans.benefits import apply_agreement, generate_purchase, process_benefits
from lunchbox.sources.tables import read_model, write_model
from lunchbox.sources.testdata import PERIOD, catalog

SF = "/root/testdata/sf0.001"
RULES = '{"valor_vr_diario_padrao": 37.5, "limites": {"max_desconto": 400.0}}'


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stored_model_round_trip(spark, tmp_path):
    m = catalog(spark, SF)
    write_model(m, str(tmp_path / "model"))
    back = read_model(spark, str(tmp_path / "model"), PERIOD)
    assert rows(calc.monthly_purchase(back)) == rows(calc.monthly_purchase(m))


def test_generate_and_process(spark, tmp_path):
    m = catalog(spark, SF)
    layout, totals = generate_purchase(m)
    t = {r["metric"]: r["value"] for r in totals.collect()}
    assert t["Total colaboradores"] == layout.count() > 0
    overlay = {r["registration"]: r for r in apply_agreement(m, RULES).collect()}
    base = {r["registration"]: r for r in layout.collect()}
    for reg, r in overlay.items():
        if base[reg]["daily_value"] <= 0:             # zero value replaced by the default
            assert r["daily_value"] == 37.5 and r["total"] == round(r["days"] * 37.5, 2)
            assert r["company_cost"] == base[reg]["company_cost"]   # shares not recomputed
    out = process_benefits(m, RULES, str(tmp_path / "sheet"))
    assert os.path.isdir(os.path.join(out, "period_start=1998-04-15", "period_end=1998-05-15"))


def test_cli(spark, tmp_path):
    from lunchbox.__main__ import main
    main(["--tables", SF, "--testdata", "--start", "1998-04-15", "--end", "1998-05-15",
          "--out", str(tmp_path / "cli")])
    back = spark.read.option("header", "true").csv(str(tmp_path / "cli"))
    assert back.count() > 0
