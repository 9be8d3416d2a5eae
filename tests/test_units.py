"""Unit tests of column helpers and generic operators on small frames."""

import datetime as dt
import random

from pyspark.sql import functions as F

from lunchbox.functions.keys import sorted_surrogate_ids
from lunchbox.functions.text import clean_header, job_category
from lunchbox.operators import agreement, declared, eligibility, ingest
from lunchbox.periods import Period
from lunchbox.sources.rules import load_rules, read_rules


def test_job_category_rule(spark):
    titles = ["Estagiario de dados", "JOVEM APRENDIZ", "DIRETORA", "PRESIDENTE", "ceo",
              "PROCEOPS", "ANALISTA", None, "APRENDIZ ESTAGIARIO"]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = [r[0] for r in df.select(job_category("t")).collect()]
    assert got == ["ESTAGIARIO", "APRENDIZ", "DIRETOR", "DIRETOR", "DIRETOR", "DIRETOR",
                   "FUNCIONARIO", "FUNCIONARIO", "ESTAGIARIO"]


def test_clean_header():
    assert clean_header("MATRICULA ") == "MATRICULA"
    assert clean_header("DIAS DE FÉRIAS") == "DIAS_DE_FERIAS"
    assert clean_header("Unnamed: 2") == "UNNAMED_2"
    assert clean_header("na compra?") == "NA_COMPRA"
    assert clean_header("DESC. SITUACAO") == "DESC_SITUACAO"


def test_null_category_is_kept(spark):
    df = spark.createDataFrame([(None, "Trabalhando"), ("DIRETOR", "Trabalhando"), (None, None),
                                ("FUNCIONARIO", "Atestado")], "job_category string, status string")
    assert eligibility.category_status_filter(df).count() == 2


def test_sorted_surrogate_ids(spark):
    words = [f"w{random.Random(i).randint(0, 10**6):07d}" for i in range(500)] + ["Á", "a", "B", None]
    df = spark.createDataFrame([(w,) for w in words + words[:50]], "title string")
    got = {r["title"]: r["id"] for r in sorted_surrogate_ids(df, "title", "id").collect()}
    expect = {t: i + 1 for i, t in enumerate(sorted({w for w in words if w is not None},
                                                     key=lambda s: s.encode("utf-8")))}
    assert got == expect


def test_calendar_counts_days_one_by_one(spark):
    """Any range of days, in states with and without holidays of their own, against counting day by day."""
    rng = random.Random(5)
    first, last = dt.date(2024, 12, 1), dt.date(2025, 6, 30)
    states = spark.createDataFrame([(1,), (2,)], "state_id long")
    holidays = [(dt.date(2025, 1, 1), None), (dt.date(2025, 4, 21), None), (dt.date(2025, 4, 21), 2), (dt.date(2025, 4, 23), 2), (dt.date(2025, 5, 3), 1)]
    ranges = [(k, s, first + dt.timedelta(days=rng.randrange(212)), rng.randrange(-3, 90)) for k in range(200) for s in (1, 2)]
    ranges = [(k, s, a, min(a + dt.timedelta(days=n), last)) for k, s, a, n in ranges] + [(999, 1, first, last), (999, 2, first, first)]
    calendar = declared.working_day_calendar(states, spark.createDataFrame(holidays, "holiday_date date, holiday_state_id long"), first, last)
    rows = spark.createDataFrame(ranges, "k int, state_id long, a date, b date").join(calendar, "state_id")
    got = {(r.k, r.state_id): r.n for r in rows.select("k", "state_id", F.expr(declared.days_between_sql(first, "a", "b")).alias("n")).collect()}

    def count(state, a, b):
        days = [a + dt.timedelta(days=n) for n in range((b - a).days + 1)]
        return sum(d.weekday() < 5 and not any(d == h and s in (None, state) for h, s in holidays) for d in days)

    assert got == {(k, s): count(s, a, b) for k, s, a, b in ranges}


def test_consolidated_base_takes_whole_first_rows(spark):
    active = spark.createDataFrame([(1, "A", dt.date(2020, 1, 1))], "registration long, job_title string, hire_date date")
    hires = spark.createDataFrame([(2, "A", dt.date(2020, 2, 2), 10), (2, "B", dt.date(2020, 1, 1), 11), (1, "Z", None, 5), (None, "N", None, 6), (3, None, None, 7)],
                                  "registration long, job_title string, hire_date date, hire_id long")
    rows = sorted(map(tuple, declared.consolidated_base(active, hires, "hire_id").collect()))
    assert rows == [(1, "A", dt.date(2020, 1, 1)), (2, "A", dt.date(2020, 2, 2)), (3, None, None)]


def test_cast_checked_quarantines(spark):
    df = spark.createDataFrame([("1", "2025-04-01"), ("x", "2025-13-01"), (None, None)], "a string, b string")
    out = ingest.cast_checked(df, {"a": "bigint", "b": "date"}).orderBy(F.col("a").asc_nulls_last()).collect()
    errs = sorted(tuple(r["cast_errors"]) for r in out)
    assert errs == [(), (), ("a", "b")]


def test_upsert_changed(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", dt.date(2025, 1, 1))],
                                "k long, s string, h date")
    new = spark.createDataFrame([(1, "a", dt.date(2025, 2, 1)), (2, "b", dt.date(2025, 1, 1)), (3, "c", None)],
                                "k long, s string, h date")
    out = {r["k"]: r for r in ingest.upsert_changed(old, new, "k", ["s", "h"], F.lit(dt.datetime(2025, 5, 1))).collect()}
    assert out[1]["changed"] and out[1]["updated_at"] is not None
    assert not out[2]["changed"] and out[2]["updated_at"] is None
    assert out[3]["changed"]


def test_lookup_with_default(spark):
    df = spark.createDataFrame([("A",), ("Z",), (None,)], "name string")
    dim = spark.createDataFrame([("A", 7)], "n string, id long")
    out = sorted((r["x"], r["x_matched"]) for r in
                 ingest.lookup_with_default(df, "name", dim, "n", "id", "x").collect())
    assert out == [(1, False), (1, False), (7, True)]


def test_rules_from_text_and_defaults(spark, tmp_path):
    rules = load_rules(spark, '{"excecoes": {"por_sindicato": {"U": {"valor_vr_diario": 40.0}}}}')
    df = spark.createDataFrame([("U", 10, 0.0), ("V", 10, 0.0)], "union_name string, days int, daily_value double")
    out = {r["union_name"]: r for r in agreement.apply_declared(
        df.withColumn("daily_value", F.col("daily_value").cast("decimal(10,2)"))
          .withColumn("total", F.lit(0)).withColumn("company_cost", F.lit(0))
          .withColumn("employee_discount", F.lit(0)), rules).collect()}
    assert float(out["U"]["total"]) == 400.0 and float(out["U"]["company_cost"]) == 320.0
    assert float(out["V"]["total"]) == 0.0          # default value 0.0 when absent
    path = tmp_path / "rules.json"
    path.write_text('{\n "valor_vr_diario_padrao": 37.5,\n "limites": {"max_desconto": 10.0}\n}')
    r2 = read_rules(spark, str(path)).first()
    assert r2["valor_vr_diario_padrao"] == 37.5 and r2["limites"]["max_desconto"] == 10.0
    r3 = load_rules(spark, str(path))
    assert r3.default_value == 37.5 and r3.max_discount == 10.0 and r3.employee_share == 0.2


def test_period_value_object():
    p = Period.parse("2025-04-15", "2025-05-15")
    assert p.label == "05/2025" and p.days == 31 and p.slug == "05.2025"


def test_checked_broadcast_falls_back_over_bound(spark):
    from lunchbox.functions.keys import checked_broadcast
    big, small = spark.range(100), spark.range(5)
    left = spark.range(1000)
    over = left.join(checked_broadcast(big, max_bytes=100), "id")._jdf.queryExecution().logical().toString()
    under = left.join(checked_broadcast(small, max_bytes=100), "id")._jdf.queryExecution().logical().toString()
    assert "ResolvedHint (strategy=broadcast)" in under
    assert "ResolvedHint" not in over and "broadcast" not in over.lower()


def test_retention(spark):
    import datetime as dt
    from lunchbox.operators import maintenance
    r = spark.createDataFrame([(1, 2024, 12), (2, 2025, 1), (3, 2025, 5)],
                              "employee_id long, period_year int, period_month int")
    assert sorted(x[0] for x in maintenance.retain_results(r, 2025).collect()) == [2, 3]
    assert sorted(x[0] for x in maintenance.retain_recent_results(r, dt.date(2025, 5, 15), 4).collect()) == [2, 3]
    v = spark.createDataFrame([(1, dt.date(2024, 12, 31)), (2, dt.date(2025, 1, 1))], "vacation_id long, period_end date")
    assert [x[0] for x in maintenance.retain_vacations(v, dt.date(2025, 1, 1)).collect()] == [2]
