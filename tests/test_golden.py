"""Golden rows (documented examples) and hand-made edge cases for the calculation."""

from lunchbox.operators import calc, reports
from lunchbox.periods import Period
from lunchbox.sources.builder import build_model, d

P = Period(d("2025-04-15"), d("2025-05-15"))          # 31 days
P30 = Period(d("2025-04-16"), d("2025-05-15"))        # 30 days: half-even ties

STATES = [(1, "Paraná", "PR", "35.00"), (2, "Rio de Janeiro", "RJ", "35.00"),
          (3, "Rio Grande do Sul", "RS", "35.00"), (4, "São Paulo", "SP", "37.50"),
          (5, "Zero", "ZZ", "0")]
UNIONS = [(1, "SITEPD PR full", "SITEPD PR", 1), (2, "SINDPPD RS full", "SINDPPD RS", 3),
          (3, "SINDPD SP full", "SINDPD SP", 4), (4, "SINDPD RJ full", "SINDPD RJ", 2),
          (5, "ZERO full", "ZERO", 5)]


def wd(period, values=None):
    values = values or {1: 22, 2: 21, 3: 22, 4: 21, 5: 22}
    return [(u, period.start, period.end, n) for u, n in values.items()]


def emp(i, union, title="ANALISTA", status="Trabalhando", hire=None):
    return (i, 1000 + i, 1, title, union, status, hire, None)


def run(spark, period=P, **rows):
    rows.setdefault("states", STATES)
    rows.setdefault("unions", UNIONS)
    rows.setdefault("working_days", wd(period))
    m = build_model(spark, period, **rows)
    out = calc.purchase_calc(m).collect()
    return {r["employee_id"]: r for r in out}


def money(r):
    return (float(r["total"]), float(r["company_cost"]), float(r["employee_discount"]))


def test_documented_examples(spark):
    res = run(spark,
              employees=[emp(1, 3), emp(2, 2), emp(3, 3), emp(4, 3), emp(5, 1)],
              vacations=[(1, 2, P.start, P.end, 10)],
              hires=[(1, 3, d("2025-04-07"))],
              terminations=[(1, 4, d("2025-05-01"), True)])
    assert res[1]["days"] == 22 and money(res[1]) == (825.0, 660.0, 165.0)
    assert res[2]["days"] == 11 and money(res[2]) == (385.0, 308.0, 77.0)
    # hired before the period: no proration (documented example says 15; code gives 22)
    assert res[3]["days"] == 22 and money(res[3]) == (825.0, 660.0, 165.0)
    assert res[4]["days"] == 0 and res[4]["notes"] == "Desligado c/ comunicado até dia 15"
    assert res[5]["days"] == 22 and money(res[5]) == (770.0, 616.0, 154.0)


def test_hire_and_termination_edges(spark):
    res = run(spark,
              employees=[emp(i, 3) for i in range(1, 10)],
              vacations=[(1, 1, P.start, P.end, 30)],
              hires=[(1, 2, d("2025-04-15")), (2, 3, d("2025-05-15")),
                     (3, 8, d("2025-04-20")),
                     (4, 9, d("2025-04-20")), (5, 9, d("2025-04-25"))],
              terminations=[(1, 4, d("2025-05-15"), True), (2, 5, d("2025-04-16"), True),
                            (3, 6, d("2025-05-01"), False), (4, 8, d("2025-05-10"), False)])
    assert res[1]["days"] == 0                          # vacation above working days
    assert res[2]["days"] == 22                         # hired on the first day: 31/31
    assert res[3]["days"] == 1                          # last day: round(22/31) = 1
    assert res[4]["days"] == 0                          # day 15 with notice
    assert res[5]["days"] == 1                          # day 16 with notice: round(22*2/31)
    assert res[6]["days"] == 12                         # no notice: round(22*17/31)
    assert res[7]["days"] == 22 and res[7]["notes"] == ""
    # hired and terminated: round(22*26/31)=18, then round(18*26/31)=15
    assert res[8]["days"] == 15
    assert res[8]["notes"] == "Admissão em 20/04/2025; Desligado em 10/05/2025 (proporcional)"
    # two hire rows: the last one prorates, the first one back-fills the admission date
    assert res[9]["effective_hire_date"] == d("2025-04-25")
    assert res[9]["employee_hire_date"] == d("2025-04-20")
    assert res[9]["days"] == round(22 * 21 / 31)


def test_half_even_on_30_day_period(spark):
    # remaining 15 of 30 days: base 1 -> 0.5 -> 0, base 5 -> 2.5 -> 2 (half-up gives 1 and 3)
    res = run(spark, period=P30,
              working_days=wd(P30, {1: 1, 2: 5}),
              employees=[emp(1, 1), emp(2, 2)],
              hires=[(1, 1, d("2025-05-01")), (2, 2, d("2025-05-01"))])
    assert res[1]["days"] == 0
    assert res[2]["days"] == 2


def test_leave_overlap_edges(spark):
    res = run(spark,
              employees=[emp(i, 3) for i in range(1, 6)],
              leaves=[(1, 1, "x", d("2025-01-01"), None),          # open-ended: excluded
                      (2, 2, "x", d("2025-03-01"), d("2025-04-15")),  # ends on start day: excluded
                      (3, 3, "x", d("2025-03-01"), d("2025-04-14")),  # ends the day before: kept
                      (4, 4, "x", None, d("2025-04-20")),           # missing start = period start
                      (5, 5, "x", d("2025-05-16"), None)])          # starts after: kept
    assert set(res) == {3, 5}


def test_exclusions_category_status_and_defaults(spark):
    res = run(spark,
              employees=[emp(1, 3, title="ESTAGIARIO DE TI"), emp(2, 3, title="Jovem Aprendiz"),
                         emp(3, 3, title="DIRETORA"), emp(4, 3, title="CEO"),
                         emp(5, 3, status="Atestado"), emp(6, 3), emp(7, 99),
                         emp(8, 5), emp(9, 3, title="PROCEOPS")],
              exclusions=[(1, 6, "EXTERIOR", "50.00", None)],
              working_days=[(1, P.start, P.end, 22)])        # union 3 has no working days row
    # CEO matches inside words (PROCEOPS); unknown union 99 is dropped by the inner join
    assert set(res) == {8}
    assert res[8]["days"] == 0 and res[8]["working_days"] is None  # union 5 has no working days
    res2 = run(spark, employees=[emp(1, 3)], working_days=[(1, P.start, P.end, 22)])
    assert res2[1]["days"] == 0 and res2[1]["working_days"] is None  # missing -> 0 days


def test_zero_value_and_empty_validation(spark):
    res = run(spark, employees=[emp(1, 5)])
    assert res[1]["days"] == 22 and float(res[1]["total"]) == 0.0
    m = build_model(spark, P, states=STATES, unions=UNIONS, working_days=wd(P))
    totals = {r["metric"]: r["value"] for r in reports.validation_totals(calc.purchase_calc(m)).collect()}
    assert totals == {"Total colaboradores": 0.0, "Soma TOTAL": 0.0, "Soma Custo empresa": 0.0,
                      "Soma Desconto profissional": 0.0}


def test_multi_period_matches_single_runs(spark):
    p1, p2 = Period(d("2025-03-15"), d("2025-04-15")), Period(d("2025-04-15"), d("2025-05-15"))
    rows = dict(states=STATES, unions=UNIONS, working_days=wd(p1) + wd(p2),
                employees=[emp(i, 1 + i % 4) for i in range(1, 30)],
                vacations=[(1, 3, p1.start, p1.end, 4), (2, 3, p2.start, p2.end, 7)],
                hires=[(1, 5, d("2025-04-15")), (2, 6, d("2025-04-01"))],
                terminations=[(1, 7, d("2025-04-15"), True), (2, 8, d("2025-05-02"), False)],
                leaves=[(1, 9, "x", d("2025-03-01"), d("2025-04-01"))])
    m = build_model(spark, p2, **rows)
    cols = ["employee_id", "period_label", "days", "total", "notes"]
    both = sorted(tuple(r) for r in calc.purchase_calc(m, [p1, p2]).select(cols).collect())
    single = sorted(tuple(r) for p in (p1, p2) for r in calc.purchase_calc(m, [p]).select(cols).collect())
    assert both == single
    # the 15th belongs to both periods (inclusive ends)
    by = {(r[0], r[1]): r for r in both}
    assert by[(7, "04/2025")][2] == 0 and by[(7, "05/2025")][2] == 0


def test_strict_mode_fails_on_missing_working_days(spark):
    import pytest
    m = build_model(spark, P, states=STATES, unions=UNIONS, employees=[emp(1, 3)],
                    working_days=[(1, P.start, P.end, 22)])
    assert calc.purchase_calc(m).collect()[0]["days"] == 0
    with pytest.raises(Exception, match="no working days for union 3"):
        calc.purchase_calc(m, strict=True).collect()
