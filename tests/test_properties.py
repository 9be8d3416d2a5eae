"""Property tests: the Spark calculation vs a plain-Python brute force of the
same rules on random small fixtures, plus invariants on the driver data."""

import datetime as dt
import random

from hypothesis import given, settings, strategies as st

import __spark_entry__ as entry
from lunchbox.operators import calc
from lunchbox.periods import Period
from lunchbox.sources.builder import build_model


def brute_force(period, emp, wd, vac, hires, terms, excluded, leaves):
    """Row-by-row rules, written independently of the Spark plan."""
    out = {}
    for eid, (status, title, union, value) in emp.items():
        if eid in excluded or status in ("Auxílio Doença", "Licença Maternidade", "Atestado"):
            continue
        up = title.upper()
        if "ESTAGIARIO" in up or "APRENDIZ" in up or any(w in up for w in ("DIRETOR", "PRESIDENTE", "CEO")):
            continue
        if any(not (period.end < (s or period.start) or (e or dt.date.max) < period.start)
               for (le, s, e) in leaves if le == eid):
            continue
        days = max(wd.get(union, 0) - sum(v for (ve, v) in vac if ve == eid), 0)
        h = [d for (_, he, d) in sorted(hires) if he == eid]
        first, last = (h[0], h[-1]) if h else (None, None)
        notes = []
        if last and period.start <= last <= period.end:
            days = round(days * max(min(((period.end - last).days + 1) / period.days, 1.0), 0.0))
            notes.append(f"Admissão em {last:%d/%m/%Y}")
        t = [(d, ok) for (_, te, d, ok) in sorted(terms) if te == eid]
        if t and period.start <= t[-1][0] <= period.end:
            d, ok = t[-1]
            if ok and d.day <= 15:
                days = 0
                notes.append("Desligado c/ comunicado até dia 15")
            else:
                days = round(days * max(min(((d - period.start).days + 1) / period.days, 1.0), 0.0))
                notes.append(f"Desligado em {d:%d/%m/%Y} (proporcional)")
        days = max(days, 0)
        total = round(days * value, 2)
        out[eid] = (days, total, round(total * 0.8, 2), round(total * 0.2, 2), "; ".join(notes),
                    first.strftime("%d/%m/%Y") if first else "")
    return out


@settings(max_examples=12, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([28, 29, 30, 31]))
def test_calc_matches_brute_force(spark_session_for_hypothesis, seed, length):
    spark = spark_session_for_hypothesis
    rnd = random.Random(seed)
    start = dt.date(2025, 1, 1) + dt.timedelta(days=rnd.randint(0, 300))
    period = Period(start, start + dt.timedelta(days=length - 1))
    day = lambda lo, hi: start + dt.timedelta(days=rnd.randint(lo, hi))
    values = {1: 35.0, 2: 37.5, 3: 0.0}
    emp = {i: (rnd.choice(["Trabalhando"] * 6 + ["Férias", "Atestado"]),
               rnd.choice(["ANALISTA"] * 8 + ["DIRETOR X", "ESTAGIARIO"]), rnd.randint(1, 4),
               None) for i in range(1, 41)}
    emp = {i: (s, t, u, values.get(u, 0.0)) for i, (s, t, u, _) in emp.items()}
    wd = {u: rnd.randint(0, 23) for u in (1, 2, 3)}                      # union 4: missing
    vac = [(rnd.randint(1, 40), rnd.randint(1, 12)) for _ in range(15)]
    hires = [(k, rnd.randint(1, 40), day(-20, length + 10)) for k in range(25)]
    terms = [(k, rnd.randint(1, 40), day(-10, length + 10), rnd.random() < 0.5) for k in range(25)]
    excluded = {rnd.randint(1, 40) for _ in range(3)}
    leaves = [(rnd.randint(1, 40), rnd.choice([None, day(-40, length)]),
               rnd.choice([None, day(-40, length + 5)])) for _ in range(4)]
    m = build_model(
        spark, period,
        states=[(u, f"S{u}", f"S{u}", str(v)) for u, v in values.items()] + [(4, "S4", "S4", "35")],
        unions=[(u, f"U{u} full", f"U{u}", u) for u in (1, 2, 3, 4)],
        working_days=[(u, period.start, period.end, n) for u, n in wd.items()],
        employees=[(i, 100 + i, 1, t, u, s, None, None) for i, (s, t, u, _) in emp.items()],
        vacations=[(k, e, period.start, period.end, v) for k, (e, v) in enumerate(vac)],
        hires=hires, terminations=terms,
        exclusions=[(k, e, "EXTERIOR", None, None) for k, e in enumerate(sorted(excluded))],
        leaves=[(k, e, "x", s, en) for k, (e, s, en) in enumerate(leaves)])
    got = {r["employee_id"]: (r["days"], float(r["total"]), float(r["company_cost"]),
                              float(r["employee_discount"]), r["notes"], r["admission"])
           for r in calc.purchase_calc(m).join(
               calc.layout(calc.purchase_calc(m)).select("registration", "admission"),
               "registration").collect()}
    assert got == brute_force(period, emp, wd, vac, hires, terms, excluded, leaves)


def test_invariants_on_driver_data(spark):
    sf = "/root/testdata/sf0.01"
    from lunchbox.sources.testdata import catalog
    c = calc.purchase_calc(catalog(spark, sf))
    assert c.count() == c.select("employee_id", "period_start").distinct().count()
    dq = {r["check"]: r["offenders"] for r in entry.queries()["dq_results"](spark, sf).collect()}
    for check in ("excluded_group_present", "split_not_total", "negative_value",
                  "days_above_working_days", "missing_working_days"):
        assert dq[check] == 0, check
