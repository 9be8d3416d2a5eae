"""Independent ANSI/DuckDB SQL for every registered query.

Each statement starts from the raw driver tables (registered as views) and
re-derives the HR model with the CTEs in ``MODEL``; it shares no code with
the Spark plans.  Integers are cast to BIGINT and money to DOUBLE so both
engines report the same types.
"""

from __future__ import annotations

P_START = "DATE '1998-04-15'"
P_END = "DATE '1998-05-15'"
P_DAYS = "31"
P_LABEL = "'05/1998'"


def category(t: str) -> str:
    u = f"upper(coalesce({t}, ''))"
    return (f"CASE WHEN contains({u}, 'ESTAGIARIO') THEN 'ESTAGIARIO' "
            f"WHEN contains({u}, 'APRENDIZ') THEN 'APRENDIZ' "
            f"WHEN contains({u}, 'DIRETOR') OR contains({u}, 'DIRETORA') "
            f"OR contains({u}, 'PRESIDENTE') OR contains({u}, 'CEO') THEN 'DIRETOR' "
            f"ELSE 'FUNCIONARIO' END")


MODEL = f"""
state AS (
  SELECT CAST(r_regionkey + 1 AS BIGINT) AS state_id, r_name AS state_name,
         substr(r_name, 1, 2) AS uf,
         CAST(CASE WHEN r_name = 'EUROPE' THEN 37.50 WHEN r_name = 'ASIA' THEN 0
                   ELSE 35.00 END AS DECIMAL(10,2)) AS daily_value
  FROM region),
labor_union AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS union_id, n_name || ' - SINDICATO' AS union_full_name,
         n_name AS union_name, CAST(n_regionkey + 1 AS BIGINT) AS state_id
  FROM nation),
part_title AS (
  SELECT p_partkey,
         CASE WHEN p_size = 1 THEN 'ESTAGIARIO ' WHEN p_size = 2 THEN 'JOVEM APRENDIZ '
              WHEN p_size = 3 THEN 'DIRETOR ' ELSE 'ANALISTA ' END || p_name AS title
  FROM part),
job AS (SELECT CAST(p_partkey + 1 AS BIGINT) AS job_id, title, {category('title')} AS category FROM part_title),
title_number AS (
  SELECT CAST(row_number() OVER (ORDER BY title) AS BIGINT) AS job_id, title,
         {category('title')} AS category
  FROM (SELECT DISTINCT title FROM part_title WHERE title IS NOT NULL) t),
employee_raw AS (
  SELECT CAST(c.c_custkey + 1 AS BIGINT) AS employee_id,
         CAST(c.c_custkey + 30000 AS BIGINT) AS registration,
         CAST(1 AS BIGINT) AS company_id,
         CAST(c.c_custkey % (SELECT max(p_partkey) + 1 FROM part) + 1 AS BIGINT) AS job_id,
         CAST(c.c_nationkey + 1 AS BIGINT) AS union_id,
         CASE WHEN c.c_acctbal < -800 THEN 'Auxílio Doença'
              WHEN c.c_acctbal < -650 THEN 'Licença Maternidade'
              WHEN c.c_acctbal < -500 THEN 'Atestado'
              WHEN c.c_mktsegment = 'FURNITURE' THEN 'Férias'
              ELSE 'Trabalhando' END AS status,
         CAST(NULL AS DATE) AS hire_date,
         CAST(NULL AS DATE) AS termination_date
  FROM customer c),
employee AS (SELECT e.*, j.title AS job_title, j.category AS job_category FROM employee_raw e LEFT JOIN job j ON j.job_id = e.job_id),
working_days AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS union_id, {P_START} AS period_start,
         {P_END} AS period_end, CAST(21 + n_nationkey % 2 AS INTEGER) AS working_days
  FROM nation),
vacation AS (
  SELECT vacation_id, employee_id, period_start, CAST(period_start + INTERVAL 1 MONTH AS DATE) AS period_end, vacation_days
  FROM (SELECT o_orderkey AS vacation_id, CAST(o_custkey + 1 AS BIGINT) AS employee_id,
               CAST(date_trunc('month', CAST(o_orderdate AS DATE) - INTERVAL 14 DAY) + INTERVAL 14 DAY AS DATE) AS period_start,
               CAST(1 + o_orderkey % 30 AS INTEGER) AS vacation_days
        FROM orders WHERE o_orderstatus = 'F') own),
hire AS (
  SELECT o_orderkey AS hire_id, CAST(o_custkey + 1 AS BIGINT) AS employee_id,
         CAST(o_orderdate AS DATE) AS hire_date
  FROM orders WHERE o_orderstatus = 'O'),
termination AS (
  SELECT o_orderkey AS termination_id, CAST(o_custkey + 1 AS BIGINT) AS employee_id,
         CAST(o_orderdate AS DATE) AS termination_date,
         COALESCE(o_orderpriority IN ('1-URGENT', '2-HIGH'), FALSE) AS notice_ok
  FROM orders WHERE o_orderstatus = 'P'),
leave_ AS (
  SELECT o_orderkey AS leave_id, CAST(o_custkey + 1 AS BIGINT) AS employee_id,
         'Afastamento' AS leave_type,
         CAST(o_orderdate AS DATE) AS start_date,
         CASE WHEN o_orderkey % 3 = 0 THEN CAST(NULL AS DATE)
              ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) END AS end_date
  FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'),
exclusion AS (
  SELECT c_custkey AS exclusion_id, CAST(c_custkey + 1 AS BIGINT) AS employee_id,
         CASE c_custkey % 3 WHEN 0 THEN 'ESTAGIARIO' WHEN 1 THEN 'APRENDIZ' ELSE 'EXTERIOR' END AS exclusion_type,
         CASE WHEN c_custkey % 3 = 2 THEN CAST(c_acctbal / 200 AS DECIMAL(10,2)) END AS specific_value,
         CAST(NULL AS VARCHAR) AS notes
  FROM customer WHERE c_acctbal > 9700),
emp AS (
  SELECT e.*, u.union_name, u.union_full_name, s.state_id, s.state_name, s.uf, s.daily_value
  FROM employee e JOIN job USING (job_id) JOIN labor_union u ON e.union_id = u.union_id JOIN state s ON u.state_id = s.state_id),
hire_agg AS (
  SELECT employee_id, arg_min(hire_date, hire_id) AS first_hire, arg_max(hire_date, hire_id) AS last_hire
  FROM hire GROUP BY employee_id),
term_agg AS (
  SELECT employee_id, arg_max(termination_date, termination_id) AS last_term,
         arg_max(notice_ok, termination_id) AS last_ok
  FROM termination GROUP BY employee_id),
emp_job AS (SELECT e.* FROM employee e JOIN job USING (job_id)),
hire_r AS (SELECT * FROM hire WHERE employee_id IN (SELECT employee_id FROM employee)),
termination_r AS (SELECT * FROM termination WHERE employee_id IN (SELECT employee_id FROM employee)),
vacation_r AS (SELECT * FROM vacation WHERE employee_id IN (SELECT employee_id FROM employee)),
leave_r AS (SELECT * FROM leave_ WHERE employee_id IN (SELECT employee_id FROM employee)),
exclusion_r AS (SELECT * FROM exclusion WHERE employee_id IN (SELECT employee_id FROM employee)),
backfilled AS (
  SELECT e.employee_id, e.registration, e.company_id, e.job_id, e.union_id, e.status,
         COALESCE(e.hire_date, h.first_hire) AS hire_date, e.termination_date
  FROM employee e
  LEFT JOIN (SELECT employee_id, arg_min(hire_date, hire_id) AS first_hire FROM hire_r GROUP BY employee_id) h
    ON h.employee_id = e.employee_id)
"""


def period_ctes(sfx: str, ps: str, pe: str, pdays: str, wd: str, label: str) -> str:
    """CTEs of the purchase calculation for one period: on_leave{sfx},
    vac_sum{sfx}, calc0{sfx} .. calc{sfx}; working days come from CTE ``wd``
    (union_id, working_days)."""
    return f"""
on_leave{sfx} AS (
  SELECT DISTINCT employee_id FROM leave_
  WHERE COALESCE(start_date, {ps}) <= {pe} AND (end_date IS NULL OR end_date >= {ps})),
vac_sum{sfx} AS (
  SELECT employee_id, CAST(SUM(vacation_days) AS BIGINT) AS vacation_days FROM vacation
  WHERE period_start = {ps} AND period_end = {pe} GROUP BY employee_id),
calc0{sfx} AS (
  SELECT emp.employee_id, emp.registration, emp.union_id, emp.union_name, emp.daily_value,
         v.vacation_days AS v_raw,
         emp.status, emp.job_title, emp.job_category,
         wd.working_days AS wd_raw, COALESCE(wd.working_days, 0) AS wdays, COALESCE(v.vacation_days, 0) AS vdays,
         COALESCE(emp.hire_date, h.first_hire) AS own_hire,
         COALESCE(h.last_hire, emp.hire_date, h.first_hire) AS eff_hire,
         COALESCE(t.last_term, emp.termination_date) AS eff_term,
         COALESCE(t.last_ok, FALSE) AS ok,
         {ps} AS period_start, {label} AS period_label
  FROM emp
  LEFT JOIN {wd} wd ON wd.union_id = emp.union_id
  LEFT JOIN vac_sum{sfx} v ON v.employee_id = emp.employee_id
  LEFT JOIN hire_agg h ON h.employee_id = emp.employee_id
  LEFT JOIN term_agg t ON t.employee_id = emp.employee_id
  WHERE NOT EXISTS (SELECT 1 FROM exclusion x WHERE x.employee_id = emp.employee_id)
    AND NOT EXISTS (SELECT 1 FROM on_leave{sfx} l WHERE l.employee_id = emp.employee_id)
    AND NOT (COALESCE(emp.job_category IN ('ESTAGIARIO', 'APRENDIZ', 'DIRETOR'), FALSE)
             OR COALESCE(emp.status IN ('Auxílio Doença', 'Licença Maternidade', 'Atestado'), FALSE))),
calc1{sfx} AS (
  SELECT *, GREATEST(wdays - vdays, 0) AS d0,
         COALESCE(eff_hire BETWEEN {ps} AND {pe}, FALSE) AS hired_in,
         COALESCE(eff_term BETWEEN {ps} AND {pe}, FALSE) AS term_in
  FROM calc0{sfx}),
calc2{sfx} AS (
  SELECT *,
         CASE WHEN hired_in THEN CAST(round_even(CAST(d0 AS DOUBLE) * LEAST(GREATEST(
              CAST(date_diff('day', eff_hire, {pe}) + 1 AS DOUBLE) / {pdays}, 0.0), 1.0), 0) AS INTEGER)
              ELSE d0 END AS d1,
         term_in AND ok AND day(eff_term) <= 15 AS to_zero
  FROM calc1{sfx}),
calc3{sfx} AS (
  SELECT *,
         GREATEST(CASE WHEN to_zero THEN 0
                       WHEN term_in THEN CAST(round_even(CAST(d1 AS DOUBLE) * LEAST(GREATEST(
                            CAST(date_diff('day', {ps}, eff_term) + 1 AS DOUBLE) / {pdays}, 0.0), 1.0), 0) AS INTEGER)
                       ELSE d1 END, 0) AS days
  FROM calc2{sfx}),
calc{sfx} AS (
  SELECT *, round(days * daily_value, 2) AS total_dec,
         round(round(days * daily_value, 2) * 0.8, 2) AS company_dec,
         round(round(days * daily_value, 2) * 0.2, 2) AS employee_dec,
         concat_ws('; ',
            CASE WHEN hired_in THEN 'Admissão em ' || strftime(eff_hire, '%d/%m/%Y') END,
            CASE WHEN to_zero THEN 'Desligado c/ comunicado até dia 15' END,
            CASE WHEN term_in AND NOT to_zero
                 THEN 'Desligado em ' || strftime(eff_term, '%d/%m/%Y') || ' (proporcional)' END) AS notes
  FROM calc3{sfx})"""


MODEL = MODEL.rstrip() + f""",
wd_default AS (
  SELECT union_id, working_days FROM working_days WHERE period_start = {P_START} AND period_end = {P_END}),""" + \
    period_ctes("", P_START, P_END, P_DAYS, "wd_default", P_LABEL) + "\n"


def with_model(body: str) -> str:
    return "WITH " + MODEL.strip() + "\n" + body


SQL: dict[str, str] = {}

SQL["monthly_purchase"] = with_model(f"""
SELECT registration, COALESCE(strftime(own_hire, '%d/%m/%Y'), '') AS admission, union_name,
       {P_LABEL} AS period_label, CAST(days AS BIGINT) AS days,
       CAST(daily_value AS DOUBLE) AS daily_value, CAST(total_dec AS DOUBLE) AS total,
       CAST(company_dec AS DOUBLE) AS company_cost, CAST(employee_dec AS DOUBLE) AS employee_discount,
       notes
FROM calc""")

EXCLUDED_STATUSES = "('Auxílio Doença', 'Licença Maternidade', 'Atestado')"
PERIOD_WD = f"wd.period_start = {P_START} AND wd.period_end = {P_END}"
REG = "CAST(employee_id - 1 + 30000 AS BIGINT)"


def _q(name, body):
    SQL[name] = with_model(body)


# ----------------------------------------------------------------- sources --
_q("load_employees", """
SELECT e.registration, 'Empresa Principal' AS company, e.job_title, e.status, u.union_full_name
FROM employee e LEFT JOIN labor_union u ON e.union_id = u.union_id""")
_q("load_vacations", f"""
SELECT {REG} AS registration, 'Férias' AS status, CAST(vacation_days AS BIGINT) AS vacation_days
FROM vacation""")
_q("load_leaves", f"""
SELECT {REG} AS registration, leave_type, ['sim', 'N', ' S '][leave_id % 4 + 1] AS purchase_flag FROM leave_""")
_q("purchase_flag", f"SELECT {REG} AS registration, leave_type FROM leave_ WHERE leave_id % 4 IN (0, 2)")
_q("load_terminations", f"""
SELECT {REG} AS registration, termination_date, notice_ok FROM termination""")
_q("load_hires", """
SELECT CAST(h.employee_id - 1 + 30000 AS BIGINT) AS registration, h.hire_date, e.job_title
FROM hire h LEFT JOIN employee e ON h.employee_id = e.employee_id""")
_q("load_exclusions", f"""
SELECT {REG} AS registration, exclusion_type, CAST(specific_value AS DOUBLE) AS specific_value, notes
FROM exclusion""")
_q("dim_states", "SELECT state_id, state_name, uf, CAST(daily_value AS DOUBLE) AS daily_value FROM state")
_q("dim_unions", "SELECT union_id, union_full_name, union_name, state_id FROM labor_union")
_q("dim_working_days", """
SELECT union_id, period_start, period_end, CAST(working_days AS BIGINT) AS working_days FROM working_days""")
_q("load_bases", f"""
SELECT 'employees' AS base, CAST(COUNT(*) AS BIGINT) AS row_count FROM emp
UNION ALL SELECT 'working_days', COUNT(*) FROM working_days wd WHERE {PERIOD_WD}
UNION ALL SELECT 'vacations', COUNT(*) FROM vac_sum
UNION ALL SELECT 'exclusions', COUNT(*) FROM exclusion
UNION ALL SELECT 'leaves', COUNT(*) FROM leave_
UNION ALL SELECT 'hires', COUNT(*) FROM hire
UNION ALL SELECT 'terminations', COUNT(*) FROM termination""")
_q("working_days_for_period", f"""
SELECT union_id, CAST(working_days AS BIGINT) AS working_days FROM working_days wd WHERE {PERIOD_WD}""")

# ------------------------------------------------------------------ ingest --
_q("cast_checked", f"""
SELECT {REG} AS registration, termination_date, CAST(0 AS BIGINT) AS cast_errors FROM termination""")
_q("job_titles", """
SELECT DISTINCT title FROM (
  SELECT job_title AS title FROM employee
  UNION ALL SELECT e.job_title FROM hire h LEFT JOIN employee e ON h.employee_id = e.employee_id
  UNION ALL SELECT e.job_title FROM exclusion x LEFT JOIN employee e ON x.employee_id = e.employee_id
            WHERE x.exclusion_type = 'ESTAGIARIO'
  UNION ALL SELECT e.job_title FROM exclusion x LEFT JOIN employee e ON x.employee_id = e.employee_id
            WHERE x.exclusion_type = 'APRENDIZ') t
WHERE title IS NOT NULL""")
_q("job_category", "SELECT title, category FROM title_number")
_q("job_dim", "SELECT job_id, title, category FROM title_number")
_q("employee_dim", """
SELECT e.registration, COALESCE(j.job_id, 1) AS job_id, COALESCE(u.union_id, 1) AS union_id, e.status,
       j.job_id IS NOT NULL AS job_id_matched, u.union_id IS NOT NULL AS union_id_matched
FROM employee e
LEFT JOIN labor_union u0 ON e.union_id = u0.union_id
LEFT JOIN title_number j ON j.title = e.job_title
LEFT JOIN labor_union u ON u.union_full_name = u0.union_full_name""")
_q("resolve_vacations", f"""
SELECT employee_id, period_start, period_end, CAST(vacation_days AS BIGINT) AS vacation_days FROM vacation_r""")
_q("resolve_leaves", """
SELECT employee_id, leave_type, start_date, end_date FROM leave_r""")
_q("resolve_terminations", "SELECT employee_id, termination_date, notice_ok FROM termination_r")
_q("resolve_hires", "SELECT employee_id, hire_date FROM hire_r")
_q("exclusions_union", """
SELECT employee_id, exclusion_type, CAST(specific_value AS DOUBLE) AS specific_value, notes FROM exclusion_r""")
_q("backfill_hire_date", "SELECT employee_id, hire_date FROM backfilled")
STAMPED = """
SELECT b.employee_id, {columns},
       CASE WHEN b.hire_date IS DISTINCT FROM e.hire_date OR b.status IS DISTINCT FROM e.status
            THEN '1998-05-16 00:00:00' ELSE '1998-04-16 00:00:00' END AS updated_at
FROM backfilled b JOIN employee e ON b.employee_id = e.employee_id"""
_q("upsert_changed", STAMPED.format(columns="""b.status, b.hire_date,
       (b.hire_date IS DISTINCT FROM e.hire_date OR b.status IS DISTINCT FROM e.status) AS changed"""))
_q("merge_history", STAMPED.format(columns="b.registration, b.status, b.hire_date"))

# ----------------------------------------------------------------- filters --
_q("employee_star", """
SELECT employee_id, registration, status, job_title, job_category, union_id, union_name, state_name,
       CAST(daily_value AS DOUBLE) AS daily_value FROM emp""")
_q("category_status_filter", f"""
SELECT employee_id, registration, job_category, status FROM emp
WHERE NOT (COALESCE(job_category IN ('ESTAGIARIO', 'APRENDIZ', 'DIRETOR'), FALSE)
           OR COALESCE(status IN {EXCLUDED_STATUSES}, FALSE))""")
_q("eligible_base", f"""
SELECT employee_id, registration, job_category, status, union_name FROM emp
WHERE employee_id NOT IN (SELECT employee_id FROM exclusion)
  AND employee_id NOT IN (SELECT employee_id FROM on_leave)
  AND NOT (COALESCE(job_category IN ('ESTAGIARIO', 'APRENDIZ', 'DIRETOR'), FALSE)
           OR COALESCE(status IN {EXCLUDED_STATUSES}, FALSE))""")
_q("eligible_view", f"""
SELECT employee_id, backfilled.registration, backfilled.status, backfilled.hire_date, backfilled.termination_date,
       'Empresa Principal' AS company_name, emp.job_title, emp.job_category, emp.union_full_name, emp.state_name,
       CAST(emp.daily_value AS DOUBLE) AS daily_value
FROM emp JOIN backfilled USING (employee_id)
WHERE emp.company_id = 1 AND NOT EXISTS (FROM exclusion WHERE exclusion.employee_id = emp.employee_id)
  AND emp.status NOT IN {EXCLUDED_STATUSES}""")
ELIGIBLE_REPORT = f"""
  employee_id NOT IN (SELECT employee_id FROM exclusion)
  AND status NOT IN {EXCLUDED_STATUSES}
  AND job_category = 'FUNCIONARIO'"""
_q("eligible_employees", f"""
SELECT registration, status, job_title, job_category, union_name, state_name,
       CAST(daily_value AS DOUBLE) AS daily_value
FROM emp WHERE {ELIGIBLE_REPORT}""")

# ------------------------------------------------------------------- joins --
_q("employee_working_days", f"""
SELECT e.employee_id, e.union_id, CAST(wd.working_days AS BIGINT) AS working_days
FROM employee e LEFT JOIN working_days wd ON e.union_id = wd.union_id AND {PERIOD_WD}""")
_q("employee_vacation", """
SELECT e.employee_id, CAST(COALESCE(v.vacation_days, 0) AS BIGINT) AS vacation_days
FROM employee e LEFT JOIN vac_sum v ON e.employee_id = v.employee_id""")
_q("exclusion_flag", """
SELECT e.employee_id, EXISTS (SELECT 1 FROM exclusion x WHERE x.employee_id = e.employee_id) AS is_excluded
FROM employee e""")
_q("leave_overlap", f"""
SELECT DISTINCT employee_id FROM leave_r
WHERE COALESCE(start_date, {P_START}) <= {P_END} AND (end_date IS NULL OR end_date >= {P_START})""")
_q("not_excluded", """
SELECT employee_id, registration FROM employee WHERE employee_id NOT IN (SELECT employee_id FROM exclusion)""")
_q("latest_hire", """
SELECT employee_id, arg_max(hire_date, hire_id) AS latest_hire_date FROM hire_r GROUP BY employee_id""")
_q("latest_termination", """
SELECT employee_id, arg_max(termination_date, termination_id) AS latest_termination_date,
       arg_max(notice_ok, termination_id) AS latest_notice_ok
FROM termination_r GROUP BY employee_id""")
_q("employees_with_hire", """
SELECT employee_id, registration FROM employee e
WHERE EXISTS (SELECT 1 FROM hire h WHERE h.employee_id = e.employee_id)""")
_q("duplicate_registrations", """
SELECT employee_id, registration FROM employee
WHERE registration IN (SELECT registration FROM employee GROUP BY registration HAVING COUNT(*) > 1)""")
_q("excluded_employees", """
SELECT e.registration, e.job_title, e.job_category, x.exclusion_type,
       CAST(x.specific_value AS DOUBLE) AS specific_value, x.notes
FROM emp_job e JOIN exclusion x ON e.employee_id = x.employee_id
ORDER BY x.exclusion_type, e.registration""")

# ------------------------------------------------------------- calculation --
LAYOUT = f"""registration, COALESCE(strftime(own_hire, '%d/%m/%Y'), '') AS admission, union_name,
       {P_LABEL} AS period_label, CAST(days AS BIGINT) AS days,
       CAST(daily_value AS DOUBLE) AS daily_value, CAST(total_dec AS DOUBLE) AS total,
       CAST(company_dec AS DOUBLE) AS company_cost, CAST(employee_dec AS DOUBLE) AS employee_discount,
       notes"""
_q("purchase_layout", f"SELECT {LAYOUT}, 'VR MENSAL 05.1998' AS sheet FROM calc")
_q("base_days", """
SELECT employee_id, CAST(wdays AS BIGINT) AS working_days, CAST(vdays AS BIGINT) AS vacation_days,
       CAST(d0 AS BIGINT) AS base_days FROM calc""")
_q("hire_proration", """
SELECT employee_id, eff_hire AS hire_date, hired_in AS hired_in_period, CAST(d0 AS BIGINT) AS base_days,
       CAST(d1 AS BIGINT) AS days_after_hire FROM calc""")
_q("termination_rule", """
SELECT employee_id, eff_term AS termination_date, ok AS notice_ok, term_in AS terminated_in_period,
       to_zero AS terminated_to_zero, CAST(d1 AS BIGINT) AS days_after_hire, CAST(days AS BIGINT) AS days
FROM calc""")
_q("benefit_amounts", """
SELECT employee_id, CAST(days AS BIGINT) AS days, CAST(daily_value AS DOUBLE) AS daily_value,
       CAST(total_dec AS DOUBLE) AS total, CAST(company_dec AS DOUBLE) AS company_cost,
       CAST(employee_dec AS DOUBLE) AS employee_discount FROM calc""")
_q("observations", "SELECT employee_id, notes FROM calc")
PAID = f"""
reportable AS (
  SELECT registration, job_title, union_id, union_name, daily_value, employee_id FROM emp
  WHERE job_category = 'FUNCIONARIO' AND status NOT IN {EXCLUDED_STATUSES}
    AND NOT EXISTS (FROM exclusion WHERE exclusion.employee_id = emp.employee_id)),
off AS (FROM vacation WHERE period_start = {P_START} AND period_end = {P_END}),
paid AS (
  SELECT r.*, d.working_days, coalesce(off.vacation_days, 0) AS away, d.working_days - coalesce(off.vacation_days, 0) AS calc_days
  FROM wd_default d JOIN reportable r USING (union_id) LEFT JOIN off USING (employee_id)),
money AS (SELECT *, calc_days * daily_value AS due FROM paid)"""


def _paid(name, body):
    SQL[name] = with_model(", " + PAID.strip() + body)


_paid("simple_calc", """
SELECT registration, job_title, union_name, CAST(daily_value AS DOUBLE) AS daily_value,
       CAST(working_days AS BIGINT) AS union_working_days, CAST(away AS BIGINT) AS vacation_days,
       CAST(calc_days AS BIGINT) AS calc_days, CAST(due AS DOUBLE) AS total_value,
       CAST(due * 0.8 AS DOUBLE) AS company_cost, CAST(due * 0.2 AS DOUBLE) AS employee_discount
FROM money""")
_paid("financial_summary", """
SELECT count(*) AS eligible_employees, CAST(sum(due) AS DOUBLE) AS total_value,
       CAST(sum(due) * 0.8 AS DOUBLE) AS company_cost, CAST(sum(due) * 0.2 AS DOUBLE) AS employee_discount
FROM money""")
_q("terminated_employees", """
, earliest AS (
  SELECT left_.*, employee.registration, employee.job_title
  FROM termination left_ JOIN employee USING (employee_id)
  QUALIFY row_number() OVER (ORDER BY left_.termination_date, registration, termination_id) <= 10)
SELECT registration, job_title, termination_date, notice_ok,
       if(notice_ok, 'Recebe VR proporcional', 'Não recebe VR') AS termination_rule
FROM earliest""")
RESULTS = """
  SELECT employee_id, CAST(5 AS BIGINT) AS period_month, CAST(1998 AS BIGINT) AS period_year,
         CAST(wdays AS BIGINT) AS union_working_days, CAST(vdays AS BIGINT) AS vacation_days,
         CAST(d0 AS BIGINT) AS worked_days, CAST(days AS BIGINT) AS calc_days,
         daily_value, total_dec AS total_value, company_dec AS company_cost,
         employee_dec AS employee_discount, notes
  FROM calc"""
_q("calc_results", f"""
SELECT employee_id, period_month, period_year, union_working_days, vacation_days, worked_days, calc_days,
       CAST(daily_value AS DOUBLE) AS daily_value, CAST(total_value AS DOUBLE) AS total_value,
       CAST(company_cost AS DOUBLE) AS company_cost, CAST(employee_discount AS DOUBLE) AS employee_discount,
       notes
FROM ({RESULTS}) r""")
_q("retain_vacations", """
SELECT vacation_id, employee_id, period_end FROM vacation WHERE period_end >= DATE '1996-06-10'""")

# --------------------------------------------------------------- agreement --
DEFAULT_V = "CASE WHEN COALESCE(daily_value, 0) <= 0 THEN CAST(37.5 AS DECIMAL(10,2)) ELSE daily_value END"
UNION_V = ("CASE union_name WHEN 'BRAZIL' THEN CAST(40.0 AS DECIMAL(10,2)) "
           "WHEN 'JAPAN' THEN CAST(30.0 AS DECIMAL(10,2)) ELSE daily_value END")
NOT_INTERN = "(job_category IS NULL OR job_category <> 'ESTAGIARIO')"
_q("agreement_default_value", f"SELECT registration, CAST({DEFAULT_V} AS DOUBLE) AS daily_value FROM calc")
_q("agreement_total", f"""
SELECT registration, CAST(days AS BIGINT) AS days, CAST(v AS DOUBLE) AS daily_value,
       CAST(round(days * v, 2) AS DOUBLE) AS total, CAST(company_dec AS DOUBLE) AS company_cost,
       CAST(employee_dec AS DOUBLE) AS employee_discount
FROM (SELECT *, {DEFAULT_V} AS v FROM calc) c""")
_q("agreement_exclude_category", f"SELECT registration, job_category FROM calc WHERE {NOT_INTERN}")
_q("agreement_union_value", f"""
SELECT registration, union_name, CAST({UNION_V} AS DOUBLE) AS daily_value FROM calc""")
_q("agreement_split", """
SELECT registration, CAST(total_dec AS DOUBLE) AS total,
       CAST(round(total_dec * 0.75, 2) AS DOUBLE) AS company_cost,
       CAST(round(total_dec * 0.25, 2) AS DOUBLE) AS employee_discount FROM calc""")
_q("agreement_cap", """
SELECT registration, CAST(total_dec AS DOUBLE) AS total,
       CAST(company_dec + (employee_dec - LEAST(employee_dec, 150.00)) AS DOUBLE) AS company_cost,
       CAST(LEAST(employee_dec, 150.00) AS DOUBLE) AS employee_discount FROM calc""")
_q("agreement_declared", f"""
SELECT registration, CAST(days AS BIGINT) AS days, CAST(v AS DOUBLE) AS daily_value, CAST(t AS DOUBLE) AS total,
       CAST(round(t * 0.75, 2) + (round(t * 0.25, 2) - LEAST(round(t * 0.25, 2), 150.00)) AS DOUBLE) AS company_cost,
       CAST(LEAST(round(t * 0.25, 2), 150.00) AS DOUBLE) AS employee_discount
FROM (SELECT *, round(days * v, 2) AS t FROM (
        SELECT *, CASE WHEN COALESCE(v1, 0) <= 0 THEN CAST(37.5 AS DECIMAL(10,2)) ELSE v1 END AS v
        FROM (SELECT *, {UNION_V} AS v1 FROM calc WHERE {NOT_INTERN}) a) b) c""")

# ------------------------------------------------------------ aggregations --
_q("vacation_days", f"""
SELECT employee_id, CAST(SUM(vacation_days) AS BIGINT) AS vacation_days FROM vacation_r
WHERE period_start = {P_START} AND period_end = {P_END} GROUP BY employee_id""")
_q("validation_totals", """
SELECT 'Total colaboradores' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM calc
UNION ALL SELECT 'Soma TOTAL', CAST(round(COALESCE(SUM(total_dec), 0), 2) AS DOUBLE) FROM calc
UNION ALL SELECT 'Soma Custo empresa', CAST(round(COALESCE(SUM(company_dec), 0), 2) AS DOUBLE) FROM calc
UNION ALL SELECT 'Soma Desconto profissional', CAST(round(COALESCE(SUM(employee_dec), 0), 2) AS DOUBLE) FROM calc""")
HEADS = f"""
, heads AS (
  SELECT union_id, count(*) AS total_employees, count(*) FILTER (status = 'Trabalhando') AS working,
         count(*) FILTER (status = 'Férias') AS on_vacation, count(*) FILTER (status IN {EXCLUDED_STATUSES}) AS on_leave
  FROM employee GROUP BY union_id),
shown AS (
  SELECT heads.*, union_name, state_name, CAST(daily_value AS DOUBLE) AS daily_value, CAST(wd_default.working_days AS BIGINT) AS working_days
  FROM heads JOIN wd_default USING (union_id) JOIN labor_union USING (union_id) JOIN state USING (state_id))
"""
_q("union_distribution", HEADS + "SELECT union_name, state_name, daily_value, working_days, total_employees, working, on_vacation FROM shown")
_q("union_summary", HEADS + "SELECT * EXCLUDE (union_id) FROM shown")
_q("union_headcount", HEADS + "SELECT union_name, total_employees, daily_value, working_days FROM shown")
_q("kpi_counts", f"""
SELECT 'total_employees' AS metric, CAST(COUNT(*) AS BIGINT) AS value FROM employee
UNION ALL SELECT 'eligible_employees', COUNT(*) FROM emp_job WHERE {ELIGIBLE_REPORT}
UNION ALL SELECT 'excluded', COUNT(*) FROM exclusion_r
UNION ALL SELECT 'interns', COUNT(*) FROM exclusion_r WHERE exclusion_type = 'ESTAGIARIO'
UNION ALL SELECT 'apprentices', COUNT(*) FROM exclusion_r WHERE exclusion_type = 'APRENDIZ'
UNION ALL SELECT 'abroad', COUNT(*) FROM exclusion_r WHERE exclusion_type = 'EXTERIOR'
UNION ALL SELECT 'on_vacation', COUNT(*) FROM vacation_r
UNION ALL SELECT 'on_leave', COUNT(*) FROM leave_r
UNION ALL SELECT 'terminated', COUNT(*) FROM termination_r
UNION ALL SELECT 'hired', COUNT(*) FROM hire_r""")
_q("table_counts", """
SELECT table_name, CAST(row_count AS BIGINT) AS row_count FROM (
  SELECT 'employees' AS table_name, COUNT(*) AS row_count FROM employee
  UNION ALL SELECT 'unions', COUNT(*) FROM labor_union
  UNION ALL SELECT 'states', COUNT(*) FROM state
  UNION ALL SELECT 'jobs', COUNT(*) FROM job
  UNION ALL SELECT 'companies', 1
  UNION ALL SELECT 'vacations', COUNT(*) FROM vacation_r
  UNION ALL SELECT 'leaves', COUNT(*) FROM leave_r
  UNION ALL SELECT 'terminations', COUNT(*) FROM termination_r
  UNION ALL SELECT 'hires', COUNT(*) FROM hire_r
  UNION ALL SELECT 'exclusions', COUNT(*) FROM exclusion_r
  UNION ALL SELECT 'working_days', COUNT(*) FROM working_days) t
UNION ALL
SELECT 'TOTAL', CAST((SELECT COUNT(*) FROM employee) + (SELECT COUNT(*) FROM labor_union)
  + (SELECT COUNT(*) FROM state) + (SELECT COUNT(*) FROM job) + 1 + (SELECT COUNT(*) FROM vacation_r)
  + (SELECT COUNT(*) FROM leave_r) + (SELECT COUNT(*) FROM termination_r) + (SELECT COUNT(*) FROM hire_r)
  + (SELECT COUNT(*) FROM exclusion_r) + (SELECT COUNT(*) FROM working_days) AS BIGINT)""")

# ----------------------------------------------------------------- top-N ---
_q("eligible_top", f"""
SELECT registration, status, job_title, job_category, union_name, state_name,
       CAST(daily_value AS DOUBLE) AS daily_value
FROM emp WHERE {ELIGIBLE_REPORT} ORDER BY registration LIMIT 10""")
_q("vacation_top", """
SELECT e.registration, e.job_title, u.union_name, CAST(v.vacation_days AS BIGINT) AS vacation_days,
       v.period_start, v.period_end
FROM employee e JOIN labor_union u ON e.union_id = u.union_id JOIN vacation v ON e.employee_id = v.employee_id
ORDER BY v.vacation_days DESC, e.registration, v.vacation_id LIMIT 10""")
_q("hires_in_month", """
SELECT e.registration, e.job_title, h.hire_date, u.union_name, CAST(s.daily_value AS DOUBLE) AS daily_value
FROM employee e JOIN hire h ON e.employee_id = h.employee_id
JOIN labor_union u ON e.union_id = u.union_id JOIN state s ON u.state_id = s.state_id
WHERE h.hire_date >= DATE '1998-04-01' AND h.hire_date <= DATE '1998-04-30'
ORDER BY h.hire_date, e.registration, h.hire_id LIMIT 10""")

# --------------------------------------------------------------- quality ---
_q("dq_report", """
, repeats AS (SELECT count(*) AS n FROM employee GROUP BY registration),
found AS (
  SELECT CAST(coalesce((SELECT sum(n) FROM repeats WHERE n > 1), 0) AS BIGINT) AS duplicate_registration,
         count(*) FILTER (union_id IS NULL) AS employee_without_union,
         count(*) FILTER (job_id IS NULL) AS employee_without_job,
         (SELECT count(*) - count(*) FILTER (daily_value > 0) FROM state) AS invalid_daily_value,
         (SELECT count(*) - count(*) FILTER (working_days BETWEEN 1 AND 31) FROM working_days) AS invalid_working_days
  FROM employee)
SELECT * FROM (UNPIVOT found ON * INTO NAME "check" VALUE offenders)""")
_q("dq_foreign_keys", """
SELECT 'employees.union_id' AS foreign_key, CAST(COUNT(*) AS BIGINT) AS offenders FROM employee e
  WHERE e.union_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labor_union u WHERE u.union_id = e.union_id)
UNION ALL SELECT 'employees.company_id', COUNT(*) FROM employee e WHERE e.company_id IS NOT NULL AND e.company_id <> 1
UNION ALL SELECT 'employees.job_id', COUNT(*) FROM employee e
  WHERE e.job_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM job j WHERE j.job_id = e.job_id)
UNION ALL SELECT 'unions.state_id', COUNT(*) FROM labor_union u
  WHERE u.state_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM state s WHERE s.state_id = u.state_id)
UNION ALL SELECT 'working_days.union_id', COUNT(*) FROM working_days w
  WHERE w.union_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labor_union u WHERE u.union_id = w.union_id)
UNION ALL SELECT 'vacations.employee_id', COUNT(*) FROM vacation WHERE employee_id NOT IN (SELECT employee_id FROM employee)
UNION ALL SELECT 'leaves.employee_id', COUNT(*) FROM leave_ WHERE employee_id NOT IN (SELECT employee_id FROM employee)
UNION ALL SELECT 'terminations.employee_id', COUNT(*) FROM termination WHERE employee_id NOT IN (SELECT employee_id FROM employee)
UNION ALL SELECT 'hires.employee_id', COUNT(*) FROM hire WHERE employee_id NOT IN (SELECT employee_id FROM employee)
UNION ALL SELECT 'exclusions.employee_id', COUNT(*) FROM exclusion WHERE employee_id NOT IN (SELECT employee_id FROM employee)""")
_q("dq_unique_keys", """
SELECT 'states.state_name' AS "check", CAST(COUNT(*) AS BIGINT) AS offenders FROM state
  WHERE state_name IN (SELECT state_name FROM state GROUP BY state_name HAVING COUNT(*) > 1)
UNION ALL SELECT 'states.uf', COUNT(*) FROM state WHERE uf IN (SELECT uf FROM state GROUP BY uf HAVING COUNT(*) > 1)
UNION ALL SELECT 'unions.union_full_name', COUNT(*) FROM labor_union
  WHERE union_full_name IN (SELECT union_full_name FROM labor_union GROUP BY union_full_name HAVING COUNT(*) > 1)
UNION ALL SELECT 'employees.registration', COUNT(*) FROM employee
  WHERE registration IN (SELECT registration FROM employee GROUP BY registration HAVING COUNT(*) > 1)
UNION ALL SELECT 'working_days.union_period', COUNT(*) FROM working_days w
  WHERE (union_id, period_start, period_end) IN (SELECT (union_id, period_start, period_end) FROM working_days
         GROUP BY union_id, period_start, period_end HAVING COUNT(*) > 1)
UNION ALL SELECT 'employees.status_not_null', COUNT(*) FROM employee WHERE status IS NULL
UNION ALL SELECT 'states.daily_value_not_null', COUNT(*) FROM state WHERE daily_value IS NULL""")
NO_EMP = "employee_id - 1 + 30000 NOT IN (SELECT registration FROM employee)"
_q("dq_unmatched", f"""
SELECT 'vacations' AS feed, CAST(COUNT(*) AS BIGINT) AS offenders FROM vacation WHERE {NO_EMP}
UNION ALL SELECT 'leaves', COUNT(*) FROM leave_ WHERE {NO_EMP}
UNION ALL SELECT 'terminations', COUNT(*) FROM termination WHERE {NO_EMP}
UNION ALL SELECT 'hires', COUNT(*) FROM hire WHERE {NO_EMP}
UNION ALL SELECT 'interns', COUNT(*) FROM exclusion WHERE exclusion_type = 'ESTAGIARIO' AND {NO_EMP}
UNION ALL SELECT 'apprentices', COUNT(*) FROM exclusion WHERE exclusion_type = 'APRENDIZ' AND {NO_EMP}
UNION ALL SELECT 'abroad', COUNT(*) FROM exclusion WHERE exclusion_type = 'EXTERIOR' AND {NO_EMP}""")
_q("dq_results", f"""
SELECT 'excluded_group_present' AS "check", CAST(COUNT(*) AS BIGINT) AS offenders FROM calc
  WHERE COALESCE(job_category IN ('ESTAGIARIO', 'APRENDIZ', 'DIRETOR'), FALSE)
     OR COALESCE(status IN {EXCLUDED_STATUSES}, FALSE)
     OR employee_id IN (SELECT employee_id FROM exclusion) OR employee_id IN (SELECT employee_id FROM on_leave)
UNION ALL SELECT 'split_not_total', COUNT(*) FROM calc WHERE company_dec + employee_dec <> total_dec
UNION ALL SELECT 'negative_value', COUNT(*) FROM calc WHERE days < 0 OR total_dec < 0
UNION ALL SELECT 'days_above_working_days', COUNT(*) FROM calc WHERE days > wdays
UNION ALL SELECT 'hire_after_termination', COUNT(*) FROM calc WHERE eff_hire > eff_term
UNION ALL SELECT 'terminated_before_period', COUNT(*) FROM calc WHERE eff_term < {P_START}
UNION ALL SELECT 'missing_working_days', COUNT(*) FROM calc WHERE wd_raw IS NULL""")

# ---------------------------------------------------------------- declared --
_q("working_days_from_calendar", f"""
SELECT u.union_id, {P_START} AS period_start, {P_END} AS period_end, CAST(COUNT(*) AS BIGINT) AS working_days
FROM labor_union u,
     (SELECT CAST(d AS DATE) AS d FROM generate_series(TIMESTAMP '1998-04-15', TIMESTAMP '1998-05-15',
                                                       INTERVAL 1 DAY) g(d)) cal
WHERE isodow(cal.d) <= 5
  AND NOT EXISTS (SELECT 1 FROM (VALUES (DATE '1998-04-21', CAST(NULL AS BIGINT)),
                                        (DATE '1998-05-01', CAST(NULL AS BIGINT)),
                                        (DATE '1998-04-23', CAST(4 AS BIGINT))) h(hd, hs)
                  WHERE h.hd = cal.d AND (h.hs IS NULL OR h.hs = u.state_id))
GROUP BY u.union_id""")
_q("consolidated_base", """
, active AS (SELECT * FROM employee WHERE status <> 'Férias'),
added AS (
  SELECT registration, arg_min(job_title, hire_id) AS job_title
  FROM hire JOIN employee USING (employee_id) GROUP BY registration)
SELECT registration, job_title FROM active
UNION ALL SELECT registration, job_title FROM added WHERE registration NOT IN (SELECT registration FROM active)""")
_q("abroad_value", """
SELECT e.employee_id, e.registration, CAST(COALESCE(x.specific_value, e.daily_value) AS DOUBLE) AS daily_value
FROM exclusion_r x JOIN emp e ON x.employee_id = e.employee_id WHERE x.exclusion_type = 'EXTERIOR'""")

_q("periods", """
SELECT period_start, period_end, strftime(period_end, '%m/%Y') AS period_label,
       CAST(date_diff('day', period_start, period_end) + 1 AS BIGINT) AS period_days
FROM (SELECT period_start, period_end FROM working_days
      UNION SELECT period_start, period_end FROM vacation) p""")


def _workdays(a: str, b: str) -> str:
    """Days from a to b, one by one, that are no weekend and no holiday of the row's state."""
    return (f"(SELECT COUNT(*) FROM generate_series(CAST({a} AS TIMESTAMP), CAST({b} AS TIMESTAMP), INTERVAL 1 DAY) g(d) "
            f"WHERE isodow(d) <= 5 AND CAST(d AS DATE) NOT IN (DATE '1998-04-21', DATE '1998-05-01') "
            f"AND NOT (state_id = 4 AND CAST(d AS DATE) = DATE '1998-04-23'))")


_q("workday_proration", f"""
SELECT employee_id, CAST(d1w AS BIGINT) AS days_after_hire, CAST(dw AS BIGINT) AS days,
       CAST(round(dw * daily_value, 2) AS DOUBLE) AS total
FROM (
  SELECT *, GREATEST(CASE WHEN to_zero THEN 0
                          WHEN term_in THEN CAST(round_even(CAST(d1w AS DOUBLE) * LEAST(GREATEST(
                               CAST({_workdays(P_START, 'eff_term')} AS DOUBLE) / {_workdays(P_START, P_END)},
                               0.0), 1.0), 0) AS INTEGER)
                          ELSE d1w END, 0) AS dw
  FROM (
    SELECT *, CASE WHEN hired_in THEN CAST(round_even(CAST(d0 AS DOUBLE) * LEAST(GREATEST(
                   CAST({_workdays('eff_hire', P_END)} AS DOUBLE) / {_workdays(P_START, P_END)},
                   0.0), 1.0), 0) AS INTEGER)
              ELSE d0 END AS d1w
    FROM (SELECT calc.*, labor_union.state_id FROM calc JOIN labor_union USING (union_id)) own) a) b""")


# ------------------------------------------------------- several periods ---
MULTI_PERIODS = [("1998-02-15", "1998-03-15", "29", "'03/1998'"),
                 ("1998-03-15", "1998-04-15", "32", "'04/1998'"),
                 ("1998-04-15", "1998-05-15", "31", "'05/1998'")]


def _calendar_wd(sfx: str, ps: str, pe: str) -> str:
    return f"""
wd_cal{sfx} AS (
  SELECT u.union_id, CAST(COUNT(*) AS INTEGER) AS working_days
  FROM labor_union u,
       (SELECT CAST(d AS DATE) AS d FROM generate_series(TIMESTAMP '{ps}', TIMESTAMP '{pe}', INTERVAL 1 DAY) g(d)) cal
  WHERE isodow(cal.d) <= 5
    AND NOT EXISTS (SELECT 1 FROM (VALUES (DATE '1998-04-21', CAST(NULL AS BIGINT)),
                                          (DATE '1998-05-01', CAST(NULL AS BIGINT)),
                                          (DATE '1998-04-23', CAST(4 AS BIGINT))) h(hd, hs)
                    WHERE h.hd = cal.d AND (h.hs IS NULL OR h.hs = u.state_id))
  GROUP BY u.union_id),"""


_ctes, _selects = [], []
for _i, (_ps, _pe, _days, _label) in enumerate(MULTI_PERIODS):
    _sfx = f"_m{_i}"
    _ctes.append(_calendar_wd(_sfx, _ps, _pe)
                 + period_ctes(_sfx, f"DATE '{_ps}'", f"DATE '{_pe}'", _days, f"wd_cal{_sfx}", _label))
    _selects.append(f"""
SELECT registration, COALESCE(strftime(own_hire, '%d/%m/%Y'), '') AS admission, union_name,
       period_label, CAST(days AS BIGINT) AS days,
       CAST(daily_value AS DOUBLE) AS daily_value, CAST(total_dec AS DOUBLE) AS total,
       CAST(company_dec AS DOUBLE) AS company_cost, CAST(employee_dec AS DOUBLE) AS employee_discount,
       notes
FROM calc{_sfx}""")
SQL["monthly_purchase_periods"] = ("WITH " + MODEL.strip() + ","
                                   + ",".join(_ctes) + "\n" + "\nUNION ALL".join(_selects))

_results, _ctes = [], []
for _i, (_ps, _pe, _days, _label) in enumerate(MULTI_PERIODS):
    # working days of the seeded table exist for the last period only; the others have none
    _wd = f"wd_seed{_i} AS (SELECT union_id, working_days FROM working_days WHERE period_start = DATE '{_ps}' AND period_end = DATE '{_pe}'),"
    _ctes.append("\n" + _wd + period_ctes(f"_s{_i}", f"DATE '{_ps}'", f"DATE '{_pe}'", _days, f"wd_seed{_i}", _label))
    _results.append(f"SELECT CAST(month(DATE '{_pe}') AS BIGINT) AS period_month, CAST(year(DATE '{_pe}') AS BIGINT) AS period_year, "
                    f"employee_id, days, total_dec, company_dec, employee_dec FROM calc_s{_i}")
SQL["period_summary"] = ("WITH " + MODEL.strip() + "," + ",".join(_ctes) + f"""
SELECT period_month, period_year, CAST(COUNT(*) AS BIGINT) AS total_employees,
       CAST(SUM(days) AS BIGINT) AS total_days, CAST(SUM(total_dec) AS DOUBLE) AS total_value,
       CAST(SUM(company_dec) AS DOUBLE) AS company_cost, CAST(SUM(employee_dec) AS DOUBLE) AS employee_discount
FROM ({" UNION ALL ".join(_results)}) r GROUP BY period_month, period_year""")

SQL["retain_results"] = ("WITH " + MODEL.strip() + "," + ",".join(_ctes) + f"""
SELECT employee_id, period_month, period_year, CAST(days AS BIGINT) AS calc_days
FROM ({" UNION ALL ".join(_results)}) r WHERE period_year * 12 + period_month >= 1998 * 12 + 4""")


# ----------------------------------------------- the same checks over faults --
def _faulty(model: str, changes: dict[str, str]) -> str:
    """``model`` with further CTEs right after those they change: ``name`` becomes ``name_clean``, and ``name`` reads it."""
    for name, select in changes.items():
        at = model.index(f"\n{name} AS (") + 1
        end, depth = at + len(f"{name} AS "), 0
        while True:
            depth += {"(": 1, ")": -1}.get(model[end], 0)
            end += 1
            if not depth:
                break
        model = model[:at] + f"{name}_clean" + model[at + len(name):end] + f",\n{name} AS ({select.format(f'{name}_clean')})" + model[end:]
    return model


def _lost(key: str) -> str:
    return "SELECT * REPLACE (CASE WHEN " + key + " % 13 = 0 THEN employee_id + 10000000 ELSE employee_id END AS employee_id) FROM {}"


FAULTS = {
    "state": "SELECT * REPLACE (CASE WHEN state_id = 2 THEN NULL ELSE daily_value END AS daily_value, CASE WHEN state_id = 3 THEN 'AF' ELSE uf END AS uf) FROM {}",
    "labor_union": "SELECT * REPLACE (CASE WHEN union_id = 7 THEN 10000000 ELSE state_id END AS state_id, "
                   "CASE WHEN union_id = 9 THEN 'CANADA - SINDICATO' ELSE union_full_name END AS union_full_name) FROM {}",
    "job": "SELECT * REPLACE (CASE WHEN job_id % 5 = 0 THEN NULL ELSE category END AS category) FROM {}",
    "employee_raw": "SELECT * REPLACE (CASE WHEN employee_id % 97 = 0 THEN registration - 1 ELSE registration END AS registration, "
                    "CASE WHEN employee_id % 89 = 0 THEN NULL WHEN employee_id % 83 = 0 THEN union_id + 10000000 ELSE union_id END AS union_id, "
                    "CASE WHEN employee_id % 79 = 0 THEN NULL WHEN employee_id % 73 = 0 THEN job_id + 10000000 ELSE job_id END AS job_id, "
                    "CASE WHEN employee_id % 71 = 0 THEN NULL ELSE status END AS status) FROM {}",
    "working_days": "SELECT w.* REPLACE (CASE union_id WHEN 3 THEN 0 WHEN 4 THEN NULL WHEN 5 THEN 40 ELSE working_days END AS working_days) "
                    "FROM {} w, generate_series(1, CASE WHEN union_id = 6 THEN 2 ELSE 1 END)",
    "vacation": _lost("vacation_id"), "hire": _lost("hire_id"), "termination": _lost("termination_id"), "leave_": _lost("leave_id"), "exclusion": _lost("exclusion_id"),
}
_FAULTY = _faulty("\n" + MODEL.strip(), FAULTS).strip()
_CLEAN_PREFIX = "WITH " + MODEL.strip()
for _name in ("dq_report", "dq_foreign_keys", "dq_unique_keys", "dq_unmatched", "duplicate_registrations", "kpi_counts"):
    SQL[f"{_name}_faults"] = "WITH " + _FAULTY + SQL[_name][len(_CLEAN_PREFIX):]
SQL["category_status_faults"] = "WITH " + _FAULTY + f"""
SELECT employee_id, job_category, status FROM emp
WHERE coalesce(job_category, '') NOT IN ('ESTAGIARIO', 'APRENDIZ', 'DIRETOR') AND coalesce(status, '') NOT IN {EXCLUDED_STATUSES}"""
SQL["resolve_hires_faults"] = "WITH " + _FAULTY + f"""
SELECT e.employee_id, e.registration FROM hire h JOIN employee e ON e.registration = h.employee_id - 1 + 30000"""
SQL["employee_dim_faults"] = "WITH " + _FAULTY + """
, by_name AS (SELECT union_full_name, min(union_id) AS union_id FROM labor_union GROUP BY 1)
SELECT e.registration, coalesce(n.job_id, 1) AS job_id, coalesce(b.union_id, 1) AS union_id, n.job_id IS NOT NULL AS job_id_matched,
       b.union_id IS NOT NULL AS union_id_matched
FROM employee e LEFT JOIN labor_union u ON u.union_id = e.union_id LEFT JOIN by_name b ON b.union_full_name = u.union_full_name
LEFT JOIN title_number n ON n.title = e.job_title"""
_q("cast_checked_faults", f"""
SELECT termination_id, CASE WHEN termination_id % 17 <> 0 THEN {REG} END AS registration,
       CASE WHEN termination_id % 11 <> 0 THEN termination_date END AS termination_date,
       concat_ws(',', CASE WHEN termination_id % 17 = 0 THEN 'MATRICULA' END, CASE WHEN termination_id % 11 = 0 THEN 'DATA_DEMISSAO' END) AS cast_errors
FROM termination""")
_q("agreement_exclude_apprentices", """
SELECT registration, job_category FROM emp_job WHERE job_category IS NULL OR job_category NOT IN ('ESTAGIARIO', 'APRENDIZ')""")
