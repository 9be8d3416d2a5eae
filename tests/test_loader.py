"""From CSV sheets to the model: DuckDB reads the same files and agrees on model and quarantine."""

import csv
import random

import duckdb
import pytest

from lunchbox.operators import calc
from lunchbox.periods import Period
from lunchbox.sources.builder import d
from lunchbox.sources import jobs
from lunchbox.sources.loader import SHEETS, load_sheets, read_quarantine

PERIOD = Period(d("2025-04-15"), d("2025-05-15"))
REG_BAD = ["", "x12", "12.5.1", None]


def write(folder, name, header, rows, raw=()):
    with open(folder / name, "w", newline="", encoding="utf-8") as out:
        w = csv.writer(out, lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)
        for line in raw:
            out.write(line + "\n")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Eight sheets of 400 employees with bad cells, malformed lines, repeated and unknown registrations, and a padded header."""
    at = tmp_path_factory.mktemp("sheets")
    rng = random.Random(3)
    reg = lambda: rng.choice([*range(1000, 1400)] * 3 + [*range(5000, 5060), "", "x12", " 1007 "])
    titles = ["ANALISTA", "ESTAGIARIO DE TI", "JOVEM APRENDIZ", "DIRETORA", "TECNICO, SENIOR", ""]
    unions = ["SIND A", "SIND B", "SIND UNKNOWN", ""]
    date = lambda: rng.choice(["2025-04-20", "20/04/2025", "2025-05-01 00:00:00", "31/02/2025", "soon", ""])
    write(at, "ativos.csv", ["MATRICULA ", "EMPRESA", "TITULO DO CARGO", "DESC. SITUACAO", "Sindicato"],
          [(k if k % 40 else "bad", 1, rng.choice(titles), rng.choice(["Trabalhando", "Férias", "Atestado", ""]), rng.choice(unions)) for k in range(1000, 1400)]
          + [(1001, 1, "REPEATED", "Trabalhando", "SIND A"), (1002, 1, "REPEATED", "Trabalhando", "SIND A")], ["1003,1,too,many,cells,here", "1004,too few"])
    write(at, "ferias.csv", ["MATRICULA", "DESC. SITUACAO", "DIAS DE FÉRIAS"], [(reg(), "Férias", rng.choice([5, 10, "many", ""])) for _ in range(200)])
    write(at, "afastamentos.csv", ["MATRICULA", "DESC. SITUACAO", "na compra?", "INICIO", "FIM"],
          [(reg(), "Atestado", "sim", *rng.choice([("2025-04-10", "2025-04-20"), ("", ""), ("2024-01-01", "2024-02-01"), ("never", "")])) for _ in range(60)])
    write(at, "desligados.csv", ["MATRICULA ", "DATA DEMISSÃO", "COMUNICADO DE DESLIGAMENTO"], [(reg(), date(), rng.choice(["OK", "ok", ""])) for _ in range(90)])
    write(at, "admissoes.csv", ["MATRICULA", "Admissão", "Cargo"], [(reg(), date(), rng.choice(titles + ["NOVO CARGO"])) for _ in range(90)])
    write(at, "estagiarios.csv", ["MATRICULA", "TITULO DO CARGO", "na compra?"], [(reg(), rng.choice(titles), "") for _ in range(20)])
    write(at, "aprendizes.csv", ["MATRICULA", "TITULO DO CARGO"], [(reg(), "APRENDIZ B") for _ in range(20)])
    write(at, "exterior.csv", ["Cadastro", "Valor", "Unnamed: 2"], [(reg(), rng.choice(["10.50", "ten", ""]), rng.choice(["note", ""])) for _ in range(20)])
    write(at, "states.csv", ["state_id", "state_name", "uf", "daily_value"], [(1, "S", "SS", "37.50"), (2, "T", "TT", "35.00")])
    write(at, "unions.csv", ["union_id", "union_full_name", "union_name", "state_id"], [(1, "SIND A", "A", 1), (2, "SIND B", "B", 2)])
    write(at, "working_days.csv", ["union_id", "period_start", "period_end", "working_days"], [(u, PERIOD.start, PERIOD.end, 20 + u) for u in (1, 2)])
    return at


@pytest.fixture(scope="module")
def loaded(spark, folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("model"))
    return load_sheets(spark, str(folder), root, PERIOD), root


REGISTRATION = "TRY_CAST(trim({}) AS BIGINT)"
DATE = "COALESCE(CAST(try_strptime(trim({0}), '%d/%m/%Y') AS DATE), CAST(TRY_CAST(trim({0}) AS TIMESTAMP) AS DATE))"


@pytest.fixture(scope="module")
def duck(folder):
    """The good rows by DuckDB, straight from the files."""
    con = duckdb.connect()
    for name, sheet in SHEETS.items():
        header = next(csv.reader(open(folder / sheet.file, encoding="utf-8")))
        columns = ", ".join(f"'{h}': 'VARCHAR'" for h in header)
        con.execute(f"CREATE TABLE raw_{name} AS SELECT *, row_number() OVER () AS line FROM read_csv('{folder}/{sheet.file}', header=true, auto_detect=false, "
                    f"columns={{{columns}}}, delim=',', quote='\"', ignore_errors=true)")
    con.execute(f"""CREATE TABLE emp AS SELECT {REGISTRATION.format('"MATRICULA "')} AS registration, nullif(trim("TITULO DO CARGO"), '') AS title,
        trim("DESC. SITUACAO") AS status, trim("Sindicato") AS union_name, line FROM raw_employees
        WHERE {REGISTRATION.format('"MATRICULA "')} IS NOT NULL AND trim("DESC. SITUACAO") <> ''
        QUALIFY row_number() OVER (PARTITION BY registration ORDER BY line) = 1""")
    return con


def rows(con, sql):
    return sorted(map(tuple, con.sql(sql).fetchall()), key=repr)


def of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_employees_agree(loaded, duck):
    m, _ = loaded
    got = of(m.employees.join(m.jobs, "job_id", "left").select("registration", "status", "union_id", "title"))
    first = m.jobs.where("job_id = 1").first().title
    assert got == rows(duck, f"""SELECT registration, status, CASE union_name WHEN 'SIND B' THEN 2 ELSE 1 END, coalesce(title, '{first}') FROM emp""")


def test_feeds_agree(loaded, duck):
    m, _ = loaded
    known = "IN (SELECT registration FROM emp)"
    reg = REGISTRATION.format('"MATRICULA"')
    assert of(m.vacations.select("employee_id", "vacation_days")) == rows(duck, f"""
        SELECT {reg}, TRY_CAST("DIAS DE FÉRIAS" AS INT) FROM raw_vacations WHERE {reg} {known} AND TRY_CAST("DIAS DE FÉRIAS" AS INT) IS NOT NULL""")
    padded = REGISTRATION.format('"MATRICULA "')
    assert of(m.terminations.select("employee_id", "termination_date", "notice_ok")) == rows(duck, f"""
        SELECT {padded}, {DATE.format('"DATA DEMISSÃO"')}, coalesce("COMUNICADO DE DESLIGAMENTO" = 'OK', false) FROM raw_terminations
        WHERE {padded} {known} AND {DATE.format('"DATA DEMISSÃO"')} IS NOT NULL""")
    assert of(m.hires.select("employee_id", "hire_date")) == rows(duck, f"""
        SELECT {reg}, {DATE.format('"Admissão"')} FROM raw_hires WHERE {reg} {known} AND {DATE.format('"Admissão"')} IS NOT NULL""")
    assert of(m.leaves.select("employee_id", "start_date", "end_date")) == rows(duck, f"""
        SELECT {reg}, coalesce(TRY_CAST("INICIO" AS DATE), DATE '2025-04-15'), TRY_CAST("FIM" AS DATE) FROM raw_leaves
        WHERE {reg} {known} AND (coalesce(trim("INICIO"), '') = '' OR TRY_CAST("INICIO" AS DATE) IS NOT NULL)""")
    assert of(m.exclusions.selectExpr("employee_id", "exclusion_type", "CAST(specific_value AS DOUBLE)")) == rows(duck, f"""
        SELECT {reg}, 'ESTAGIARIO', NULL::DOUBLE FROM raw_interns WHERE {reg} {known} UNION ALL SELECT {reg}, 'APRENDIZ', NULL FROM raw_apprentices WHERE {reg} {known}
        UNION ALL SELECT {REGISTRATION.format('"Cadastro"')}, 'EXTERIOR', TRY_CAST("Valor" AS DOUBLE) FROM raw_abroad
        WHERE {REGISTRATION.format('"Cadastro"')} {known} AND (coalesce("Valor", '') = '' OR TRY_CAST("Valor" AS DOUBLE) IS NOT NULL)""")


def test_model_and_quarantine_add_up(spark, folder, loaded):
    m, root = loaded
    lost = read_quarantine(spark, root)
    counts = {r.feed: r["count"] for r in lost.groupBy("feed").count().collect()}
    kept = {"employees": m.employees, "vacations": m.vacations, "leaves": m.leaves, "terminations": m.terminations, "hires": m.hires}
    for feed, sheet in SHEETS.items():
        total = len((folder / sheet.file).read_text().splitlines()) - 1
        good = kept[feed].count() if feed in kept else m.exclusions.where(f"exclusion_type = '{ {'interns': 'ESTAGIARIO', 'apprentices': 'APRENDIZ', 'abroad': 'EXTERIOR'}[feed] }'").count()
        assert 0 < counts[feed] < total and good + counts[feed] == total, feed
    reasons = {r.reason.split(":")[0] for r in lost.collect()}
    assert reasons >= {"malformed row", "bad MATRICULA", "bad DATA_DEMISSAO", "bad INICIO", "bad VALOR", "repeated registration", "unknown registration"}
    own = lost.where("feed = 'employees' AND reason = 'malformed row'").collect()
    assert {r.row for r in own} == {"1003,1,too,many,cells,here", "1004,too few"} and {r.file for r in own} == {"ativos.csv"}


def test_a_month_runs_from_the_sheets(loaded):
    m, _ = loaded
    out = calc.monthly_purchase(m)
    assert 50 < out.count() < 400 and out.where("days > 0").count() > 0


def test_ids_of_jobs_last(spark, folder, loaded, tmp_path):
    m, root = loaded
    before = {r.title: r.job_id for r in m.jobs.collect()}
    assert sorted(before.values()) == list(range(1, len(before) + 1)) and list(before) and sorted(before, key=before.get) == sorted(before)
    more = spark.createDataFrame([("AAA FIRST OF ALL",), ("ANALISTA",), ("ZZZ LAST",), (None,)], "title string")
    after = {r.title: r.job_id for r in jobs.extend_jobs(spark, f"{root}/jobs", more).collect()}
    n = len(before)
    assert {t: after[t] for t in before} == before and after["AAA FIRST OF ALL"] == n + 1 and after["ZZZ LAST"] == n + 2 and len(after) == n + 2
    assert {r.title: r.job_id for r in jobs.extend_jobs(spark, f"{root}/jobs", more).collect()} == after
    again = load_sheets(spark, str(folder), root, PERIOD)  # a second load keeps every id
    assert {r.title: r.job_id for r in again.jobs.collect()} == after


def test_a_missing_column_is_an_error(spark, folder, tmp_path):
    write(tmp_path, "ferias.csv", ["MATRICULA", "other"], [(1, 2)])
    from lunchbox.sources.loader import read_feed
    with pytest.raises(ValueError, match="DIAS_DE_FERIAS"):
        read_feed(spark, str(tmp_path), "vacations")
