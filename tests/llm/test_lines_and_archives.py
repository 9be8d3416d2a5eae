import random

import brute
import pyarrow as pa
from brute import EDGES, SF
from oracle_compare import compare, duck_connection
from pyspark.sql import functions as F

from lunchbox.llm import line_dedup as L, warc_fixity as W
from lunchbox.llm.queries import QUERIES, SQL


def test_lines_match_brute_force(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(30, 60))) for _ in range(120)]
    docs = []
    for i in range(150):
        own = []
        for _ in range(rng.randrange(1, 5)):
            line = rng.choice(lines).split(" ")
            if rng.random() < 0.4:
                line[rng.randrange(len(line))] = rng.choice(words)
            own.append(" ".join(line))
        docs.append((i, "\n".join(own + ["", "ok", "  "][:rng.randrange(4)])))
    want = brute.line_removal(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in L.without_similar_lines(df).collect()}
    assert got == want
    assert sum(len(t) for t in got.values()) < sum(len(t) for _, t in docs) / 2


def test_line_edges(spark, edges, empty):
    out = L.without_similar_lines(edges)
    assert out.columns == edges.columns and out.count() == len(EDGES)
    rows = {}
    for r in out.collect():
        rows.setdefault(r.doc_id, []).append(r.text)
    assert rows[1] == [None] and rows[2] == [""] and rows[3] == ["   \n\t "] and rows[10] == ["\n\n\n"]
    assert rows[8] == [""] and rows[9] == [""] and rows[7] == [brute_copy(), brute_copy()]
    assert L.without_similar_lines(empty).count() == 0
    counted = L.deduplicated(edges)
    assert counted.count() == len(EDGES) and counted.where("n_removed > n_lines").count() == 0


def brute_copy():
    return EDGES[6][1]


def test_given_documents_match_brute_force(documents):
    some = documents.where("doc_id < 120")
    want = brute.line_removal([(r.doc_id, r.text) for r in some.collect()])
    assert {r.doc_id: r.text for r in L.without_similar_lines(some).collect()} == want


def test_many_lines_of_one_text(spark):
    text = "\n".join(["the very same line of a log file"] * 300_000 + [f"line number {k * 7919 % 100_000:06d} of another log, told apart by its number" for k in range(20)])
    rows = L.without_similar_lines(spark.createDataFrame([(1, text), (2, "the very same line of a log file\nand one more")], "doc_id long, text string"), removed=True).collect()
    by = {r.doc_id: r for r in rows}
    assert by[1].removed >= 299_999 and by[1].text.startswith("the very same line of a log file\nline number")
    assert by[2].text == "and one more"


def test_rows_without_id_are_judged_by_themselves(spark):
    lines = ["a line that several rows without an id hold", "another line of that kind, but not like it"]
    rows = [(None, f"{lines[0]}\nonly here {k}") for k in range(50)] + [(None, lines[1]), (None, f"{lines[1]}\n"), (3, lines[1])]
    out = [r.text for r in L.without_similar_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()]
    assert len(out) == len(rows)
    assert sum(lines[0] in t for t in out) == 1 and sum(lines[1] in t for t in out) == 1 and lines[1] in out


def test_hot_keys_and_blocks(spark, monkeypatch):
    """A family of near copies in every block: all of them are one component, whatever the blocks and ranges."""
    rng = random.Random(11)
    family = _words(rng, 60)
    lines = []
    for k in range(400):
        own = family.split(" ")
        own[rng.randrange(60)] = f"changed{k}"
        lines.append(" ".join(own))
    for name, value in (("BLOCK_LINES", 16), ("RANGE_BYTES", 4096), ("HELD", 64), ("STEP", 100)):
        monkeypatch.setattr(L, name, value)
    got, want = _lines_left(spark, lines + [_words(rng, 30) for _ in range(50)])
    assert got == want and sum(t == "" for t in got.values()) >= 399


def test_long_lines_are_compared_part_by_part(monkeypatch):
    rng = random.Random(12)
    long = _words(rng, 800)
    cases = [(long, "x" + long[1:], True), (long, long[:2500], False), ("y" * 5000, "y" * 4000, True), ("short", "short", False)]
    for most in (64, 1 << 20):
        monkeypatch.setattr(L, "LONG", most)
        assert [L._link(pa.scalar(a), pa.scalar(b)) for a, b, _ in cases] == [want for *_, want in cases]


def test_audit_matches_sql(spark):
    assert compare(spark, "op3_warc_fixity", SF, QUERIES["op3_warc_fixity"], SQL["op3_warc_fixity"], duck_connection(SF))[0]


def test_audit_edges(spark):
    rows = [(1, "u", "x"), (2, None, None), (2, None, None), (3, "u", ""), (None, "u", "none"), (90_000, "far", "away"), (-4, "u", "neg")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    a = W.stored(pages)
    assert W.audit(a, a).count() == 0
    assert W.audit(a.limit(0), a.limit(0)).count() == 0
    assert {r.kind for r in W.audit(a, a.limit(0)).collect()} == {"missing"} and W.audit(a, a.limit(0)).count() == len(rows)
    far = W.stored(spark.createDataFrame([((1 << 62) + 1, "u", "beyond doubles")], pages.schema))
    assert [r.kind for r in W.audit(far.limit(0), far).collect()] == ["extra"]
    b = spark.createDataFrame([(1, "u", "y"), *rows[2:4], *rows[5:], (70, "new", "n")], pages.schema)
    got = sorted((str(r.page_id), r.kind) for r in W.audit(a, W.stored(b.withColumn("node", F.lit(1)))).collect())
    # the second record of page 2 closed the gap of the first, so that page 3 lies elsewhere
    assert got == sorted([("1", "changed"), ("2", "missing"), ("None", "missing"), ("70", "extra"), ("3", "moved")])


def test_moved_records_are_located(spark):
    pages = spark.createDataFrame([(k, "u", "text " * (k % 50)) for k in range(3000)], "page_id long, url string, html string")
    a = W.stored(pages)
    moved = a.withColumn("offset", F.when(F.col("page_id").isin(5, 2500), F.col("offset") + 1_000_000).otherwise(F.col("offset")))
    got = {r.page_id: (r.kind, r.replica_offset - r.record_offset) for r in W.audit(a, moved).collect()}
    assert got == {5: ("moved", 1_000_000), 2500: ("moved", 1_000_000)}
    swapped = a.where("page_id = 7").select("offset").first()[0]
    both = a.withColumn("offset", F.when(F.col("page_id") == 9, F.lit(swapped)).otherwise(F.col("offset")))  # two records at one offset
    assert {(r.page_id, r.kind) for r in W.audit(a, both).collect()} == {(9, "moved")}


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(4, 9))) for _ in range(n))


def _lines_left(spark, lines):
    """What is left of documents of a line each, and what brute force leaves."""
    docs = list(enumerate(lines))
    out = L.without_similar_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    return {r.doc_id: r.text for r in out}, brute.line_removal(docs)


def test_lines_of_one_template_meet_each_other(spark):
    rng = random.Random(8)
    template = _words(rng, 60)
    tails = [_words(rng, 20) for _ in range(40)]
    got, want = _lines_left(spark, [f"{template} {t}" for t in tails] + [f"{template} {t[:-1]}z" for t in tails])
    assert sum(t == "" for t in want.values()) == 40
    assert got == want


def test_change_at_the_beginning_of_a_short_line(spark):
    lines = ["The annual report of 2024 ends", "the annual report of 2024 ends"]
    got, want = _lines_left(spark, lines)
    assert got == want == {0: lines[0], 1: ""}


def test_signatures_of_all_scripts_and_lengths(spark):
    rng = random.Random(9)
    signs = [chr(0x4E00 + k) for k in range(3000)] + ["\U0001F600"]
    chinese = ["".join(rng.choice(signs) for _ in range(200)) for _ in range(30)]
    encoded = ["".join(rng.choice("0123456789abcdef") for _ in range(120)) for _ in range(30)]
    short = ["abcdefghijkl", "abcdefghijk", "zzzzzzzzz", "zzzzzzzz", "ab cdefghijklmnopqr", "abxcdefghijklmnopqr"]
    lines = chinese + encoded + short + ["〇" + x[1:] for x in chinese] + [x[:4] + "-" + x[5:] for x in encoded]
    got, want = _lines_left(spark, lines)
    assert sum(t == "" for t in want.values()) >= 62
    assert got == want
