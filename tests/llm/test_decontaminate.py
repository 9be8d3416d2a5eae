import brute
from brute import SF

from lunchbox.llm import decontaminate as D


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_both_ways_match_brute_force(spark, documents, texts):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = sorted(brute.contamination(texts, [(r.item_id, r.text) for r in bench.collect()]), key=str)
    assert any(r[-1] for r in want)
    assert rows(D.contamination(documents, bench)) == want
    assert rows(D.contamination(documents, bench, most=1)) == want


def test_edges(spark, edges, empty):
    items = [(1, "the quick brown fox"), (2, "The, quick; BROWN fox"), (3, ""), (4, None), (None, "one"), (5, "One"), (6, "no such words here"),
             (7, brute_window()), (5, "One")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    want = sorted(brute.contamination(docs, [x for x in items if x[0] is not None]), key=str)
    assert rows(D.contamination(edges, bench)) == want
    assert rows(D.contamination(edges, bench, most=0)) == want
    assert rows(D.contamination(empty, bench)) == []
    assert not any(r.contaminated for r in D.contamination(edges, bench.limit(0)).collect())
    kept = D.without_contaminated(edges, bench)
    assert kept.columns == edges.columns
    assert kept.count() == sum(not r[-1] for r in want)


def brute_window():
    return "fox jumps over the lazy dog and runs far away from the old red barn"


def test_spans_are_cut(spark):
    docs = spark.createDataFrame([(1, "keep this. One two THREE, then that"), (2, "nothing"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = {r.doc_id: r.text for r in D.without_spans(docs, bench).collect()}
    assert got == {1: "keep this. , then that", 2: "nothing", 3: None}


def test_spans_of_larger_benchmarks_are_cut(spark, edges, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = documents.select("doc_id", "text")
    want = rows(D.without_spans(docs, bench))
    assert want != rows(docs) and rows(D.without_spans(docs, bench, most=0)) == want
    small = spark.createDataFrame([(1, brute_window())], "item_id long, text string")
    assert rows(D.without_spans(edges, small, most=0)) == rows(D.without_spans(edges, small)) != rows(edges)
