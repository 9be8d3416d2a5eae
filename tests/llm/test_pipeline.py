import brute
import corpus_pipeline
from brute import SMALL

from lunchbox.llm import toxicity


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    stage = dict(corpus_pipeline.STAGES)
    frames = [docs]
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, frames[-1], SMALL)
        assert out.columns == docs.columns, name
        frames.append(out.cache())
    texts = [{r.doc_id: r.text for r in f.collect()} for f in frames]
    bad = {r.doc_id for r in toxicity.scores(docs, labels).collect() if r.predicted == 1}
    assert set(texts[1]) == set(texts[0]) - bad
    assert texts[2] == brute.line_removal(list(texts[1].items()))
    linked = brute.linked(list(texts[2].items()))
    assert set(texts[3]) == {i for i, (_, c) in linked.items() if c == i}
    judged = brute.contamination(list(texts[3].items()), [(r.item_id, r.text) for r in bench.collect()])
    assert set(texts[4]) == {r[0] for r in judged if not r[-1]}
    last = stage["bpe"](spark, frames[-1], SMALL).collect()
    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r.doc_id for r in last) == sorted(texts[4])
    assert sorted((r.doc_id, r.ids_sha256) for r in whole) == sorted((r.doc_id, r.ids_sha256) for r in last)


def test_stages_on_edges(spark, edges, empty):
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, edges, SMALL).count() <= edges.count(), name
        assert function(spark, empty, SMALL).count() == 0, name
