import random

import brute
from pyspark.sql import functions as F

from lunchbox.llm import jaccard_join as J
from lunchbox.llm.graph import components


def got(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in J.linked_documents(docs).collect()}


def test_matches_brute_force(documents, texts):
    want = brute.linked(texts)
    assert len({c for _, c in want.values()}) < len(want)
    assert got(documents) == want


def test_families_of_near_copies(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    docs, k = [], 0
    for family in range(4):
        base = [rng.choice(words) for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(60):
            text = list(base)
            for _ in range(rng.randrange(6)):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.2:
                text = text[rng.randrange(4):]
            k += 1
            docs.append((k * 7 % 1009, " ".join(text)))
    passage = " ".join(rng.choice(words) for _ in range(60))
    docs += [(2000 + i, passage + " " + " ".join(rng.choice(words) for _ in range(rng.randrange(5, 120)))) for i in range(80)]
    want = brute.linked(docs)
    assert 10 < len({c for _, c in want.values()}) < len(docs) - 50
    assert got(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)) == want


def test_edges(spark, edges, empty):
    rows = J.linked_documents(edges).collect()
    assert len(rows) == edges.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert by_id[1] == {(0, 1)} and by_id[2] == {(0, 2)} and by_id[3] == {(0, 3)} and by_id[10] == {(0, 10)}
    assert by_id[4] == {(1, 4)} and by_id[5] == {(1, 4)}
    assert by_id[8] == by_id[7] and by_id[9] == {(by_id[7].copy().pop()[0] + 1, 7)} and (by_id[15]) == by_id[7]
    assert {c for _, c in by_id[None]} == {7, None}
    assert got(empty) == {}
    assert J.one_of_each_group(empty).count() == 0
    kept = J.one_of_each_group(edges)
    assert kept.columns == edges.columns
    assert kept.where("doc_id in (7, 8, 9, 15)").count() == 1


def test_components_of_a_chain(spark):
    edges = spark.range(300).select(F.format_string("%04d", "id").alias("a"), F.format_string("%04d", F.col("id") + 1).alias("b"))
    edges = edges.union(spark.createDataFrame([("x", "y"), ("y", "x"), ("z", "z")], "a string, b string"))
    labels = {r.node: r.label for r in components(edges).collect()}
    assert len({labels[f"{i:04d}"] for i in range(301)}) == 1
    assert labels["x"] == labels["y"] != labels["0000"]
