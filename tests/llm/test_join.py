"""Operator 9 and components, against plain Python."""

import random

import pytest
from conftest import TESTDATA
from llm_tables import edges, no_docs  # noqa: F401
from pyspark.sql import functions as F

from tripflow.llm import near_copies
from tripflow.llm.components import connected


def shingle_set(text, n):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + n]) for k in range(max(len(words) - n, 0) + 1)} if words else set()


def by_hand(docs, n, least):
    sets = [(i, shingle_set(t, n)) for i, t in docs]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is None or j is None or not a or not b or root(i) == root(j):
                continue
            if least * max(len(a), len(b)) <= 100 * min(len(a), len(b)) and 100 * len(a & b) >= least * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return sorted((i is None, i or 0, len(s), -1 if i is None else root(i)) for i, s in sets)


def found(docs, **settings):
    rows = near_copies.jaccard_join(docs, **settings).collect()
    return sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.doc_id is None else r.component_id) for r in rows
    )


def copies(spark, edges):
    random.seed(11)
    vocabulary = [f"w{k}" for k in range(500)]
    passage = random.choices(vocabulary, k=60)
    rows, texts = [], [random.choices(vocabulary, k=random.randint(5, 120)) for _ in range(25)]
    for k in range(400):
        words = list(texts[k % 3] if k % 2 else random.choice(texts))
        for _ in range(random.choice((0, 0, 1, 2, 5))):
            at = random.randrange(len(words))
            words[at : at + random.randint(0, 2)] = random.choices(vocabulary, k=random.randint(0, 2))
        rows.append((1000 + k, " ".join(words)))
    rows += [(2000 + k, " ".join(passage + random.choices(vocabulary, k=k % 40))) for k in range(120)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    return table.unionByName(edges.select("doc_id", "text"))


@pytest.mark.parametrize(
    "settings",
    [
        {"n": 4, "least": 85},
        {"n": 5, "least": 80, "often": 10**9},
        # Regions of more than some sets are split over tasks.
        {"n": 4, "least": 85, "weight": 400, "most_sets": 6, "pivots": 3, "often": 10**9},
    ],
)
def test_join(spark, edges, settings):
    docs = copies(spark, edges).cache()
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    expected = by_hand(pairs, settings["n"], settings["least"])
    assert found(docs.withColumn("component_id", F.lit(0)), **settings) == expected


def test_one_of_each(spark, edges, no_docs):
    docs = copies(spark, edges).withColumn("region", F.lit("clash"))
    rows = near_copies.one_of_each(docs).collect()
    labels = {r.doc_id: r.component_id for r in near_copies.jaccard_join(docs, 5, 80).collect()}
    kept = [r.doc_id for r in rows if r.doc_id is not None]
    assert sorted(kept) == sorted({c for d, c in labels.items() if d is not None})
    assert sum(r.doc_id is None for r in rows) == 1
    assert near_copies.one_of_each(no_docs).count() == 0
    assert near_copies.jaccard_join(no_docs).count() == 0


def test_same_result_at_sf(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    assert found(docs) == by_hand([(r.doc_id, r.text) for r in docs.collect()], 4, 85)


def test_components(spark):
    random.seed(2)
    chain = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5000)]
    random.shuffle(chain)
    rows = connected(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {(r.node, r.component) for r in rows} == {(k, 0) for k in range(201)} | {
        (1000 + k, 1000) for k in range(300)
    }
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
