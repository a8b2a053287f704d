import zlib

import numpy as np

from linkweave.llm import quality as Q

from cases import TEXTS, documents, labels


def walk(trees, row):
    """One tree after the other, one node after the other."""
    total = trees.base
    for node in trees.roots.tolist():
        while trees.feature[node] >= 0:
            low = row[trees.feature[node]] <= trees.threshold[node]
            node = (trees.low if low else trees.high)[node]
        total += trees.value[node]
    return total


def test_flat_walk_against_node_by_node():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 6)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    trees = Q.fit(x, y, rounds=30)
    margins = trees.margins(x)
    assert np.allclose(margins, [walk(trees, r) for r in x])
    assert ((margins > 0) == (y > 0)).mean() > 0.97


def test_fit_without_both_classes():
    assert np.allclose(Q.fit(np.zeros((0, 3), np.float32), np.zeros(0)).scores(np.zeros((2, 3))), 0.5)
    assert Q.fit(np.zeros((5, 3), np.float32), np.ones(5)).scores(np.zeros((1, 3)))[0] > 0.8


def test_cases(spark):
    got = Q.score(documents(spark), labels(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in TEXTS)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= Q.ACCEPTED)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    by_text = {}
    for r in got:
        by_text.setdefault(dict(TEXTS)[r.doc_id] or "", set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert Q.score(documents(spark).limit(0), labels(spark)).count() == 0
    assert Q.score(documents(spark), labels(spark, ())).count() == len(TEXTS)


def test_held_out_rows_are_never_learnt_from(spark):
    sample = Q.labelled_sample(labels(spark, [(i, i % 2, 0) for i in range(200)]), "quality", 1000).collect()
    assert {r.doc_id for r in sample} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = Q.score(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    hits = [r.predicted == marks[r.doc_id] for r in got.collect() if r.held_out and r.doc_id in marks]
    assert len(hits) > 50 and np.mean(hits) > 0.95
