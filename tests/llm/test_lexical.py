import math
import random
import re

import compare
import numpy as np
import pytest
from conftest import TESTDATA

from linkweave.llm import lexical as X
from linkweave.llm.queries import ORACLE, QUERIES

from cases import documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, queries, k):
    """Every document scored for every query; (item, rank, doc, score)."""
    bags = [(i, words(t)) for i, t in rows if words(t)]
    n_docs, n_terms = len(bags), sum(len(b) for _, b in bags)
    df = {}
    for _, bag in bags:
        for t in set(bag):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in queries:
        asked = [t for t in dict.fromkeys(words(text)) if t in df]
        scored = []
        for i, bag in bags:
            score = 0
            for t in asked:
                if tf := bag.count(t):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1000000000 * tf // (1000 * tf + 20 * (50 + 50 * len(bag) * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        for rank, (score, known, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, i if known else None, -score))
    return sorted(out, key=str)


def items(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, SCORE int")


def result(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_terms():
    text = "A_b-Ç9 x\x00y É{z}~ 日本.ΣΑΣ 1,2"
    assert [t.decode() for part in X.terms_of(text.encode()) for t in part] == words(text)


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = " ".join(f"w{i}é" for i in range(3000)) + "," + "a" * 500
    whole = [t.decode() for part in X.terms_of(text.encode()) for t in part]
    monkeypatch.setattr(X, "PIECE", 100)
    assert [t.decode() for part in X.terms_of(text.encode()) for t in part] == whole == words(text)


def test_cases(spark):
    queries = [(1, "ONE two word1 and"), (1, "one two word1 AND"), (2, None), (3, ""), (None, "a id text b"), (4, "nowhere"), (5, "日本語 é 👩 one one")]
    df = documents(spark)
    rows = [(r[0], r[1]) for r in df.collect()]
    assert result(X.rank(df, items(spark, queries), 3)) == brute(rows, queries, 3)
    assert X.rank(df.limit(0), items(spark, queries)).count() == 0
    assert X.rank(df, items(spark, queries).limit(0)).count() == 0


def zipf(rng, n, size):
    return " ".join(f"t{int(rng.paretovariate(0.7)) % size}" for _ in range(n))


@pytest.fixture
def small(monkeypatch):
    """Small blocks and shards, so that few documents have many."""
    monkeypatch.setattr(X, "POSTINGS", 8)
    monkeypatch.setattr(X, "SHARD_DOCS", 97)


def test_many_shards_and_ties_against_brute_force(spark, small):
    rng = random.Random(5)
    rows = [(rng.randrange(900), zipf(rng, rng.randrange(1, 60), 400)) for _ in range(1000)]
    rows += [(2000 - i, "t1 t2 t3") for i in range(300)] + [(None, "t1 t2 t3")] * 5
    queries = [(i, zipf(rng, rng.randrange(1, 12), 400)) for i in range(40)] + [(99, "t1 t2 t3")]
    found = X.rank(documents(spark, rows), items(spark, queries), 10)
    # Of documents with one id and score either may stand at a rank: ids and scores are compared.
    assert result(found) == brute(rows, queries, 10)


def shards_of(rows, kept=None):
    out = []
    for start in range(0, len(rows), X.SHARD_DOCS):
        part = rows[start:start + X.SHARD_DOCS]
        row = X.shard_row([i for i, _ in part], [t.encode() for _, t in part], kept)
        out.append({k: np.asarray(v) if k not in ("terms", "nameless", "widths", "payload") else v for k, v in row.items()})
        out[-1]["terms"] = row["terms"].to_pylist()
    return out


def test_bounds_hold_and_blocks_stay_compressed(small):
    rng = random.Random(6)
    rows = [(i, zipf(rng, rng.choice([3, 30, 300]), 2000)) for i in range(970)]
    n_docs, n_terms = len(rows), sum(len(words(t)) for _, t in rows)
    shards = [X.Shard(r, n_docs, n_terms) for r in shards_of(rows)]
    for shard in shards:
        for b in range(len(shard.last)):
            docs, impacts = shard.block(b)
            assert docs[-1] == shard.last[b] and impacts.max() <= shard.high[b]
        shard.blocks.clear()
    df = {}
    for _, t in rows:
        for w in set(words(t)):
            df[w] = df.get(w, 0) + 1
    heap = X.Heap(3)
    query = [(t.encode(), X.weight(n_docs, df[t])) for t in ("t1", "t2", "t3", "t400", "t77") if t in df]
    for shard in shards:
        docs, scores = shard.search(query, 3, heap.needed)
        heap.take(scores, shard.ids[docs], shard.nameless[docs])
    asked = sum(end - begin for s in shards for t, _ in query if (at := s.lists.get(t)) for begin, end, _ in [at])
    assert sum(len(s.blocks) for s in shards) < 0.8 * asked
    text = " ".join(t.decode() for t, _ in query)
    assert list(zip(heap.ids.tolist(), heap.scores.tolist(), strict=True)) == [(d, s) for _, _, d, s in sorted(brute(rows, [(0, text)], 3), key=lambda r: r[1])]


def test_all_terms_or_the_queries_terms(spark, small, monkeypatch):
    rng = random.Random(7)
    df = documents(spark, [(i, zipf(rng, 40, 300)) for i in range(500)])
    queries = items(spark, [(i, zipf(rng, 6, 300)) for i in range(20)])
    some = result(X.rank(df, queries, 10))
    monkeypatch.setattr(X, "KEPT_TERMS", 10)
    monkeypatch.setattr(X, "QUERIES_AT_ONCE", 7)
    assert X.query_terms(queries) is None
    assert result(X.rank(df, queries, 10)) == some
    monkeypatch.setattr(X, "TERMS_AT_ONCE", 5)
    assert result(X.search(X.build(df), queries, 10)) == some


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, scale):
    folder = TESTDATA / scale
    got = QUERIES["op12_block_max_search"](spark, str(folder))
    assert compare.differences(got, compare.connect(folder), ORACLE["op12_block_max_search"]) is None
