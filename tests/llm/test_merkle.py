import hashlib
import zlib

import compare
import pytest
from conftest import TESTDATA
from hypothesis import given, settings
from hypothesis import strategies as st

from linkweave.llm import merkle as M
from linkweave.llm.queries import ORACLE, QUERIES

from cases import documents


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified; rows as doc_id, source, lang, n_chars, text."""
    langs = sorted({r[2] for r in rows}, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, levels([leaf(r) for r in own])
    tops = levels([trees[lang][1][-1][0] for lang in langs])
    out = []
    for number, lang in enumerate(langs):
        own, tree = trees[lang]
        for at, row in enumerate(own):
            lowered = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and lowered is not None:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in lowered)
            now, proof = leaf((*row[:4], lowered)), []
            for nodes, i in [(tree, at), (tops, number)]:
                for level in nodes[:-1]:
                    run = level[i // 8 * 8:i // 8 * 8 + 8]
                    proof += [d for j, d in enumerate(run) if j != i % 8]
                    now = H(now if j == i % 8 else d for j, d in enumerate(run))
                    i //= 8
            out.append((row[0], tree[0][at], tree[-1][0], tops[-1][0], H(proof), now, now == tops[-1][0]))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in M.verify_tampered(df).collect()), key=str)


def test_cases(spark):
    df = documents(spark)
    plain = [(r[0], r[3], r[2], r[4], r[1]) for r in df.collect()]
    assert result(df) == brute(plain)
    assert M.verify_tampered(df.limit(0)).count() == 0
    assert M.build(M.leaves(df.limit(0))).root().count() == 0


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


@pytest.mark.parametrize("sizes", [[1], [8], [9], [64, 1], [65, 7, 8], [1] * 9, [2] * 65])
def test_shapes_of_trees(spark, sizes):
    rows = [
        (1000 * t + i, None, None if t == 0 else f"l{t}é", i, f"Text {t} {i}") for t, n in enumerate(sizes) for i in range(n)
    ]
    assert result(table(spark, rows)) == brute(rows)


def test_more_than_a_block(spark):
    """Three blocks of one tree; ids repeat, and a third of all rows are equal."""
    rows = [(i // 2 - 3000, "s", "en", 1, f"T{i % 5}") for i in range(6000)] + [(None, None, "en", None, None)] * 3000
    rows += [(i, "s", "fr", 1, "x") for i in range(20)]
    assert result(table(spark, rows)) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 700), st.data())
def test_fewest_nodes_prove_any_leaves(size, data):
    held = data.draw(st.sets(st.integers(0, size - 1), min_size=1))
    tree = levels([H([str(i)]) for i in range(size)])
    wanted = M.missing(held, size)
    assert len(set(wanted)) == len(wanted)
    fetched = {(level, i): tree[level][i] for level, i in wanted}
    climb = M.Climb({i: tree[0][i] for i in held}, fetched, size)
    assert climb.top == tree[-1][0]
    for i in held:
        now = tree[0][i]
        for before, behind in climb.path(i):
            now = H([before, now, behind])
        assert now == climb.top
    # None of them can be left out: each is a run's member that no held leaf lies below.
    for level, i in wanted:
        assert not any(h // 8**level == i for h in held)
        assert any(h // 8**(level + 1) == i // 8 for h in held)


def test_query_equals_sql(spark):
    folder = TESTDATA / "sf0.001"
    got = QUERIES["op13_merkle_manifest"](spark, str(folder))
    assert compare.differences(got, compare.connect(folder), ORACLE["op13_merkle_manifest"]) is None
    assert {r.verified for r in got.collect()} == {True, False}


def test_documents(spark):
    df = spark.read.parquet(str(TESTDATA / "sf0.01" / "documents.parquet"))
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]
    assert result(df) == brute(rows)
