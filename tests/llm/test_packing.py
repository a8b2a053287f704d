import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linkweave.llm import packing as P

from cases import TEXTS, documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(library, text):
    return [*library.encode(text, add_special_tokens=False).ids, P.END]


def check(library, rows, got, capacity=P.CAPACITY):
    """Every id once and in order, gapless sequences, cuts only where a document is too long."""
    wanted = []
    for i, text in rows:
        found = ids(library, text or "")
        first = len(found) % capacity or capacity
        cuts = [0, *range(first, len(found) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            wanted.append((i, piece, a, b - a, zlib.crc32(array("I", found[a:b]).tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(wanted, key=str)
    at = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values(), default=0) <= capacity
    return len(at)


def test_ids_as_the_library(library):
    coder = P.ids_of(public_tokenizers.path("byte_bpe_50k.json"))
    for text in [t or "" for _, t in TEXTS] + [
        "a  b", " a b", "a b ", "a \n b", "x\n\ny z", "don't  I'll", "１２ ½ ٣", "　x y", "a\x1cb c\x85d", "é é",
    ]:
        assert np.frombuffer(coder.ids(text), "<u4").tolist() == ids(library, text)[:-1]


def test_cases(spark, library):
    got = P.pack(documents(spark)).collect()
    check(library, TEXTS, got)
    assert P.pack(documents(spark).limit(0)).count() == 0


def test_documents_fill_their_sequences(spark, library):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = P.pack(df).collect()
    used = check(library, rows, got)
    tokens = sum(r.length for r in got)
    assert used <= -(-tokens // P.CAPACITY) * 1.05 + 1


def test_islands(spark, library, monkeypatch):
    monkeypatch.setattr(P, "ISLAND", 40)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(library, [(r.doc_id, r.text) for r in df.collect()], P.pack(df).collect())


def test_best_fit_leaves_least_room():
    bins = P.best_fit([[5], [7], [2, 4]], [3, 2, 9, 1], 10)
    assert bins == [[5], [7, 3], [2, 4, 2], [9, 1]]


def test_crossover_keeps_all_pieces():
    rng = np.random.default_rng(0)
    items = rng.integers(1, 100, 300)
    counts = np.bincount(items, minlength=101)
    a = P.best_fit([], sorted(items.tolist(), reverse=True), 100)
    b = P.best_fit([], items.tolist(), 100)
    foreign = [[100 - x, x] for x in range(1, 50)] + [[100]]
    for donor, other in ((a, b), (b, a), (foreign, a)):
        child = P.crossover(donor, other, counts, 100, rng)
        assert sorted(x for bin_ in child for x in bin_) == sorted(items.tolist())
        assert max(map(sum, child)) <= 100


def test_evolution_beats_best_fit_decreasing():
    # Pairs and triples that fill bins exactly, which falling order does not find.
    rng = np.random.default_rng(5)
    items = []
    for _ in range(60):
        x, y = sorted(rng.integers(200, 500, 2).tolist())
        items += [x, y, 1000 - x - y] if x + y < 1000 else [x, 1000 - x]
    counts = np.bincount(items, minlength=1001)
    first = P.best_fit([], sorted(items, reverse=True), 1000)
    best = P.evolve(counts, [], [], 1, 1000, generations=60)[0]
    assert sorted(x for b in best for x in b) == sorted(items)
    assert len(best) <= len(first)
    assert P.worth(best) >= P.worth(first)


def test_packings_as_bytes():
    population = [[[1, 2], [3]], [], [[1023]]]
    assert P._unpack(P._pack(population)) == population
    assert P._unpack(None) == []
