import hashlib
import random

import numpy as np

from linkweave.llm import winnowing as W

from cases import TEXTS, documents


def brute(text):
    """Chosen (hash, position), window by window."""
    if not text:
        return []
    if len(text) < W.GRAM:
        return [(int(W.gram_hashes(text)[0]), 0)]
    hashes = [int(W.gram_hashes(text[i:i + W.GRAM])[0]) for i in range(len(text) - W.GRAM + 1)]
    out = []
    for begin in range(max(1, len(hashes) - W.WINDOW + 1)):
        window = hashes[begin:begin + W.WINDOW]
        least = min(window)
        at = max(i for i, h in enumerate(window) if h == least) + begin
        if not out or out[-1] != (least, at):
            out.append((least, at))
    return out


def test_windows_against_brute_force():
    rng = random.Random(1)
    for n in [0, 1, 5, 31, 32, 33, 62, 63, 64, 65, 200, 999]:
        for letters in ("ab", "abcdefgh ", "a"):
            text = "".join(rng.choice(letters) for _ in range(n))
            hashes, positions = W.winnow(text)
            assert list(zip(hashes.tolist(), positions.tolist(), strict=True)) == brute(text)


def test_shared_passage_is_found():
    rng = random.Random(2)
    make = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    for _ in range(50):
        passage = make(W.GRAM + W.WINDOW - 1)
        a, b = make(rng.randint(0, 300)) + passage + make(77), make(rng.randint(0, 300)) + passage
        assert np.intersect1d(W.winnow(a)[0], W.winnow(b)[0]).size


def expected(rows):
    key = lambda r: W.LOWEST if r[0] is None else r[0]
    rows = sorted(rows, key=key)
    out = []
    for at, (i, text) in enumerate(rows):
        text, following = text or "", rows[(at + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = (text[:len(text) - half] if half else text) + following[:half]
        sets = [{h for h, _ in brute(t)} for t in (text, changed, following)]
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), like(sets[0], sets[1]), like(sets[0], sets[2])))
    return sorted(out, key=str)


def result(df):
    return sorted(
        ((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in W.compare_with_edits(df).collect()),
        key=str,
    )


def test_cases(spark):
    assert result(documents(spark)) == expected(TEXTS)
    assert W.compare_with_edits(documents(spark).limit(0)).count() == 0


def test_alone_and_all_alike(spark):
    assert result(documents(spark, [(4, "abcdef" * 20)])) == expected([(4, "abcdef" * 20)])
    rows = [(i, "the very same text, " * 9) for i in range(40)]
    assert result(documents(spark, rows)) == expected(rows)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert result(df) == expected(rows)
    prints = {}
    for r in W.compare_with_edits(df).collect():
        text = dict(rows)[r.doc_id]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
