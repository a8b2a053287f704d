import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from linkweave.llm import neardup as N
from linkweave.llm.common import DOCUMENT_COLUMNS, pick

from cases import TEXTS, documents

WORD = re.compile(r"\w+")


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def words(rng, n):
    return [f"{rng.choice('abcdefghijklmnop')}{rng.randrange(400)}" for _ in range(n)]


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(max(1, len(out)))
        kind = rng.randrange(3)
        out[at:at + (kind < 2)] = [f"new{rng.randrange(9999)}"] * (kind != 1)
    return out


def test_banded_length_against_the_plain_table():
    rng = random.Random(0)
    for _ in range(400):
        a = [rng.randrange(rng.choice([3, 50])) for _ in range(rng.randrange(40))]
        b = edited(rng, a, rng.randrange(8)) if a and rng.random() < 0.7 else [rng.randrange(3) for _ in range(rng.randrange(40))]
        true = lcs(a, b)
        for need in range(max(len(a), len(b)) + 2):
            found = N.common_length(a, b, need)
            assert found <= true
            assert (found >= need) == (true >= need)


def test_similar_at_the_very_limit():
    a = np.arange(90)
    b = a.copy()
    b[:10] += 1000
    assert 80 / 100 == 0.8 and N.similar(a, b)
    b[10] += 1000
    assert not N.similar(a, b)
    assert not N.similar(a, a[::-1].copy())


def test_verdicts_against_plain_alignment_and_count():
    """Distances by the count obey the triangle; what is aligned is linked; moved passages are linked only."""
    rng = random.Random(7)
    seen = Counter()
    for _ in range(300):
        base = [rng.randrange(60) for _ in range(rng.randrange(1, 60))]
        cut = rng.randrange(len(base))
        texts = [N.labelled(np.array(t or [1], np.uint64)) for t in (
            base, edited_numbers(rng, base), base[cut:] + base[:cut]
        )]
        far = {}
        for i, j in itertools.combinations(range(3), 2):
            a, b = texts[i], texts[j]
            common = sum((Counter(a.tolist()) & Counter(b.tolist())).values())
            far[i, j], linked, aligned = N.verdict(a, b, True)
            assert far[i, j] == len(a) + len(b) - 2 * common
            need = N.needed(len(a), len(b))
            assert linked == (common >= need)
            assert aligned == (lcs(a.tolist(), b.tolist()) >= need)
            assert N.verdict(a, b, False) == (far[i, j], linked, False)
            seen[linked, aligned] += 1
        assert far[1, 2] >= abs(far[0, 1] - far[0, 2])
    assert min(seen[True, True], seen[True, False], seen[False, False]) > 20


def edited_numbers(rng, base):
    return [rng.randrange(100, 200) if rng.random() < 0.08 else x for x in base]


def test_order_is_kept_beside_the_shingles():
    """Sketches alike in shingles and order, and in shingles alone."""
    rng = random.Random(3)
    text = words(rng, 200)
    found = N.shingles(N.words_of(" ".join(text))[0])
    moved = N.shingles(N.words_of(" ".join(text[100:] + text[:100]))[0])
    same = {s >> N.ORDER_BITS for s in N.sketches(found)} & {s >> N.ORDER_BITS for s in N.sketches(moved)}
    in_order = set(N.sketches(found)) & set(N.sketches(moved))
    assert len(same) > len(in_order)
    assert {s >> N.ORDER_BITS for s in N.sketches(found)} == {
        (s & (1 << 64 - N.ORDER_BITS) - 1) - ((s & 1 << 63 - N.ORDER_BITS) << 1) for s in N.sketches(found, ordered=False)
    }


def test_bands_lose_no_pair(spark):
    """Rows of one bucket: every pair of sizes and distances that may be similar meets, in any size of bucket."""
    rng = random.Random(5)
    rows = []
    for uid in range(300):
        size = rng.randrange(1, 400)
        true = rng.randrange(0, size + 200)
        slack = rng.choice([0, 0, 0, rng.randrange(1, 300)])
        rows.append((uid, size, true, max(0, true - slack), true + slack))
    frame = spark.createDataFrame(rows, "uid long, size long, true long, low long, up long")
    pairs = {}
    for members in (300, N.WHOLE):
        df = frame.selectExpr("*", f"{members}L AS members")
        left, right = N._in_bands(df)
        right = right.selectExpr("uid AS b", "band AS b_band", "lane", "place")
        met = left.join(right, ["lane", "place"]).selectExpr("uid", "b").distinct().collect()
        pairs[members] = {(min(p), max(p)) for p in met if p[0] != p[1]}
    wanted = {
        (x[0], y[0]) for x, y in itertools.combinations(rows, 2)
        if min(x[1], y[1]) >= N.SIMILARITY * max(x[1], y[1]) and abs(x[2] - y[2]) * 9 <= x[1] + y[1]
    }
    assert wanted <= pairs[300] < pairs[N.WHOLE]
    assert len(pairs[N.WHOLE]) == 300 * 299 // 2


def test_groups_around_a_shared_passage(spark):
    """More texts than a bucket that meets whole: near pairs among them are found, and no others."""
    rng = random.Random(9)
    passage = words(rng, 80)
    texts = []
    for i in range(100):
        text = words(rng, rng.randrange(40, 90)) + passage
        texts += [text, edited(rng, text, 2)]
    links = [
        (i, j) for (i, x), (j, y) in itertools.combinations(enumerate(texts), 2) if jaccard(x, y) >= N.SIMILARITY
    ]
    got = classes(documents(spark, [(i, " ".join(t)) for i, t in enumerate(texts)]))
    wanted = partition(links, range(len(texts)))
    assert {r.doc_id: r.class_id for r in got} == wanted
    alone = {c for c, n in Counter(wanted.values()).items() if n == 1}
    assert all((r.aligned_links + r.moved_links > 0) == (r.class_id not in alone) for r in got)


def test_sketches_know_occurrence_and_order():
    found = N.shingles(np.arange(1, 300, dtype=np.uint64))
    assert N.sketches(found) == N.sketches(found)
    assert not set(N.sketches(found)) & set(N.sketches(found[::-1].copy()))
    assert N.sketches(found[:1].repeat(9)) != N.sketches(found[:1])
    assert N.sketches(found[:0]) == [] and len(N.sketches(found[:2])) == N.SKETCHES
    many = N.shingles(np.arange(1, 90_000, dtype=np.uint64))
    assert len(N.sketches(many)) == N.SKETCHES


def partition(pairs, nodes):
    part = {n: n for n in nodes}

    def top(n):
        while part[n] != n:
            n = part[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        part[b] = a
    return {n: top(n) for n in nodes}


def jaccard(x, y):
    """Of the five-word shingles of two lists of words, each occurrence counted."""
    a, b = (Counter(tuple(t[i:i + 5]) for i in range(max(1, len(t) - 4))) for t in (x, y))
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def brute(rows):
    """Classes of all pairs of texts whose five-word shingles, counted, have the similarity."""
    usable = [(i, t, WORD.findall(t.lower())) for i, t in rows if i is not None and t is not None]
    links = [
        (i, j) for (i, s, x), (j, t, y) in itertools.combinations(usable, 2)
        if s == t or (x and y and jaccard(x, y) >= N.SIMILARITY)
    ]
    return partition(links, [i for i, _, _ in usable])


def classes(df):
    return N.near_duplicates(df).collect()


def check(spark, rows):
    got = classes(documents(spark, rows))
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    wanted = brute(rows)
    texts = dict(rows)
    for r in got:
        alone = r.doc_id is None or texts[r.doc_id] is None
        assert r.class_id == (None if alone else wanted[r.doc_id])
        if alone:
            assert r.kept
    kept = {(r.class_id, r.doc_id) for r in got if r.kept and r.class_id is not None}
    assert {c for c, _ in kept} == set(wanted.values())
    assert len(kept) == len(set(wanted.values()))


def test_cases(spark):
    check(spark, TEXTS)
    assert classes(documents(spark).limit(0)) == []


def test_edited_copies_chains_and_shared_passages(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng, rng.randrange(60, 300)))) for i in range(60)]
    base = words(rng, 200)
    rows += [(100 + i, " ".join(edited(rng, base, rng.randrange(1, 8)))) for i in range(40)]
    chain = words(rng, 200)
    for i in range(12):  # each like the one before, the last unlike the first
        chain = edited(rng, chain, 9)
        rows.append((200 + i, " ".join(chain)))
    passage = " ".join(words(rng, 60))
    rows += [(300 + i, " ".join(words(rng, 150)) + " " + passage) for i in range(40)]
    rows += [(400 + i, rows[0][1].upper() + "!") for i in range(5)]
    rng.shuffle(rows)
    check(spark, rows)


def test_large_groups_of_copies(spark):
    """A hot group of exact copies, and one of near copies: no pair of the group is written out."""
    rng = random.Random(2)
    base = words(rng, 150)
    rows = [(i, " ".join(base)) for i in range(400)]
    rows += [(1000 + i, " ".join(edited(rng, base, 3))) for i in range(300)]
    rows += [(5000 + i, " ".join(words(rng, 100))) for i in range(50)]
    got = classes(documents(spark, rows))
    assert {r.class_id for r in got if r.doc_id < 5000} == {0}
    assert all(r.class_id == r.doc_id for r in got if r.doc_id >= 5000)


def test_one_of_each_stays_and_repeated_rows_go(spark):
    df = documents(spark, [*TEXTS, (None, "again without id"), (3, None), (2, "")])
    kept = N.keep_one_of_each(pick(df, *DOCUMENT_COLUMNS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    wanted = [t for t in dict.fromkeys(TEXTS) if t[0] != 5]
    assert found == sorted([*wanted, (None, "again without id"), (3, None)], key=str)


@pytest.mark.parametrize("links, parts", [
    ([], {}), ([(1, 2)], {1: 1, 2: 1}), ([(i, i + 1) for i in range(40)], dict.fromkeys(range(41), 0)),
    ([(9, i) for i in range(5)] + [(20, 30), (30, 20), (20, 30)], {**dict.fromkeys([*range(5), 9], 0), 20: 20, 30: 20}),
])
def test_components(spark, links, parts):
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.part for r in N.components(df).collect()} == parts


def test_moved_passages_are_linked_and_rewritten_texts_are_not(spark):
    rng = random.Random(11)
    rows, together = [], {}
    for i in range(40):
        base = words(rng, 100)
        moved, rewritten = base[50:] + base[:50], [f"other{k}" if k % 10 == 4 else w for k, w in enumerate(base)]
        assert jaccard(base, moved) >= N.SIMILARITY > jaccard(base, rewritten)
        rows += [(3 * i, " ".join(base)), (3 * i + 1, " ".join(moved)), (3 * i + 2, " ".join(rewritten))]
        together |= {3 * i: 3 * i, 3 * i + 1: 3 * i, 3 * i + 2: 3 * i + 2}
    assert {r.doc_id: r.class_id for r in classes(documents(spark, rows))} == together


def test_classes_against_all_pairs_of_shingle_counts(spark):
    rng = random.Random(12)
    texts = [words(rng, rng.randrange(60, 300)) for _ in range(30)]
    base = words(rng, 200)
    texts += [edited(rng, base, rng.randrange(1, 8)) for _ in range(40)]
    chain = words(rng, 200)
    for _ in range(12):  # each like the one before, the last unlike the first
        chain = edited(rng, chain, 3)
        texts.append(chain)
    passage = words(rng, 60)
    texts += [words(rng, 150) + passage for _ in range(40)]
    links = [
        (i, j) for (i, x), (j, y) in itertools.combinations(enumerate(texts), 2) if jaccard(x, y) >= N.SIMILARITY
    ]
    got = classes(documents(spark, [(i, " ".join(t)) for i, t in enumerate(texts)]))
    assert {r.doc_id: r.class_id for r in got} == partition(links, range(len(texts)))


@pytest.mark.parametrize("size", [60, 200, 1000])
def test_pairs_just_above_the_similarity_meet(size):
    """Changed words, or changed words and a moved passage: every such pair shares a bucket."""
    rng = random.Random(size)
    met = []
    while len(met) < 200:
        a = words(rng, size)
        b = a[size // 3:] + a[:size // 3] if len(met) % 2 else list(a)
        last = b
        while jaccard(a, b) >= N.SIMILARITY:
            last, b = b, list(b)
            b[rng.randrange(size)] = f"new{rng.randrange(10**9)}"
        assert N.SIMILARITY <= jaccard(a, last) < 0.95
        found = [
            set(N.sketches(N.shingles(N.words_of(" ".join(t))[0]), ordered=False)) for t in (a, last)
        ]
        met.append(bool(found[0] & found[1]))
    assert all(met)
