"""The ranked join against scoring every pair."""

import math
import random
from collections import Counter

import pytest

from linkweave import schemas as S
from linkweave.operators import blocking, matching

SCHEMA = "record_type STRING, record_id BIGINT, first_name STRING, middle_name STRING, last_name STRING"


def brute_force(records, k=5, least=0.2):
    """Rank all pairs of all blocks, on plain ASCII lower-case names."""
    terms = {r[:2]: {p.strip() for p in r[2:] if p and p.strip()} for r in records}
    blocks = {
        r[:2]: {p[0] for p in (r[2:] if r[0] == "gpo" else r[2:3]) if p} for r in records
    }
    frequency = Counter(t for parts in terms.values() for t in parts)
    weight = {
        t: round(1_000_000 * (math.log((1 + len(records)) / (1 + n)) + 1) ** 2)
        for t, n in frequency.items()
    }
    length = {key: sum(weight[t] for t in parts) for key, parts in terms.items()}
    best = set()
    for source in (r[:2] for r in records if r[0] == "gpo"):
        ranked = []
        for target in (r[:2] for r in records if r[0] == "pm"):
            if blocks[source] & blocks[target]:
                dot = sum(weight[t] for t in terms[source] & terms[target])
                score = dot / math.sqrt(length[source] * length[target]) if dot else 0.0
                ranked.append((-score, target[1]))
        for i, (negative, target) in enumerate(sorted(ranked)):
            if (i < k and -negative >= least) or i == 0:
                best.add((source[1], target, round(-negative, 9)))
    return best


def ranked_join(spark, records, **options):
    df = spark.createDataFrame(records, SCHEMA)
    linked = matching.linkable(df)
    return {
        (r.source_id, r.target_id, round(r.score, 9))
        for r in matching.best_targets(linked, **options).collect()
    }


def people(seed, n, hot_share=0.0, names=12):
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcd", k=rng.randint(1, 4))) for _ in range(names)]
    rows = []
    for i in range(n):
        parts = [rng.choice(pool + [None]) for _ in range(3)]
        if rng.random() < hot_share:
            parts = ["ab", "ab c", "dd"]
        rows.append((rng.choice(["gpo", "pm"]), i, *parts))
    return rows


@pytest.mark.parametrize(
    ("seed", "hot_share", "names"), [(1, 0.0, 12), (2, 0.35, 12), (3, 0.0, 60), (4, 0.6, 5)]
)
def test_equals_all_pairs(spark, seed, hot_share, names):
    records = people(seed, 160, hot_share, names)
    assert ranked_join(spark, records) == brute_force(records)


def test_other_limits(spark):
    records = people(7, 120)
    found = ranked_join(spark, records, k=2, min_score=0.6)
    assert found == brute_force(records, k=2, least=0.6)


def test_source_sharing_no_name_part_gets_the_first_target_of_its_block(spark):
    records = [("gpo", 1, "anna", None, None), ("pm", 8, "abel", None, None), ("pm", 5, "abe", None, None), ("pm", 2, "bob", None, None)]
    assert ranked_join(spark, records) == {(1, 5, 0.0)}


def test_records_without_names(spark):
    records = [("gpo", 1, None, None, None), ("gpo", 2, " ", None, None), ("pm", 3, " ", None, None), ("pm", 4, "null", None, None)]
    assert ranked_join(spark, records) == {(2, 3, 0.0)}


def test_candidate_counts_with_several_keys_on_both_sides(spark):
    records = people(11, 200)
    df = spark.createDataFrame(records, SCHEMA)
    keyed = blocking.block_rows(df).where("record_type = 'gpo'")
    both = keyed.unionByName(keyed.selectExpr("'other' AS record_type", "record_id", "block"))
    found = {r.source_id: r.n_candidates for r in blocking.candidate_counts(both, "gpo", "other").collect()}
    sets = {}
    for r in keyed.collect():
        sets.setdefault(r.record_id, set()).add(r.block)
    assert found == {i: sum(1 for other in sets.values() if own & other) for i, own in sets.items()}


def test_pairs_in_blocks_share_their_block(spark):
    records = people(5, 60)
    df = spark.createDataFrame(records, SCHEMA)
    blocks = blocking.block_rows(df)
    pairs = spark.createDataFrame(
        [("gpo", a[1], "pm", b[1]) for a in records for b in records if a[0] == "gpo" and b[0] == "pm"][:300],
        S.PAIR,
    )
    of = {}
    for r in blocks.collect():
        of.setdefault((r.record_type, r.record_id), set()).add(r.block)
    expected = {
        (p.source_id, p.target_id, b)
        for p in pairs.collect()
        for b in of.get(("gpo", p.source_id), set()) & of.get(("pm", p.target_id), set())
    }
    found = {(r.source_id, r.target_id, r.block) for r in blocking.pairs_in_blocks(pairs, blocks).collect()}
    assert found == expected


WEIGHTS = {"first_name": 1.0, "last_name": 1.5, "npi": 4.0, "country": 0.25}


def classified_brute(records, k=5, least=0.2):
    """Every pair of every block, scored and ranked."""
    out = []
    sources = [r for r in records if r["record_type"] == "gpo"]
    targets = [r for r in records if r["record_type"] == "pm"]
    for s in sources:
        scored = []
        for t in targets:
            if not blocks_of(s) & blocks_of(t):
                continue
            z = -2.0 + sum(w for a, w in WEIGHTS.items() if s[a] is not None and t[a] is not None and s[a].lower() == t[a].lower())
            scored.append((-z, t["record_id"], 1 / (1 + math.exp(-z))))
        ranked = sorted(scored)[:k]
        out += [(s["record_id"], t, round(p, 9)) for i, (_, t, p) in enumerate(ranked) if p >= least or i == 0]
    return sorted(out)


def blocks_of(r):
    names = [r["first_name"]] + ([r["last_name"]] if r["record_type"] == "gpo" else [])
    return {n[0].lower() for n in names if n}


def classified(spark, records):
    df = spark.createDataFrame(
        [(r["record_type"], r["record_id"], r["first_name"], None, r["last_name"], r["npi"], r["country"]) for r in records],
        "record_type STRING, record_id BIGINT, first_name STRING, middle_name STRING, last_name STRING, npi STRING, country STRING",
    )
    linked = matching.agreeing(df, list(WEIGHTS))
    found = matching.classified_targets(linked, WEIGHTS, -2.0).collect()
    return sorted((r.source_id, r.target_id, round(r.score, 9)) for r in found)


def person(kind, number, first, last, npi=None, country="us"):
    return {"record_type": kind, "record_id": number, "first_name": first, "last_name": last, "npi": npi, "country": country}


def test_classified_targets_equal_scoring_every_pair(spark):
    rng = random.Random(4)
    records = [
        person(
            rng.choice(["gpo", "pm"]), i, rng.choice(["Anna", "anna", "Bob", "Bea", None]), rng.choice(["Abel", "Bond", None]),
            rng.choice([None, "1", "2", "3"]), rng.choice(["us", "fr", None]),
        )
        for i in range(200)
    ]
    assert classified(spark, records) == classified_brute(records)


def test_equal_npi_outranks_many_equal_names(spark):
    """Hot block and hot name: the one target with the same npi still comes first."""
    records = [person("pm", i, "Jack", "Other", f"n{i}") for i in range(300)]
    records += [person("pm", 900, "Jim", "Smith", "x1"), person("gpo", 1, "Jack", "Other", "x1")]
    found = classified(spark, records)
    assert found == classified_brute(records)
    assert max(found, key=lambda r: r[2])[1] == 900


def test_weights_must_not_be_negative(spark):
    linked = matching.agreeing(spark.createDataFrame([("pm", 1, "a")], "record_type STRING, record_id BIGINT, first_name STRING").selectExpr("*", "first_name AS middle_name", "first_name AS last_name"), ["first_name"])
    with pytest.raises(ValueError):
        matching.classified_targets(linked, {"first_name": -1.0}, 0.0)


def test_lists_of_agreement_stay_one_row_each(spark):
    """Forty targets agree in everything: a source meets one short list per set, not five rows of whole values."""
    rows = [("pm", i, ["a"], ["anna", None]) for i in range(40)] + [("gpo", i, ["a"], ["anna", None]) for i in range(3)]
    linked = spark.createDataFrame(rows, "record_type string, record_id bigint, blocks array<string>, values array<string>")
    members, lists = matching.agreement_lists(linked, 2)
    assert sorted(r.record_id for r in members.collect()) == [0, 1, 2]
    got = sorted((r.mask, [i.record_id for i in r.ids]) for r in lists.collect())
    assert got == [(0, [0, 1, 2, 3, 4]), (1, [0, 1, 2, 3, 4])]
