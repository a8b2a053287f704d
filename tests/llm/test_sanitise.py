import hashlib
import random
import re
from math import log2
from collections import Counter

from conftest import TESTDATA
from hypothesis import given, settings
from hypothesis import strategies as st

from linkweave.llm import sanitise as Z
from linkweave.llm.queries import QUERIES

from cases import documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


def test_patterns():
    text = (
        "a@b a@b.c x..%@y-.z.q@w.e é@a.b a@@b.c @a.b 1.2.3.4.5 256.1.1.1 01.002.3.255 1.2.3 9.9.9.9.9.9.9.9 "
        "4111 1111 1111 1111 4111-1111-1111-1112 4111--1111 4111111111111111 +1 (487) 555-7209. +49(0)30.123-45 +1 2 "
        "+12345678901234567 ++1 234 567 890- 0000000000000"
    )
    assert Z.base_spans(text) == brute(text)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab.@-+%1029 ()é", max_size=60))
def test_patterns_against_plain_search(text):
    assert Z.base_spans(text) == brute(text)


def test_long_runs_take_no_longer():
    for unit in ("a", "1", "1.", "a@", "+1", "1 ", "1-", "a.", "@a.", "1.1.1.1", "+1("):
        Z.base_spans(unit * 300_000)


PEOPLE = ["zorblaxquint", "mirabellaquorn", "xanthippeoldcastle"]


def planted(rng):
    """Names beside a phone number in ever other surroundings; a value in copies only; common words."""
    vocabulary = [f"w{i:03}ord" for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(i, text(60)) for i in range(400)]
    for p, name in enumerate(PEOPLE):
        rows += [(1000 + 10 * p + i, f"{text(20)} {name.title()} at +1 (487) 555-720{p} {text(20)}") for i in range(6)]
        rows.append((1100 + p, f"{text(9)} {name.upper()}, {text(9)}"))
    rows += [(1200 + i, f"{text(30)} mirage {text(9)} mirable") for i in range(30)]
    copy = f"{text(20)} onlyhere a.b@mail.example {text(20)} alsohere"
    rows += [(2000 + i, copy) for i in range(200)]
    # Near copies: edits, some of them beside the value.
    parts = f"{text(12)} rareword c.d@mail.example {text(12)}".split()
    for i in range(200):
        other = list(parts)
        other[rng.randrange(len(parts))] = rng.choice(vocabulary)
        rows.append((3000 + i, " ".join(other if "@" in " ".join(other) else parts)))
    rng.shuffle(rows)
    return rows


def terms_by_brute_force(rows):
    """Terms above the threshold, counted in the plainest way."""
    holds, entity_docs, beside, total = Counter(), Counter(), {}, len(rows)
    for _, text in rows:
        text = text or ""
        spans = brute(text)
        plain = list(text)
        for _, s, e in spans:
            plain[s:e] = " " * (e - s)
        words = [(m.start(), m[0].lower()) for m in re.finditer(r"\w{3,}", "".join(plain))]
        wide = lambda ws: set(ws) | {w[:4] + "*" for w in ws if len(w) > 4}
        holds.update(wide([w for _, w in words]))
        seen = {}
        for kind, s, e in spans:
            value = text[s:e].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", text[s:e])
            before, after = [w for at, w in words if at < s][-12:], [w for at, w in words if at > s][:12]
            seen.setdefault((kind, value), ((tuple(before[-2:]), tuple(after[:2])), set()))[1].update(wide(before + after))
        for entity, (around, near) in seen.items():
            entity_docs[entity] += 1
            for w in near:
                beside.setdefault((entity, w), Counter())[around] += 1
    above = set()
    for (entity, w), arounds in beside.items():
        n = sum(arounds.values())
        entropy = -sum(k / n * log2(k / n) for k in arounds.values())
        told, rest = log2(total * n / (entity_docs[entity] * holds[w])), log2(holds[w] / n)
        if entropy >= log2(3) - 1e-9 and told >= 4 and rest <= 1:
            above.add(w)
    return {w: (w[:4] + "*" if len(w) > 4 and w[:4] + "*" not in above else None) for w in above if not w.endswith("*")}


def test_terms_above_the_threshold(spark):
    rows = planted(random.Random(3))
    wanted = terms_by_brute_force(rows)
    got = {r.term: r.general for r in Z.disclosing(documents(spark, rows)).collect()}
    assert got == wanted
    assert set(PEOPLE) <= set(wanted)
    assert not {"onlyhere", "alsohere", "rareword"} & set(wanted)
    assert wanted["zorblaxquint"] is None and wanted["mirabellaquorn"] == "mira*"


def check(found, rows, general_of):
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append(([tuple(s) for s in r.spans], r.sanitised))
    wanted = {}
    for i, text in rows:
        text = text or ""
        base = brute(text)
        inside = lambda s, e, base=base: any(a < e and s < b for _, a, b in base)
        blanked = "".join(" " if inside(k, k + 1) else c for k, c in enumerate(text)) if base else text
        terms = [("term", *m.span()) for m in re.finditer(r"\w{3,}", blanked) if m[0].lower() in general_of]
        wanted.setdefault(i, []).append(base + terms)
    assert {i: sorted(s for s, _ in found) for i, found in got.items()} == {i: sorted(s) for i, s in wanted.items()}
    return got


def test_spans_and_texts(spark, monkeypatch):
    rows = planted(random.Random(4))
    general_of = terms_by_brute_force(rows)
    got = check(Z.sanitise(documents(spark, rows)), rows, general_of)
    for i, text in rows:
        (spans, clean), = got[i]
        assert "555" not in clean and "@" not in clean and not any(p in clean.lower() for p in PEOPLE)
        if not spans:
            assert clean == text
    assert all(not spans for i in range(400) for spans, _ in got[i])
    assert any("[PHONE]" in clean and "mira*" in clean for (_, clean), in got.values())
    monkeypatch.setattr(Z, "HELD_TERMS", 0)
    assert check(Z.sanitise(documents(spark, rows)), rows, general_of) == got


def test_cases(spark):
    df = documents(spark)
    rows = [(r[0], r[1]) for r in df.collect()]
    got = check(Z.sanitise(df), rows, {})
    for i, found in got.items():
        assert sorted(clean for _, clean in found) == sorted(t or "" for j, t in rows if j == i)
    assert Z.sanitise(df.limit(0)).count() == 0


def test_query(spark):
    folder = TESTDATA / "sf0.01"
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(str(folder / "documents.parquet")).collect()}
    general_of = terms_by_brute_force(list(rows.items()))
    got = QUERIES["op11_sanitisation"](spark, str(folder)).collect()
    assert len(got) == len(rows)
    for r in got:
        base = brute(rows[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in Z.BASE]
        text = Z.written(base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans == text or r.spans.startswith(text) and r.n_term
        assert r.n_term == len([w for w in re.findall(r"\w{3,}", Z.outside(rows[r.doc_id], base)) if w.lower() in general_of])
