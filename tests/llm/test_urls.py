import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linkweave.llm import urls as U


def pages(spark, rows, html="<p>plain words of text and more words</p>"):
    return spark.createDataFrame(
        [(i, u, html, "x", 1.0) for i, u in rows], "page_id long, url string, html string, host string, odds double"
    ).withColumnRenamed("host", "URL")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:end], rest[end:]
    stop = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path[:stop]


def rule(host, path):
    fitting = [
        r.text for r in U.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fitting, key=len, default=None)


URLS = [
    "http://Example.COM/en/1", "https://www.example.com/en/2?x=/a", "http://a.www.example.com/en/", "http://example.com/de/1",
    "http://x.net/es/4#top", "http://x.net/fr", "http://x.net/fr/", "http://x.net/de/", "net/es/1", "http://net/es/",
    "http://com", "http://com/", "http://notexample.com/en/1", "http://xnet/es/", "http://a.org?u=http://b.com/", "",
    None, "x://y://z/en", "HTTP://ÄÖ.Org/Pfad", "http://casinowin.org/1", "http://www.free-bets.org/en/77", "://", "http:///p",
    "http://" + "verylonghostname" * 40 + ".org/", "http://casinowin.org/1",
]


def test_rules_and_parts(spark):
    got = U.judge(pages(spark, list(enumerate(URLS)))).collect()
    assert sorted(r.page_id for r in got) == list(range(len(URLS)))
    for r in got:
        host, path = split(URLS[r.page_id])
        assert (r.host, r.path) == (host, path)
        assert r.rule == rule(host, path)
        if r.rule:
            assert r.verdict == {x.text: x.verdict for x in U.RULES}[r.rule]
        else:
            assert r.verdict == ("block" if r.odds > 0 else "allow")


def test_bad_hosts_are_blocked_and_others_not(spark):
    rows = [(i, f"http://m.clean{i % 9}name.org/en/{i}") for i in range(60)]
    rows += [(100 + i, f"http://casinowin.org/en/{i}") for i in range(6)]
    rows += [(200, "http://freebets.org/en/1"), (201, None), (None, "http://spamfarm.org/en/2")]
    html = "<p>free win farm clean name words en m org free win farm</p>"
    got = {r.page_id: r.verdict for r in U.judge(pages(spark, rows, html)).collect()}
    blocked = {i for i, v in got.items() if v == "block"}
    assert blocked == {*range(100, 106), 200, None}


def test_empty_and_nulls(spark):
    assert U.judge(pages(spark, [])).count() == 0
    got = U.judge(pages(spark, [(1, None), (1, None), (None, None)], html=None)).collect()
    assert [(r.host, r.path, r.rule) for r in got] == [("", "", None)] * 3


def cheapest(name, counts, total):
    """All ways to cut a name."""
    best = None
    for bits in range(1 << (len(name) - 1)):
        cuts = [0, *[i + 1 for i in range(len(name) - 1) if bits >> i & 1], len(name)]
        words = [name[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        score = sum(
            math.log(counts[w] / total) if w in counts else -math.log(total) - len(w) * math.log(10) for w in words
        )
        if best is None or score > best[0] + 1e-9:
            best = score, words
    return best


@pytest.mark.parametrize("name", ["freebets", "spamfarm", "xqz", "thewinners", "a", "aaa"])
def test_cut_against_all_ways(name):
    counts = {"free": 50, "bets": 9, "bet": 20, "spam": 5, "farm": 7, "the": 900, "win": 30, "winners": 2, "a": 400, "s": 3}
    total = sum(counts.values())
    places = {
        (i, n): counts[name[i:i + n]] for i in range(len(name)) for n in range(1, len(name) - i + 1) if name[i:i + n] in counts
    }
    got = U.best_cut(name, places, total)
    score = sum(math.log(counts[w] / total) if w in counts else -math.log(total) - len(w) * math.log(10) for w in got)
    assert "".join(got) == name
    assert score == pytest.approx(cheapest(name, counts, total)[0])


def test_odds_against_brute_force(spark):
    """Naive Bayes over the words that segmentation gives."""
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = U.judge(df).collect()
    keys = Counter((r.host, "".join(c if not c.isnumeric() else "\0" for c in r.path)) for r in got)
    assert len({(r.host, round(r.odds, 9)) for r in got}) <= len(keys)
    counts = U.word_counts(df)
    names = df.select(F.explode(F.split(U.host_and_path(F.col("url"))[0], r"[^\p{L}\p{N}]+")).alias("name")).distinct()
    words = {r.name: list(r.words) for r in U.segment(names, counts).collect()}
    tokens, labels, n = {}, {}, Counter()
    allowing = {x.text for x in U.RULES if x.verdict == "allow"}
    for r in got:
        host = [w for p in re.split(r"[\W_]+", r.host) if p for w in words[p]]
        path = [p for p in re.split(r"[\W_]+", re.sub(r"\d+", "0", r.path).lower()) if p]
        key = r.host, re.sub(r"\d+", "0", r.path)
        tokens[key] = [U.NUMBER if t.isdigit() else t for t in host + path]
        labels[key] = 1.0 if any(t in U.SEEDS for t in host) else 0.0 if rule(*key) in allowing else None
        n[key] += 1
    bad = {k: v or 0.0 for k, v in labels.items()}
    for _ in range(U.ROUNDS + 1):
        by = Counter(), Counter()
        for key, ts in tokens.items():
            for t in ts:
                by[0][t] += n[key] * (1 - bad[key])
                by[1][t] += n[key] * bad[key]
        size = len(set(by[0]) | set(by[1]))
        sums = [sum(c.values()) + size for c in by]
        blocked = sum(n[k] * bad[k] for k in n)
        prior = math.log((blocked + 1) / (sum(n.values()) - blocked + 1))
        odds = {
            key: prior + sum(
                math.log((by[1][t] + 1) / sums[1]) - math.log((by[0][t] + 1) / sums[0]) for t in ts
            )
            for key, ts in tokens.items()
        }
        bad = {k: 1 / (1 + math.exp(-odds[k])) if v is None else v for k, v in labels.items()}
    for r in got:
        assert r.odds == pytest.approx(odds[r.host, re.sub(r"\d+", "0", r.path)], abs=1e-3)


def test_a_host_that_shares_its_words_with_bad_ones_is_bad(spark):
    rows = [(i, f"http://m.clean{'abcdefghi'[i % 9]}name.org/en/{i}") for i in range(90)]
    rows += [(100 + i, f"http://{x}{y}.org/en/{i}") for i, (x, y) in enumerate(
        [("casino", "win"), ("poker", "farm"), ("win", "bets"), ("lucky", "casino"), ("farm", "slots"), ("poker", "lucky")] * 3
    )]
    rows += [(200 + i, f"http://luckywinfarm.org/en/{i}") for i in range(12)]
    html = "<p>lucky win farm clean name words m org en lucky win farm</p>"
    blocked = {r.page_id for r in U.judge(pages(spark, rows, html)).collect() if r.verdict == "block"}
    assert blocked == {*range(100, 118), *range(200, 212)}


def test_words_of_any_length_are_found(spark):
    long, other = "abcdefghijklmnopqrstuvwxyz" * 40, "abcdefghijklmnopqrstuvwxyz" * 2 + "q"
    df = pages(spark, [(i, "") for i in range(5)], f"<p>{long} {other} one two</p>")
    names = spark.createDataFrame([(f"one{long}two",), (f"{other}one",), ("abcdefghijklmnopqrst",)], "name string")
    got = {r.name: list(r.words) for r in U.segment(names, U.word_counts(df)).collect()}
    assert got == {
        f"one{long}two": ["one", long, "two"], f"{other}one": [other, "one"], "abcdefghijklmnopqrst": ["abcdefghijklmnopqrst"],
    }


def test_cuts_do_not_depend_on_the_size_of_the_input():
    seen = {"be": 4000, "t": 3000, "my": 2000, "s": 3000, "and": 20_000, "other": 1_068_000}
    names = ["mybet", *U.SEEDS]

    def cuts(times):
        counts = Counter({w: n * times for w, n in seen.items()})
        counts.update(dict.fromkeys(U.SEEDS, U.seed_count(counts.total())))
        total = counts.total()
        return [
            U.best_cut(
                name,
                {(i, j - i): counts[name[i:j]] for i in range(len(name)) for j in range(i + 1, len(name) + 1)}, total,
            )
            for name in names
        ]

    assert cuts(1) == cuts(10_000) == [["my", "bet"], *[[w] for w in U.SEEDS]]
