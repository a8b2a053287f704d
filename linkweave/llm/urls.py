"""URL filter: rules first, then host word segmentation and naive Bayes.

Concatenated host names are split into words by a unigram model: of all ways to cut a name,
the one with the highest product of word probabilities (Viterbi). Word counts come from the
text of all pages. The candidates of a name, its parts of up to ``HEAD`` characters, are
joined with the counts, so no dictionary is held anywhere whole; longer words are found by
their first ``HEAD`` characters and compared with the name behind these, whatever their length.

A multinomial naive Bayes model scores the words of host and path. It learns from the urls
themselves by expectation-maximisation: those with a seed word in the host are examples to
block, those that a rule allows are examples to allow. The rest begin as examples to allow
and then count for each class by their posterior, ``ROUNDS`` times. So a host without a seed
word that shares its words with bad ones becomes bad itself. Numbers count as one word. A url
is blocked if block is the likelier class, allowed if both are alike.

All this works on distinct (host, shape of the path), with the number of their urls as
weight; verdicts go back to the pages by a join. Texts and names of any length are read whole.
A null url, and one without "://", has an
empty host and path; without words it has the classes' prior odds. Rows are judged one by
one, repeated rows and null ids like any other. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import pick, stored
from linkweave.operators.lookup import lookup_join

#: Longest part of a name that is looked up; longer words are found by as many characters.
HEAD = 20
#: Rounds of expectation-maximisation behind the first model.
ROUNDS = 4
#: Posteriors count in so many parts, so that their sums are exact in any order.
PARTS = 1 << 20
#: Words in the host names of sites that sell bets, drugs, sex, or links.
SEEDS = (
    "ads", "adult", "bet", "bets", "betting", "bingo", "casino", "escort", "gambling", "jackpot",
    "lottery", "pills", "poker", "porn", "roulette", "sex", "slots", "spam", "viagra", "xxx",
)
#: Times that a seed word counts as seen, so that names are cut around it: at least so often,
#: and at least once in so many words, so that cuts do not depend on the size of the input.
SEED_COUNT = 1000
SEED_SHARE = 1000
NUMBER = "0"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host, with all its subdomains, and the beginning of a path, like ``net/es/``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self, path: str = "path") -> Column:
        host = (F.col("host") == self.host) | F.col("host").endswith("." + self.host)
        return host & F.col(path).startswith(self.path)


RULES = (
    Rule("com/", "allow"),
    Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"),
    Rule("net/fr/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(rules: tuple[Rule, ...], path: str = "path") -> Column:
    """The text of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        found = F.when(rule.fits(path), rule.text).otherwise(found)
    return found


def seed_count(total: int) -> int:
    """Times that each seed word counts as seen besides ``total`` words."""
    return max(SEED_COUNT, total // SEED_SHARE)


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n) over the text of all pages, with the seed words."""
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(html), F.lit(""))), r"<[^>]*>", " ")
    words = pages.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word")).where("word != ''")
    counts = stored(words.groupBy("word").agg(F.count("*").alias("n")))
    n = seed_count(counts.agg(F.sum("n")).first()[0] or 0)
    seeds = pages.sparkSession.createDataFrame([(w, n) for w in SEEDS], "word string, n long")
    return counts.unionByName(seeds).groupBy("word").agg(F.sum("n").alias("n"))


def best_cut(name: str, counts: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest words of a name; ``counts`` has those of the known parts (start, length).

    An unknown part of n characters has the probability of 10**-n of a word seen once.
    """
    ends: dict[int, list[tuple[int, float]]] = {}
    for (start, size), n in counts.items():
        if n:
            ends.setdefault(start + size, []).append((start, math.log(n / total)))
    best = [0.0] * (len(name) + 1)
    back = [0] * (len(name) + 1)
    # Of all places that an unknown part can begin at, the best one so far.
    ahead, begin = 0.0, 0
    for end in range(1, len(name) + 1):
        best[end], back[end] = ahead - end * math.log(10) - math.log(total), begin
        for start, own in ends.get(end, ()):
            if best[start] + own > best[end]:
                best[end], back[end] = best[start] + own, start
        if best[end] + end * math.log(10) > ahead:
            ahead, begin = best[end] + end * math.log(10), end
    words, end = [], len(name)
    while end:
        words.append(name[back[end]:end])
        end = back[end]
    return words[::-1]


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of distinct names, by the counts of words."""
    # Numbered pieces, so that a part that many names hold is looked up for each alone.
    parts = names.select(
        "name",
        F.explode(F.expr(
            f"""flatten(transform(sequence(1, length(name)), i ->
                transform(sequence(1, least({HEAD}, length(name) - i + 1)),
                    l -> struct(i - 1 AS start, l AS size, substring(name, i, l) AS word))))"""
        )).alias("p"),
    ).select("name", "p.*")
    short = lookup_join(parts, counts.where(F.length("word") <= HEAD), ["word"])
    heads = counts.where(F.length("word") > HEAD).select(
        F.substring("word", 1, HEAD).alias("word"), F.col("word").alias("whole"), "n"
    )
    long = (
        lookup_join(parts.where(F.col("size") == HEAD), heads, ["word"])
        .where("substring(name, start + 1, length(whole)) = whole")
        .withColumn("size", F.length("whole"))
    )
    columns = ["name", "start", "size", "n"]
    known = short.select(columns).unionByName(long.select(columns)).groupBy("name").agg(
        F.collect_list(F.struct("start", "size", "n")).alias("known")
    )
    total = counts.agg(F.sum("n")).first()[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [
                best_cut(name, {(k["start"], k["size"]): k["n"] for k in (() if known is None else known)}, total)
                for name, known in zip(batch["name"], batch["known"], strict=True)
            ]
            yield pd.DataFrame({"name": batch["name"], "words": words})

    return names.join(known, "name", "left").mapInPandas(run, "name string, words array<string>")


def _tokens(keys: DataFrame, counts: DataFrame) -> DataFrame:
    """(id, token, n_urls, in_host): the words of host and path of every distinct key."""
    def pieces(column: str) -> Column:
        return F.explode(F.filter(F.split(F.lower(column), r"[^\p{L}\p{N}]+"), lambda x: x != ""))

    host = keys.select("id", "n_urls", pieces("host").alias("name"))
    words = segment(host.select("name").distinct(), counts)
    in_host = lookup_join(host, words, ["name"]).select(
        "id", "n_urls", F.lit(True).alias("in_host"), F.explode("words").alias("token")
    )
    in_path = keys.select(
        "id", "n_urls", F.lit(False).alias("in_host"), pieces("shape").alias("token")
    )
    both = in_host.unionByName(in_path)
    return both.withColumn("token", F.regexp_replace("token", r"^\p{N}+$", NUMBER))


def _odds(tokens: DataFrame, keys: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(host, shape, odds): log odds of block by naive Bayes, learnt by expectation-maximisation."""
    seeded = tokens.groupBy("id").agg(
        F.max(F.col("in_host") & F.col("token").isin(*SEEDS)).alias("seed")
    )
    allowed = F.lit(False)
    for rule in rules:
        if rule.verdict == "allow":
            allowed = allowed | (matching_rule(rules, "shape") == rule.text)
    known = F.when(F.col("seed"), F.lit(PARTS)).when(allowed, 0)
    # What each key counts as bad, of PARTS; null: not known.
    keys = stored(
        lookup_join(keys, seeded, ["id"], "left").select("id", "host", "shape", "n_urls", known.alias("known"))
    )
    tokens = stored(tokens.groupBy("id", "token").agg(F.count("*").alias("times")))
    bad = keys.select("id", "n_urls", F.coalesce("known", F.lit(0)).cast("long").alias("bad"))
    for _ in range(ROUNDS + 1):
        counted = lookup_join(tokens, bad, ["id"])
        by_token = stored(counted.groupBy("token").agg(
            F.sum(F.col("times") * F.col("n_urls") * F.col("bad")).alias("bad"),
            F.sum(F.col("times") * F.col("n_urls") * (PARTS - F.col("bad"))).alias("good"),
        ))
        sums = by_token.agg(F.sum("bad"), F.sum("good"), F.count("*")).first()
        all_bad, all_good, size = (x or 0 for x in sums)
        weight = (
            F.log((F.col("bad") + PARTS) / F.lit(float(all_bad + size * PARTS)))
            - F.log((F.col("good") + PARTS) / F.lit(float(all_good + size * PARTS)))
        )
        weights = by_token.select("token", weight.alias("weight"))
        prior = bad.agg(F.sum(F.col("n_urls") * F.col("bad")), F.sum(F.col("n_urls") * (PARTS - F.col("bad")))).first()
        base = math.log(((prior[0] or 0) + PARTS) / ((prior[1] or 0) + PARTS))
        scored = (
            lookup_join(tokens, weights, ["token"]).groupBy("id")
            .agg(F.sum(F.col("times") * F.col("weight")).alias("weight"))
        )
        odds = stored(lookup_join(keys, scored, ["id"], "left").select(
            "id", "host", "shape", "n_urls", "known", (F.coalesce("weight", F.lit(0.0)) + base).alias("odds")
        ))
        posterior = F.round(F.lit(PARTS) / (1 + F.exp(-F.col("odds")))).cast("long")
        bad = odds.select("id", "n_urls", F.coalesce(F.col("known").cast("long"), posterior).alias("bad"))
    return odds.select("host", "shape", "odds")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and odds (log odds of block by the method)."""
    rows = pick(pages, "page_id", "url", "html")
    host, path = host_and_path(F.col("url"))
    shape = F.regexp_replace("path", r"\p{N}+", NUMBER)
    urls = rows.select("page_id", host.alias("host"), path.alias("path")).withColumn("shape", shape)
    keys = stored(
        urls.groupBy("host", "shape").agg(F.count("*").alias("n_urls"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    counts = stored(word_counts(rows))
    tokens = stored(_tokens(keys, counts))
    odds = _odds(tokens, keys, rules)
    judged = lookup_join(urls, odds, ["host", "shape"]).withColumn("rule", matching_rule(rules))
    verdict = F.when(F.col("odds") > 0, "block").otherwise("allow")
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.text, rule.verdict).otherwise(verdict)
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "odds")
