"""Information-theoretic sanitisation of personal data.

The protected entities are the values found by fixed patterns: e-mail addresses, IPv4
addresses, payment cards, phone numbers (``base_spans``). How strongly another term reveals an
entity is estimated from the corpus: with N documents, n(t) that hold the term, n(c) that hold
the entity, and n(c, t) where the term stands within ``REACH`` words of it,

    information  PMI(c; t) = log2(N n(c, t) / (n(c) n(t))),   rest = log2(n(t) / n(c, t)).

The rest is what of the entity's own information -log2(n(c) / N) the term leaves open. A term
is above the disclosure threshold if it tells ``TOLD`` bits or more and leaves ``LEFT`` or less
open. Copies of a document are one witness, not many: the perplexity of the surroundings in
which the entity stands beside the term must be ``WITNESSES`` or more; so a value that occurs
once, or in copies only, never makes the words around it personal data.

A term above the threshold is generalised: its beginning of ``PREFIX`` letters stands for it, if
that is no term above the threshold itself, else it is removed. Terms are sought everywhere, also
where the entity does not stand: a name that goes with a phone number is personal data anywhere.

Terms are runs of at least ``SHORTEST`` word characters, lower-cased, outside of base spans. Base
spans stay whatever the corpus tells. Null and empty texts have no spans and sanitise to the
empty text; texts of any length are searched whole, in time that grows with their length. Rows
that repeat an id or a text are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import chunks, pick, stored
from linkweave.operators.lookup import lookup_join

KINDS = ["email", "ip", "card", "phone", "term"]
BASE = KINDS[:4]

REACH = 12
SHORTEST = 3
PREFIX = 4
TOLD = 4.0
LEFT = 1.0
WITNESSES = 3.0
#: Words on each side that tell one surrounding of an entity from another.
BESIDE = 2
#: A task holds the terms above the threshold up to so many bytes; beyond, they are joined.
HELD_TERMS = 1 << 25
#: Documents whose terms are counted before their counts are given on.
COUNTED_DOCS, COUNTED_CHARS = 8192, 1 << 24

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match that starts inside a run of digits would have started at the run's beginning.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_TERM = re.compile(r"\w{%d,}" % SHORTEST)

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each sign is met once and its local part read backwards, so long runs cost no more."""
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at)):
            end = found.end()
            yield start, end
            at = end
        else:
            # No later sign's local part reaches beyond this one.
            end = at = at + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 1) % 9 + 1 if d else 0
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start; positions in code points."""
    out: list[Span] = [("email", *at) for at in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(digits := _DIGITS.sub("", m[0])) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def entity_of(text: str, span: Span) -> str:
    """The value that a span writes, in one form."""
    kind, start, end = span
    value = text[start:end]
    return f"{kind}:{_DIGITS.sub('', value) if kind in ('card', 'phone') else value.lower()}"


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def outside(text: str, spans: list[Span]) -> str:
    """The text with blanks in the place of its base spans, of the same length."""
    if not spans:
        return text
    parts, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if end > at:
            start = max(start, at)
            parts += [text[at:start], " " * (end - start)]
            at = end
    return "".join([*parts, text[at:]])


def _with_general(terms: Iterable[str]) -> set[str]:
    """The terms, and the beginnings of longer ones with a star behind."""
    out = set(terms)
    return out | {term[:PREFIX] + "*" for term in out if len(term) > PREFIX}


def _mentions(text: str, spans: list[Span], plain: str) -> Iterator[tuple[str, str, set[str]]]:
    """Each entity of a document once: its first surrounding, and the terms near any mention."""
    words = list(_TERM.finditer(plain))
    starts = [m.start() for m in words]
    found: dict[str, tuple[str, set[str]]] = {}
    for span in spans:
        after = bisect_left(starts, span[1])
        near = [m[0].lower() for m in words[max(0, after - REACH):after + REACH]]
        behind = min(REACH, after)
        around = " ".join([*near[max(0, behind - BESIDE):behind], "|", *near[behind:behind + BESIDE]])
        found.setdefault(entity_of(text, span), (around, set()))[1].update(near)
    for entity, (around, terms) in found.items():
        yield entity, hashlib.md5(around.encode()).hexdigest()[:16], _with_general(terms)


_SEEN = "entity string, around string, terms array<string>, term string, n long"


def _seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of all documents: mentions of entities, and counts of the documents that hold each term."""
    counts: Counter[str] = Counter()
    docs = chars = 0

    def given(mentions: list[tuple[str, str, list[str]]], counted: dict[str, int]) -> pa.RecordBatch:
        m, n = len(mentions), len(counted)
        entity, around, terms = zip(*mentions, strict=True) if mentions else ((), (), ())
        return pa.record_batch(
            [
                pa.array([*entity, *[None] * n], pa.string()), pa.array([*around, *[None] * n], pa.string()),
                pa.array([*terms, *[None] * n], pa.list_(pa.string())),
                pa.array([*[None] * m, *counted], pa.string()), pa.array([*[None] * m, *counted.values()], pa.int64()),
            ],
            names=["entity", "around", "terms", "term", "n"],
        )

    for _, texts in chunks(batches, chars=1 << 21, rows=1024):
        mentions = []
        for text in texts:
            spans = base_spans(text)
            plain = outside(text, spans)
            if spans:
                mentions += [(c, around, sorted(terms)) for c, around, terms in _mentions(text, spans, plain)]
            counts.update(_with_general(_TERM.findall(plain.lower()) if plain.isascii() else map(str.lower, _TERM.findall(plain))))
            chars += len(text)
        # The empty term counts the documents.
        counts[""] += len(texts)
        docs += len(texts)
        if mentions:
            yield given(mentions, {})
        if docs >= COUNTED_DOCS or chars >= COUNTED_CHARS:
            yield given([], counts)
            counts.clear()
            docs = chars = 0
    if counts:
        yield given([], counts)


def disclosing(documents: DataFrame) -> DataFrame:
    """term, entities, told, rest, general: all terms above the threshold.

    ``told`` and ``rest`` are those of the entity that the term reveals most; ``general`` is what
    stands for the term, null if it is removed.
    """
    texts = pick(documents, "doc_id", "text")
    seen = stored(texts.mapInArrow(_seen, _SEEN))
    mentions = seen.where(F.col("entity").isNotNull()).select("entity", "around", "terms")
    counts = seen.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n").alias("n_t"))
    total = seen.where(F.col("term") == "").agg(F.sum("n")).first()[0] or 0
    # Fewer surroundings than that cannot have the perplexity.
    entities = (
        mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n_c")).where(F.col("n_c") >= WITNESSES)
    )
    around = (
        lookup_join(mentions, entities, ["entity"])
        .select("entity", "n_c", "around", F.explode("terms").alias("term"))
        .groupBy("entity", "n_c", "term", "around").agg(F.count(F.lit(1)).alias("n"))
    )
    n = F.col("n").cast("double")
    pairs = (
        around.groupBy("entity", "n_c", "term")
        .agg(F.sum("n").alias("n_ct"), F.sum(n * F.log2(n)).alias("inside"))
        .where(F.log2("n_ct") - F.col("inside") / F.col("n_ct") >= F.log2(F.lit(WITNESSES)) - 1e-9)
    )
    told = F.log2(F.lit(float(total)) * F.col("n_ct") / (F.col("n_c").cast("double") * F.col("n_t")))
    above = stored(
        lookup_join(pairs, counts, ["term"])
        .withColumns({"told": told, "rest": F.log2(F.col("n_t") / F.col("n_ct"))})
        .where((F.col("told") >= TOLD) & (F.col("rest") <= LEFT))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("entities"), F.max(F.struct("told", F.negative("rest").alias("rest"))).alias("most"))
        .select("term", "entities", "most.told", F.negative("most.rest").alias("rest"))
    )
    wide = above.where(F.col("term").endswith("*")).select(F.col("term").alias("general"), F.lit(True).alias("known"))
    shorter = F.when(F.length("term") > PREFIX, F.concat(F.substring("term", 1, PREFIX), F.lit("*")))
    return (
        above.where(~F.col("term").endswith("*"))
        .withColumn("general", shorter)
        .join(wide, "general", "left")
        .select("term", "entities", "told", "rest", F.when(F.col("known").isNull(), F.col("general")).alias("general"))
    )


def rewritten(text: str, spans: list[Span], general_of: dict[str, str | None]) -> str:
    """The text with its base spans named by kind, and its terms generalised or removed."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start < at:
            # It overlaps one that is gone already: what is left of it goes too.
            at = max(at, end)
            continue
        new = (general_of.get(text[start:end].lower()) or "") if kind == "term" else f"[{kind.upper()}]"
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]])


def term_spans(text: str, base: list[Span], known) -> list[Span]:
    return [("term", *m.span()) for m in _TERM.finditer(outside(text, base)) if m[0].lower() in known]


_FOUND = "doc_id long, spans array<struct<kind:string,start:int,end:int>>, sanitised string"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _batch(ids: list, spans: list[list[Span]], texts: list[str]) -> pa.RecordBatch:
    rows = [[{"kind": k, "start": s, "end": e} for k, s, e in own] for own in spans]
    return pa.record_batch(
        [pa.array(ids, pa.int64()), pa.array(rows, _SPAN), pa.array(texts)], names=["doc_id", "spans", "sanitised"]
    )


def _held(documents: DataFrame, general_of: dict[str, str | None]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in chunks(batches, chars=1 << 21, rows=1024):
            spans = []
            for text in texts:
                base = base_spans(text)
                spans.append(base + (term_spans(text, base, general_of) if general_of else []))
            yield _batch(ids, spans, [rewritten(t, s, general_of) for t, s in zip(texts, spans, strict=True)])

    return documents.mapInArrow(run, _FOUND)


def _joined(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """The same by a join of each document's distinct terms, where the terms are too many to hold."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uids, texts in chunks(batches, chars=1 << 21, rows=1024):
            out = [sorted({m[0].lower() for m in _TERM.finditer(outside(t, base_spans(t)))}) for t in texts]
            yield pa.record_batch([pa.array(uids, pa.int64()), pa.array(out, pa.list_(pa.string()))], names=["uid", "terms"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, spans = [], [], []
            for row in batch.to_pylist():
                text = row["text"] or ""
                general_of = {x["term"]: x["general"] for x in row["known"] or []}
                base = base_spans(text)
                spans.append(base + (term_spans(text, base, general_of) if general_of else []))
                ids.append(row["doc_id"])
                texts.append(rewritten(text, spans[-1], general_of))
            yield _batch(ids, spans, texts)

    rows = stored(documents.withColumn("uid", F.monotonically_increasing_id()))
    held = rows.select(F.col("uid").alias("doc_id"), "text").mapInArrow(distinct, "uid long, terms array<string>")
    known = (
        lookup_join(held.select("uid", F.explode("terms").alias("term")), terms.select("term", "general"), ["term"])
        .groupBy("uid").agg(F.collect_list(F.struct("term", "general")).alias("known"))
    )
    return rows.join(known, "uid", "left").select("doc_id", "text", "known").mapInArrow(run, _FOUND)


def sanitise(documents: DataFrame) -> DataFrame:
    """doc_id, spans (kind, start, end) and the sanitised text of every document."""
    texts = pick(documents, "doc_id", "text")
    terms = stored(disclosing(documents))
    size = terms.agg(F.sum(F.octet_length("term") + 128)).first()[0] or 0
    if size > HELD_TERMS:
        return _joined(texts, terms)
    # At most ``HELD_TERMS`` bytes.
    return _held(texts, {r.term: r.general for r in terms.collect()})


def digests(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of every document."""
    base = F.filter("spans", lambda s: s["kind"] != "term")

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    return found.select(
        "doc_id", *counts[:4], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        counts[4], F.sha2("sanitised", 256).alias("sanitised_sha256"),
    )
