"""Toxicity: cumulative-link ordinal regression of severity grades on the words of a text.

P(grade > j) = s(w.x - t_j) with one weight per word for all ordered thresholds t_j; the
result is the expected severity, the sum of these over j. x has log(1 + count) of each
word and beginning of a word in the model that the text holds, so few entries.

The tables hold no grades, only a mark toxic or not. Grades are made from it: 0 for rows
not marked; of marked rows, by how many words lean to the mark: 1, from 3 on 2, from 6 on 3.
A word or beginning leans if its share of the marked rows and of the others differ with a z
of ``LEANS`` or more; all that lean enter the model, terms with equal z by their letters.

It is fitted on at most ``SAMPLE`` labelled documents, those whose ids hash lowest, none of
them held out; of rows that repeat an id the smallest text counts. Whole texts count and are
scored, however long. Without labels of both kinds every
severity is 0. Null and empty texts have no words. Rows are scored one by one, repeated
rows and null ids like any other; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import chunks, pick, stored, where_score
from linkweave.llm.quality import labelled_sample

SAMPLE = 20_000
LEANS = 5.0
#: Words that lean to the mark from which on a marked row has the next grade.
NEXT_GRADE = (3, 6)
GRADES = 2 + len(NEXT_GRADE)
STEPS = 400
L2 = 1e-4
#: Expected severity from which on a document is toxic.
TOXIC = 0.5

#: Lengths of the beginnings that count besides whole words.
BEGINNINGS = (3, 4, 5, 6, 7)
KEPT_WORDS = 300_000
#: Terms whose counts a task holds before it gives them on.
COUNTED_TERMS = 1_000_000

#: Term that counts all words of a text: a word weighs less in a long text.
LENGTH = "#"

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def terms_of(word: str) -> list[str]:
    """The word, and its beginnings with a star behind."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if n < len(word)]]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass(frozen=True)
class Ordinal:
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES - 1, 500.0))
    weights: dict[str, float] = field(default_factory=dict)

    def severities(self, sums: np.ndarray) -> np.ndarray:
        return _sigmoid(sums[:, None] - self.thresholds).sum(1)

    def sum_of(self, words: list[str], known: dict[str, list[str]]) -> float:
        """w.x of a text; ``known`` keeps the terms of words met before."""
        found: list[str] = []
        for word in words:
            terms = known.get(word)
            if terms is None:
                if len(known) > KEPT_WORDS:
                    known.clear()
                terms = known[word] = [t for t in terms_of(word) if t in self.weights]
            if terms:
                found += terms
        counts = Counter(found)
        if LENGTH in self.weights:
            counts[LENGTH] = len(words)
        return sum(self.weights[t] * np.log1p(n) for t, n in sorted(counts.items()))


def fit(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int,
    steps: int = STEPS,
) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds and weights of the likeliest model (Adam); entries are (row, column, value)."""
    n = len(grades)
    share = np.clip([(grades > j).mean() for j in range(GRADES - 1)], 1e-4, 1 - 1e-4)
    first = np.log((1 - share) / share)
    # The first threshold and the logarithms of the gaps, so that they stay in order.
    gaps = np.log(np.maximum(np.diff(first), 0.1))
    point = np.concatenate([np.zeros(width), first[:1], gaps])
    mean, square = np.zeros_like(point), np.zeros_like(point)
    every = np.arange(n)
    for step in range(1, steps + 1):
        w, gap = point[:width], np.exp(point[width + 1:])
        thresholds = point[width] + np.concatenate([[0], np.cumsum(gap)])
        sums = np.bincount(rows, w[columns] * values, n)
        below = np.ones((n, GRADES + 1))
        below[:, 0] = 0
        below[:, 1:GRADES] = _sigmoid(thresholds - sums[:, None])
        to, frm = below[every, grades + 1], below[every, grades]
        p = np.maximum(to - frm, 1e-12)
        by_sum = (1 - to - frm) / n
        by_threshold = np.zeros(GRADES + 1)
        np.add.at(by_threshold, grades + 1, -to * (1 - to) / p / n)
        np.add.at(by_threshold, grades, frm * (1 - frm) / p / n)
        inner = by_threshold[1:GRADES]
        gradient = np.concatenate([
            np.bincount(columns, by_sum[rows] * values, width) + L2 * w,
            [inner.sum()],
            gap * np.cumsum(inner[::-1])[::-1][1:],
        ])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        point -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return point[width] + np.concatenate([[0], np.cumsum(np.exp(point[width + 1:]))]), point[:width]


def _terms_in(text: str) -> Counter[str]:
    words = words_of(text)
    found = Counter(t for w in words for t in terms_of(w))
    found[LENGTH] = len(words)
    return found


def _rows_by_term(texts: DataFrame) -> DataFrame:
    """(word, marked, rows): how many of the documents, and of the marked ones, hold each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: Counter[str] = Counter()
        marked: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            terms = list(rows)
            return pa.record_batch(
                [pa.array(terms), pa.array([marked[t] for t in terms], pa.int64()), pa.array(list(rows.values()), pa.int64())],
                names=["word", "marked", "rows"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                found = _terms_in(row["text"] or "").keys()
                rows.update(found)
                if row["label"]:
                    marked.update(found)
                if len(rows) > COUNTED_TERMS:
                    yield counted()
                    rows.clear()
                    marked.clear()
        if rows:
            yield counted()

    counts = texts.mapInArrow(run, "word string, marked long, rows long")
    return counts.groupBy("word").agg(F.sum("marked").alias("marked"), F.sum("rows").alias("rows"))


def _entries(texts: DataFrame, index: dict[str, int]) -> DataFrame:
    """(label, at, n): one row per document, with the numbers and counts of its terms in the model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = {index[t]: n for t, n in _terms_in(row["text"] or "").items() if t in index}
                yield pa.record_batch(
                    [
                        pa.array([row["label"]], pa.int32()), pa.array([list(found)], pa.list_(pa.int32())),
                        pa.array([list(found.values())], pa.list_(pa.int32())),
                    ],
                    names=["label", "at", "n"],
                )

    return texts.mapInArrow(run, "label int, at array<int>, n array<int>")


def train(documents: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Ordinal:
    sample = stored(labelled_sample(labels, "toxic", size))
    by_label = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    marked, others = by_label.get(1, 0), by_label.get(0, 0)
    if not marked or not others:
        return Ordinal()
    # At most ``size`` ids of 8 bytes; and then one text for each.
    texts = stored(
        pick(documents, "doc_id", "text").join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").cast("int").alias("label"))
    )
    share = F.col("rows") / F.lit(marked + others)
    z = (F.col("marked") / marked - F.col("others") / others) / F.sqrt(
        F.greatest(share * (1 - share), F.lit(1e-9)) * F.lit(1 / marked + 1 / others)
    )
    leaning = (
        _rows_by_term(texts)
        .withColumn("others", F.col("rows") - F.col("marked"))
        .withColumn("z", z)
        .where((F.abs("z") >= LEANS) & (F.col("word") != LENGTH))
        .orderBy(F.desc(F.abs("z")), "word")
        .select("word", "z").collect()
    )
    if not leaning:
        return Ordinal()
    terms = [LENGTH, *[r.word for r in leaning]]
    # Of at most ``size`` documents, numbers of their leaning terms only.
    found = _entries(texts, {t: i for i, t in enumerate(terms)}).toArrow()
    at, n = (found.column(c).combine_chunks() for c in ("at", "n"))
    columns, n, sizes = np.asarray(at.flatten()), np.asarray(n.flatten()), np.asarray(at.value_lengths())
    rows = np.repeat(np.arange(len(sizes)), sizes)
    marks = np.asarray(found.column("label")) == 1
    # A word has one term of each length at most, so the most of one length is counted.
    length = np.array([len(t) if t.endswith("*") else 0 for t in terms])
    toward = np.isin(terms, [r.word for r in leaning if r.z > 0])[columns]
    by_length = np.zeros((len(sizes), length.max() + 1))
    np.add.at(by_length, (rows[toward], length[columns[toward]]), n[toward])
    grades = np.where(marks, 1 + (by_length.max(1)[:, None] >= NEXT_GRADE).sum(1), 0)
    thresholds, weights = fit(rows, columns, np.log1p(n), grades, len(terms))
    return Ordinal(thresholds, dict(zip(terms, weights.tolist(), strict=True)))


def _severities(model: Ordinal) -> Callable[[list[str]], np.ndarray]:
    known: dict[str, list[str]] = {}

    def run(texts: list[str]) -> np.ndarray:
        return model.severities(np.array([model.sum_of(words_of(t), known) for t in texts], np.float64))

    return run


def score(documents: DataFrame, labels: DataFrame, toxic: float = TOXIC) -> DataFrame:
    """doc_id, severity (expected grade), toxic (1 or 0) of every document."""
    severities = _severities(train(documents, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in chunks(batches, chars=1 << 21):
            yield pa.record_batch(
                [pa.array(doc_ids, pa.int64()), pa.array(severities(texts))], names=["doc_id", "severity"]
            )

    return pick(documents, "doc_id", "text").mapInArrow(run, "doc_id long, severity double").select(
        "doc_id", "severity", F.when(F.col("severity") >= toxic, 1).otherwise(0).alias("toxic")
    )


def without_toxic(documents: DataFrame, labels: DataFrame, toxic: float = TOXIC) -> DataFrame:
    """The rows of documents whose own text is not toxic, as ``score`` judges it."""
    return where_score(documents, _severities(train(documents, labels)), lambda s: s < toxic)
