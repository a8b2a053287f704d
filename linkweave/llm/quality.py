"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from the whole text alone. Trees are grown level by level on binned
statistics and logistic loss; the model is a handful of flat arrays (feature, threshold,
children, value), and numpy walks all trees for many documents at once.

It is fitted on at most ``SAMPLE`` labelled documents, those whose ids hash lowest, none of
them held out: a bounded sample, so fitting fits into one process at any size. Of rows that
repeat an id one counts there. Without labels, or with labels of one class, every score is
that class's smoothed share.

Null and empty texts have statistics of zeros and get a score like any other. Rows are
scored one by one, repeated ones too; a null id is not held out. An empty table gives none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import chunks, held_out, pick, stored, where_score

SAMPLE = 20_000
BINS = 64
ROUNDS = 80
DEPTH = 4
RATE = 0.1
L2 = 1.0
LEAST_WEIGHT = 3.0
ACCEPTED = 0.3

FEATURES = (
    "log_chars", "log_words", "word_length", "distinct_words", "distinct_pairs", "repeated_neighbours",
    "deflated", "distinct_lines", "line_length", "longest_word", "upper", "digits", "punctuation",
    "symbols", "white", "letters", "signs_per_word", "bars_per_word", "stops_per_word",
)
_UPPER, _LETTER, _DIGIT, _PUNCTUATION, _SYMBOL, _WHITE, _OTHER = range(7)


def _classes() -> np.ndarray:
    import unicodedata

    kinds = {"Lu": _UPPER, "L": _LETTER, "M": _LETTER, "N": _DIGIT, "P": _PUNCTUATION, "S": _SYMBOL, "Z": _WHITE}
    out = np.full(1 << 16, _OTHER, np.uint8)
    for code in range(1 << 16):
        name = unicodedata.category(chr(code))
        out[code] = kinds.get(name, kinds.get(name[0], _OTHER))
    out[[9, 10, 11, 12, 13]] = _WHITE
    return out


_table: list[np.ndarray] = []


def statistics(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    if not _table:
        _table.append(_classes())
    out = np.zeros((len(texts), len(FEATURES)), np.float32)
    sizes = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    # Beyond the basic plane: one class for all.
    kinds = _table[0][np.minimum(codes, 0xFFFF)].astype(np.int64)
    kinds += np.repeat(np.arange(len(texts)) * 7, sizes)
    counts = np.bincount(kinds, minlength=7 * len(texts)).reshape(-1, 7)
    for i, text in enumerate(texts):
        words = text.split()
        n = len(words) or 1
        lines = text.split("\n")
        out[i, :10] = (
            0, len(words), len(text) / n, len(set(words)) / n,
            len(set(zip(words, words[1:], strict=False))) / n, sum(map(eq, words, words[1:])) / n,
            len(zlib.compress(text.encode(), 1)) / (len(text) + 16),
            len(set(lines)) / len(lines), len(text) / len(lines), max(map(len, words), default=0),
        )
        out[i, 17:] = text.count("|") / n, text.count(".") / n
    chars = np.maximum(sizes, 1)
    letters = counts[:, _UPPER] + counts[:, _LETTER]
    words = np.maximum(out[:, 1], 1)
    out[:, 10] = counts[:, _UPPER] / np.maximum(letters, 1)
    for at, kind in ((11, _DIGIT), (12, _PUNCTUATION), (13, _SYMBOL), (14, _WHITE)):
        out[:, at] = counts[:, kind] / chars
    out[:, 15] = letters / chars
    out[:, 16] = (counts[:, _PUNCTUATION] + counts[:, _SYMBOL]) / words
    out[:, 0] = np.log1p(sizes)
    out[:, 1] = np.log1p(out[:, 1])
    out[sizes == 0] = 0
    return out


@dataclass(frozen=True)
class Trees:
    """All trees one behind the other; a leaf has feature -1 and is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        node = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            below = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(below, self.low[node], self.high[node])
        return self.base + self.value[node].sum(1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> Trees:
    n, width = x.shape
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    feature, threshold, low, high, value, roots = [], [], [], [], [], []

    def node() -> int:
        for column, empty in ((feature, -1), (threshold, 0.0), (value, 0.0)):
            column.append(empty)
        low.append(len(low))
        high.append(len(high))
        return len(feature) - 1

    if n == 0 or y.min() == y.max():
        rounds = 0
    else:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
        offsets = np.arange(width) * BINS
        margin = np.full(n, base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = p - y, p * (1 - p)
        root = node()
        roots.append(root)
        at = np.full(n, root)
        level = [root]
        for depth in range(DEPTH + 1):
            # Histograms of all nodes of a level in one pass over the rows.
            first = level[0]
            here = at >= first
            place = ((at[here] - first) * width * BINS)[:, None] + offsets + binned[here]
            shape = (len(level), width, BINS)
            size = len(level) * width * BINS
            g, h = (
                np.bincount(place.ravel(), np.repeat(s[here], width), size).reshape(shape)
                for s in (slope, curve)
            )
            all_g, all_h = g[:, 0].sum(1), h[:, 0].sum(1)
            for i, number in enumerate(level):
                value[number] = float(-RATE * all_g[i] / (all_h[i] + L2))
            if depth == DEPTH:
                break
            left_g, left_h = g.cumsum(2), h.cumsum(2)
            right_g, right_h = all_g[:, None, None] - left_g, all_h[:, None, None] - left_h
            gain = left_g**2 / (left_h + L2) + right_g**2 / (right_h + L2)
            gain -= (all_g**2 / (all_h + L2))[:, None, None]
            gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
            best = gain.reshape(len(level), -1).argmax(1)
            split = {}
            for i, number in enumerate(level):
                f, b = divmod(int(best[i]), BINS)
                if gain[i, f, b] > 1e-6 and b < len(edges[f]):
                    feature[number], threshold[number] = f, float(edges[f][b])
                    split[number] = f, b
            children = []
            for number in split:
                low[number], high[number] = node(), node()
                children += [low[number], high[number]]
            if not children:
                break
            for number, (f, b) in split.items():
                mine = at == number
                at[mine] = np.where(binned[mine, f] <= b, low[number], high[number])
            level = children
        margin += np.array(value)[at]
    return Trees(
        np.array(roots, np.int64), np.array(feature, np.int64), np.array(threshold, np.float32),
        np.array(low, np.int64), np.array(high, np.int64), np.array(value), base,
    )


def _statistics_of(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in chunks(batches, chars=1 << 21, rows=2048):
            found = statistics(texts)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(texts) + 1) * len(FEATURES), pa.int32()), pa.array(found.ravel(), pa.float32())
            )
            yield pa.record_batch([pa.array(doc_ids, pa.int64()), lists], names=["doc_id", "statistics"])

    return pick(documents, "doc_id", "text").mapInArrow(run, "doc_id long, statistics array<float>")


def labelled_sample(labels: DataFrame, label: str, size: int) -> DataFrame:
    """(doc_id, label) of at most ``size`` documents that models may learn from."""
    return (
        pick(labels, "doc_id", label)
        .where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.min(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    )


def train(statistics: DataFrame, labels: DataFrame, label: str = "quality", size: int = SAMPLE) -> Trees:
    sample = labelled_sample(labels, label, size)
    rows = (
        # At most ``size`` ids of 8 bytes.
        statistics.join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.min("statistics").alias("statistics"))
        .select("label", "statistics").toArrow()
    )
    x = np.array(rows.column("statistics").to_pylist(), np.float32).reshape(-1, len(FEATURES))
    return fit(x, np.asarray(rows.column("label"), np.float64))


def score(documents: DataFrame, labels: DataFrame, accepted: float = ACCEPTED) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    found = stored(_statistics_of(documents))
    trees = train(found, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch.column("statistics").flatten(), np.float32)
            scores = trees.scores(flat.reshape(-1, len(FEATURES)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return found.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= accepted, 1).otherwise(0).alias("predicted"),
    )


def without_poor(
    documents: DataFrame, labels: DataFrame, accepted: float = ACCEPTED, label: str = "quality", size: int = SAMPLE
) -> DataFrame:
    """The rows of documents whose own text has an accepted score, as ``score`` gives it."""
    # At most ``size`` ids of 8 bytes.
    sample = F.broadcast(labelled_sample(labels, label, size).select("doc_id"))
    labelled = _statistics_of(pick(documents, "doc_id", "text").join(sample, "doc_id", "left_semi"))
    trees = train(labelled, labels, label, size)

    def scores(texts: list[str]) -> np.ndarray:
        return trees.scores(np.asarray(statistics(texts), np.float32))

    return where_score(documents, scores, lambda s: s >= accepted)
