"""Winnowing fingerprints of whole texts.

Every run of ``GRAM`` code points has a rolling hash; of every ``WINDOW`` runs in a row
the smallest hash is chosen, the rightmost of equal ones, and kept with its position. So
any passage of ``GRAM + WINDOW - 1`` code points that two texts share gives both of them
a common chosen hash. A text with fewer runs than a window is one window; a text shorter
than a run has the hash of the whole text at position 0; an empty text has none.

Likeness is the Jaccard similarity of the sets of chosen hashes: 1 for two empty texts,
0 if only one is empty. Null texts count as empty. Rows are ordered by id, null ids
first, then by a hash of the text; rows equal in both stay side by side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import pick

#: Both are powers of two: hashes and minima of runs are put together by doubling.
GRAM = 32
WINDOW = 32
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xFF51AFD7ED558CCD)
LOWEST = -(1 << 63)
#: Ranges of rows per shuffle partition, so that hashing them evens out.
RANGES = 4

SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("n_chosen", pa.int64()),
])


def gram_hashes(text: str, gram: int = GRAM) -> np.ndarray:
    """32-bit hashes of all runs of ``gram`` code points; of the text if it is shorter."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    size, power = 1, BASE
    rolled = codes + np.uint64(1)
    while size < gram and len(rolled) > size:
        rolled = rolled[:-size] * np.uint64(power) + rolled[size:]
        power = power * power % (1 << 64)
        size *= 2
    if size < gram:
        # A short text: every code point counts, whatever the runs that were put together.
        power, whole = 1, 0
        for c in reversed(codes.tolist()):
            whole = (whole + (c + 1) * power) % (1 << 64)
            power = power * BASE % (1 << 64)
        rolled = np.array([whole], np.uint64)
    rolled ^= rolled >> np.uint64(32)
    rolled *= MIX
    return rolled >> np.uint64(32)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The chosen hashes and their positions, in text order."""
    if not text:
        none = np.array([], np.uint64)
        return none, none
    hashes = gram_hashes(text, gram)
    positions = np.arange(len(hashes), dtype=np.uint64)
    # The smaller position is the larger number, so of equal hashes the right one is chosen.
    last = np.uint64((1 << 32) - 1)
    low = (hashes << np.uint64(32)) | (last - positions)
    size = 1
    while size < window and len(low) > size:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < window:
        low = low.min(keepdims=True) if len(hashes) > 1 else low
    chosen = low[np.concatenate([[True], low[1:] != low[:-1]])]
    return chosen >> np.uint64(32), last - (chosen & last)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    return hashlib.sha256(hashes.astype("<u4").tobytes() + positions.astype("<u4").tobytes()).hexdigest()


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


class _Print:
    def __init__(self, text: str) -> None:
        self.text = text
        hashes, positions = winnow(text)
        self.name, self.set = digest(hashes, positions), np.unique(hashes)


def _key():
    return F.coalesce(F.col("doc_id"), F.lit(LOWEST)), F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _ranges(rows: DataFrame) -> list[tuple[int, int]]:
    """First keys of ranges of rows; as many as there are ranges, whatever the input."""
    n = RANGES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, second = _key()
    keys = rows.select(first.alias("a"), second.alias("b")).repartitionByRange(n, "a", "b")
    least = keys.groupBy(F.spark_partition_id()).agg(F.min(F.struct("a", "b")).alias("k"))
    return sorted((r.k.a, r.k.b) for r in least.collect())


def compare_with_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    Rows are dealt by ranges of their keys. A range also gets the first row of the next
    one (the last range: of the first), so every row finds its follower in its own task.
    """
    rows = pick(documents, "doc_id", "text")
    starts = _ranges(rows)
    if not starts:
        return rows.sparkSession.createDataFrame([], _DDL)
    n = len(starts)
    first, second = _key()

    @F.pandas_udf("array<int>")
    def places(a: pd.Series, b: pd.Series) -> pd.Series:
        """The row's range; for the first key of a range also the one before, as a follower."""
        bounds = np.array(starts, [("a", np.int64), ("b", np.int64)])
        keys = np.empty(len(a), bounds.dtype)
        keys["a"], keys["b"] = a, b
        at = np.searchsorted(bounds, keys, "right") - 1
        begins = bounds[at] == keys
        return pd.Series([[p, ~((p - 1) % n)] if s else [p] for p, s in zip(at.tolist(), begins.tolist(), strict=True)])

    dealt = (
        rows.withColumns({"a": first, "b": second})
        .withColumn("place", F.explode(places("a", "b")))
        .select(
            F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place")).alias("part"),
            (F.col("place") < 0).alias("follower"),
            "a", "b", "doc_id", "text",
        )
        .repartition("part")
        .sortWithinPartitions("part", "follower", "a", "b")
        .select("part", "follower", "doc_id", "text")
    )
    return dealt.mapInArrow(_pairs, _DDL)


_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, n_chosen long"
)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: tuple[int, int | None, _Print] | None = None
    out: list[tuple] = []
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            for row in batch.slice(start, 256).to_pylist():
                now = _Print(row["text"] or "")
                if waiting and waiting[0] == row["part"]:
                    out.append(_compared(waiting[1], waiting[2], now))
                # Of several rows equal to a range's first, one is the follower.
                waiting = None if row["follower"] else (row["part"], row["doc_id"], now)
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), SCHEMA, strict=True)], schema=SCHEMA)
                out = []


def _compared(doc_id: int | None, own: _Print, following: _Print) -> tuple:
    changed = edited(own.text, following.text)
    other = _Print(changed)
    return (
        doc_id, len(own.text), hashlib.sha256(changed.encode()).hexdigest(), own.name, other.name,
        likeness(own.set, other.set), likeness(own.set, following.set), len(own.set),
    )
