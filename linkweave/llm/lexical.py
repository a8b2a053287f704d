"""Ranked lexical search by Block-Max MaxScore over an index in shards.

A shard is a run of neighbouring documents, indexed inside the task that reads them: each
term has a list of postings (document, occurrences) in blocks of ``POSTINGS``, compressed to
bytes, and each block notes its last document and what bounds its highest impact. No posting
is shuffled. Numbers of all documents (how many, how many terms, how many hold a term) are
put together from the shards.

A task goes through its shards with a heap of the best documents of each query. Bounds of whole
lists split the lists of a query: those without which a document can still reach the heap are
essential; only their documents are candidates. The other lists are looked at by falling bound. For each
candidate the highest impact of the block where it would stand decides whether it can still
reach the heap; if not it goes before the block is decompressed. The heaps of all tasks are
merged. A document that ties with a heap's last stays until the end, so the result is exact.

Terms are runs of ASCII letters and digits and all characters beyond ASCII, only A-Z lower-cased.
Scores are whole numbers; see ``impact`` and ``weight``. Null and empty texts hold no terms
and take no part; texts of any length are indexed whole. Rows that repeat an id or a text are
documents of their own. Equal scores are ranked by ascending doc_id, null first. Queries are
rows too: of those that repeat an id each has its own ranks; a query without terms, or one
whose terms no document holds, has no result. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkweave.llm.common import pick, stored

POSTINGS = 128
#: A shard ends after so many documents, or so many bytes of text.
SHARD_DOCS = 4096
SHARD_BYTES = 1 << 23
#: Bytes of a text that are cut into words at once.
PIECE = 1 << 22
#: The index keeps the queries' terms alone while these have so many bytes at most; else all.
KEPT_TERMS = 1 << 24
#: Queries that meet the index together: so many, with so many terms.
QUERIES_AT_ONCE = 4096
TERMS_AT_ONCE = 1 << 18

#: Bytes outside of terms become blanks, A-Z lower case; all bytes beyond ASCII are parts of terms.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)

_SHARDS = (
    "ids array<long>, nameless binary, lengths array<long>, terms array<binary>, dfs array<int>, "
    "last array<int>, most array<long>, ratio array<double>, starts array<long>, widths binary, payload binary"
)


def terms_of(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, some of its bytes at a time."""
    plain, at = raw.translate(_TABLE), 0
    while len(plain) - at > PIECE:
        cut = plain.rfind(b" ", at + 1, at + PIECE)
        cut = cut if cut >= 0 else plain.find(b" ", at + PIECE)
        cut = cut if cut >= 0 else len(plain)
        yield plain[at:cut].split()
        at = cut
    yield plain[at:].split()


def impact(tf, m):
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _width(most: np.ndarray) -> np.ndarray:
    """Bytes that each block's numbers take."""
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


def _put(payload: np.ndarray, at: np.ndarray, values: np.ndarray, widths: np.ndarray) -> None:
    for byte in range(4):
        here = widths > byte
        payload[at[here] + byte] = (values[here] >> (8 * byte)) & 255


def shard_row(ids: list, texts: list[bytes], kept: pa.Array | None) -> dict | None:
    """The index of some documents; None if they hold no terms."""
    lengths, words = [], []
    for raw in texts:
        n = 0
        for part in terms_of(raw):
            if part:
                words.append(pa.array(part, pa.binary()))
                n += len(part)
        lengths.append(n)
    n = np.array(lengths, np.int64)
    holds = np.flatnonzero(n)
    if not len(holds):
        return None
    n, ids = n[holds], [ids[i] for i in holds.tolist()]
    every = pa.chunked_array(words)
    if kept is None:
        every = every.dictionary_encode().combine_chunks()
        every = every if isinstance(every, pa.DictionaryArray) else every.chunk(0)
        names, codes = every.dictionary, np.asarray(every.indices, np.int64)
    else:
        names, codes = kept, np.asarray(pc.fill_null(pc.index_in(every, kept), -1), np.int64)
    docs = np.repeat(np.arange(len(n)), n)
    met = codes >= 0
    pairs, tf = np.unique(codes[met] * len(n) + docs[met], return_counts=True)
    code, doc = pairs // len(n), pairs % len(n)
    first = np.flatnonzero(np.diff(code, prepend=-1))
    size = np.diff(first, append=len(code))
    inside = np.arange(len(code)) - np.repeat(first, size)
    begins = np.flatnonzero(inside % POSTINGS == 0)
    count = np.diff(begins, append=len(code))
    block = np.repeat(np.arange(len(begins)), count)
    # The gap before a list's first posting counts from document 0.
    gaps = np.where(inside == 0, doc, np.diff(doc, prepend=0))
    some = bool(len(begins))
    most = np.maximum.reduceat(tf, begins) if some else tf
    gap_width = _width(np.maximum.reduceat(gaps, begins)) if some else gaps
    tf_width = _width(most)
    starts = np.concatenate([[0], np.cumsum(count * (gap_width + tf_width))]).astype(np.int64)
    payload = np.zeros(starts[-1], np.uint8)
    place = np.arange(len(code)) - begins[block] if some else gaps
    _put(payload, starts[block] + place * gap_width[block], gaps, gap_width[block])
    _put(payload, starts[block] + (count * gap_width)[block] + place * tf_width[block], tf, tf_width[block])
    return {
        "ids": [0 if i is None else i for i in ids],
        "nameless": bytes(i is None for i in ids),
        "lengths": n, "terms": names.take(pa.array(code[first])), "dfs": size.astype(np.int32),
        "last": doc[begins + count - 1].astype(np.int32) if some else doc.astype(np.int32),
        "most": most.astype(np.int64),
        "ratio": np.minimum.reduceat(n[doc] / tf, begins) if some else np.zeros(0),
        "starts": starts, "widths": gap_width.astype(np.uint8).tobytes(), "payload": payload.tobytes(),
    }


def _shards(batches: Iterable[pa.RecordBatch], kept: pa.Array | None) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("ids", pa.list_(pa.int64())), ("nameless", pa.binary()), ("lengths", pa.list_(pa.int64())),
        ("terms", pa.list_(pa.binary())), ("dfs", pa.list_(pa.int32())), ("last", pa.list_(pa.int32())),
        ("most", pa.list_(pa.int64())), ("ratio", pa.list_(pa.float64())), ("starts", pa.list_(pa.int64())),
        ("widths", pa.binary()), ("payload", pa.binary()),
    ])

    def made() -> Iterator[pa.RecordBatch]:
        row = shard_row(ids, texts, kept)
        if row:
            yield pa.record_batch([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

    ids: list = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        names, values = batch.column("doc_id").to_pylist(), batch.column("raw")
        for i, name in enumerate(names):
            raw = values[i].as_py()
            if not raw:
                continue
            ids.append(name)
            texts.append(raw)
            size += len(raw)
            if size >= SHARD_BYTES or len(ids) >= SHARD_DOCS:
                yield from made()
                ids, texts, size = [], [], 0
    if ids:
        yield from made()


class Shard:
    """One shard as a query reads it. ``n_documents`` and ``n_terms`` are those of the corpus."""

    def __init__(self, row: dict, n_documents: int, n_terms: int) -> None:
        self.ids, self.starts, self.payload = row["ids"], row["starts"], row["payload"]
        self.nameless = np.frombuffer(row["nameless"], np.uint8)
        self.last, self.most = row["last"], row["most"]
        self.m = 50 + 50 * row["lengths"] * n_documents // n_terms
        self.gap_width = np.frombuffer(row["widths"], np.uint8).astype(np.int64)
        self.tf_width = _width(self.most)
        blocks = -(-row["dfs"].astype(np.int64) // POSTINGS)
        ends = np.cumsum(blocks)
        begins = ends - blocks
        # m / tf > 49 / tf + 50 n (N / L) / tf, and the impact falls as m / tf rises.
        least = 49 / np.maximum(self.most, 1) + 50 * (n_documents / n_terms) * row["ratio"] * (1 - 1e-9)
        self.high = np.floor(1e9 / (1000 + 20 * least)).astype(np.int64) + 1
        highest = np.maximum.reduceat(self.high, begins) if len(begins) else self.high
        self.lists = {
            t: at for t, at in zip(row["terms"], zip(begins.tolist(), ends.tolist(), highest.tolist(), strict=True), strict=True)
        }
        self.count = np.zeros(len(self.last), np.int64)
        self.count[:] = POSTINGS
        if len(ends):
            self.count[ends - 1] = row["dfs"] - (blocks - 1) * POSTINGS
        self.before = np.zeros(len(self.last), np.int64)
        self.before[1:] = self.last[:-1]
        self.before[begins] = 0
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block, decompressed when first asked for."""
        if b not in self.blocks:
            n, at = int(self.count[b]), int(self.starts[b])
            gap, tf = int(self.gap_width[b]), int(self.tf_width[b])
            docs = np.frombuffer(self.payload, f"<u{gap}", n, at).astype(np.int64).cumsum() + self.before[b]
            times = np.frombuffer(self.payload, f"<u{tf}", n, at + n * gap).astype(np.int64)
            self.blocks[b] = docs, impact(times, self.m[docs])
        return self.blocks[b]

    def postings(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        if begin not in self.whole:
            parts = [self.block(b) for b in range(begin, end)]
            self.whole[begin] = tuple(map(np.concatenate, zip(*parts, strict=True)))
        return self.whole[begin]

    def search(self, query: list[tuple[bytes, int]], k: int, needed: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of all that reach ``needed`` and may be among the k best."""
        found = [(w * at[2], w, at) for t, w in query if w > 0 and (at := self.lists.get(t))]
        found.sort(key=lambda x: x[0])
        reach = np.cumsum([b for b, _, _ in found]).tolist()
        scores = np.zeros(len(self.ids), np.int64)
        at = len(found) - 1
        while at >= 0 and reach[at] >= needed:
            _, w, (begin, end, _) = found[at]
            docs, impacts = self.postings(begin, end)
            scores[docs] += w * impacts
            at -= 1
            if at >= 0 and len(scores) > k:
                # k documents have so much already.
                needed = max(needed, int(np.partition(scores, -k)[-k]))
        near = np.flatnonzero((scores > 0) & (scores + (reach[at] if at >= 0 else 0) >= needed))
        own = scores[near]
        while at >= 0 and len(near):
            _, w, (begin, end, _) = found[at]
            block = begin + np.searchsorted(self.last[begin:end], near)
            there = block < end
            high = np.where(there, w * self.high[np.minimum(block, end - 1)], 0)
            keep = own + high + (reach[at - 1] if at else 0) >= needed
            near, own, block, there = near[keep], own[keep], block[keep], there[keep]
            for b in np.unique(block[there]).tolist():
                docs, impacts = self.block(b)
                mine = np.flatnonzero(block == b)
                spot = np.minimum(np.searchsorted(docs, near[mine]), len(docs) - 1)
                hit = docs[spot] == near[mine]
                own[mine[hit]] += w * impacts[spot[hit]]
            at -= 1
        keep = own >= needed
        return near[keep], own[keep]


class Heap:
    """The best documents of a query so far, of all shards that a task has gone through."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = self.ids = np.zeros(0, np.int64)
        self.nameless = np.zeros(0, np.uint8)

    @property
    def needed(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def take(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        nameless = np.concatenate([self.nameless, nameless])
        best = np.lexsort((ids, 1 - nameless, -scores))[:self.k]
        self.scores, self.ids, self.nameless = scores[best], ids[best], nameless[best]


def rows_in(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        row = {}
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            plain = name == "terms" or pa.types.is_binary(column.type)
            row[name] = column[i].as_py() if plain else np.asarray(column[i].values)
        yield row


@dataclass(frozen=True)
class Index:
    shards: DataFrame
    documents: int
    terms: int

    def frequencies(self) -> DataFrame:
        """term, df: in how many documents each indexed term stands."""
        return (
            self.shards.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x"))
            .groupBy(F.col("x.terms").alias("term"))
            .agg(F.sum("x.dfs").alias("df"))
        )


def build(documents: DataFrame, kept: list[bytes] | None = None) -> Index:
    """Index of all documents; of the given terms alone, if any are given.

    The numbers of documents and terms count everything in either case.
    """
    names = None if kept is None else pa.array(sorted(kept), pa.binary())
    raw = pick(documents, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw")
    )
    shards = stored(raw.mapInArrow(lambda batches: _shards(batches, names), _SHARDS))
    total = shards.agg(
        F.sum(F.size("lengths").cast("long")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))
    ).first()
    return Index(shards, total[0] or 0, total[1] or 0)


def _terms(raw: bytes | None) -> list[bytes]:
    return list(dict.fromkeys(t for part in terms_of(raw or b"") for t in part))


def query_terms(queries: DataFrame) -> list[bytes] | None:
    """The distinct terms of all queries; None if they are too many to be held at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("raw"):
                yield pa.record_batch([pa.array(_terms(raw.as_py()), pa.binary())], names=["term"])

    raw = pick(queries, "text").select(F.col("text").cast("binary").alias("raw"))
    terms = stored(raw.mapInArrow(run, "term binary").distinct())
    size = terms.agg(F.sum(F.octet_length("term") + 64)).first()[0]
    if (size or 0) > KEPT_TERMS:
        return None
    return [bytes(r.term) for r in terms.collect()]


def _blocks_of(queries: DataFrame) -> Iterator[list[tuple]]:
    """(number, item_id, terms) of some queries at a time."""
    block: list[tuple] = []
    terms = 0
    rows = pick(queries, "item_id", "text").select("item_id", F.col("text").cast("binary").alias("raw"))
    for number, row in enumerate(rows.toLocalIterator()):
        block.append((number, row.item_id, _terms(None if row.raw is None else bytes(row.raw))))
        terms += len(block[-1][2])
        if len(block) >= QUERIES_AT_ONCE or terms >= TERMS_AT_ONCE:
            yield block
            block, terms = [], 0
    if block:
        yield block


def _heaps(index: Index, block: list[tuple], k: int) -> DataFrame:
    """The best documents of the queries, of each task."""
    spark = index.shards.sparkSession
    asked = spark.createDataFrame([(bytearray(t),) for t in {t for q in block for t in q[2]}], "term binary")
    df = {bytes(r.term): r.df for r in index.frequencies().join(asked, "term", "left_semi").collect()}
    queries = [
        (number, item, [(t, weight(index.documents, df[t])) for t in terms if t in df]) for number, item, terms in block
    ]
    n_documents, n_terms = index.documents, index.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = [Heap(k) for _ in queries]
        for batch in batches:
            for row in rows_in(batch):
                shard = Shard(row, n_documents, n_terms)
                for (_, _, query), heap in zip(queries, heaps, strict=True):
                    docs, scores = shard.search(query, k, heap.needed)
                    if len(docs):
                        heap.take(scores, shard.ids[docs], shard.nameless[docs])
        for (number, item, _), heap in zip(queries, heaps, strict=True):
            n = len(heap.scores)
            yield pa.record_batch(
                [
                    pa.array([number] * n, pa.int64()), pa.array([item] * n, pa.int64()),
                    pa.array(heap.ids, pa.int64(), mask=heap.nameless == 1), pa.array(heap.scores, pa.int64()),
                ],
                names=["number", "item_id", "doc_id", "score"],
            )

    return index.shards.mapInArrow(run, "number long, item_id long, doc_id long, score long")


def search(index: Index, queries: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of every query."""
    found = [stored(_heaps(index, block, k)) for block in _blocks_of(queries)] if index.documents else []
    if not found:
        return index.shards.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def rank(documents: DataFrame, queries: DataFrame, k: int = 50) -> DataFrame:
    """Index all documents by the queries' terms, then search."""
    return search(build(documents, query_terms(queries)), queries, k)
