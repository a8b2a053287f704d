"""Exact top-k search by an impact-ordered score-at-a-time index.

Components are integers, floor(256 x). A block of vectors is indexed by posting segments:
the postings (vector, dimension, value) whose impact, the value's size, falls into one
quantised level. A query adds up segments by descending impact. After a segment the rest
of a vector's score is bounded by what is left of the vector (Cauchy-Schwarz), so each
vector has a highest and a lowest possible score. A query stops early only when no more
than a small share of the block can still be among its best: those are scored anew,
exactly. Otherwise it goes on to the last segment.

Queries meet all vectors in blocks: each block of vectors with each block of queries, and
the best of a query are put together from its blocks.

Vectors that are null or hold null or non-finite components, and rows without an id, take
no part. A shorter vector counts as filled up with zeros. Rows that repeat an id are rows
of their own: each is a query if its id is one, and only the very row is left out of its
candidates. Ties go to the smaller id. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkweave.llm.common import pick, stored

SCALE = 256
LEVELS = 16
BLOCK = 16_384
QUERY_BLOCK = 8_192
#: Queries that are worked on at once: their scores of a block are in memory.
AT_ONCE = 256
#: A query may stop when this share of a block is still possible.
SHARE = 1 / 32

BEST = "query bigint, query_id bigint, uid bigint, vec_id bigint, score bigint"


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    usable = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return (
        pick(vectors, "vec_id", "embedding")
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(usable)
        .select(
            "vec_id",
            F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"),
        )
    )


class ImpactIndex:
    def __init__(self, vectors: np.ndarray, kind: type = np.float32) -> None:
        self.vectors, self.kind = vectors, kind
        size = np.abs(vectors)
        width = int(size.max(initial=0)) // LEVELS + 1
        level = size // width
        self.segments = []
        for at in range(LEVELS - 1, -1, -1):
            rows, dims = np.nonzero((level == at) & (size > 0))
            if len(rows):
                left = np.where(level < at, vectors, 0).astype(np.float64)
                # Rounded up: the bound must hold.
                bound = np.sqrt((left * left).sum(1)) * (1 + 1e-6)
                self.segments.append((rows, dims, vectors[rows, dims].astype(kind), bound))

    def possible(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query the vectors that can be among its k best, but its own (-1: none)."""
        n, m = len(self.vectors), len(queries)
        scores = np.zeros((m, n), self.kind)
        mine = np.flatnonzero(own >= 0)
        scores[mine, own[mine]] = -np.inf
        length = np.sqrt((queries.astype(np.float64) ** 2).sum(1)) * (1 + 1e-6)
        going = np.arange(m)
        found: list[np.ndarray] = [np.flatnonzero(np.arange(n) != o) for o in own.tolist()]
        if n <= k:
            return found
        weights = queries.astype(self.kind)
        for number, (rows, dims, values, bound) in enumerate(self.segments):
            plane = np.zeros(self.vectors.shape, self.kind)
            plane[rows, dims] = values
            scores[going] += weights[going] @ plane.T
            last = number == len(self.segments) - 1
            if not last and number < LEVELS // 2:
                continue
            rest = length[going, None] * bound[None, :]
            now = scores[going]
            # Whoever is below what the k best reach at least is out.
            least = np.partition(now - rest, n - k, axis=1)[:, n - k]
            can = (now + rest >= least[:, None]) & np.isfinite(now)
            done = np.full(len(going), True) if last else can.sum(1) <= max(4 * k, int(n * SHARE))
            for i in np.flatnonzero(done).tolist():
                found[going[i]] = np.flatnonzero(can[i])
            going = going[~done]
            if not len(going):
                break
        return found


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    sizes = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten(), np.int64)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    at = np.arange(dims)[None, :] < sizes[:, None]
    out[at] = flat
    return out


def best_in_block(table: pa.Table, k: int) -> pa.Table:
    """The k best of every query of one block against one block of vectors."""
    is_query = np.asarray(table.column("is_query"))
    dims = int(np.asarray(pc.list_value_length(table.column("v"))).max(initial=0))
    every = _matrix(table.column("v"), dims)
    uids, ids = np.asarray(table.column("uid")), np.asarray(table.column("vec_id"))
    vectors, queries = every[~is_query], every[is_query]
    vector_uids, vector_ids = uids[~is_query], ids[~is_query]
    order = np.lexsort((vector_uids, vector_ids))
    vectors, vector_uids, vector_ids = vectors[order], vector_uids[order], vector_ids[order]
    place = dict(zip(vector_uids.tolist(), range(len(order)), strict=True))
    # Sums must be exact in the kind of number that adds them up.
    top = int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(dims, 1)
    index = ImpactIndex(vectors, np.float32 if top < 1 << 24 else np.float64)
    columns: list[list[np.ndarray]] = [[], [], [], [], []]
    for start in range(0, len(queries), AT_ONCE):
        part = slice(start, start + AT_ONCE)
        own = np.array([place.get(u, -1) for u in uids[is_query][part].tolist()], np.int64)
        for i, at in enumerate(index.possible(queries[part], own, k), start):
            if top >= 1 << 53:
                exact = np.array([sum(a * b for a, b in zip(v, queries[i].tolist(), strict=True)) for v in vectors[at].tolist()], object)
            else:
                exact = vectors[at] @ queries[i]
            # Candidates stand in the order of their ids, and the sort is stable.
            best = np.argsort(-exact, kind="stable")[:k]
            n = len(best)
            for column, values in zip(columns, (
                np.full(n, uids[is_query][i]), np.full(n, ids[is_query][i]),
                vector_uids[at[best]], vector_ids[at[best]], exact[best].astype(np.int64),
            ), strict=True):
                column.append(values)
    names = ["query", "query_id", "uid", "vec_id", "score"]
    return pa.table({
        name: pa.array(np.concatenate(c) if c else [], pa.int64()) for name, c in zip(names, columns, strict=True)
    })


def top_k(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest inner products of every query."""
    rows = stored(scaled(vectors).withColumn("uid", F.monotonically_increasing_id()))
    queries = rows.where(is_query)
    blocks = max(1, -(-rows.count() // BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int, query: bool) -> DataFrame:
        return df.select(
            "uid", "vec_id", "v", F.lit(query).alias("is_query"),
            F.pmod(F.xxhash64("uid"), F.lit(n_own)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))).alias(other),
        )

    met = dealt(rows, "block", blocks, "query_block", query_blocks, False).unionByName(
        dealt(queries, "query_block", query_blocks, "block", blocks, True)
    )
    best = met.groupBy("block", "query_block").applyInArrow(lambda t: best_in_block(t, k), BEST)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "uid")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
