"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

A document's ids, with an end mark, are cut only if they exceed a sequence; all pieces of
such a document but the first are full sequences. All other pieces go to islands of about
``ISLAND`` pieces. An island evolves a few packings: crossover injects whole well-filled
bins of one parent into another, removes the bins whose pieces that uses up, and places
the displaced pieces by best fit, the longest first. After each epoch the best packing of
an island migrates to the next one, where its well-filled bins are injected as far as
pieces of these lengths are there. Pieces of one length are alike, so an island works on
counts of lengths; which piece stands where is settled by a join at the end. An island
stops when it needs no more bins than its tokens fill.

Null and empty texts are a document of the end mark alone. Rows are taken one by one, so
repeated rows and null ids are packed like any other; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linkweave.llm.bpe import byte_letters
from linkweave.llm.common import chunks, pick, stored

CAPACITY = 1024
END = 2
ISLAND = 4096
POPULATION = 6
GENERATIONS = 6
EPOCHS = 2
#: A bin is well filled from this share of the capacity on.
WELL_FILLED = 0.995
#: Distinct words whose ids a Python worker keeps; beyond it starts anew.
KEPT_WORDS = 500_000

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
    ("length", pa.int64()), ("ids_crc32", pa.int64()),
])


class ByteIds:
    """Ids of texts by a byte-level vocabulary file, 4 bytes an id, the lowest first.

    A space between two words belongs to the word behind it, and no token reaches over
    the place before such a space; so a text's ids are the ids of its words.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        code = {c: b for b, c in enumerate(byte_letters())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(code[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.encoding = tiktoken.Encoding(
            "byte level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.doubled = re.compile(r" \s|\s ")
        self.words: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def plain(self, text: str) -> bytes:
        if not text or text[0].isspace() or text[-1].isspace() or self.doubled.search(text):
            return self.whole(text)
        first, *words = text.split(" ")
        kept = self.words
        for word in words:
            if word not in kept:
                kept[word] = self.whole(" " + word)
        out = self.whole(first) + b"".join(map(kept.__getitem__, words))
        if len(kept) > KEPT_WORDS or len(out) > 1 << 22:
            kept.clear()
        return out

    def ids(self, text: str) -> bytes:
        if not any(name in text for name in self.special):
            return self.plain(text)
        return b"".join(
            array("I", [self.special[p]]).tobytes() if p in self.special else self.plain(p)
            for p in self.cut.split(text)
        )


@cache
def ids_of(path: str) -> ByteIds:
    return ByteIds(path)


def cut_into_pieces(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    end = array("I", [END]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ids_of(path or public_tokenizers.path("byte_bpe_50k.json"))
        for doc_ids, texts in chunks(batches, rows=1024):
            out = []
            for doc_id, text in zip(doc_ids, texts, strict=True):
                raw = coder.ids(text) + end
                total = len(raw) // 4
                at = 0
                for piece in range(-(-total // capacity)):
                    size = capacity if at or total % capacity == 0 else total % capacity
                    out.append((doc_id, piece, at, size, zlib.crc32(raw[4 * at:4 * (at + size)])))
                    at += size
            yield pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), PIECES, strict=True)],
                schema=PIECES,
            )

    return pick(documents, "doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


Bins = list[list[int]]


def best_fit(bins: Bins, items: list[int], capacity: int) -> Bins:
    """Put each item, in the given order, into the bin that it leaves least room in."""
    room: dict[int, list[int]] = {}
    mask = 0
    for i, b in enumerate(bins):
        free = capacity - sum(b)
        room.setdefault(free, []).append(i)
        mask |= 1 << free
    for item in items:
        fitting = mask >> item
        if fitting:
            free = item + (fitting & -fitting).bit_length() - 1
            at = room[free].pop()
            if not room[free]:
                mask ^= 1 << free
            bins[at].append(item)
        else:
            free, at = capacity, len(bins)
            bins.append([item])
        free -= item
        room.setdefault(free, []).append(at)
        mask |= 1 << free
    return bins


def worth(bins: Bins) -> tuple[int, int]:
    """Fewer bins are better; then those with their room in as few bins as can be."""
    return -len(bins), sum(sum(b) ** 2 for b in bins)


def crossover(
    donor: Bins, other: Bins, counts: np.ndarray, capacity: int, rng: np.random.Generator
) -> Bins:
    """Well-filled bins of one packing, the bins of the other that still can be, the rest best fit."""
    left = counts.tolist()

    def take(b: list[int]) -> bool:
        for k, item in enumerate(b):
            if not left[item]:
                for back in b[:k]:
                    left[back] += 1
                return False
            left[item] -= 1
        return True

    full = [b for b in donor if sum(b) >= WELL_FILLED * capacity]
    chosen = rng.random(len(full)) < 0.5
    child = [list(b) for b, c in zip(full, chosen.tolist(), strict=True) if c and take(b)]
    # Poorly filled bins are opened, all the more the emptier they are.
    opened = rng.random(len(other)) < [2 * (1 - sum(b) / capacity) + 0.01 for b in other]
    child += [list(b) for b, o in zip(other, opened.tolist(), strict=True) if not o and take(b)]
    rest = [item for item in range(len(left) - 1, 0, -1) for _ in range(left[item])]
    return best_fit(child, rest, capacity)


def evolve(
    counts: np.ndarray, population: list[Bins], migrants: list[Bins], seed: int,
    capacity: int = CAPACITY, generations: int = GENERATIONS,
) -> list[Bins]:
    """The population, the best packing first, after some generations."""
    rng = np.random.default_rng(seed)
    items = [item for item in range(len(counts) - 1, 0, -1) for _ in range(counts[item])]
    least = -(-sum(items) // capacity)
    if not population:
        population = [best_fit([], items, capacity)]
    if len(population[0]) > least:
        while len(population) < POPULATION:
            mixed = rng.permutation(items).tolist()
            population.append(best_fit([], mixed, capacity))
        population += [crossover(m, population[0], counts, capacity, rng) for m in migrants]
    population.sort(key=worth, reverse=True)
    for _ in range(generations):
        if len(population[0]) <= least:
            break
        pairs = rng.integers(0, len(population), (POPULATION, 2)).tolist()
        population += [
            crossover(population[i], population[min(i, j)], counts, capacity, rng) for i, j in pairs
        ]
        population.sort(key=worth, reverse=True)
        del population[POPULATION:]
    return population


def _pack(population: list[Bins]) -> bytes:
    """Lengths, a 0 behind each bin and another behind each packing."""
    return array("H", [x for bins in population for b in [*bins, []] for x in [*b, 0]]).tobytes()


def _unpack(raw: bytes | None) -> list[Bins]:
    out: list[Bins] = [[]]
    bin_: list[int] = []
    for x in array("H", raw or b""):
        if x:
            bin_.append(x)
        elif bin_:
            out[-1].append(bin_)
            bin_ = []
        else:
            out.append([])
    return out[:-1]


def _epoch(number: int, capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                counts = np.zeros(capacity + 1, np.int64)
                for x in row.lengths:
                    counts[x["length"]] = x["n"]
                population = evolve(
                    counts, _unpack(row.population), _unpack(row.migrants), row.island * EPOCHS + number, capacity
                )
                out.append((row.island, row.lengths, _pack(population), _pack(population[:1])))
            yield pd.DataFrame(out, columns=["island", "lengths", "population", "elite"])

    return run


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Where the k-th piece of each length stands in the island's best packing."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            seen: dict[int, int] = {}
            out = []
            for number, b in enumerate(_unpack(row.elite)[0]):
                offset = 0
                for length in b:
                    seen[length] = seen.get(length, 0) + 1
                    out.append((row.island, length, seen[length], number, offset))
                    offset += length
            yield pd.DataFrame(out, columns=["island", "length", "k", "bin", "offset"])


def pack(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place there."""
    pieces = stored(
        cut_into_pieces(documents, path, capacity).withColumn("uid", F.monotonically_increasing_id())
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = pieces.where(F.col("length") == capacity).select(
        *columns, (F.col("uid") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    short = pieces.where(F.col("length") < capacity)
    islands = max(1, -(-short.count() // ISLAND))
    dealt = short.withColumn("island", F.pmod(F.xxhash64("uid"), F.lit(islands)))
    lengths = dealt.groupBy("island", "length").agg(F.count("*").alias("n"))
    state = (
        lengths.groupBy("island")
        .agg(F.collect_list(F.struct("length", "n")).alias("lengths"))
        .withColumns({"population": F.lit(None).cast("binary"), "migrants": F.lit(None).cast("binary")})
    )
    schema = T.StructType(
        [f for f in state.schema if f.name in ("island", "lengths")]
        + [T.StructField("population", T.BinaryType()), T.StructField("elite", T.BinaryType())]
    )
    # Islands are few bytes and much work: adaptive execution would put them into one task.
    tasks = max(min(islands, documents.sparkSession.sparkContext.defaultParallelism), islands // 16)
    for number in range(EPOCHS):
        state = stored(
            state.select("island", "lengths", "population", "migrants")
            .repartition(tasks, "island")
            .mapInPandas(_epoch(number, capacity), schema)
        )
        after = state
        arrived = after.select(
            F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("elite").alias("migrants")
        )
        state = after.drop("elite").join(arrived, "island", "left")
    places = after.select("island", "elite").mapInPandas(
        _places, "island long, length long, k int, bin long, offset long"
    )
    order = Window.partitionBy("island", "length").orderBy("uid")
    packed = (
        dealt.withColumn("k", F.row_number().over(order))
        .join(places, ["island", "length", "k"])
        .select(
            *columns,
            ((F.col("island") * (ISLAND * 4) + F.col("bin")) * 2).alias("sequence_id"),
            "offset",
        )
    )
    return full.unionByName(packed)
