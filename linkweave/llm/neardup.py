"""Near duplicates by Order MinHash, verified by banded alignment.

A text is the sequence of its lower-case words; a shingle is five words in a row (a text
with fewer words is one shingle), labelled with its occurrence. Each sketch takes the
``KEPT`` smallest of a text's shingles under its own hash and retains their order in the
text: it is the shingles, as one number, and their order beside it. Texts with a sketch
alike in shingles and order are candidates in order; texts with sketches alike in shingles
only are candidates with a moved passage.

The similarity of two texts is that of their labelled shingles: with c in common of n and
m, c / (n + m - c). At ``SIMILARITY`` or more they are linked. Candidates in order are verified
by banded alignment of their sequences of shingles. An alignment never has more in common
than the count, so what it accepts is a link. What it rejects, and candidates with a moved
passage, go by the count. Classes are the connected parts.

A bucket of equal sketches is not written out in pairs. First each text is checked against
the bucket's hub, the text that meets most others over all its buckets: of edited copies the
one they were made from. Then only texts of one bucket that are still in different classes
are checked against each other. Links inside a class would not change it, so classes are
those of all links between candidates. Two texts at known distances from their hub need no
check if these differ too much: the distance n + m - 2c obeys the triangle inequality, and
similar texts have one of (n + m) / 9 at most. So a bucket is cut by bands of size and, within
these, of distance to the hub, which are keys of the join: a text meets only those of its own
and the neighbouring bands. Nor need two texts be checked whose shingles, counted in ``BINS``
bins, have too few in common. All these rules are exact. Texts with equal words are one text
throughout. Texts of any length are read whole; ties between equal shingles of a sketch are
settled by their place in the text.

Rows with null text or null id are in no class (class_id null). Texts without words are
copies of each other only if equal. Repeated rows fall into one class. An empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import chunks, pick, stored
from linkweave.operators.lookup import lookup_join

SHINGLE = 5
SKETCHES = 16
KEPT = 3
SIMILARITY = 0.8
#: Room for the order of a sketch's shingles: KEPT digits of base KEPT.
ORDER_BITS = (KEPT**KEPT - 1).bit_length()
#: Sketch values that are in memory at once, so that long texts need no more.
AT_ONCE = 1 << 16
KEPT_WORDS = 500_000
#: Bins in which a text's shingles are counted; a power of two.
BINS = 256

WORD = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


@cache
def _seeds(n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * BASE)


class _Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: str) -> int:
        value = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        if len(self) > KEPT_WORDS:
            self.clear()
        self[word] = value
        return value


_words = _Words()


def words_of(text: str) -> tuple[np.ndarray, str]:
    """Hashes of the text's words in order, and a name that texts with equal words share."""
    words = WORD.findall(text.lower())
    if not words:
        return np.array([], np.uint64), hashlib.blake2b(b"\0" + text.encode(), digest_size=16).hexdigest()
    known = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    return known, hashlib.blake2b(known.tobytes(), digest_size=16).hexdigest()


def shingles(known: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of a sequence of word hashes, in order."""
    size = min(SHINGLE, len(known))
    n = len(known) - size + 1 if size else 0
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * BASE + known[i:i + n]
    return _mixed(out + np.uint64(size))


def labelled(found: np.ndarray) -> np.ndarray:
    """The shingles, in order, with the k-th occurrence of one as a shingle of its own."""
    n = len(found)
    values, inverse = np.unique(found, return_inverse=True)
    if len(values) == n:
        return found
    order = np.argsort(inverse, kind="stable")
    counts = np.bincount(inverse)
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
    nth = np.empty(n, np.uint64)
    nth[order] = np.arange(n) - np.repeat(begins, counts)
    return found + nth * BASE


def sketches(found: np.ndarray, count: int = SKETCHES, kept: int = KEPT, ordered: bool = True) -> list[int]:
    """One number per sketch: its shingles, and in the last ``ORDER_BITS`` bits their order in the text.

    Without ``ordered`` those bits are left out, so sketches of the same shingles are equal.
    """
    n = len(found)
    if not n:
        return []
    labels = labelled(found)
    seeds = _seeds(count)
    out = []
    step = max(1, AT_ONCE // n)
    for at in range(0, count, step):
        part = seeds[at:at + step]
        keys = _mixed(labels[None, :] ^ part[:, None])
        small = np.argpartition(keys, kept - 1, axis=1)[:, :kept] if n > kept else np.tile(np.arange(n), (len(part), 1))
        small.sort(axis=1)
        chosen = found[small]
        # Equal shingles rank by their place, so the order of a sketch is one of KEPT! orders.
        ranks = np.argsort(np.argsort(chosen, axis=1, kind="stable"), axis=1, kind="stable")
        order = np.zeros(len(part), np.uint64)
        for column in ranks.T:
            order = order * np.uint64(kept) + column.astype(np.uint64)
        chosen.sort(axis=1)
        bucket = part.copy()
        for column in chosen.T:
            bucket = _mixed(bucket * BASE + column)
        bucket >>= np.uint64(ORDER_BITS)
        if ordered:
            bucket = (bucket << np.uint64(ORDER_BITS)) | order
        out += bucket.view(np.int64).tolist()
    return out


def common_length(a: list[int], b: list[int], need: int) -> int:
    """Longest common subsequence, exact if it is ``need`` or more, else possibly less.

    Alignments of that length leave at most n - need of a's and m - need of b's places
    out, so matches further from the diagonal are not looked at. Bits of whole numbers are
    the places of a.
    """
    n, m = len(a), len(b)
    above, below = n - need, m - need
    if above < 0 or below < 0:
        return 0
    begin = 0
    while begin < min(n, m) and a[begin] == b[begin]:
        begin += 1
    end = 0
    while end < min(n, m) - begin and a[n - 1 - end] == b[m - 1 - end]:
        end += 1
    a, b = a[begin:n - end], b[begin:m - end]
    if not a or not b:
        return begin + end
    places: dict[int, int] = {}
    for i, value in enumerate(a):
        places[value] = places.get(value, 0) | (1 << i)
    full = (1 << len(a)) - 1
    band = (1 << (above + below + 1)) - 1
    row = full
    for j, value in enumerate(b):
        matches = places.get(value)
        if not matches:
            continue
        low = j - below
        matches &= band << low if low >= 0 else band >> -low
        hit = row & matches
        row = ((row + hit) | (row - hit)) & full
    return begin + end + len(a) - row.bit_count()


def needed(n: int, m: int, least: float = SIMILARITY) -> int:
    """What sequences of n and m must have in common to be similar."""
    # c / (n + m - c) >= s; the small term keeps exact fractions in.
    return int(np.ceil(least * (n + m) / (1 + least) - 1e-9))


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether two sequences, aligned, have the similarity."""
    need = needed(len(a), len(b), least)
    if min(len(a), len(b)) < need:
        return False
    return common_length(a.tolist(), b.tolist(), need) >= need


def verdict(a: np.ndarray, b: np.ndarray, in_order: bool, least: float = SIMILARITY) -> tuple[int, bool, bool]:
    """Of two sequences of labelled shingles: n + m - 2c, whether linked, whether by alignment."""
    common, need = common_labels(a, b), needed(len(a), len(b), least)
    far = len(a) + len(b) - 2 * common
    # What too few have in common in any order needs no alignment.
    if common < need:
        return far, False, False
    return far, True, in_order and similar(a, b, least)


def common_labels(a: np.ndarray, b: np.ndarray) -> int:
    """Labelled shingles in common, in whatever order; each stands once in its text."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _sketched(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = batch.column("text_md5").to_pylist()
            at = 0
            for doc_ids, texts in chunks([batch], chars=1 << 22):
                names, sizes, buckets = [], [], []
                for text in texts:
                    known, name = words_of(text)
                    found = shingles(known)
                    names.append(name)
                    sizes.append(len(found))
                    buckets.append(sketches(found))
                yield pa.record_batch(
                    [
                        pa.array(doc_ids, pa.int64()), pa.array(sums[at:at + len(texts)], pa.string()), pa.array(names),
                        pa.array(sizes, pa.int64()), pa.array(buckets, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_md5", "name", "size", "buckets"],
                )
                at += len(texts)

    return documents.mapInArrow(
        run, "doc_id long, text_md5 string, name string, size long, buckets array<long>"
    )


def _sequences(texts: DataFrame) -> DataFrame:
    """(uid, sequence, bins): the labelled shingles of texts in order, eight bytes each, and counted in bins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                uids, raws, bins = [], [], []
                for row in batch.slice(start, 256).to_pylist():
                    known, name = words_of(row["text"])
                    # Another text may have the same id.
                    if name == row["name"]:
                        uids.append(row["uid"])
                        found = labelled(shingles(known))
                        raws.append(found.astype("<u8").tobytes())
                        bins.append(np.bincount(found & np.uint64(BINS - 1), minlength=BINS).tolist())
                yield pa.record_batch(
                    [pa.array(uids, pa.int64()), pa.array(raws, pa.binary()), pa.array(bins, pa.list_(pa.int32()))],
                    names=["uid", "sequence", "bins"],
                )

    return texts.mapInArrow(run, "uid long, sequence binary, bins array<int>").dropDuplicates(["uid"])


def _with_sequences(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    left = sequences.select(F.col("uid").alias("a"), F.col("sequence").alias("left"))
    right = sequences.select(F.col("uid").alias("b"), F.col("sequence").alias("right"))
    return lookup_join(lookup_join(pairs, left, ["a"]), right, ["b"]).select("a", "b", "in_order", "left", "right")


def _verified(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """(a, b, far, linked, aligned) of every pair: its distance n + m - 2c, whether it is similar, and in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [
                    verdict(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), in_order)
                    for x, y, in_order in zip(*(part.column(c).to_pylist() for c in ("left", "right", "in_order")), strict=True)
                ]
                far, linked, aligned = map(list, zip(*found, strict=True))
                yield pa.record_batch(
                    [
                        part.column("a"), part.column("b"), pa.array(far, pa.int64()),
                        pa.array(linked, pa.bool_()), pa.array(aligned, pa.bool_()),
                    ],
                    names=["a", "b", "far", "linked", "aligned"],
                )

    return _with_sequences(pairs, sequences).mapInArrow(
        run, "a long, b long, far long, linked boolean, aligned boolean"
    )


#: Buckets of no more members meet whole; it costs more to cut them.
WHOLE = 64


def _in_bands(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of buckets twice, with a ``lane`` and a ``place`` at which similar texts meet.

    A lane is a band of sizes, each 1 / SIMILARITY times the one before. Similar texts lie in
    one band or in neighbouring ones, so the left rows stand in the lane of their band, the
    right ones in that and the one below. A lane's places are as wide as the distances of
    similar texts to their hub can differ there: left rows stand where their distance may
    lie, between ``low`` and ``up``, right ones one place further to either side. Buckets of
    ``WHOLE`` members at most are one lane and place.
    """
    step = 1 / SIMILARITY
    rows = rows.withColumn("band", F.floor(F.log("size") / float(np.log(step)) + 1e-9).cast("int"))
    # Sizes of a pair are below the upper ends of the lane and of the one above it.
    most = (1 - SIMILARITY) / (1 + SIMILARITY) * (step + step * step)
    width = F.pow(F.lit(step), F.col("lane")) * most * (1 + 1e-6)
    cut = F.col("members") > WHOLE

    def placed(lanes, beside):
        first, last = F.floor(F.col("low") / width) - beside, F.floor(F.col("up") / width) + beside
        places = F.when(cut, F.sequence(first, last)).otherwise(F.array(F.lit(0).cast("long")))
        in_lanes = F.when(cut, lanes).otherwise(F.array(F.lit(0)))
        return rows.withColumn("lane", F.explode(in_lanes)).withColumn("place", F.explode(places))

    return placed(F.array("band"), 0), placed(F.array(F.col("band"), F.col("band") - 1), 1)


def components(links: DataFrame) -> DataFrame:
    """(node, part): the smallest node of the connected part, for every node with a link.

    Each round every node takes the smallest part of its neighbours, and then the part of
    the node that its own part names.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    parts = stored(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("part")))
    while True:
        beside = lookup_join(both, parts.withColumnRenamed("node", "a"), ["a"])
        least = beside.groupBy(F.col("b").alias("node")).agg(F.min("part").alias("near"))
        step = parts.join(least, "node").select("node", "part", F.least("part", "near").alias("to"))
        named = parts.select(F.col("node").alias("to"), F.col("part").alias("beyond"))
        after = stored(
            lookup_join(step, named, ["to"]).select("node", "part", F.least("to", "beyond").alias("to"))
        )
        settled = after.where(F.col("to") < F.col("part")).isEmpty()
        parts = after.select("node", F.col("to").alias("part"))
        if settled:
            return parts


def _with_parts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``part`` of every uid: itself where it has no link."""
    return lookup_join(rows, parts.withColumnRenamed("node", "uid"), ["uid"], "left").withColumn(
        "part", F.coalesce("part", "uid")
    )


def _with_links(texts: DataFrame, *links: DataFrame) -> DataFrame:
    """Numbers of links of every text, by alignment and by the count alone."""
    ends = [df.select(F.col(side).alias("uid"), "aligned") for df in links for side in ("a", "b")]
    counts = (
        reduce(DataFrame.unionByName, ends).groupBy("uid")
        .agg(F.count_if("aligned").alias("aligned_links"), F.count_if(~F.col("aligned")).alias("moved_links"))
    )
    return lookup_join(texts, counts, ["uid"], "left").fillna(0, ["aligned_links", "moved_links"])


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, text_md5, class_id (the class's smallest doc_id), kept: one text of a class is.

    aligned_links, moved_links: the links to other texts that made the class, as alignment or
    only the count found them. Links inside a class that need no check are not among them.
    """
    rows = stored(
        _sketched(pick(documents, "doc_id", "text").withColumn("text_md5", F.md5("text")))
        .withColumn("uid", F.monotonically_increasing_id())
    )
    usable = F.col("doc_id").isNotNull() & F.col("text_md5").isNotNull()
    texts = stored(
        rows.where(usable).groupBy("name")
        .agg(F.min(F.struct("uid", "doc_id", "size", "buckets")).alias("t"), F.min(F.struct("doc_id", "text_md5")).alias("least"))
        .select("name", "t.*", "least")
    )
    members = texts.select("uid", "size", F.explode("buckets").alias("sketch")).select(
        "uid", "size", F.shiftright("sketch", ORDER_BITS).alias("bucket"),
        F.col("sketch").bitwiseAND((1 << ORDER_BITS) - 1).cast("int").alias("order"),
    )
    close = (F.least("size", "hub_size") >= SIMILARITY * F.greatest("size", "hub_size"))

    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    members = stored(lookup_join(members, shared, ["bucket"]))
    meetings = members.groupBy("uid").agg(F.sum("n").alias("meetings"))
    hubs = (
        lookup_join(members, meetings, ["uid"])
        .groupBy("bucket")
        .agg(F.max(F.struct("meetings", -F.col("uid"), "size", "order")).alias("hub"), F.count("*").alias("members"))
        .select(
            "bucket", "members", (-F.col("hub.col2")).alias("hub"), F.col("hub.size").alias("hub_size"),
            F.col("hub.order").alias("hub_order"),
        )
    )
    members = stored(lookup_join(members.drop("n"), hubs, ["bucket"]))
    wanted = members.select("uid").distinct().join(texts.select("uid", "doc_id", "name"), "uid")
    sequences = stored(_sequences(lookup_join(pick(documents, "doc_id", "text"), wanted, ["doc_id"])))

    stars = stored(
        members.where((F.col("uid") != F.col("hub")) & close)
        .groupBy(F.col("hub").alias("a"), F.col("uid").alias("b"))
        .agg(F.max(F.col("order") == F.col("hub_order")).alias("in_order"))
    )
    measured = stored(_verified(stars, sequences))
    parts = components(measured.where("linked").select("a", "b"))

    # What the stars left apart: pairs of a bucket that lie in different classes.
    from_hub = measured.select(F.col("a").alias("hub"), F.col("b").alias("uid"), "far")
    is_hub = F.col("uid") == F.col("hub")
    placed = stored(
        lookup_join(_with_parts(members, parts), from_hub, ["uid", "hub"], "left").select(
            "uid", "size", "bucket", "order", "members", "part",
            # A hub is at 0; a text too long or too short for it has its distance bounded by that.
            F.coalesce("far", F.when(is_hub, 0).otherwise(F.abs(F.col("size") - F.col("hub_size")))).alias("low"),
            F.coalesce("far", F.when(is_hub, 0).otherwise(F.col("size") + F.col("hub_size"))).alias("up"),
        )
    )
    mixed = placed.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q")
    open_members = lookup_join(
        placed.join(mixed.select("bucket"), "bucket", "left_semi"), sequences.select("uid", "bins"), ["uid"]
    )
    left, right = _in_bands(open_members)
    right = right.select(
        F.col("uid").alias("b"), F.col("size").alias("hub_size"), F.col("part").alias("to"), "bucket", "lane", "place",
        F.col("low").alias("b_low"), F.col("up").alias("b_up"), F.col("bins").alias("b_bins"),
        F.col("order").alias("b_order"), F.col("band").alias("b_band"),
    )
    # In a lane of its own band a pair stands twice; across bands the left one is the smaller.
    once = (F.col("members") > WHOLE) & (F.col("band") < F.col("b_band")) | (F.col("a") < F.col("b")) & (
        (F.col("members") <= WHOLE) | (F.col("band") == F.col("b_band"))
    )
    apart = F.greatest(F.col("low") - F.col("b_up"), F.col("b_low") - F.col("up"))
    within = apart * (1 + SIMILARITY) <= (F.col("size") + F.col("hub_size")) * (1 - SIMILARITY) + 1e-6
    shared = F.aggregate(F.zip_with("bins", "b_bins", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    enough = shared * (1 + SIMILARITY) >= (F.col("size") + F.col("hub_size")) * SIMILARITY - 1e-6
    pairs = (
        left.withColumnRenamed("uid", "a").join(right, ["bucket", "lane", "place"])
        .where(once & (F.col("part") != F.col("to")) & close & within & enough)
        .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .agg(F.max(F.col("order") == F.col("b_order")).alias("in_order"))
        .join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    )
    checked = stored(_verified(stored(pairs), sequences).where("linked"))
    more = stored(lookup_join(
        checked.select("a", "b"), parts.withColumnRenamed("node", "a").withColumnRenamed("part", "pa"), ["a"], "left"
    ))
    more = lookup_join(more, parts.withColumnRenamed("node", "b").withColumnRenamed("part", "pb"), ["b"], "left")
    bridges = more.select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))
    joined = components(stored(bridges))
    final = stored(
        lookup_join(
            _with_parts(_with_links(texts.select("uid", "name", "least"), measured.where("linked"), checked), parts),
            joined.select(F.col("node").alias("part"), F.col("part").alias("whole")), ["part"], "left",
        ).select("name", "least", "aligned_links", "moved_links", F.coalesce("whole", "part").alias("class"))
    )
    first = final.groupBy("class").agg(F.min("least").alias("first"))
    named = lookup_join(final.drop("least"), first, ["class"]).drop("class")
    classed = lookup_join(rows.where(usable).select("doc_id", "text_md5", "name"), named, ["name"]).select(
        "doc_id", "text_md5", F.col("first.doc_id").alias("class_id"),
        ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("text_md5") == F.col("first.text_md5"))).alias("kept"),
        "aligned_links", "moved_links",
    )
    alone = rows.where(~usable).select(
        "doc_id", "text_md5", F.lit(None).cast("long").alias("class_id"), F.lit(True).alias("kept"),
        F.lit(0).cast("long").alias("aligned_links"), F.lit(0).cast("long").alias("moved_links"),
    )
    return classed.unionByName(alone)


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """The documents but for all but one of each class; repeated rows count as copies."""
    kept = near_duplicates(documents).where(F.col("kept") & F.col("class_id").isNotNull())
    rows = documents.withColumn("text_md5", F.md5("text"))
    usable = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    chosen = (
        rows.where(usable)
        .join(kept.select("doc_id", "text_md5").distinct(), ["doc_id", "text_md5"], "left_semi")
        .dropDuplicates(["doc_id", "text_md5"])
    )
    return chosen.unionByName(rows.where(~usable)).drop("text_md5")
