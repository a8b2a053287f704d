"""Merkle manifest of a table of documents, and octopus multiproofs of all its rows.

H is the lower-case hex SHA-256 of its inputs written one behind the other. A row is a leaf:
H of its doc_id, source, lang, n_chars and text, each as ``-`` if null, else as its number of
UTF-8 bytes, a colon and the value. The leaves of one lang, by ascending doc_id (null first;
rows with one id by their leaf), are a tree: every ``RUN`` neighbours become their H until
one is left, the lang's subroot. The subroots by lang (null first) are a tree likewise; its
top is the root of the table.

A leaf partition is a block of neighbouring leaves of one tree. A proof of a leaf is the list
of the other members of its run, and so on up to the root. The partition does not ask for them
leaf by leaf: it climbs from the leaves it holds and notes, level by level, which members of a
run it can neither hold nor derive. That union, the least that proves all its leaves, is
fetched in one join; the interiors its leaves share are derived once, and each leaf's own
proof is expanded and folded inside the task.

Only digests move, never texts: a leaf is hashed where its row is read. Equal rows are leaves
of their own; which of them stands first makes no difference. Null and empty texts are different
leaves. Texts of any length are hashed whole. An empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.llm.common import pick, stored
from linkweave.operators.lookup import lookup_join

RUN = 8
#: Levels that one block spans, and the leaves it holds.
SPAN = 4
BLOCK = RUN**SPAN
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Name of the tree of subroots. Those of the langs are ``-`` and ``=lang``: null first.
ROOTS = ""

_NODES = "tree string, size long, level int, index long, digest binary, top boolean"
_WANTED = "tree string, block long, node_tree string, level int, index long"
_PROOFS = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def joined(digests: Iterable[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height(size: int) -> int:
    """Levels between the leaves and the top of a tree."""
    levels = 0
    while size > 1:
        size, levels = -(-size // RUN), levels + 1
    return levels


def missing(held: Iterable[int], size: int) -> list[tuple[int, int]]:
    """(level, index) of the fewest nodes that, with the held leaves, prove every one of these."""
    wanted, known, level = [], set(held), 0
    while size > 1:
        runs = sorted({i // RUN for i in known})
        for run in runs:
            members = range(run * RUN, min(run * RUN + RUN, size))
            wanted += [(level, i) for i in members if i not in known]
        known, size, level = set(runs), -(-size // RUN), level + 1
    return wanted


class Climb:
    """Digests known of one tree; held leaves and fetched nodes go in, the rest is derived."""

    def __init__(self, leaves: dict[int, str], fetched: dict[tuple[int, int], str], size: int) -> None:
        #: Of each known node below the top: what stands before and behind it in its run.
        self.around: list[dict[int, tuple[str, str]]] = []
        held, level = leaves, 0
        while size > 1:
            members = held | {i: d for (at, i), d in fetched.items() if at == level}
            own: dict[int, tuple[str, str]] = {}
            above = {}
            for run in sorted({i // RUN for i in held}):
                first, last = run * RUN, min(run * RUN + RUN, size)
                digests = [members[i] for i in range(first, last)]
                above[run] = joined(digests)
                for i in range(first, last):
                    if i in held:
                        own[i] = "".join(digests[:i - first]), "".join(digests[i - first + 1:])
            self.around.append(own)
            held, size, level = above, -(-size // RUN), level + 1
        (self.top,) = held.values()

    def path(self, leaf: int) -> Iterator[tuple[str, str]]:
        for level in self.around:
            yield level[leaf]
            leaf //= RUN


def _leaf(text: Column) -> Column:
    def field(value: Column) -> Column:
        written = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))

    fields = [text if name == "text" else F.col(name) for name in FIELDS]
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def leaves(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """tree, doc_id, leaf and ``now``: the leaf of the row with its text as ``tampered`` has it."""
    return pick(documents, *FIELDS).select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        _leaf(F.col("text")).alias("leaf"),
        (_leaf(F.col("text")) if tampered is None else _leaf(tampered)).alias("now"),
    )


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with their number ``pos`` in their tree and the tree's ``size``.

    Dealt by ranges, also of equal rows; a range adds what stands before it in the tree.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, "tree", *order, "tie")
        .sortWithinPartitions("tree", *order, "tie")
        .drop("tie")
        .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    )
    counts = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = counts.select(
        "tree", "part",
        (F.sum("n").over(tree.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(tree).alias("size"),
    )
    return (
        dealt.join(before, ["tree", "part"])
        .withColumn("pos", F.col("at") + F.col("shift"))
        .drop("part", "at", "shift")
    )


def _climbed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes above the rows of each block, as far as the block spans."""
    for batch in batches:
        out: list[tuple] = []
        for row in batch.to_pylist():
            level, first = row["level"], row["block"] * BLOCK
            width = -(-row["size"] // RUN**level)
            digests = [d.hex() for d in row["digests"]]
            if width == 1:
                out.append((row["tree"], row["size"], level, 0, bytes.fromhex(digests[0]), True))
            for _ in range(SPAN if width > 1 else 0):
                digests = [joined(digests[i:i + RUN]) for i in range(0, len(digests), RUN)]
                level, first, width = level + 1, first // RUN, -(-width // RUN)
                out += [
                    (row["tree"], row["size"], level, first + i, bytes.fromhex(d), width == 1)
                    for i, d in enumerate(digests)
                ]
                if width == 1:
                    break
        columns = zip(*out, strict=True) if out else [[]] * 6
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.bool_()]
        yield pa.record_batch(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            names=["tree", "size", "level", "index", "digest", "top"],
        )


def _grown(blocks: DataFrame, largest: int) -> DataFrame:
    """All nodes above the leaves of the trees; of a tree of one leaf, this leaf."""
    level = 0
    found = []
    rows = blocks.select(
        "tree", "size", F.lit(0).alias("level"), "block",
        F.transform("rows", lambda r: r["leaf"]).alias("digests"),
    )
    while True:
        nodes = stored(rows.mapInArrow(_climbed, _NODES))
        found.append(nodes)
        level += SPAN
        if largest <= RUN**level:
            return reduce(DataFrame.unionByName, found)
        rows = (
            nodes.where((F.col("level") == level) & ~F.col("top"))
            .groupBy("tree", "size", "level", F.expr(f"index DIV {BLOCK}").alias("block"))
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("index", "digest"))), lambda r: r["digest"]).alias("digests"))
        )


@dataclass(frozen=True)
class Manifest:
    """The leaf partitions, and every node above the leaves."""

    #: tree, size, rank (of the tree among the trees), trees, block, rows (pos, doc_id, leaf, now)
    blocks: DataFrame
    #: tree, level, index, digest; of the tree of subroots the leaves too
    nodes: DataFrame

    def root(self) -> DataFrame:
        """One row: the root. None for an empty table."""
        return self.nodes.where((F.col("tree") == ROOTS) & F.col("top")).select(F.hex("digest").alias("root"))


def _blocks(placed: DataFrame) -> DataFrame:
    """At most ``BLOCK`` neighbouring leaves of a tree as one row."""
    rest = [c for c in placed.columns if c not in ("tree", "size", "pos", "doc_id", "leaf", "now")]
    return placed.groupBy("tree", "size", *rest, F.expr(f"pos DIV {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "doc_id", "leaf", "now"))).alias("rows")
    )


def build(leaf_rows: DataFrame) -> Manifest:
    placed = stored(_placed(leaf_rows, "doc_id", "leaf"))
    sizes = placed.select("tree", "size").distinct()
    ranks = stored(
        _placed(sizes.select(F.lit(ROOTS).alias("tree"), F.col("tree").alias("name"), F.col("size").alias("leaves")), "name")
        .select(F.col("name").alias("tree"), F.col("pos").alias("rank"), F.col("size").alias("trees"), "leaves")
    )
    largest = ranks.agg(F.max("leaves"), F.max("trees")).first()
    blocks = stored(_blocks(lookup_join(placed, ranks.drop("leaves"), ["tree"])))
    trees = _grown(blocks, largest[0] or 0)
    tops = trees.where("top").join(ranks, "tree").select(
        F.lit(ROOTS).alias("tree"), F.col("trees").alias("size"), F.col("rank").alias("pos"),
        F.lit(None).cast("long").alias("doc_id"), F.col("digest").alias("leaf"), F.col("digest").alias("now"),
    )
    tops = stored(tops)
    above = _grown(_blocks(tops), largest[1] or 0)
    subroots = tops.select(
        "tree", "size", F.lit(0).alias("level"), F.col("pos").alias("index"), F.col("leaf").alias("digest"),
        F.lit(False).alias("top"),
    )
    return Manifest(blocks, reduce(DataFrame.unionByName, [trees, above, subroots]))


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for r in batch.to_pylist():
            first = r["block"] * BLOCK
            own = missing(range(first, first + r["held"]), r["size"])
            out += [(r["tree"], r["block"], r["tree"], *at) for at in own]
            out += [(r["tree"], r["block"], ROOTS, *at) for at in missing([r["rank"]], r["trees"])]
        columns = zip(*out, strict=True) if out else [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
        yield pa.record_batch(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            names=["tree", "block", "node_tree", "level", "index"],
        )


def _proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            (block,) = batch.slice(i, 1).to_pylist()
            yield _proofs_of(block)


def _proofs_of(block: dict) -> pa.RecordBatch:
    rows = block["rows"]
    fetched: dict[bool, dict[tuple[int, int], str]] = {True: {}, False: {}}
    for node in block["fetched"] or []:
        fetched[node["node_tree"] == ROOTS][node["level"], node["index"]] = node["digest"].hex()
    tree = Climb({r["pos"]: r["leaf"].hex() for r in rows}, fetched[False], block["size"])
    roots = Climb({block["rank"]: tree.top}, fetched[True], block["trees"])
    shared = list(roots.path(block["rank"]))
    proofs, folded = [], []
    for row in rows:
        path = [*tree.path(row["pos"]), *shared]
        proofs.append(joined(part for around in path for part in around))
        now = row["now"].hex()
        for before, behind in path:
            now = joined((before, now, behind))
        folded.append(now)
    n = len(rows)
    return pa.record_batch(
        [
            pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array([r["leaf"].hex() for r in rows]),
            pa.array([tree.top] * n), pa.array([roots.top] * n), pa.array(proofs), pa.array(folded),
            pa.array([f == roots.top for f in folded]),
        ],
        names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    )


def prove(manifest: Manifest) -> DataFrame:
    """Digests of each leaf's proof, and the root that its row as it is now folds to."""
    blocks, nodes = manifest.blocks, manifest.nodes
    wanted = blocks.select("tree", "size", "rank", "trees", "block", F.size("rows").alias("held")).mapInArrow(_wanted, _WANTED)
    known = nodes.select(F.col("tree").alias("node_tree"), "level", "index", "digest")
    fetched = (
        lookup_join(wanted, known, ["node_tree", "level", "index"])
        .groupBy("tree", "block")
        .agg(F.collect_list(F.struct("node_tree", "level", "index", "digest")).alias("fetched"))
    )
    return blocks.join(fetched, ["tree", "block"], "left").select(
        "size", "rank", "trees", "rows", "fetched"
    ).mapInArrow(_proved, _PROOFS)


def lowered_third() -> Column:
    """The text with A-Z lower-cased in the third of the rows whose id's checksum 3 divides."""
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return F.when(changed, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def verify_tampered(documents: DataFrame) -> DataFrame:
    """Proofs of all rows of the table, checked against a copy of it that was tampered with."""
    return prove(build(leaves(documents, lowered_third())))
