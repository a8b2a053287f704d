"""Chat formatting of reply trees.

Messages form trees: a message names its parent, one without a parent (or whose parent is
not there) is a root. Iterative self-joins list the path from each leaf to its root: step
k joins what is known of the paths with the ancestors 2**k above, and the ancestors with
themselves, so the number of joins grows with the logarithm of the depth. The branches of
a tree are ranked by the mean score of their messages. Each path is formatted as one
conversation, a row per turn; its text is the turns' texts one behind the other.

The template marks turns by control strings. Inside roles and texts a backslash is put
behind each backslash and behind the first character of each control string, so no control
string is left there and the text can be read back exactly.

Null texts and roles are empty, null scores 0. Rows without tree or node belong to no
conversation. Of rows that repeat a node the smallest (parent, role, text) counts. Messages
whose parents run in a circle are on no path. An empty table has no conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkweave.llm.common import pick, stored

START, MIDDLE, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of this and of other templates.
CONTROLS = [START, MIDDLE, STOP, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>"]
_FIRST = r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS)
TURN = re.compile(
    re.escape(START) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(STOP), re.DOTALL
)
LEARNED_ROLE = "assistant"


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def _escaped(column: str):
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), F.lit(_FIRST), F.lit("$0\\\\"))


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): the nodes on the path of each leaf, ``up`` steps above it.

    Also ``rank``, the branch's place in its tree: by mean score, then by leaf.
    """
    nodes = stored(messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    known = nodes.select("tree", F.col("node").alias("parent"))
    jump = stored(
        nodes.join(known, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("above"))
    )
    inner = jump.select("tree", F.col("above").alias("node")).distinct()
    path = nodes.join(inner, ["tree", "node"], "left_anti").select(
        "tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")
    )
    step, total = 1, nodes.count()
    while step <= total and not jump.isEmpty():
        more = path.join(jump, ["tree", "node"]).select(
            "tree", "leaf", F.col("above").alias("node"), (F.col("up") + step).alias("up")
        )
        path = stored(path.unionByName(more))
        beyond = jump.select("tree", F.col("node").alias("above"), F.col("above").alias("top"))
        jump = stored(
            jump.join(beyond, ["tree", "above"]).select("tree", "node", F.col("top").alias("above"))
        )
        step *= 2
    # Whoever has an ancestor that far up runs in a circle.
    path = path.join(jump.select("tree", F.col("node").alias("leaf")), ["tree", "leaf"], "left_anti")
    means = (
        path.join(nodes.select("tree", "node", "score"), ["tree", "node"])
        .groupBy("tree", "leaf")
        .agg(F.avg("score").alias("mean"))
    )
    order = Window.partitionBy("tree").orderBy(F.desc("mean"), "leaf")
    ranks = means.withColumn("rank", F.row_number().over(order)).drop("mean")
    return path.join(ranks, ["tree", "leaf"])


def format_trees(messages: DataFrame, best: int | None = None) -> DataFrame:
    """The conversations of the branches, or of the ``best`` of each tree, a row per turn.

    ``messages`` has tree, node, parent, role, text, score. The result has tree, leaf,
    rank, up (turns are in order of falling ``up``), piece (the formatted turn) and
    loss_start and loss_end, the code points of the piece that count for the loss (null
    for turns that do not).
    """
    rows = pick(messages, "tree", "node", "parent", "role", "text", "score").where(
        F.col("tree").isNotNull() & F.col("node").isNotNull()
    )
    rows = stored(
        rows.groupBy("tree", "node")
        .agg(F.min(F.struct("parent", "role", "text", "score")).alias("m"))
        .select("tree", "node", "m.*")
    )
    chosen = paths(rows)
    if best is not None:
        chosen = chosen.where(F.col("rank") <= best)
    role, text = _escaped("role"), _escaped("text")
    learned = F.col("role") == LEARNED_ROLE
    begin = F.length(F.col("head"))
    turns = (
        rows.select(
            "tree", "node", "role",
            F.concat(F.lit(START), role, F.lit(MIDDLE)).alias("head"), text.alias("body"),
        )
        .select(
            "tree", "node",
            F.concat("head", "body", F.lit(STOP)).alias("piece"),
            F.when(learned, begin).cast("long").alias("loss_start"),
            F.when(learned, begin + F.length("body")).cast("long").alias("loss_end"),
        )
    )
    return chosen.join(turns, ["tree", "node"]).drop("node")


READ = pa.schema([
    ("tree", pa.int64()), ("leaf", pa.int64()), ("rank", pa.int32()), ("n_turns", pa.int64()),
    ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
    ("formatted_chars", pa.int64()),
])


class _Reader:
    """Reads one conversation turn by turn; what it holds does not grow with the turns."""

    def __init__(self, key: tuple) -> None:
        self.key = key
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.waiting = ""

    def take(self, piece: str, start: int | None, end: int | None) -> None:
        self.chars += len(piece)
        if start is not None:
            learned = unescape(piece[start:end])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
        self.waiting += piece
        at = 0
        while found := TURN.match(self.waiting, at):
            self.turns += 1
            self.all.update(f"{unescape(found[1])}\n{unescape(found[2])}\n".encode())
            at = found.end()
        self.waiting = self.waiting[at:]

    def row(self) -> tuple:
        if self.waiting:
            raise ValueError(f"conversation {self.key} ends inside a turn")
        return (
            *self.key, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say, turn by turn from their text, as digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[] for _ in READ]
            return pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(columns, READ, strict=True)], schema=READ
            )

        reader, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = row["tree"], row["leaf"], row["rank"]
                if reader is None or reader.key != key:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(key)
                reader.take(row["piece"], row["loss_start"], row["loss_end"])
            if done:
                yield batch_of(done)
                done = []
        if reader is not None:
            yield batch_of([reader.row()])

    ordered = (
        formatted.select("tree", "leaf", "rank", "up", "piece", "loss_start", "loss_end")
        .repartition("tree", "leaf")
        .sortWithinPartitions("tree", "leaf", F.desc("up"))
    )
    return ordered.mapInArrow(
        run,
        "tree long, leaf long, rank int, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )


def chains(conversations: DataFrame) -> DataFrame:
    """Conversations of rows by turn as trees without branches: each row answers the one before."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return (
        pick(conversations, "conv_id", "turn", "role", "text")
        .where(F.col("conv_id").isNotNull())
        .withColumnRenamed("conv_id", "tree")
        .withColumn("node", F.row_number().over(order).cast("long"))
        .select(
            "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
            "role", "text", F.lit(0.0).alias("score"),
        )
    )
