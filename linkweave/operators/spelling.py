"""Pairs of names that are near in spelling, found without forming the pairs of a block.

Two names are near when their edit distance is at most ``1 - threshold`` of the longer one,
that is when ``name_match_score`` reaches the threshold. The join is exact. A target's name of
l letters is cut into as many segments as edits could be allowed to it, and one more; so a name near
to it has one segment whole, and that at a place which the edits before and behind it can explain.
Source names ask for the pieces at these places only. What meets is checked by
blocks and letters, as bits, and then by ``levenshtein`` with its bound, inside the join.

Names are folded first: copies of a name are one form. Pairs are pairs of forms, so a name that a
third of all records bear costs what one record does. Empty names are near to none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.functions import text
from linkweave.operators.lookup import lookup_join

#: Least name_match_score, in hundredths: whole numbers leave no doubt at the very limit.
NEAR = 80


def allowed_edits(longer: str, near: int = NEAR) -> str:
    return f"(({100 - near} * {longer}) DIV 100)"


def _pieces(length: str, near: int) -> str:
    """Number of segments of a name: one more than the edits that any name near to it can have."""
    return f"(CAST({allowed_edits(f'(({length} * 100) DIV {near})', near)} AS INT) + 1)"


def _start(length: str, i: str, near: int) -> str:
    """Where segment i begins; the last ones are a letter longer if they do not come out even."""
    n = _pieces(length, near)
    return f"CAST({i} * ({length} DIV {n}) + greatest(0, {i} - ({n} - {length} % {n})) AS INT)"


def _size(length: str, i: str, near: int) -> str:
    n = _pieces(length, near)
    return f"CAST({length} DIV {n} + if({i} >= {n} - {length} % {n}, 1, 0) AS INT)"


def segments(name: str, near: int = NEAR) -> Column:
    """(length, i, piece): the segments of a name that may be found."""
    length = f"length({name})"
    return F.expr(
        f"""if({length} = 0, array(), transform(sequence(0, {_pieces(length, near)} - 1), i -> named_struct(
            'length', {length}, 'i', i,
            'piece', substring({name}, {_start(length, 'i', near)} + 1, {_size(length, 'i', near)}))))"""
    )


def probes(name: str, near: int = NEAR) -> Column:
    """(length, i, piece): what a name near to this one may have as one of its segments.

    i edits at most stand before segment i that is the first whole one, and no more than the
    number of segments behind it after; either bounds how far it can have moved.
    """
    own = f"length({name})"
    start, size = _start("l", "i", near), _size("l", "i", near)
    behind = f"({_pieces('l', near)} - 1 - i)"
    low = f"greatest(0, {start} - i, {start} + {own} - l - {behind})"
    high = f"least({own} - {size}, {start} + i, {start} + {own} - l + {behind})"
    return F.expr(
        f"""if({own} = 0, array(), array_distinct(flatten(transform(
            sequence(CAST(({near} * {own} + 99) DIV 100 AS INT), CAST(({own} * 100) DIV {near} AS INT)),
            l -> flatten(transform(sequence(0, {_pieces('l', near)} - 1), i -> transform(
                if({low} <= {high}, sequence(CAST({low} AS INT), CAST({high} AS INT)), CAST(array() AS array<int>)),
                p -> named_struct('length', l, 'i', i, 'piece', substring({name}, p + 1, {size})))))))))"""
    )


def _letter_bits(name: str) -> Column:
    """Which letters a name has, and which twice: an edit adds one bit at most, and takes one."""
    bits = []
    for i, letter in enumerate("abcdefghijklmnopqrstuvwxyz -"):
        n = f"(length({name}) - length(replace({name}, '{letter}', '')))"
        bits.append(f"if({n} > 0, {1 << i}L, 0L) | if({n} > 1, {1 << (i + 28)}L, 0L)")
    return F.expr(" | ".join(bits))


def _block_bits(blocks: str) -> Column:
    """A bit for each block, which others may share: without one in common no block is."""
    return F.expr(f"aggregate({blocks}, 0L, (bits, b) -> bits | shiftleft(1L, pmod(ascii(b), 63)))")


def named(records: DataFrame) -> DataFrame:
    """What the join reads of a record: key, block keys, full name in ASCII."""
    return records.select(
        *S.RECORD_KEY, text.block_keys().alias("blocks"), text.ascii_full_name().alias("name")
    )


def near_names(sources: DataFrame, targets: DataFrame, near: int = NEAR) -> DataFrame:
    """All pairs of name forms with a block in common and the nearness in spelling.

    Both sides have ``name`` and ``blocks``. Columns: source_name, source_blocks, target_name,
    target_blocks, edits.
    """
    def forms(rows: DataFrame, side: str) -> DataFrame:
        named = rows.select(F.col("name").alias(f"{side}_name"), F.col("blocks").alias(f"{side}_blocks")).distinct()
        # Few bytes, but many pieces: they are not left to the few tasks that would do for the bytes.
        return named.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))).select(
            "*", _letter_bits(f"{side}_name").alias(f"{side}_letters"), _block_bits(f"{side}_blocks").alias(f"{side}_bits")
        )

    left = forms(sources, "source").select("*", F.explode(probes("source_name", near)).alias("s")).select("*", "s.*").drop("s")
    right = forms(targets, "target").select("*", F.explode(segments("target_name", near)).alias("s")).select("*", "s.*").drop("s")
    allowed = f"CAST({allowed_edits('greatest(length(source_name), length(target_name))', near)} AS INT)"
    edits = f"levenshtein(source_name, target_name, {allowed})"
    may_be_near = F.expr(
        f"""source_bits & target_bits <> 0 AND bit_count(source_letters & ~target_letters) <= {allowed}
            AND bit_count(target_letters & ~source_letters) <= {allowed}"""
    )
    # The pieces of a table far outgrow it: what is small enough to be sent before need not be after.
    met = lookup_join(left, right.hint("merge"), ["length", "i", "piece"]).where(
        may_be_near & F.arrays_overlap("source_blocks", "target_blocks") & (F.expr(edits) >= 0)
    )
    return (
        met.select("source_name", "source_blocks", "target_name", "target_blocks").distinct()
        .withColumn("edits", F.expr(edits))
    )


def near_pairs(linked: DataFrame, source_type: str = "gpo", target_type: str = "pm", near: int = NEAR) -> DataFrame:
    """Keys of the pairs with near names; of targets alike in name and ``values``, the first few.

    ``linked`` has name, blocks and values. Targets that nothing tells apart have the same score
    by any model and are ranked by id, so no more than the export's limit can be among the best.
    """
    sources = linked.where(F.col("record_type") == source_type)
    targets = linked.where(F.col("record_type") == target_type)
    copies = Window.partitionBy("name", "blocks", "values").orderBy("record_id")
    alike = targets.withColumn("_rank", F.row_number().over(copies)).where(F.col("_rank") <= S.TOP_K).select(
        F.col("name").alias("target_name"), F.col("blocks").alias("target_blocks"), F.col("record_id").alias("target_id")
    )
    found = lookup_join(near_names(sources, targets, near), alike, ["target_name", "target_blocks"]).select(
        F.col("source_name").alias("name"), F.col("source_blocks").alias("blocks"), "target_id"
    )
    return lookup_join(sources, found, ["name", "blocks"]).select(
        F.lit(source_type).alias("source_type"), F.col("record_id").alias("source_id"),
        F.lit(target_type).alias("target_type"), "target_id",
    )
