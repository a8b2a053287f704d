"""The best targets of every source by a fitted forest, over all pairs of its blocks, exactly.

The pairs of a block are not formed. What a forest reads of a pair is which attributes agree, the
similarity of the names, and what is known of the source alone. Its score is constant on the cells
of a lattice: a set of agreements, and an interval of each number between two of the forest's own
split points. The cells are scored once.

A value that only one side has agrees with none, and is left out; sources alike in the rest are one
class, and of targets alike in it the first few by id are enough.

Classes ask for targets in rounds. A round lists, for each place and each set of agreeing values,
the first targets by id. Places are the blocks, and the forms of a name near in spelling
(``spelling``). A target not yet listed agrees in exactly some set whose lists were cut. If its name
is near, the list of its form was cut, and its score is that of the list: it follows from set and
form. If not, no cell with that set and a low name score gives more than its own score. What is near
follows the forest: where a split point of the name score stands a little below, names above it are.
A list is done with when nothing behind its cut can come before the best of its class: that bound is
the proof. Places with a list not done with are asked again for longer lists; a list that holds all
its targets bounds nothing, so every class ends.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.functions import naming, text
from linkweave.operators import matching, spelling
from linkweave.operators.features import MATCH_ATTRIBUTES, name_match_score
from linkweave.operators.lookup import lookup_join
from linkweave.operators.model import tree_nodes
from linkweave.session import stored

NAME_SCORE = "name_match_score"
SOURCE_COUNTS = {"f_name_freq_src": "f_name_freq", "l_name_freq_src": "l_name_freq"}
#: Least nearness in spelling, in hundredths, that a split point of the forest can ask for.
LEAST_NEAR = 70
#: Targets of a list in the first round, and how much longer the lists of the next are.
FIRST, GROWTH = 8, 8


class Inputs:
    """The columns that a forest reads, by what they are."""

    def __init__(self, fitted: PipelineModel) -> None:
        self.columns: list[str] = list(fitted.stages[0].getInputCols())
        by_flag = {flag: attribute for attribute, flag in MATCH_ATTRIBUTES.items()}
        #: Feature without its group's name.
        self.features = {c: c.removeprefix(f"{naming.table_name('FgLegacy')}_") for c in self.columns}
        unknown = [c for c, f in self.features.items() if f not in by_flag and f != NAME_SCORE and f not in SOURCE_COUNTS]
        if unknown:
            raise ValueError(f"features without a lattice: {unknown}")
        self.attributes = [by_flag[f] for f in self.features.values() if f in by_flag]
        self.flags = [c for c, f in self.features.items() if f in by_flag]

    def pair_columns(self) -> list[Column]:
        """The features of a pair from the values, names and counts of its records."""
        out = []
        for column, feature in self.features.items():
            if column in self.flags:
                at = self.flags.index(column)
                value = F.when(F.get("own_values", F.lit(at)) == F.get("values", F.lit(at)), 1.0).otherwise(0.0)
            elif feature == NAME_SCORE:
                value = name_match_score("own_name", "name")
            else:
                value = F.col(SOURCE_COUNTS[feature]).cast("double")
            out.append(value.alias(column))
        return out

    def list_columns(self) -> list[Column]:
        """The features of any pair that agrees in a list's values only, with the name score of its place."""
        out = []
        for column, feature in self.features.items():
            if column in self.flags:
                out.append(F.getbit("mask", F.lit(self.flags.index(column))).cast("double"))
            else:
                out.append(F.col("name_score" if feature == NAME_SCORE else SOURCE_COUNTS[feature]).cast("double"))
        return [c.alias(name) for c, name in zip(out, self.columns, strict=True)]


def split_points(fitted: PipelineModel) -> dict[int, list[float]]:
    """The forest's own split points of each input, in order: at most 31 each."""
    splits = (
        tree_nodes(fitted).where("nodeData.leftChild >= 0")
        .select(F.col("nodeData.split.featureIndex").alias("i"), F.element_at("nodeData.split.leftCategoriesOrThreshold", 1).alias("at"))
        .distinct()
    )
    points: dict[int, list[float]] = {}
    for row in splits.collect():
        points.setdefault(row.i, []).append(row.at)
    return {i: sorted(at) for i, at in points.items()}


def near_limit(points: dict[int, list[float]], inputs: Inputs) -> int:
    """Least nearness of a near name: above it begins an interval of the name score, if one begins a little below."""
    at = [i for i, c in enumerate(inputs.columns) if inputs.features[c] == NAME_SCORE]
    return min((int(p * 100) for i in at for p in points.get(i, []) if LEAST_NEAR <= p * 100 <= spelling.NEAR), default=spelling.NEAR)


def in_cells(points: dict[int, list[float]], inputs: Inputs) -> list[Column]:
    """The features, each number as the end of its interval: the forest scores both alike."""
    out = []
    for i, name in enumerate(inputs.columns):
        column = F.col(name)
        if name not in inputs.flags:
            ends = points.get(i, [])
            end = F.lit((ends[-1] if ends else 0.0) + 1.0)
            for e in reversed(ends):
                end = F.when(F.col(name) <= e, e).otherwise(end)
            column = F.when(F.col(name).isNotNull(), end)
        out.append(column.alias(name))
    return out


def cell_bounds(
    spark: SparkSession, fitted: PipelineModel, inputs: Inputs, points: dict[int, list[float]], near: int = spelling.NEAR
) -> DataFrame:
    """(mask, bound): the highest score of a pair with these agreements that is not near in spelling."""
    cells = spark.range(1).select(F.lit(0).alias("mask"))
    for i, column in enumerate(inputs.columns):
        if column in inputs.flags:
            bit = 1 << inputs.flags.index(column)
            cells = cells.select("*", F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias(column)).withColumn(
                "mask", F.col("mask") + F.when(F.col(column) == 1.0, bit).otherwise(0)
            )
            continue
        # A value at a split point goes left: each point stands for the interval that ends there.
        ends = points.get(i, [])
        if inputs.features[column] == NAME_SCORE:
            # Those that begin below the limit.
            kept = [e for e, begin in zip([*ends, 2.0], [-1.0, *ends], strict=True) if begin < near / 100]
        else:
            kept = [*ends, (ends[-1] if ends else 0.0) + 1.0]
        cells = cells.select("*", F.explode(F.array(*[F.lit(e) for e in kept])).alias(column))
    scored = fitted.transform(cells).select("mask", F.get(vector_to_array("_probability"), 1).alias("score"))
    return scored.groupBy("mask").agg(F.max("score").alias("bound"))


def comparable(records: DataFrame, attributes: list[str]) -> DataFrame:
    """What the search reads of a record: key, block keys, prepared values, ASCII name."""
    values = [text.prep_text(a) if a in records.columns else F.lit(None).cast("string") for a in attributes]
    own = [c for c in SOURCE_COUNTS.values() if c in records.columns]
    return records.select(
        *S.RECORD_KEY, *own, text.block_keys().alias("blocks"), F.array(*values).cast("array<string>").alias("values"),
        text.ascii_full_name().alias("name"),
    )


def shared_values(sources: DataFrame, targets: DataFrame, n: int) -> list[DataFrame]:
    """Both sides with a number for each value that both have; NULL for any other, which can agree with none."""
    if n == 0:
        return [side.withColumn("values", F.col("values").cast("array<bigint>")) for side in (sources, targets)]
    apart = [
        side.select("values").distinct().select("values", F.posexplode("values").alias("i", "value")).where("value IS NOT NULL")
        for side in (sources, targets)
    ]
    met, others = (rows.select("i", "value").distinct() for rows in apart)
    numbers = stored(met.join(others, ["i", "value"]).withColumn("number", F.monotonically_increasing_id()))
    out = []
    for side, rows in zip((sources, targets), apart, strict=True):
        held = lookup_join(rows, numbers, ["i", "value"]).groupBy("values").agg(
            F.map_from_entries(F.collect_list(F.struct("i", "number"))).alias("_numbers")
        )
        own = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.try_element_at("_numbers", i))
        out.append(lookup_join(side, held, ["values"], "left").withColumn("values", own).drop("_numbers"))
    return out


def _form(name: str, blocks: str) -> Column:
    """The place of a form of a name. No block key has its sign."""
    return F.concat(name, F.lit("|"), F.array_join(blocks, "|"))


def _asked(n: int) -> Column:
    """Every set of present values, also the empty one."""
    none = F.struct(F.lit(0).alias("mask"), F.transform("values", lambda v: F.lit(None).cast("bigint")).alias("shared"))
    if n == 0:
        return F.array(none)
    return F.concat(matching._agreements(n), F.array(none))


def _lists(targets: DataFrame, n: int, depth: int) -> DataFrame:
    """(place, mask, shared, target_id, last): the first targets that agree in the values.

    ``last`` marks the one after the first ``depth``: where there is one, more may follow.
    """
    places = F.explode(F.array_append("blocks", _form("name", "blocks"))).alias("place")
    folded = matching._top(
        targets.select("record_id", "values", places), ["place", "values"], [F.col("record_id")], depth + 1
    ).drop("_rank")
    return matching._top(
        folded.select("place", "record_id", F.explode(_asked(n)).alias("s")).select("place", "s.mask", "s.shared", "record_id"),
        ["place", "mask", "shared"], [F.col("record_id")], depth + 1,
    ).select("place", "mask", "shared", F.col("record_id").alias("target_id"), (F.col("_rank") > depth).alias("last"))


def distinct_scores(fitted: PipelineModel, features: DataFrame, inputs: Inputs) -> DataFrame:
    """The features that occur, each set once, with its score: many pairs share one set."""
    scored = fitted.transform(features.select(*inputs.columns).distinct())
    return stored(scored.select(*inputs.columns, F.get(vector_to_array("_probability"), 1).alias("score")))


def forest_targets(
    sources: DataFrame,
    targets: DataFrame,
    fitted: PipelineModel,
    source_type: str = "gpo",
    target_type: str = "pm",
    k: int = S.TOP_K,
    min_score: float = S.MIN_MATCH_SCORE,
) -> DataFrame:
    """Per source the k best targets of its blocks by the forest, or else the best one.

    Both sides are records, one row each; the sources with their name counts where the forest
    reads them. The result equals scoring every pair of every block and ranking by score, then
    target id. Sources whose blocks hold no target have no row.
    """
    spark = sources.sparkSession
    inputs = Inputs(fitted)
    points = split_points(fitted)
    n = len(inputs.attributes)
    asking, asked = shared_values(
        stored(comparable(sources, inputs.attributes)),
        stored(comparable(targets.where("record_id IS NOT NULL"), inputs.attributes)), n,
    )
    asking = stored(asking)
    # Targets that nothing tells apart have one score with any source, and their order is by id.
    asked = stored(matching._top(asked, ["blocks", "values", "name"], [F.col("record_id")], k).drop("_rank"))
    counts = [SOURCE_COUNTS[f] for f in inputs.features.values() if f in SOURCE_COUNTS]
    alike = ["blocks", "values", "name", *counts]
    # Sources that nothing tells apart are one.
    classes = stored(asking.groupBy(*alike).agg(F.min("record_id").alias("class_id")))
    near = near_limit(points, inputs)
    bounds = stored(cell_bounds(spark, fitted, inputs, points, near))
    # (class_id, place, name_score): where a class asks, and the name score of all targets there, if they have one.
    places = classes.select(
        "class_id", "values", *counts, F.explode("blocks").alias("place"), F.lit(None).cast("double").alias("name_score")
    )
    if NAME_SCORE in inputs.features.values():
        forms = stored(spelling.near_names(classes, asked, near).select(
            F.col("source_name").alias("name"), F.col("source_blocks").alias("blocks"),
            _form("target_name", "target_blocks").alias("place"),
            name_match_score("source_name", "target_name").alias("name_score"),
        ))
        places = places.unionByName(
            lookup_join(classes, forms, ["name", "blocks"]).select("class_id", "values", *counts, "place", "name_score")
        )
    places = stored(places)

    left = classes.withColumnsRenamed({"values": "own_values", "name": "own_name"}).drop("blocks")
    right = asked.select(F.col("record_id").alias("target_id"), "values", "name")
    cells_of = in_cells(points, inputs)
    held: DataFrame | None = None
    open_places, depth = places, FIRST
    while True:
        wanted = open_places.select("*", F.explode(_asked(n)).alias("s")).select(
            "class_id", "place", "name_score", *counts, "s.mask", "s.shared"
        )
        found = stored(
            lookup_join(wanted, _lists(asked, n, depth), ["place", "mask", "shared"])
            .select("class_id", "place", "name_score", *counts, "target_id", "mask", "last")
        )
        pairs = stored(found.select("class_id", "target_id").distinct())
        features = stored(
            lookup_join(lookup_join(pairs, left, ["class_id"]), right, ["target_id"]).select(
                "class_id", "target_id", *inputs.pair_columns()
            ).select("class_id", "target_id", *cells_of)
        )
        cut = found.where("last")
        in_forms = cut.where("name_score IS NOT NULL").select(
            "class_id", "place", F.col("target_id").alias("after"), *inputs.list_columns()
        ).select("class_id", "place", "after", *cells_of)
        cells = distinct_scores(fitted, features.select(*inputs.columns).unionByName(in_forms.select(*inputs.columns)), inputs)
        scores = lookup_join(features, cells, inputs.columns).select("class_id", "target_id", "score")
        if held is not None:
            scores = held.join(pairs, ["class_id", "target_id"], "left_anti").unionByName(scores)
        best = stored(matching._top(scores, ["class_id"], [F.col("score").desc(), F.col("target_id")], k))
        state = best.groupBy("class_id").agg(
            F.max(F.when(F.col("_rank") == 1, F.struct("score", "target_id"))).alias("top"),
            F.max(F.when(F.col("_rank") == k, F.struct("score", "target_id"))).alias("worst"),
        )
        # At most one row for each set of attributes.
        in_blocks = cut.where("name_score IS NULL").join(F.broadcast(bounds), "mask").select(
            "class_id", "place", F.col("target_id").alias("after"), "bound"
        )
        beyond = in_blocks.unionByName(
            lookup_join(in_forms, cells, inputs.columns).select("class_id", "place", "after", F.col("score").alias("bound"))
        )

        def safe(row: str) -> Column:
            """Nothing unlisted comes before this one; what is unlisted has ids behind ``after``."""
            beats = (F.col(f"{row}.score") > F.col("bound")) | (
                (F.col(f"{row}.score") == F.col("bound")) & (F.col(f"{row}.target_id") <= F.col("after"))
            )
            return F.coalesce(beats, F.lit(False))

        low = F.col("bound") < min_score
        settled = safe("worst") | (low & ((F.col("top.score") >= min_score) | safe("top")))
        left_open = stored(lookup_join(beyond, state, ["class_id"]).where(~settled).select("class_id", "place").distinct())
        if left_open.isEmpty():
            break
        held = best.drop("_rank")
        open_places = stored(lookup_join(open_places, left_open, ["class_id", "place"]))
        depth *= GROWTH
    ranked = best.where((F.col("score") >= min_score) | (F.col("_rank") == 1))
    members = lookup_join(asking.select("record_id", *alike), classes, alike).select("record_id", "class_id")
    return lookup_join(members, ranked, ["class_id"]).select(
        F.lit(source_type).alias("source_type"), F.col("record_id").alias("source_id"),
        F.lit(target_type).alias("target_type"), "target_id", "score",
    )
