"""Term vectors of a text column, held in long form: one row per text and term.

The long form is the sparse matrix itself and has no vocabulary to gather on the
driver, so neither the number of texts nor of terms is bounded. Texts are read
whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.operators.lookup import lookup_join
from linkweave.session import stored

# Fixed value: words of two or more letters, digits or underscores.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
#: Terms whose weights are sent to every task, the most frequent ones; all others are looked up by a shuffle.
COMMON = 100_000
#: Parts, a power of two, over which the rows of one term are spread by their texts; a text has one row of it.
PARTS = 64
_PART = "_part"


def tokens(value: Column | str, analyzer: str = "word") -> Column:
    """Terms of a text in lower case, repeated as often as they occur."""
    lower = F.lower(F.col(value) if isinstance(value, str) else value)
    if analyzer == "word":
        return F.regexp_extract_all(lower, F.lit(WORD_PATTERN), 0)
    if analyzer == "char":
        return F.split(F.regexp_replace(lower, r"\s\s+", " "), "")
    if analyzer == "char_wb":
        words = F.filter(F.split(lower, r"\s+"), lambda word: word != "")
        padded = F.transform(words, lambda word: F.split(F.concat(F.lit(" "), word, F.lit(" ")), ""))
        return F.flatten(padded)
    raise ValueError(f"unknown analyzer {analyzer!r}")


def term_counts(
    texts: DataFrame,
    key: str,
    column: str,
    analyzer: str = "word",
    min_df: int | float = 1,
) -> DataFrame:
    """Occurrences of each term in each text.

    ``min_df`` leaves out terms found in fewer texts: a number of texts when whole,
    a share of all texts when a fraction.
    """
    if min_df != 1 and analyzer == "word" and not _keys_repeat(texts, key):
        # Texts are counted where they lie, so no task holds the terms of many. Letters are few and counted below.
        counted = texts.select(key, F.explode_outer(_counted(tokens(column))).alias("t"))
        # Bits of a hash are never NULL; a filter for that would set the two readers of the exchange apart.
        part = F.xxhash64(key).bitwiseAND(PARTS - 1)
        counts = (
            counted.select(key, "t.term", "t.n").where(F.col("term") != "").repartition("term", part).withColumn(_PART, part)
        )
        on, dealt = ["term", _PART], True
    else:
        counts = (
            # explode_outer: the plain form would take every text apart twice, once for
            # a filter on non-empty arrays.
            texts.select(key, F.explode_outer(tokens(column, analyzer)).alias("term"))
            .where(F.col("term") != "")
            .groupBy(key, "term")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        on, dealt = ["term"], False
    if min_df == 1 and isinstance(min_df, int):
        return counts
    least = F.lit(min_df)
    if isinstance(min_df, float):
        least = texts.agg(F.count(F.lit(1))).scalar() * F.lit(min_df)
    frequent = _document_frequency(counts, on).where(F.col("df") >= least).select(*on)
    # Inner on distinct terms; Spark would move a semi join below the counting.
    return lookup_join(counts, frequent, on, dealt=dealt).select(key, "term", "n")


def _keys_repeat(texts: DataFrame, key: str) -> bool:
    return not texts.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).isEmpty()


def _document_frequency(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Number of texts each term occurs in, once per term, or in each part of it where ``by`` names the parts.

    Counting over ``n`` keeps the input equal to what the counts are joined back
    to, so one exchange of the texts' terms serves both.
    """
    df = F.count_if(F.col("n") > 0).alias("df")
    if by in (None, ["term"]):
        return counts.groupBy("term").agg(df)
    # A term has PARTS rows at most here, however many texts it is in.
    return counts.groupBy(*by).agg(df).withColumn("df", F.sum("df").over(Window.partitionBy("term")))


def _counted(terms: Column) -> Column:
    """(term, n) of each term in an array: sorted, equal terms stand together."""
    return F.transform(
        F.array(F.sort_array(terms)),
        lambda s: F.transform(
            F.array(
                F.when(F.size(s) == 0, F.array().cast("array<int>")).otherwise(
                    F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (s[i] != F.get(s, i - 1)))
                )
            ),
            lambda starts: F.transform(
                starts,
                lambda i, j: F.struct(
                    s[i].alias("term"), (F.coalesce(F.get(starts, j + 1), F.size(s)) - i).cast("bigint").alias("n")
                ),
            ),
        )[0],
    )[0]


def _stored_counts(
    texts: DataFrame, key: str, column: str, analyzer: str, min_df: int | float
) -> tuple[DataFrame, int]:
    """The rows of ``term_counts`` as a stored table, for plans that read them several times, and the number of texts."""
    if min_df != 1 or isinstance(min_df, float):
        return stored(term_counts(texts, key, column, analyzer, min_df)), texts.count()
    # Texts are counted where they lie; only those that share a key have to meet.
    bags = stored(texts.select(key, _counted(tokens(column, analyzer)).alias("bag")), "zstd")
    counts = bags.select(key, F.explode("bag").alias("t")).select(key, "t.term", "t.n").where(F.col("term") != "")
    # The stored keys tell both how many texts there are and whether any share a key.
    keys = bags.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    found = keys.agg(F.sum("_n").alias("total"), F.max("_n").alias("most")).first()
    if (found.most or 0) > 1:
        counts = stored(counts.groupBy(key, "term").agg(F.sum("n").alias("n")))
    return counts, found.total or 0


def tfidf(
    texts: DataFrame,
    key: str,
    column: str,
    analyzer: str = "word",
    min_df: int | float = 1,
    only: DataFrame | None = None,
    numbered: bool = False,
) -> DataFrame:
    """Term weights n * (ln((1 + texts) / (1 + df)) + 1), scaled to length 1 per text.

    Rarity comes from all texts. With ``only``, a table of keys, the texts named there alone
    are weighted. With ``numbered`` each term is given as a number of its own, which is shorter than it.
    """
    counts, total = _stored_counts(texts, key, column, analyzer, min_df)
    frequency = _document_frequency(counts)
    if numbered:
        # Written with the terms, so that all that read them have the same numbers.
        frequency = frequency.withColumn("number", F.monotonically_increasing_id())
        how = "inner"
    else:
        # About half of all terms are in one text only. These are not written; a term not found is one of them.
        frequency = frequency.where(F.col("df") > 1)
        how = "left"
    frequency = stored(frequency)
    idf = F.log(F.lit(1.0 + total) / (1.0 + F.coalesce("df", F.lit(1)))) + 1.0
    weighted = counts if only is None else counts.join(only.select(key).distinct(), key, "left_semi")
    if texts.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1":
        # A session without broadcasts looks every term up.
        known = lookup_join(weighted, frequency, ["term"], how)
    else:
        # Most rows are of few terms; these stay where they are. The limit bounds what is sent, not what is read.
        # Ranked once and written: rows that stay and rows that are looked up are told apart by the same terms.
        common = stored(frequency.orderBy(F.col("df").desc(), "term").limit(COMMON))
        sent = weighted.join(F.broadcast(common), "term", "left")
        rare = lookup_join(sent.where(F.col("df").isNull()).select(key, "term", "n"), frequency, ["term"], how)
        known = sent.where(F.col("df").isNotNull()).unionByName(rare)
    if numbered:
        known = known.drop("term").withColumnRenamed("number", "term")
    # Whole numbers move, being shorter than weights. The window holds the terms of one text, no more.
    raw = known.repartition(key).withColumn("w", F.col("n") * idf)
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("w") / length).alias("weight"))


def packed(weights: DataFrame, key: str) -> DataFrame:
    """One row per text: its terms in order, and their weights."""
    vector = F.sort_array(F.collect_list(F.struct("term", "weight")))
    # Two plain arrays take half the room of one of pairs.
    return weights.groupBy(key).agg(vector.alias("v")).select(key, F.col("v.term").alias("terms"), F.col("v.weight").alias("weights"))


def _dot(left: str, right: str) -> Column:
    """Dot product of two packed vectors: of both together in order, equal terms are neighbours."""
    both = ", ".join(f"arrays_zip({v}.terms, {v}.weights)" for v in (left, right))
    return F.expr(
        f"transform(array(sort_array(concat({both}))), both -> aggregate("
        "zip_with(both, slice(both, 2, size(both)), (x, y) -> if(x.terms = y.terms, x.weights * y.weights, 0.0D)), "
        "0.0D, (total, z) -> total + z))[0]"
    )


def pair_cosine(pairs: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """Cosine of the two texts of each given pair; 0.0 where no term is shared.

    ``weights`` are unit vectors in long form, keyed by record id. Each text's vector is packed
    into one row and looked up once, for all pairs that it is in on either side; the two vectors
    of a pair then meet. Pairs of the same texts are one pair until then.
    """
    ids = ["source_id", "target_id"]
    sides = pairs.select(*ids).distinct().select("*", F.explode(F.array(*ids)).alias(key))
    met = (
        lookup_join(sides, packed(weights, key), [key])
        .groupBy(*ids)
        .agg(F.collect_list(F.struct("terms", "weights")).alias("v"))
        # A text without terms has no vector.
        .where(F.size("v") == 2)
        .select(*ids, _dot("v[0]", "v[1]").alias("cosine"))
    )
    return lookup_join(pairs, met, ids, "left").withColumn("cosine", F.coalesce("cosine", F.lit(0.0)))
