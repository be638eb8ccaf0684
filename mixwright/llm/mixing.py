"""Mixing sources to target weights by hash thresholds.

Every document has a fixed hash. A source takes the documents below a threshold; a source
that must be repeated takes all of them once and those below the threshold once more, so
thresholds of rising budgets are nested. Thresholds come from histograms: tokens are summed
by source and hash bucket, the bucket in which a source's budget ends is found, and only
that bucket is cut finer, round by round, until a bucket is a single hash. The filter is a
comparison; nothing is sorted. All of it is exact integer arithmetic, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mixwright.llm.common import WORD, land

# Fixed values of the contract: the weights that are dealt to the sources in turn, the
# share of all sizes that the mix has, and how often a source can be taken.
WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
MOST_REPEATS = 2

HASH_HEX = 15  # hex digits of the hash: 60 bits
HASH_BITS = 4 * HASH_HEX
ROUND_BITS = 12  # buckets of one round: 4096 for each source that is still open


def word_count(column: str = "text") -> Column:
    """Number of words, 0 for null. Counted by the lengths of the text with and without its
    words' letters: a word is replaced by one mark, blanks by nothing."""
    marked = F.regexp_replace(F.coalesce(F.col(column).cast("string"), F.lit("")), WORD, "x")
    return F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")).cast("bigint")


def document_hash(*columns: str) -> Column:
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, HASH_HEX), 16, 10).cast("bigint")


def source_targets(
    totals: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = BUDGET_PERCENT,
    repeats: int = MOST_REPEATS,
) -> DataFrame:
    """(source, source_size, target, copies, budget) from ``totals(source, source_size)``.

    Sources in code-point order, null last, get ``weights`` in turn and share ``percent`` of
    all sizes. A target stops at ``repeats`` times its source's size; what is left is shared
    again among the others. Sources stop in the order of size by weight, so the ones that
    stop are a prefix of that order and running sums give the level of the rest. ``copies``
    are whole passes over the source, ``budget`` is what the next pass may take. The table
    has one row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    deal = F.array(*[F.lit(int(w)) for w in weights])
    dealt = totals.withColumn("w", F.get(deal, ((F.row_number().over(by_name) - 1) % len(weights))).cast("bigint"))
    everything = Window.partitionBy(F.lit(0))
    # Whole numbers throughout: sizes by weight as multiples of one fraction.
    by_weight = F.col("source_size") * (F.lit(lcm(*weights)) / F.col("w")).cast("bigint")
    order = Window.partitionBy(F.lit(0)).orderBy(by_weight, F.col("source").asc_nulls_last())
    ranked = dealt.withColumns(
        {"total": F.sum("source_size").over(everything), "place": F.row_number().over(order)}
    )
    order = Window.partitionBy(F.lit(0)).orderBy("place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    summed = ranked.withColumns(
        {
            "stopped": F.coalesce(F.sum("source_size").over(before), F.lit(0)) * repeats,
            "rest_w": F.sum("w").over(after),
        }
    )
    # With the sources before it stopped, does this one stay below its own cap?
    left = F.col("total") * percent - F.col("stopped") * 100
    open_here = left * F.col("w") <= F.col("source_size") * repeats * 100 * F.col("rest_w")
    level = F.min(F.when(open_here, F.struct(F.col("place"), left.alias("left"), F.col("rest_w").alias("w"))))
    known = summed.withColumn("level", level.over(everything))
    capped = F.col("source_size") * repeats
    share = (F.col("w") * F.col("level")["left"]).cast("double") / (F.lit(100) * F.col("level")["w"]).cast("double")
    target = F.when(F.col("place") >= F.col("level")["place"], share).otherwise(capped.cast("double"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return known.withColumn("target", target).withColumn("copies", whole.cast("bigint")).select(
        "source", "source_size", "target", "copies",
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"),
    )


def _at(bits: int) -> Column:
    return F.shiftright("hash", HASH_BITS - bits)


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, threshold): documents of the source below ``threshold`` fill its budget.

    ``sized(source, hash, size)`` is read once a round, and each round but the first reads
    only the boundary bucket of each source. The boundary hash itself is taken if that
    comes nearer to the budget (on a draw it is left).
    """
    frontier = targets.select("source", "budget", F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("below"))
    for bits in range(ROUND_BITS, HASH_BITS + 1, ROUND_BITS):
        inside = sized.withColumn("prefix", _at(bits - ROUND_BITS)).alias("d").join(
            frontier.select(F.col("source").alias("of"), F.col("prefix").alias("open"), "budget", "below"),
            F.col("source").eqNullSafe(F.col("of")) & (F.col("prefix") == F.col("open")),
        )
        histogram = inside.groupBy("source", "budget", "below", _at(bits).alias("bucket")).agg(F.sum("size").alias("size"))
        running = Window.partitionBy("source").orderBy("bucket")
        summed = histogram.withColumn("reached", F.col("below") + F.sum("size").over(running))
        # The first bucket at which the budget is reached; the last one if none is.
        crossing = F.coalesce(
            F.min(F.when(F.col("reached") >= F.col("budget"), F.struct("bucket", "reached", "size"))),
            F.max(F.struct("bucket", "reached", "size")),
        )
        found = summed.groupBy("source", "budget").agg(crossing.alias("c"))
        frontier = land(
            found.select(
                "source", "budget", F.col("c.bucket").alias("prefix"),
                (F.col("c.reached") - F.col("c.size")).alias("below"), F.col("c.reached").alias("reached"),
            )
        )
    nearer = (F.col("reached") - F.col("budget")) < (F.col("budget") - F.col("below"))
    return frontier.select("source", (F.col("prefix") + nearer.cast("bigint")).alias("threshold"))


def _measured(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count().alias("size"),
        document_hash("doc_id").alias("hash"),
    )


def mix_rules(
    sized: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = BUDGET_PERCENT,
    repeats: int = MOST_REPEATS,
) -> DataFrame:
    """(of, source_size, target, copies, threshold): one row for each source of
    ``sized(source, hash, size)``. A table that was written, so Spark knows its size and
    broadcasts it only if it is small."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = land(source_targets(totals, weights, percent, repeats))
    cuts = thresholds(sized, targets).withColumnRenamed("source", "of")
    return land(
        targets.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(
            F.col("source").alias("of"), "source_size", "target", "copies",
            F.coalesce("threshold", F.lit(0)).alias("threshold"),
        )
    )


def _times(hashed: Column) -> Column:
    return F.col("copies") + (hashed < F.col("threshold")).cast("bigint")


def plan_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = BUDGET_PERCENT,
    repeats: int = MOST_REPEATS,
) -> DataFrame:
    """Per row of ``docs(doc_id, text, source)``: doc_id, source, size (words), source_size,
    target (of the source), times (how often the mix takes it) and taken (times * size).

    Null and empty texts have size 0. A null source is a source of its own. Rows with the
    same doc_id and source share a hash and are taken or left together; a null doc_id is an
    id of its own. Extra columns are ignored; an empty table gives an empty result.
    """
    sized = land(_measured(docs))
    rules = mix_rules(sized, weights, percent, repeats)
    return (
        sized.join(rules, F.col("source").eqNullSafe(F.col("of")))
        .select("doc_id", "source", "size", "source_size", "target", _times(F.col("hash")).alias("times"))
        .withColumn("taken", F.col("times") * F.col("size"))
    )


def apply_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = BUDGET_PERCENT,
    repeats: int = MOST_REPEATS,
) -> DataFrame:
    """The rows of the mix, each as often as the mix takes it, columns unchanged. Texts are
    filtered where they are read: they meet one rule for each source."""
    rules = mix_rules(land(_measured(docs)), weights, percent, repeats)
    names = {c: f"_rule_{c}" for c in rules.columns}
    ruled = docs.join(rules.withColumnsRenamed(names), F.col("source").cast("string").eqNullSafe(F.col("_rule_of")))
    times = F.col("_rule_copies") + (document_hash("doc_id") < F.col("_rule_threshold")).cast("bigint")
    marks = F.array_repeat(F.lit(1), times.cast("int"))
    return ruled.withColumn("_copy", F.explode(marks)).select(*docs.columns)
