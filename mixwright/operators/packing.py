"""Fixed-size token blocks from consecutive rows."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mixwright.functions.lookup import literal_array
from mixwright.functions.numbers import whole_div
from mixwright.operators.ordering import BUCKET_ROWS, MAX_BUCKETS
from mixwright.schema import BUCKET, ORD, SPLIT, ones_like, refuse_stream

# Rows joined before cutting, and the block length from which a
# tokenizer's own maximum is reported as unusually long.
PACK_ROWS = 1000
LONG_BLOCK = 2048


def resolve_block_size(requested: int | None, model_max: int) -> int:
    """Requested block length, at most the model's; the model's own when none is given."""
    if requested is None:
        if model_max > LONG_BLOCK:
            warnings.warn(f"block size is the model maximum, {model_max}", stacklevel=2)
        return model_max
    if requested > model_max:
        warnings.warn(f"block size {requested} cut to the model maximum {model_max}", stacklevel=2)
    return min(requested, model_max)


def blocks_in(total: Column, block_size: int) -> Column:
    """Blocks made of ``total`` tokens: the full ones, or one short block if none is full."""
    return (
        F.when(total >= block_size, whole_div(total, block_size))
        .when(total > 0, F.lit(1).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )


def _with_buckets(df: DataFrame, pack_rows: int) -> DataFrame:
    """Rows of a batch need a common bucket. Tables that were not placed by the ordering
    functions get one from ``ord`` (one narrow job, one exchange)."""
    if BUCKET in df.columns:
        return df
    by = [SPLIT] if SPLIT in df.columns else []
    found = df.groupBy(*by).agg(F.max(ORD).alias("top")).collect()
    tops = [r for r in found if r["top"] is not None]
    rows = sum(r["top"] + 1 for r in tops)
    size = max(min(BUCKET_ROWS, rows // (2 * _parallelism(df))), -(-rows // MAX_BUCKETS), 1)
    size = -(-size // pack_rows) * pack_rows
    number = whole_div(F.col(ORD), size)
    first = 0
    shift = F.lit(0).cast("bigint")
    for row in tops:
        if by:
            shift = F.when(F.col(SPLIT) == row[SPLIT], F.lit(first)).otherwise(shift)
        first += row["top"] // size + 1
    bucketed = df.withColumn(BUCKET, (number + shift).cast("int"))
    return bucketed.repartitionById(max(first, 1), F.col(BUCKET))


def _parallelism(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def _batch_totals(df: DataFrame, pack_rows: int, length: Column) -> DataFrame:
    """Tokens of each batch of rows; token arrays are not built for it."""
    by = [SPLIT] if SPLIT in df.columns else []
    batch = whole_div(F.col(ORD), pack_rows).alias("batch")
    rows = df.select(*by, BUCKET, batch, length.cast("bigint").alias("n"))
    return rows.groupBy(*by, BUCKET, "batch").agg(F.sum("n").alias("total"))


def blocks_per_bucket(
    df: DataFrame, block_size: int, pack_rows: int, length: Column
) -> dict[tuple, int]:
    """Blocks that each (split, bucket) will give."""
    by = [SPLIT] if SPLIT in df.columns else []
    totals = _batch_totals(df, pack_rows, length)
    counts = totals.groupBy(*by, BUCKET).agg(F.sum(blocks_in(F.col("total"), block_size)).alias("n"))
    return {(r[SPLIT] if by else None, r[BUCKET]): r["n"] for r in counts.collect()}


def _block_spans(
    df: DataFrame, block_size: int, pack_rows: int, length: Column, firsts: Sequence[int]
) -> DataFrame:
    """(split, first, last, n): the blocks ``first`` to ``last``, made of one batch of rows,
    have ``n`` tokens each. Numbers only: this side of packing moves no text."""
    by = [SPLIT] if SPLIT in df.columns else []
    made = blocks_in(F.col("total"), block_size)
    running = Window.partitionBy(BUCKET).orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    base = F.get(literal_array(firsts, "bigint"), F.col(BUCKET))
    rows = _batch_totals(df, pack_rows, length).withColumn("last", base + F.sum(made).over(running) - 1)
    return rows.filter(F.col("total") > 0).select(
        *by, (F.col("last") - made + 1).alias("first"), "last", F.least("total", F.lit(block_size)).alias("n")
    )


def _first_block(counts: Mapping[tuple, int]) -> tuple[list[int], dict]:
    """Ordinal of the first block of each bucket, and blocks per split; numbering restarts
    in each split."""
    firsts = [0] * (max((bucket for _, bucket in counts), default=-1) + 1)
    seen: dict = {}
    for split, bucket in sorted(counts, key=lambda at: at[1]):
        firsts[bucket] = seen.get(split, 0)
        seen[split] = firsts[bucket] + counts[split, bucket]
    return firsts, seen


@dataclass(frozen=True)
class Packed:
    """Blocks, how many each split has (key ``None`` without splits), the ordinal of the
    first block of each bucket by split, and how long blocks are (see ``_block_spans``)."""

    blocks: DataFrame
    sizes: Mapping[str | None, int]
    firsts: Mapping[str | None, Sequence[int]]
    spans: DataFrame


def pack_blocks(
    df: DataFrame,
    block_size: int = 1024,
    pack_rows: int = PACK_ROWS,
    tokens: str | Column = "input_ids",
    length: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Blocks of :func:`pack_and_count`."""
    return pack_and_count(df, block_size, pack_rows, tokens, length, carry).blocks


def pack_and_count(
    df: DataFrame,
    block_size: int = 1024,
    pack_rows: int = PACK_ROWS,
    tokens: str | Column = "input_ids",
    length: str | None = None,
    carry: Sequence[str] = (),
    counted: DataFrame | None = None,
) -> Packed:
    """Join the tokens of ``pack_rows`` consecutive rows and cut them into blocks.

    ``df`` has a dense ``ord`` (per split, where there is a ``split``). A batch of rows
    gives its full blocks and drops the rest, unless it has less than one block: then
    that short block is kept. ``length`` names a column with the token count, so that
    counting passes need not build the arrays; a count that is wrong is an error. ``tokens``
    may be an expression over the ``carry`` columns: text then goes through the sorts and
    windows, and the (larger) arrays are made only where they are cut. ``counted`` is the
    same placed table with the lengths alone, for the counting passes.

    Batches follow ``ord``, not the physical partitions. Rows that the ordering functions
    placed (``bucket``) are packed where they are; only slices of the token arrays are
    regrouped, never single tokens.
    """
    refuse_stream(df, "packing")
    if block_size < 1 or pack_rows < 1:
        raise ValueError("block_size and pack_rows must be at least 1")
    by = [SPLIT] if SPLIT in df.columns else []
    carry = list(carry) if isinstance(tokens, Column) else [tokens]
    tokens = tokens if isinstance(tokens, Column) else F.col(tokens)
    size = F.col(length) if length else F.size(tokens)
    df = _with_buckets(df, pack_rows)
    lengths = df if counted is None else counted
    counts = blocks_per_bucket(lengths, block_size, pack_rows, size)
    firsts, sizes = _first_block(counts)

    rows = df.select(
        *by,
        BUCKET,
        ORD,
        whole_div(F.col(ORD), pack_rows).alias("batch"),
        size.cast("bigint").alias("_n"),
        *carry,
    )
    batch = Window.partitionBy(BUCKET, "batch").orderBy(ORD)
    whole = batch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = rows.withColumns(
        {
            "_end": F.sum("_n").over(batch.rowsBetween(Window.unboundedPreceding, 0)),
            "_total": F.sum("_n").over(whole),
            "_first": F.min(ORD).over(whole) == F.col(ORD),
        }
    )
    made = blocks_in(F.col("_total"), block_size)
    bucket = Window.partitionBy(BUCKET).orderBy("batch", ORD)
    before = F.sum(F.when(F.col("_first"), made).otherwise(0)).over(
        bucket.rowsBetween(Window.unboundedPreceding, 0)
    )
    start = F.col("_end") - F.col("_n")
    usable = F.when(
        F.col("_total") >= block_size, whole_div(F.col("_total"), block_size) * block_size
    ).otherwise(F.col("_total"))
    base = F.get(literal_array(firsts, "bigint"), F.col(BUCKET))
    touched = (
        spans.withColumn("_base", base + before - made)
        .withColumn("_start", start)
        .withColumn("_stop", F.least(F.col("_end"), usable))
        .filter(F.col("_start") < F.col("_stop"))
        .withColumn("_made", tokens)
        .withColumn("_tokens", _as_counted(F.col("_made"), F.col("_n")) if length else F.col("_made"))
        .withColumn(
            "block",
            F.explode(
                F.sequence(
                    whole_div(F.col("_start"), block_size),
                    whole_div(F.col("_stop") - 1, block_size),
                )
            ),
        )
    )
    low = F.greatest(F.col("_start"), F.col("block") * block_size)
    high = F.least(F.col("_stop"), (F.col("block") + 1) * block_size)
    piece = F.slice(
        F.col("_tokens"), (low - F.col("_start") + 1).cast("int"), (high - low).cast("int")
    )
    pieces = touched.select(
        *by,
        BUCKET,
        "batch",
        "block",
        (F.col("_base") + F.col("block")).alias("_ord"),
        F.struct(F.col(ORD).alias("at"), piece.alias("ids")).alias("_piece"),
    )
    joined = pieces.groupBy(*by, BUCKET, "batch", "block", "_ord").agg(
        F.sort_array(F.collect_list("_piece")).alias("_pieces")
    )
    blocks = joined.select(
        *by,
        BUCKET,
        F.col("_ord").alias(ORD),
        "batch",
        "block",
        F.flatten(F.col("_pieces.ids")).alias("input_ids"),
    )
    examples = blocks.withColumns(
        {"attention_mask": ones_like(F.col("input_ids")), "labels": F.col("input_ids")}
    )
    of_split: dict = {}
    for split, bucket in counts:
        of_split.setdefault(split, []).append(firsts[bucket])
    spans = _block_spans(lengths, block_size, pack_rows, size, firsts)
    return Packed(examples, sizes, {s: sorted(f) for s, f in of_split.items()}, spans)


def _as_counted(tokens: Column, n: Column) -> Column:
    wrong = F.raise_error(F.lit("the length of a row is not the number of its tokens"))
    return F.when(F.size(tokens) == n, tokens).otherwise(wrong)
