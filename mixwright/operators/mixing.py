"""Merging the two sources, and padded batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mixwright.functions.lookup import literal_array, locate
from mixwright.functions.numbers import ceil_div, whole_div
from mixwright.schema import BUCKET, EXAMPLE_SCHEMA, IGNORE_INDEX, ORD, SpecialIds, refuse_stream

EXAMPLE_COLUMNS = EXAMPLE_SCHEMA.fieldNames()


@dataclass(frozen=True)
class Placed:
    """Examples that the ordering functions placed: ``rows`` with ``ord`` and ``bucket``, how
    many there are, the ordinal of the first row of each bucket, and the lengths without the
    arrays: ``spans(first, last, n)``, where rows ``first`` to ``last`` have ``n`` ids each."""

    rows: DataFrame
    n_rows: int
    firsts: Sequence[int]
    spans: DataFrame


def mix(
    pt: DataFrame | None, sft: DataFrame | None, pt_rows: int | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Corpus blocks followed by instruction examples; duplicates stay.

    ``ord`` of the second part continues after the first. ``pt_rows`` saves counting.
    ``keep`` names further columns, NULL where a part has none.
    """
    if pt is None and sft is None:
        raise ValueError("nothing to mix: both sources are absent")
    parts = []
    if pt is not None:
        refuse_stream(pt, "mix")
        parts.append(_part(pt, "pt", 0, keep))
    if sft is not None:
        refuse_stream(sft, "mix")
        before = 0 if pt is None else pt.count() if pt_rows is None else pt_rows
        parts.append(_part(sft, "sft", before, keep))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _part(df: DataFrame, source: str, before: int, keep: Sequence[str] = ()) -> DataFrame:
    kept = [c for c in keep if c in df.columns]
    return df.select(
        F.lit(source).alias("source"), (F.col(ORD) + before).alias(ORD), *EXAMPLE_COLUMNS, *kept
    )


def unpadded(df: DataFrame) -> DataFrame:
    """Rows of padded batches as they were before: arrays without their padding."""
    n = F.size(F.filter("attention_mask", lambda x: x == 1))
    cut = {c: F.slice(F.col(c), F.size(c) - n + 1, n) for c in ("input_ids", "labels", "attention_mask")}
    return df.withColumns(cut).drop("batch_id", "width")


def pad_batches(
    df: DataFrame, batch_size: int, multiple: int = 8, special: SpecialIds = SpecialIds()
) -> DataFrame:
    """Group ``batch_size`` consecutive rows and pad them, on the left, to one width.

    The width is that of the longest row, rounded up to ``multiple``. For any table with
    ``ord``: rows travel to their batch (masks, and labels equal to the ids, do not). Rows
    that the plans placed need not travel at all: see :func:`pad_placed`.
    """
    refuse_stream(df, "pad_batches")
    _check(batch_size, multiple)
    others = [c for c in df.columns if c not in (*EXAMPLE_COLUMNS, "batch_id")]
    rows = df.select(
        *others,
        whole_div(F.col(ORD), batch_size).alias("batch_id"),
        "input_ids",
        F.col("labels").eqNullSafe(F.col("input_ids")).alias("_same"),
        F.when(~F.col("labels").eqNullSafe(F.col("input_ids")), F.col("labels")).alias("_labels"),
        F.size("input_ids").alias("_n"),
    )
    longest = F.max("_n").over(Window.partitionBy("batch_id"))
    labels = F.when(F.col("_same"), F.col("input_ids")).otherwise(F.col("_labels"))
    wide = rows.withColumn("width", rounded(longest, multiple)).withColumn("labels", labels)
    return padded(wide, [*others, "batch_id", "width"], special)


def _check(batch_size: int, multiple: int) -> None:
    if batch_size < 1 or multiple < 1:
        raise ValueError("batch_size and multiple must be at least 1")


def rounded(longest: Column, multiple: int) -> Column:
    return (ceil_div(longest, multiple) * multiple).cast("int")


def padded(wide: DataFrame, keep: Sequence[str], special: SpecialIds) -> DataFrame:
    """Arrays of ``wide(.., width, _n, input_ids, labels)`` with their padding."""
    gap = F.col("width") - F.col("_n")
    return wide.select(
        *keep,
        F.concat(F.array_repeat(F.lit(special.pad), gap), "input_ids").alias("input_ids"),
        F.concat(F.array_repeat(F.lit(0), gap), F.array_repeat(F.lit(1), F.col("_n"))).alias(
            "attention_mask"
        ),
        F.concat(F.array_repeat(F.lit(IGNORE_INDEX), gap), "labels").alias("labels"),
    )


def pad_placed(
    parts: Mapping[str, Placed], batch_size: int, multiple: int = 8, special: SpecialIds = SpecialIds()
) -> DataFrame:
    """The parts one after the other (see :func:`mix`) in padded batches, without an exchange.

    A batch inside one bucket is padded where it lies: its rows are in one task already. Only
    batches over the edge of two buckets (at most one for each bucket, of which there are at
    most ``MAX_BUCKETS``) need rows of elsewhere, and of these only the lengths, which a
    narrow pass over ``spans`` collects. Widths of such batches are constants of the plan.
    """
    _check(batch_size, multiple)
    if not parts:
        raise ValueError("nothing to mix: both sources are absent")
    edges, spans, shifts, total = set(), [], {}, 0
    for name, part in parts.items():
        shifts[name] = total
        edges |= {(f + total) // batch_size for f in part.firsts if (f + total) % batch_size}
        first, last = (whole_div(F.col(c) + total, batch_size) for c in ("first", "last"))
        spans.append(part.spans.select(F.sequence(first, last).alias("batches"), "n"))
        total += part.n_rows
    at = sorted(edges)
    widest = {}
    if at:
        listed = reduce(DataFrame.unionByName, spans).select(F.explode("batches").alias("batch_id"), "n")
        known = literal_array(at, "bigint")
        place = locate(known, len(at), F.col("batch_id"))
        found = listed.filter(F.get(known, place - 1) == F.col("batch_id")).groupBy("batch_id")
        widest = {r["batch_id"]: r["n"] for r in found.agg(F.max("n").alias("n")).collect()}
    lengths = literal_array([widest.get(b, 0) for b in at], "bigint")
    done = []
    for name, part in parts.items():
        shifted = F.col(ORD) + shifts[name]
        rows = part.rows.select(
            F.lit(name).alias("source"),
            shifted.alias(ORD),
            whole_div(shifted, batch_size).alias("batch_id"),
            BUCKET,
            "input_ids",
            "labels",
            F.size("input_ids").alias("_n"),
        )
        longest = F.max("_n").over(Window.partitionBy(BUCKET, "batch_id")).cast("bigint")
        if at:
            known = literal_array(at, "bigint")
            place = locate(known, len(at), F.col("batch_id"))
            over_edge = F.get(known, place - 1) == F.col("batch_id")
            longest = F.when(over_edge, F.get(lengths, place - 1)).otherwise(longest)
        wide = rows.withColumn("width", rounded(longest, multiple))
        done.append(padded(wide, ["source", ORD, "batch_id", "width"], special))
    return reduce(DataFrame.unionByName, done)
