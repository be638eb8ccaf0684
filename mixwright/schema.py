"""Shared constants, the example schema and the null policy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The label that a loss function skips, and the label positions
# (0-based, end exclusive) that are made trainable when a cut row has no label left.
IGNORE_INDEX = -100
REPAIR_START, REPAIR_END = 18, 24

IDS = T.ArrayType(T.IntegerType(), containsNull=False)

EXAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("input_ids", IDS, False),
        T.StructField("attention_mask", IDS, False),
        T.StructField("labels", IDS, False),
    ]
)

# Working columns that the ordering functions add.
ORD = "ord"
BUCKET = "bucket"
SPLIT = "split"


@dataclass(frozen=True)
class SpecialIds:
    """Ids of the special tokens; ordinary tokens start after them."""

    pad: int = 0
    bos: int = 1
    eos: int = 2
    unk: int = 3

    @property
    def first_free(self) -> int:
        return max(self.pad, self.bos, self.eos, self.unk) + 1

    @property
    def codepoint_offset(self) -> int:
        """What is added to a code point, so that the first one, U+0001, gets the first
        free id. (U+0000 is no text: it would have the id of a special token.)"""
        return self.first_free - 1


def require_values(df: DataFrame, columns: Sequence[str], on_null: str = "fail") -> DataFrame:
    """Apply the null policy to ``columns``: fail while the row is read, or drop it.

    The check is part of the projection, so it costs no extra pass. It names the task's
    partition only to count as non-deterministic: filters that come later then stay above
    it, and those that came earlier have already removed their rows.
    """
    if on_null == "drop":
        return df.dropna(subset=list(columns))
    if on_null != "fail":
        raise ValueError(f"on_null must be 'fail' or 'drop', not {on_null!r}")
    in_place = F.spark_partition_id() >= 0
    checked = {
        name: F.when(
            F.col(name).isNull() & in_place, F.raise_error(F.lit(f"NULL in column {name}"))
        ).otherwise(F.col(name))
        for name in columns
    }
    return df.withColumns(checked)


def split_of(df: DataFrame, name: str) -> DataFrame:
    """Rows of one split. The split label must be a column of ``df``."""
    if SPLIT not in df.columns:
        raise ValueError(f"no split {name!r}: the table has no {SPLIT!r} column")
    return df.filter(F.col(SPLIT) == name)


def require_split(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`split_of`, but an empty or absent split is an error (one small job)."""
    rows = split_of(df, name)
    if rows.select(SPLIT).isEmpty():
        raise ValueError(f"a {name} dataset is required, but the split is absent")
    return rows


def with_attention_mask(df: DataFrame, tokens: str = "input_ids") -> DataFrame:
    """Add a mask of ones as long as ``tokens``."""
    return df.withColumn("attention_mask", ones_like(F.col(tokens)))


def ones_like(tokens: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(tokens))


def refuse_stream(df: DataFrame, what: str) -> None:
    """Raise for operators that need a finite input."""
    if df.isStreaming:
        raise ValueError(f"{what} needs a finite table, not a stream")
