"""What several operators of this folder share: word rules, row keys, labels, landing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mixwright.session import land

# The characters that separate words (blank and U+0009 to U+000D), the
# letters that are lower-cased (A-Z alone), and the fold rule of the labels.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDS, HELD_OUT_FOLD = 3, 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def whole_text(column: str = "text") -> Column:
    """The text, a null being the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(*columns: str) -> Column:
    """A number that stands for the content of a row. Equal rows share it, and an operator
    gives equal rows equal results, so joins by it need no unique ids."""
    return F.xxhash64(*[F.col(c) for c in columns])


def fold_of(doc_id: str = "doc_id") -> Column:
    """0, 1 or 2; a row without an id counts as held out, as no label can belong to it."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold, F.lit(HELD_OUT_FOLD)).cast("int")


def learning_labels(labels: DataFrame, target: str) -> DataFrame:
    """(doc_id, fold, y) of the rows that may be learned from: one row for each doc_id, the
    majority of its labels (1 on a draw); null ids and labels are left out."""
    known = labels.select("doc_id", fold_of().alias("fold"), F.col(target).cast("double").alias("y"))
    return (
        known.filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & (F.col("fold") != HELD_OUT_FOLD))
        .groupBy("doc_id", "fold")
        .agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    )


def only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Just the named columns, so that no other column can clash with a working column."""
    return df.select(*columns)


__all__ = [
    "BLANKS", "FOLDS", "HELD_OUT_FOLD", "LOWER", "UPPER", "WORD", "ascii_lower", "fold_of", "land",
    "learning_labels", "only", "read_table", "row_key", "whole_text",
]
