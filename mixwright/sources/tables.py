"""Corpus rows from existing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corpus_from_table(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, text) with an ordering key; only these two columns are read."""
    return df.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("text"))
