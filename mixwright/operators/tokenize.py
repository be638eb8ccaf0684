"""Token columns added to tables; see ``functions.tokens`` for the expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.functions import tokens as tok
from mixwright.operators import mapping
from mixwright.operators.vocabulary import decode_vocab
from mixwright.schema import SpecialIds


def encode_codepoints(
    df: DataFrame,
    text: str,
    add_bos: bool = False,
    special: SpecialIds = SpecialIds(),
    out: str = "input_ids",
) -> DataFrame:
    return df.withColumn(out, tok.codepoints(F.col(text), special.bos if add_bos else None, special))


def split_words(df: DataFrame, text: str, out: str = "tokens") -> DataFrame:
    return df.withColumn(out, tok.words(F.col(text)))


def encode_with(
    df: DataFrame,
    text: str,
    load: Callable[[], Callable[[list[str]], list[list[int]]]],
    out: str = "input_ids",
) -> DataFrame:
    """Ids from the caller's tokenizer; ``load`` runs once per Python task."""
    return df.withColumn(out, mapping.encode_with(F.col(text), load))


def decode(
    df: DataFrame,
    ids: str,
    vocab: DataFrame | None = None,
    keys: Sequence[str] = (),
    special: SpecialIds = SpecialIds(),
    out: str = "text",
) -> DataFrame:
    """Ids back to text: code points, or the entries of ``vocab`` (``keys`` identify a row)."""
    if vocab is not None:
        return decode_vocab(df, ids, vocab, keys, out)
    return df.withColumn(out, tok.codepoints_to_text(F.col(ids), special)).drop(ids)
