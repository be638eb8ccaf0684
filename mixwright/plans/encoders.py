"""Encoders for the plans: from a text column of a table to a column of token ids.

An encoder is a function ``(df, text, out) -> df`` that adds ``out`` and drops ``text``. The
plans store what it returns, so a tokenizer sees every text once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.functions import tokens as tok
from mixwright.operators import mapping
from mixwright.operators.vocabulary import BROADCAST_ENTRIES, INLINE_ENTRIES, decode_vocab, encode_vocab
from mixwright.schema import SpecialIds

Encoder = Callable[[DataFrame, str, str], DataFrame]


def vocabulary_encoder(
    vocab: DataFrame,
    special: SpecialIds = SpecialIds(),
    inline: int = INLINE_ENTRIES,
    broadcast: int = BROADCAST_ENTRIES,
) -> Encoder:
    """Words, then their ids in ``vocab(token, id)``. Its ``decode(df, ids, out)`` gives text.
    ``inline`` and ``broadcast`` are the sizes of ``encode_vocab``."""
    sizes = {"inline": inline, "broadcast": broadcast}

    def encode(df: DataFrame, text: str, out: str) -> DataFrame:
        worded = df.withColumn("_words", tok.words(F.col(text))).drop(text)
        return encode_vocab(worded, "_words", vocab, out=out, special=special, **sizes)

    encode.decode = lambda df, ids, out: decode_vocab(df, ids, vocab, out=out, **sizes)
    return encode


def tokenizer_encoder(load: Callable[[], Callable[[list[str]], list[list[int]]]]) -> Encoder:
    """The caller's tokenizer; ``load`` runs once per Python task."""

    def encode(df: DataFrame, text: str, out: str) -> DataFrame:
        return df.withColumn(out, mapping.encode_with(F.col(text), load)).drop(text)

    return encode
