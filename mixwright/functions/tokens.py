"""Token columns from text columns, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mixwright.schema import SpecialIds

# Fixed value: a word is a run of letters and digits, any other visible character stands
# alone.
WORD_PATTERN = r"([\p{L}\p{N}]+|[^\p{L}\p{N}\s])"


def codepoints(text: Column, bos: int | None = None, special: SpecialIds = SpecialIds()) -> Column:
    """``array<int>`` of code point ids, optionally led by ``bos``. Ids follow the special ones."""
    ids = F.when(text == "", F.array().cast("array<int>")).otherwise(
        F.transform(F.split(text, ""), lambda ch: F.ascii(ch) + special.codepoint_offset)
    )
    return ids if bos is None else F.concat(F.array(F.lit(bos)), ids)


def codepoint_count(text: Column, bos: int | None = None) -> Column:
    """Length of :func:`codepoints` without building it."""
    return F.char_length(text) + (0 if bos is None else 1)


def codepoints_to_text(ids: Column, special: SpecialIds = SpecialIds()) -> Column:
    """Inverse of :func:`codepoints`; special ids are left out."""
    plain = F.filter(ids, lambda i: i > special.codepoint_offset)
    as_hex = F.transform(plain, lambda i: F.lpad(F.hex(i - special.codepoint_offset), 8, "0"))
    return F.decode(F.unhex(F.array_join(as_hex, "")), "UTF-32")


def words(text: Column) -> Column:
    """``array<string>`` of words and single punctuation marks, in order."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(1))
