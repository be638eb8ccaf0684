"""Small constant tables inside expressions: sorted search and hashed lookup.

Both work on literals whose size the caller has bounded, so rows are matched in the
scan stage itself: no join, no shuffle and no Python worker.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_array(values: Sequence, element_type: str) -> Column:
    """Array literal. Parsing one JSON string folds to a constant and builds far faster
    than thousands of ``lit`` calls."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{element_type}>")


def locate(bounds: Column, length: int, value: Column) -> Column:
    """How many of the ``length`` ascending ``bounds`` are <= ``value``.

    A binary descent: log2(length) comparisons per row for any type Spark can order. The
    outer one-element ``transform`` binds ``value``, so that an expensive key is computed
    once and not in every step.
    """
    if length == 0:
        return F.lit(0)
    strides = F.array(*[F.lit(1 << k) for k in reversed(range(length.bit_length()))])

    def descend(bound_value: Column) -> Column:
        def step(found: Column, stride: Column) -> Column:
            probe = found + stride
            fits = (probe <= length) & (F.get(bounds, probe - 1) <= bound_value)
            return F.when(fits, probe).otherwise(found)

        return F.aggregate(strides, F.lit(0), step)

    return F.get(F.transform(F.array(value), descend), 0)


def slot_count(entries: int) -> int:
    """Slots of a hashed table: a power of two, at least twice the entries."""
    return 1 << max(4, (2 * entries).bit_length())


def slot_of(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def hashed_lookup(table: Column, slots: int, key: Column) -> Column:
    """Value of ``key`` in a table laid out as ``array<map<string,int>>`` by
    :func:`slot_of`, or NULL. A slot holds one or two entries, so this is O(1)."""
    return F.element_at(F.get(table, slot_of(key, slots)), key)
