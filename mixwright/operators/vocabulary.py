"""Vocabulary build, encode and decode as table jobs."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.window import Window

from mixwright.functions.lookup import hashed_lookup, slot_count, slot_of
from mixwright.operators.ordering import cap, with_ordinal
from mixwright.schema import ORD, SpecialIds, refuse_stream
from mixwright.session import cut_lineage, land

# Vocabularies that are looked up inside the projection, and those that are broadcast: both
# their entries and the bytes of their tokens are bounded. Measured: see README.
INLINE_ENTRIES, INLINE_BYTES = 20_000, 2_000_000
BROADCAST_ENTRIES, BROADCAST_BYTES = 1_000_000, 100_000_000
# Longer tokens are never part of the inline head of a large vocabulary.
HEAD_TOKEN_BYTES = 100
# Vocabularies up to this size are ordered in one task, larger ones by buckets.
ONE_TASK_ENTRIES = 100_000
SALTS = 16
# The most frequent misses of the head are looked up inline as well; a sketch of this many
# items finds them, so that no other item has more than a few of 10,000 of all misses.
HOT_MISSES, SKETCHED = 1_000, 10_000


def token_counts(df: DataFrame, tokens: str) -> DataFrame:
    """(token, n) over all rows. Counts are combined per task before the exchange, so a
    very common token is no hot key. (``explode_outer`` keeps the optimizer from adding
    a filter that would evaluate the token expression a second time.)"""
    exploded = df.select(F.explode_outer(tokens).alias("token"))
    return exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("token is not null")


def build_vocab(
    df: DataFrame, tokens: str, size: int, special: SpecialIds = SpecialIds()
) -> DataFrame:
    """(token, id, n) of the ``size`` most frequent tokens, ties in token order.

    Ids follow the special ids by falling frequency. A histogram of magnitudes first
    drops the tokens that cannot be among the chosen ones, so the final top-``size``
    step sees little more than it keeps. Beyond ``ONE_TASK_ENTRIES`` that step numbers
    buckets of tokens side by side; the vocabulary is the same.
    """
    refuse_stream(df, "build_vocab")
    if size < 1:
        raise ValueError("size must be at least 1")
    counts = cut_lineage(token_counts(df, tokens))
    magnitude = F.floor(F.log2("n"))
    histogram = counts.groupBy(magnitude.alias("m")).agg(F.count(F.lit(1)).alias("kinds"))
    least, kept = 0, 0
    for row in sorted(histogram.collect(), key=lambda r: -r["m"]):
        least, kept = row["m"], kept + row["kinds"]
        if kept >= size:
            break
    if size > ONE_TASK_ENTRIES:
        likely = counts.filter(magnitude >= least).withColumn("_rank", -F.col("n"))
        placed = cap(with_ordinal(likely, ["_rank", "token"]), size)
        return placed.select("token", (F.col(ORD) + special.first_free).cast("int").alias("id"), "n")
    top = counts.filter(magnitude >= least).orderBy(F.desc("n"), "token").limit(size)
    place = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    return top.select(
        "token", (place + special.first_free - 1).cast("int").alias("id"), "n"
    )


def _tier(vocab: DataFrame, inline: int, broadcast: int) -> tuple[str, int]:
    """How a vocabulary is used, and its entries (one job over the vocabulary)."""
    size = vocab.agg(
        F.count(F.lit(1)).alias("entries"),
        F.coalesce(F.sum(F.octet_length("token").cast("bigint")), F.lit(0)).alias("bytes"),
    ).first()
    if size["entries"] <= inline and size["bytes"] <= INLINE_BYTES:
        return "inline", size["entries"]
    if size["entries"] <= broadcast and size["bytes"] <= BROADCAST_BYTES:
        return "broadcast", size["entries"]
    return "join", size["entries"]


def _inline_table(
    head: DataFrame, key: str, value: str, kind: str, entries: int
) -> tuple[Column, int]:
    """Hashed literal of at most ``entries`` rows of ``head``; keys are looked up as text."""
    slots = slot_count(entries)
    table: list[dict] = [{} for _ in range(slots)]
    text = F.col(key).cast("string")
    for row in head.select(text.alias("k"), F.col(value).alias("v"), slot_of(text, slots).alias("slot")).collect():
        table[row["slot"]][row["k"]] = row["v"]
    return F.from_json(F.lit(json.dumps(table)), f"array<map<string,{kind}>>"), slots


def _known(head: DataFrame, key: str, value: str, kind: str, entries: int) -> Callable[[Column], Column]:
    table, slots = _inline_table(head, key, value, kind, entries)
    return lambda item: hashed_lookup(table, slots, item.cast("string"))


def _swap_in_batches(
    df: DataFrame, column: str, mapping: DataFrame, missing: int | None, out: str, kind: T.DataType
) -> DataFrame:
    """Replace the elements of ``column`` through ``mapping(item, value)``, which goes to
    every task: the caller has checked its size. Whole Arrow batches are looked up at once;
    rows are neither moved nor told apart, so keys play no part and streams work as well.
    Elements without a value become ``missing``, or are left out where that is None.
    """
    rows = mapping.select("item", "value").collect()
    shared = df.sparkSession.sparkContext.broadcast(([r["item"] for r in rows], [r["value"] for r in rows]))
    kept = [f for f in df.schema.fields if f.name not in (column, out)]
    shape = T.StructType([*kept, T.StructField(out, T.ArrayType(kind))])
    item_type = to_arrow_type(df.schema[column].dataType.elementType)
    arrow = to_arrow_schema(shape)

    def swap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, values = shared.value
        lists = pa.list_(arrow.field(out).type.value_type)
        known = pa.array(items, item_type)
        found = pa.array(values, lists.value_type)
        for batch in batches:
            array = batch.column(batch.schema.get_field_index(column))
            parents = pc.list_parent_indices(array)
            swapped = pc.take(found, pc.index_in(pc.list_flatten(array), value_set=known))
            if missing is not None:
                swapped = pc.fill_null(swapped, missing)
            else:
                full = pc.is_valid(swapped)
                swapped, parents = pc.filter(swapped, full), pc.filter(parents, full)
            sizes = np.bincount(parents.to_numpy(), minlength=len(array))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
            mask = pc.is_null(array)
            made = pa.ListArray.from_arrays(pa.array(offsets), swapped, type=lists, mask=mask)
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*arrays, made.cast(arrow.field(out).type)], schema=arrow)

    return df.mapInArrow(swap, shape)


def _swap_by_misses(
    df: DataFrame, column: str, mapping: DataFrame, known, missing: Column | None, out: str
) -> DataFrame:
    """Frequent elements are looked up inline; only the others meet ``mapping(item, value)``.

    Rows get a number and are written once, so they are told apart whatever their keys are.
    The misses that are common in this very table, whether the mapping has them or not, are
    found by a sketch and looked up inline, too; what is left is spread over ``SALTS`` tasks.
    """
    refuse_stream(df, "a vocabulary beyond the broadcast size (use pack_stream or foreachBatch)")
    others = [c for c in df.columns if c not in (column, out)]
    look = lambda x, i: F.struct(i.alias("pos"), known(x).alias("value"), x.alias("item"))
    coded = land(
        df.select(*others, F.transform(column, look).alias("_coded")).withColumn(
            "_row", F.monotonically_increasing_id()
        )
    )
    missed = F.filter("_coded", lambda c: c["value"].isNull() & c["item"].isNotNull())
    misses = coded.select("_row", F.explode(missed).alias("_miss")).select("_row", "_miss.pos", "_miss.item")
    hot, answer = _hot_misses(misses, mapping)
    misses = misses.filter(~F.col("item").isin(hot)) if hot else misses
    salted = misses.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)))
    wanted = misses.select("item").distinct()
    spread = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    copies = mapping.join(wanted, "item", "left_semi").withColumn("_salt", F.explode(spread))
    found = (
        salted.join(copies, ["item", "_salt"])
        .groupBy("_row")
        .agg(F.collect_list(F.struct("pos", "value")).alias("_found"))
    )
    values = F.map_from_entries(F.coalesce("_found", F.expr("array()").cast(_entries(mapping))))
    # The outer one-element ``transform`` binds the map: it is made once a row, not once an element.
    fill = lambda late: F.transform("_coded", lambda c: F.coalesce(c["value"], answer(c["item"]), late[c["pos"]]))
    merged = F.get(F.transform(F.array(values), fill), F.lit(0))
    swapped = F.transform(merged, lambda v: F.coalesce(v, missing)) if missing is not None else F.filter(merged, lambda v: v.isNotNull())
    return coded.join(found, "_row", "left").select(*others, swapped.alias(out))


def _hot_misses(misses: DataFrame, mapping: DataFrame) -> tuple[list, Callable[[Column], Column]]:
    """The most frequent missed items (at most ``HOT_MISSES``, none of them long), and what
    looks up their values. Counting is combined per task; a sketch is bounded."""
    counted = F.call_function("approx_top_k", F.col("item"), F.lit(HOT_MISSES), F.lit(SKETCHED))
    top = misses.filter(F.octet_length(F.col("item").cast("string")) <= HEAD_TOKEN_BYTES).agg(counted.alias("top"))
    hot = [r["item"] for r in top.first()["top"] or []]
    found = mapping.filter(F.col("item").isin(hot)) if hot else mapping.limit(0)
    kind = mapping.schema["value"].dataType.simpleString()
    return hot, _known(found, "item", "value", kind, max(len(hot), 1))


def _entries(mapping: DataFrame) -> str:
    return f"array<struct<pos:int,value:{mapping.schema['value'].dataType.simpleString()}>>"


def encode_vocab(
    df: DataFrame,
    tokens: str,
    vocab: DataFrame,
    keys: Sequence[str] = (),
    out: str = "input_ids",
    special: SpecialIds = SpecialIds(),
    inline: int = INLINE_ENTRIES,
    broadcast: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """Replace ``tokens`` by ids, ``unk`` where the vocabulary lacks one.

    The result does not depend on the size of the vocabulary: each row keeps its other
    columns, a NULL array stays NULL, a NULL element is unknown, and rows may repeat. Only
    the way depends on it, which is measured first. Up to ``inline`` entries become a
    hashed constant, and encoding is part of the scan stage. Up to ``broadcast`` entries go
    to every task and are looked up in Arrow batches. (Both have a limit in bytes, too.)
    Beyond, the most frequent entries are inline and the misses are joined. Streams take the
    first two ways. ``keys`` is kept for callers that name a row's key; nothing needs it.
    """
    tier, entries = _tier(vocab, inline, broadcast)
    unk = F.lit(special.unk)
    mapping = vocab.select(F.col("token").alias("item"), F.col("id").cast("int").alias("value"))
    if tier == "broadcast":
        return _swap_in_batches(df, tokens, mapping, special.unk, out, T.IntegerType())
    head = vocab if tier == "inline" else vocab.filter(F.octet_length("token") <= HEAD_TOKEN_BYTES)
    known = _known(head.orderBy("id").limit(inline), "token", "id", "int", min(entries, inline))
    if tier == "inline":
        ids = F.transform(tokens, lambda t: F.coalesce(known(t), unk))
        return df.withColumn("_ids", ids).drop(tokens).withColumnRenamed("_ids", out)
    return _swap_by_misses(df, tokens, mapping, known, unk, out)


def decode_vocab(
    df: DataFrame,
    ids: str,
    vocab: DataFrame,
    keys: Sequence[str] = (),
    out: str = "text",
    inline: int = INLINE_ENTRIES,
    broadcast: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """Ids back to tokens, joined by blanks; special and unknown ids are left out, a NULL
    array gives NULL. The ways are those of :func:`encode_vocab`, for any size and any ids.
    """
    tier, entries = _tier(vocab, inline, broadcast)
    mapping = vocab.select(F.col("id").cast("int").alias("item"), F.col("token").alias("value"))
    if tier == "broadcast":
        found = _swap_in_batches(df, ids, mapping, None, "_tokens", T.StringType())
        return found.withColumn(out, F.array_join("_tokens", " ")).drop("_tokens")
    head = vocab if tier == "inline" else vocab.filter(F.octet_length("token") <= HEAD_TOKEN_BYTES)
    known = _known(head.orderBy("id").limit(inline), "id", "token", "string", min(entries, inline))
    if tier == "inline":
        text = F.array_join(F.transform(ids, known), " ")
        return df.withColumn("_text", text).drop(ids).withColumnRenamed("_text", out)
    found = _swap_by_misses(df, ids, mapping, known, None, "_tokens")
    return found.withColumn(out, F.array_join("_tokens", " ")).drop("_tokens")
