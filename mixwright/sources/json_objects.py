"""JSON files cut anywhere: arrays of objects, objects on lines, or both in one folder.

A file is read by Spark's own text reader as records that end at a closing brace, so it is
split by byte ranges like any text, no file is opened on the driver, and no file has to be
known as an array or as lines beforehand: a row is an object that no other object holds.

Whether a brace is inside a string, and how deep it lies, depends on all that comes before
it. A first scan therefore sums, for each byte range, what it does to that state from either
possible start: the parity of quotes, the change of depth and its lowest point. Prefix sums
over the ranges of a file give the state at the start of each range. The second scan starts
each range from its state and gives whole objects; an object over the end of a range comes in
fragments, which alone are brought together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from mixwright.session import land

# Byte ranges whose states are broadcast (some 100 bytes each); beyond, they are joined.
BROADCAST_RANGES = 200_000
_ESCAPED = re.compile(r"\\.", re.DOTALL)
# Records that are Python values at once, and characters of objects that are sent back at once.
SLICE_RECORDS, SENT_CHARS = 256, 4_000_000
_BETWEEN = re.compile(r"[\s,\[\]﻿]*")


def _effect(record: str) -> tuple[int, int, int]:
    """Quotes, and opening braces outside of strings if the record starts outside, or inside."""
    parts = (_ESCAPED.sub("", record) if "\\" in record else record).split('"')
    return len(parts) - 1, "".join(parts[::2]).count("{"), "".join(parts[1::2]).count("{")


def _after(record: str, inside: int, depth: int) -> tuple[int, int]:
    """State after a record and the brace that ends it."""
    quotes, from_outside, from_inside = _effect(record)
    depth += from_inside if inside else from_outside
    inside = (inside + quotes) & 1
    return inside, depth if inside else depth - 1


_SUMS = "path string, block bigint, file_size bigint, bytes bigint, parity int, d0 bigint, m0 bigint, d1 bigint, m1 bigint"


def _records(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple]:
    """Rows of the batches; few of them are Python values at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_RECORDS):
            part = batch.slice(at, SLICE_RECORDS)
            yield from zip(*(part.column(name).to_pylist() for name in names))


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], shape: str) -> pa.RecordBatch:
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in (part.split() for part in shape.split(", "))])
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each byte range that the task reads: rows of a range are consecutive."""
    sums: dict[tuple, list] = {}
    for path, block, size, n, record in _records(batches, ("path", "block", "file_size", "octets", "value")):
        at = sums.setdefault((path, block, size), [0, [0, 0, 0], [1, 0, 0]])
        at[0] += n + 1
        for state in at[1:]:
            state[0], state[1] = _after(record, state[0], state[1])
            state[2] = min(state[2], state[1])
    yield _batch([(*key, n, a[0], a[1], a[2], b[1], b[2]) for key, (n, a, b) in sums.items()], _SUMS)


def _starts(records: DataFrame) -> DataFrame:
    """(path, block, inside, depth, opener, open_end): state at the start of each range, the
    range in which an object that is open there began, and whether the file's last record
    lacks its closing brace."""
    sums = records.mapInArrow(_summarise, _SUMS)
    file = Window.partitionBy("_path").orderBy("_block")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    named = sums.withColumnsRenamed({"path": "_path", "block": "_block"})
    inside = F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2
    with_inside = named.withColumn("inside", inside.cast("int"))
    change, lowest = (F.when(F.col("inside") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in "dm")
    with_depth = with_inside.withColumns({"change": change, "lowest": lowest}).withColumn(
        "depth", F.coalesce(F.sum("change").over(before), F.lit(0))
    )
    begins = (F.col("depth") == 0) | (F.col("depth") + F.col("lowest") <= 0)
    opener = F.max(F.when(begins, F.col("_block"))).over(before)
    whole = Window.partitionBy("_path")
    last = F.col("_block") == F.max("_block").over(whole)
    # Each record counts one byte for its brace; the reader leaves out a byte order mark (3).
    unclosed = (F.sum("bytes").over(whole) - F.col("file_size")).isin(1, 1 - 3)
    return with_depth.select(
        "_path", "_block", "inside", "depth", opener.alias("opener"), (last & unclosed).alias("open_end")
    )


_FOUND = "path string, block bigint, line bigint, opener bigint, closed boolean, json string"


_TOLD = ("path", "block", "line", "value", "inside", "depth", "opener", "open_end")


def _objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Objects, and the fragments of those that go over the end of a range (``opener`` is
    the range in which they begin)."""
    at = None  # the range being read
    held: list[str] = []  # records of the open object
    inside = depth = first = 0
    carried = False  # the open object began in an earlier range
    waiting = None  # the last record, which may be the last of its file
    out: list[tuple] = []
    made = 0  # characters in ``out``

    def malformed(what: str) -> ValueError:
        return ValueError(f"Malformed JSON in {at['path']}: {what}")

    def take(line: int, record: str, last: bool) -> None:
        nonlocal inside, depth, first, carried, made
        if last and at["open_end"]:  # nothing but what may follow the last object
            if held or not _BETWEEN.fullmatch(record):
                raise malformed("the file ends inside a value")
            return
        if depth == 0 and not held:
            begin = record.find("{")
            if begin < 0 or not _BETWEEN.fullmatch(record, 0, begin):
                raise malformed("rows must be objects")
            record, first = record[begin:], line
        held.append(record + "}")
        inside, depth = _after(record, inside, depth)
        if depth == 0 and not inside:
            opener = at["opener"] if carried else None
            out.append((at["path"], at["block"], first, opener, True, "".join(held)))
            made += len(out[-1][-1])
            held.clear()
            carried = False

    def leave() -> None:
        """End of a range."""
        if waiting is not None:
            take(*waiting, True)
        if at is not None and held:
            opener = at["opener"] if carried else at["block"]
            out.append((at["path"], at["block"], first, opener, False, "".join(held)))
            held.clear()

    for path, block, line, record, starts_inside, starts_depth, opener, open_end in _records(batches, _TOLD):
        if at is None or (path, block) != (at["path"], at["block"]):
            leave()
            if starts_inside is None:
                raise ValueError("byte ranges changed between two scans: try again")
            at = {"path": path, "block": block, "open_end": bool(open_end), "opener": opener}
            inside, depth, first, waiting = starts_inside, starts_depth, line, None
            carried = depth > 0
        elif waiting is not None:
            take(*waiting, False)
        waiting = (line, record)
        if made > SENT_CHARS:
            yield _batch(out, _FOUND)
            out.clear()
            made = 0
    leave()
    yield _batch(out, _FOUND)


def scan_json_objects(spark: SparkSession, path: str, schema: StructType, glob: str | None = None) -> DataFrame:
    """Rows of the objects in JSON files: the fields of ``schema``, ``path``, ``block_start``
    and ``line`` (see :mod:`mixwright.sources.files`).

    Objects may stand in arrays or follow one another, in any mixture of files. A file that
    ends inside a value, a row that is no object, or an object that does not parse is an
    error. An object is held whole by one task. The rows are stored at once, so both scans
    cut the files alike.
    """
    reader = spark.read.option("lineSep", "}").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    records = reader.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("line"),
        F.octet_length("value").alias("octets"),
        "value",
    )
    starts = land(_starts(records))
    found = (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block"))
    if starts.count() <= BROADCAST_RANGES:
        placed = records.join(F.broadcast(starts), found, "left")
    else:
        moved = records.join(starts, found, "left").repartition("path", "block")
        placed = moved.sortWithinPartitions("path", "block", "line")
    told = placed.select(*_TOLD)
    pieces = land(told.mapInArrow(_objects, _FOUND))
    whole = pieces.filter("opener is null").select("path", "block", "line", "json")
    parts = F.sort_array(F.collect_list(F.struct("block", "line", "json", "closed")))
    joined = (
        pieces.filter("opener is not null").groupBy("path", "opener").agg(parts.alias("parts"))
        .withColumn("closed", F.element_at("parts", -1)["closed"])
    )
    cut = F.raise_error(F.concat(F.lit("Malformed JSON in "), "path", F.lit(": the file ends inside an object")))
    text = F.when(F.col("closed"), F.array_join("parts.json", "")).otherwise(cut)
    first = F.get("parts", F.lit(0))
    fragments = joined.select("path", first["block"].alias("block"), first["line"].alias("line"), text.alias("json"))
    objects = whole.unionByName(fragments)
    parsed = F.from_json("json", schema, {"mode": "FAILFAST"})
    return objects.select(
        parsed.alias("row"), "path", F.col("block").alias("block_start"), "line"
    ).select("row.*", "path", "block_start", "line")
