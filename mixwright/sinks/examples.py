"""Example shards and metric files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mixwright.functions.numbers import whole_div
from mixwright.operators.mixing import EXAMPLE_COLUMNS, padded, rounded
from mixwright.schema import ORD, SPLIT, SpecialIds, ones_like, refuse_stream

# Rows of a shard: about 100 MB of Parquet at 1024 ids a row.
SHARD_ROWS = 50_000
# Rows, and about how many ids, that one task sorts and writes as one file of a shard.
TASK_ROWS, TASK_IDS = 8_192, 8_388_608
# How files are written where Spark's own choice is not taken. Plain JSON has ten bytes for an id of
# a block, as mask and labels repeat what the ids say; a fast level of gzip finds the repeats as well.
FILE_OPTIONS = {"json": {"compression": "gzip", "zlib.compress.level": "THREE"}}
# Ordinals up to this many become a list of values in the plan; more are joined.
MOST_ORDINALS = 10_000


def write_examples(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    shards: int | None = None,
    rows: Mapping[str, int] | None = None,
    pad: Padding | None = None,
    watch: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
    task_rows: int = TASK_ROWS,
    placed: bool = False,
) -> dict[str, int]:
    """Write examples as ``split=<name>/shard=<i>`` with files of consecutive rows.

    A shard is one file up to ``task_rows`` rows (or one padded batch, if that is more); a
    larger one is written by several tasks, a file each, so what a task holds depends neither
    on the table nor on the number of shards. Shards are cut by arithmetic on ``ord``. (A range repartition would first run the whole
    plan once more, to sample it.) Tables without a split are written as ``train``. ``rows``
    gives the number of rows per split where it is known; else ``ord`` is looked at first.
    ``shards`` is the number for each split; by default a shard has ``SHARD_ROWS`` rows. How
    rows are found again is kept beside the shards (see :func:`rows_at`).

    With ``placed`` rows are written where they lie, without an exchange: for rows that the
    ordering functions placed, whose tasks hold runs of consecutive ordinals. A shard then has
    a file for each such task that has rows of it.

    JSON files are compressed (``.json.gz``); Spark reads them as it reads plain ones, each
    in one task.

    Of the arrays, the ids travel, in one or two bytes each where all of a row fit. A mask of
    ones and labels that equal the ids, as all corpus blocks have them, are made again after
    the exchange. With ``pad``, shards hold whole batches, which are padded after that same
    exchange.

    ``watch`` names aggregates of the rows as they are before padding; their values are
    returned. They are observed in the tasks that write, after any exchange, so a task that
    is run again does not count twice, and no plan is run for them. ``drop`` names columns
    that only ``watch`` needs.
    """
    refuse_stream(df, "write_examples")
    if placed and pad is not None:
        raise ValueError("padded batches may lie over the rows of two tasks: they need the exchange")
    if fmt not in ("parquet", "json"):
        raise ValueError(f"fmt must be 'parquet' or 'json', not {fmt!r}")
    if SPLIT not in df.columns:
        df = df.withColumn(SPLIT, F.lit("train"))
    if rows is None:
        tops = df.groupBy(SPLIT).agg(F.max(ORD).alias("top")).collect()
        rows = {r[SPLIT]: r["top"] + 1 for r in tops}
    if task_rows < 1:
        raise ValueError("task_rows must be at least 1")
    shard = F.lit(None).cast("bigint")
    target = F.lit(None).cast("bigint")
    before = 0
    sizes = {}
    for name in sorted(name for name, n in rows.items() if n > 0):
        per_shard = SHARD_ROWS if shards is None else -(-rows[name] // shards)
        if pad is not None:
            per_shard = -(-per_shard // pad.batch_size) * pad.batch_size
        per_task = min(per_shard, task_rows if pad is None else -(-task_rows // pad.batch_size) * pad.batch_size)
        pieces = -(-per_shard // per_task)
        sizes[name] = per_shard
        number = whole_div(F.col(ORD), per_shard)
        here = F.col(SPLIT) == name
        shard = F.when(here, number).otherwise(shard)
        piece = whole_div(F.col(ORD) - number * per_shard, per_task)
        target = F.when(here, number * pieces + piece + before).otherwise(target)
        before += -(-rows[name] // per_shard) * pieces
    narrow, full, flags = _made_again(df)
    moved = df.withColumns({"shard": shard.cast("int"), "_target": target.cast("int"), **narrow})
    if not placed:
        small, wide = _smaller(df)
        moved = moved.withColumns(small).repartitionById(max(before, 1), F.col("_target"))
        moved = moved.withColumns(wide).drop(*[c for c in small if c not in wide])
    seen = {}
    if watch:
        observed = Observation()
        moved = moved.observe(observed, *[column.alias(name) for name, column in watch.items()])
    moved = moved.drop(*drop)
    if pad is not None:
        moved = _with_widths(moved, pad)
    # Sorted as they travelled; what is made again is made after.
    moved = moved.sortWithinPartitions(SPLIT, "shard", ORD).withColumns(full)
    if pad is not None:
        others = [c for c in moved.columns if c not in (*EXAMPLE_COLUMNS, "_n")]
        moved = padded(moved, others, pad.special)
    (
        moved.drop("_target", *flags)
        .write.mode("overwrite")
        .partitionBy(SPLIT, "shard")
        .format(fmt)
        .options(**FILE_OPTIONS.get(fmt, {}))
        .save(path)
    )
    if watch:
        seen = dict(observed.get)
    index = [(name, sizes[name], rows[name], fmt) for name in sizes]
    _small(df.sparkSession, index, _INDEX_SCHEMA).write.mode("overwrite").json(_index_path(path))
    return seen


@dataclass(frozen=True)
class Padding:
    """How many consecutive rows are padded to one width, and what the width is a multiple of."""

    batch_size: int
    multiple: int = 8
    special: SpecialIds = SpecialIds()


def _with_widths(moved: DataFrame, pad: Padding) -> DataFrame:
    """Batches lie inside what one task writes: nothing travels."""
    rows = moved.withColumn("batch_id", whole_div(F.col(ORD), pad.batch_size)).withColumn("_n", F.size("input_ids"))
    longest = F.max("_n").over(Window.partitionBy("_target", "batch_id"))
    return rows.withColumn("width", rounded(longest, pad.multiple))


_INDEX_SCHEMA = "split string, shard_rows bigint, n_rows bigint, fmt string"


def _index_path(path: str) -> str:
    return f"{path.rstrip('/')}/_index"


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a few rows that the driver has, as one file."""
    return spark.createDataFrame(rows, schema).coalesce(1)


def rows_at(spark: SparkSession, path: str, ordinals: Sequence[int], split: str = "train") -> DataFrame:
    """The rows of a written set with the given ordinals.

    Shards have equal numbers of rows, so arithmetic names the shards that hold them: only
    their files are opened, whatever the size of the set. Ordinals beyond the set are an error.
    """
    found = [r for r in spark.read.schema(_INDEX_SCHEMA).json(_index_path(path)).collect() if r["split"] == split]
    if not found:
        raise ValueError(f"no split {split!r} in {path}")
    index = found[0]
    outside = [i for i in ordinals if not 0 <= i < index["n_rows"]]
    if outside:
        raise IndexError(f"the split has {index['n_rows']} rows, not {outside[0]}")
    wanted = sorted(set(ordinals))
    shards = sorted({i // index["shard_rows"] for i in wanted}) or [0]
    files = [f"{path.rstrip('/')}/split={split}/shard={s}" for s in shards]
    rows = spark.read.format(index["fmt"]).option("basePath", path).load(files)
    if len(wanted) <= MOST_ORDINALS:
        return rows.filter(F.col(ORD).isin(wanted))
    return rows.join(spark.createDataFrame([(i,) for i in wanted], f"{ORD} bigint"), ORD, "left_semi")


def _made_again(df: DataFrame) -> tuple[dict[str, Column], dict[str, Column], list[str]]:
    """What replaces mask and labels on the way, what makes them again, and the flags that
    say where: a NULL stays a NULL, and tables may lack any of the arrays."""
    ids = F.col("input_ids")
    implied = {"attention_mask": ones_like(ids), "labels": ids}
    present = [c for c in implied if c in df.columns and "input_ids" in df.columns]
    narrow, full = {}, {}
    for name in present:
        same = F.col(name).eqNullSafe(implied[name])
        narrow |= {f"_same_{name}": same, name: F.when(~same, F.col(name))}
        full[name] = F.when(F.col(f"_same_{name}"), implied[name]).otherwise(F.col(name))
    return narrow, full, [f"_same_{name}" for name in present]


# Types in which ids may travel, smallest first, and the largest value of each.
_SMALLER = {"tinyint": 127, "smallint": 32_767}


def _smaller(df: DataFrame) -> tuple[dict[str, Column], dict[str, Column]]:
    """What carries integer arrays in the smallest type that holds a row's values, and what
    makes them again. What fits none of the types travels as it is."""
    small, wide = {}, {}
    for name in ("input_ids", "labels"):
        if name not in df.columns or df.schema[name].dataType.simpleString() != "array<int>":
            continue
        left = F.col(name)
        for kind, top in _SMALLER.items():
            fits = F.coalesce((F.array_max(name) <= top) & (F.array_min(name) >= -top), F.lit(True))
            small[f"_{kind}_{name}"] = F.when(fits, left.cast(f"array<{kind}>"))
            left = F.when(~fits, left)
        small[name] = left
        wide[name] = F.coalesce(*[F.col(f"_{kind}_{name}").cast("array<int>") for kind in _SMALLER], name)
    return small, wide


def write_metrics(df: DataFrame, path: str) -> None:
    """Keep a report as JSON. A one-row report is one file as it is."""
    df.write.mode("overwrite").json(path)
