"""Row order, percent split, caps and seeded shuffle at table scale.

Spark rows have no position, so a position is the rank of a unique key. Nothing here
sorts the table in one task and nothing needs a persisted copy:

1. two or three passes over the *key columns only* find the exact keys that start each
   bucket of consecutive rows (at most ``MAX_BUCKETS`` values reach the driver);
2. those keys are constants of the final plan, which sends each row to its bucket with
   one exchange and numbers it there.

The plan depends on the table and the constants alone, so a task that is run again
after an executor is lost gives the same numbers. Keys are integers or short strings.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from mixwright.functions.lookup import literal_array, locate
from mixwright.schema import BUCKET, ORD, SPLIT, refuse_stream

MAX_BUCKETS = 32_768
BUCKET_ROWS = 100_000
MIN_BUCKET_ROWS = 8_000
SAMPLES_PER_BUCKET = 16
# Where rows have lengths, the sum of lengths that a bucket is to hold at most.
BUCKET_LENGTH = 64_000_000
# Hexadecimal digits of a digest that make a cell of its histogram.
CELL_DIGITS = 4
# Up to this many keys are ranked by one task; beyond, the ranking is range partitioned.
ONE_TASK_KEYS = 200_000

_KEY_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType)


def _key(keys: Sequence[str]) -> Column:
    return F.col(keys[0]) if len(keys) == 1 else F.struct(*[F.col(k) for k in keys])


def _key_type(df: DataFrame, keys: Sequence[str]) -> str:
    types = [df.schema[k].dataType for k in keys]
    for name, kind in zip(keys, types):
        if not isinstance(kind, _KEY_TYPES):
            raise TypeError(f"key {name} must be integral or string, not {kind.simpleString()}")
    if len(keys) == 1:
        return types[0].simpleString()
    fields = (f"`{name}`:{kind.simpleString()}" for name, kind in zip(keys, types))
    return f"struct<{','.join(fields)}>"


def _plain(values: Sequence, keys: Sequence[str]):
    """A key as it is written into a literal."""
    return values[0] if len(keys) == 1 else dict(zip(keys, values))


def _approximate_bounds(narrow: DataFrame, keys: Sequence[str], rows: int) -> list:
    buckets = min(MAX_BUCKETS, -(-rows // ONE_TASK_KEYS))
    fraction = min(1.0, SAMPLES_PER_BUCKET * buckets / rows)
    sample = [tuple(r) for r in narrow.sample(fraction, seed=7).sort(*keys).collect()]
    picks = [sample[i * len(sample) // buckets] for i in range(1, buckets)] if sample else []
    return list(dict.fromkeys(picks))


def keys_at_ranks(
    df: DataFrame, keys: Sequence[str], rows: int, ranks: Sequence[int]
) -> list[tuple]:
    """Key values at the given ascending ranks (0-based), at most ``MAX_BUCKETS`` of them.

    Reads only the key columns. The ranks are broadcast and the hits collected, which that
    number bounds.
    """
    keys = list(keys)
    if not ranks:
        return []
    if len(ranks) > MAX_BUCKETS:
        raise ValueError(f"at most {MAX_BUCKETS} ranks, not {len(ranks)}")
    narrow = df.select(*keys)
    kind = _key_type(df, keys)
    cuts = _approximate_bounds(narrow, keys, rows) if rows > ONE_TASK_KEYS else []
    bounds = literal_array([_plain(c, keys) for c in cuts], kind)
    placed = narrow.withColumn("_part", locate(bounds, len(cuts), _key(keys)))
    firsts = [0]
    if cuts:
        found = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()
        sizes = {r["_part"]: r["n"] for r in found}
        firsts = [0, *accumulate(sizes.get(i, 0) for i in range(len(cuts)))]
        used = {bisect_right(firsts, r) - 1 for r in ranks}
        if len(used) < len(firsts):
            wanted = literal_array([i in used for i in range(len(firsts))], "boolean")
            placed = placed.filter(F.get(wanted, F.col("_part")))
    in_part = Window.partitionBy("_part").orderBy(*keys)
    first = F.get(literal_array(firsts, "bigint"), F.col("_part"))
    ranked = placed.select(*keys, (first + F.row_number().over(in_part) - 1).alias("_rank"))
    targets = df.sparkSession.range(1).select(F.explode(literal_array(ranks, "bigint")).alias("_rank"))
    hits = ranked.join(F.broadcast(targets), "_rank")
    at = {r["_rank"]: tuple(r[k] for k in keys) for r in hits.collect()}
    if len(at) != len(ranks):
        raise RuntimeError("the table changed while its keys were being ranked")
    return [at[r] for r in ranks]


@dataclass(frozen=True)
class Layout:
    """Buckets of consecutive rows: bucket ``i`` starts at rank ``starts[i]`` with key
    ``bounds[i - 1]``; ``sections`` are the ranks at which numbering restarts."""

    keys: tuple[str, ...]
    kind: str
    rows: int
    sections: tuple[int, ...]
    starts: tuple[int, ...]
    bounds: tuple[tuple, ...]
    by: tuple[str, ...] = ()  # the leading keys that bounds are made of; all by default

    @property
    def buckets(self) -> int:
        return len(self.starts)

    @property
    def key(self) -> Column:
        return _key(self.keys)

    def bounds_literal(self) -> Column:
        return literal_array([_plain(b, self.by or self.keys) for b in self.bounds], self.kind)

    def bucket(self) -> Column:
        return locate(self.bounds_literal(), len(self.bounds), _key(self.by or self.keys))

    def section_of(self, bucket: int) -> int:
        return bisect_right(self.sections, self.starts[bucket]) - 1

    def first_ordinals(self) -> list[int]:
        """Ordinal, within its section, of the first row of each bucket."""
        return [s - self.sections[self.section_of(i)] for i, s in enumerate(self.starts)]


def lay_out(
    df: DataFrame,
    keys: Sequence[str],
    align: int = 1,
    cut: int = 0,
    rows: int | None = None,
    min_rows: int = MIN_BUCKET_ROWS,
    max_rows: int = BUCKET_ROWS,
    length: str | None = None,
    max_length: int = BUCKET_LENGTH,
) -> Layout:
    """Find the buckets of ``df`` ordered by ``keys``.

    Each bucket holds a multiple of ``align`` rows (the last of a section excepted), so
    groups of ``align`` consecutive rows never span buckets. ``cut`` starts a second
    section. Small tables get buckets of at least ``min_rows``, others of at most
    ``max_rows`` (as long as ``MAX_BUCKETS`` suffice).

    With ``length``, a column with the size of each row, buckets are cut by size: a bucket
    ends with the group of ``align`` rows that takes it to ``max_length`` (or to ``max_rows``
    rows), so it holds less than ``max_length`` and one group more, however uneven rows are.
    """
    refuse_stream(df, "ordering rows")
    keys = list(keys)
    if rows is None:
        rows = df.select(*keys).count()
    sections = tuple(sorted({0, cut})) if 0 < cut < rows else (0,)
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    if length is not None and rows:
        starts, bounds = _starts_by_length(df, keys, align, sections, rows, tasks, min_rows, max_rows, length, max_length)
        return Layout(tuple(keys), _key_type(df, keys), rows, sections, tuple(starts), tuple(bounds))
    size = max(min(max_rows, -(-rows // tasks)), min_rows, -(-rows // (MAX_BUCKETS - 1)))
    size = -(-size // align) * align
    ends = (*sections[1:], rows)
    starts = [r for lo, hi in zip(sections, ends) for r in range(lo, hi, size)] or [0]
    bounds = keys_at_ranks(df, keys, rows, starts[1:])
    return Layout(
        tuple(keys), _key_type(df, keys), rows, sections, tuple(starts), tuple(bounds)
    )


def _starts_by_length(
    df: DataFrame,
    keys: list[str],
    align: int,
    sections: Sequence[int],
    rows: int,
    tasks: int,
    min_rows: int,
    max_rows: int,
    length: str,
    max_length: int,
) -> tuple[list[int], list[tuple]]:
    """Ranks and keys at which buckets start.

    Lengths are summed by key range first; ranges are then ranked side by side, each with
    running sums that go on from the ranges before it. The first row of a group whose
    running sums pass a multiple of the bucket size starts a bucket, so only these rows
    (at most ``MAX_BUCKETS``) reach the driver.
    """
    narrow = df.select(*keys, F.col(length).cast("bigint").alias("_n"))
    cuts = _approximate_bounds(narrow, keys, rows) if rows > ONE_TASK_KEYS else []
    part = locate(literal_array([_plain(c, keys) for c in cuts], _key_type(df, keys)), len(cuts), _key(keys))
    placed = narrow.withColumn("_part", part)
    sums = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("rows"), F.sum("_n").alias("n")).collect()
    found = {r["_part"]: (r["rows"], r["n"]) for r in sums}
    parts = [found.get(i, (0, 0)) for i in range(len(cuts) + 1)]
    total = sum(n for _, n in parts)
    unit = max(min(max_length, -(-total // tasks)), -(-total * min_rows // rows), -(-2 * total // MAX_BUCKETS), 1)
    most_rows = max(max_rows, -(-2 * rows // MAX_BUCKETS))
    first_rank = [0, *accumulate(r for r, _ in parts)][:-1]
    first_sum = [0, *accumulate(n for _, n in parts)][:-1]
    in_part = Window.partitionBy("_part").orderBy(*keys)
    rank = F.get(literal_array(first_rank, "bigint"), F.col("_part")) + F.row_number().over(in_part) - 1
    upto = F.sum("_n").over(in_part.rowsBetween(Window.unboundedPreceding, 0))
    before = F.get(literal_array(first_sum, "bigint"), F.col("_part")) + upto - F.col("_n")
    ranked = placed.select(_key(keys).alias("_key"), rank.alias("_rank"), before.alias("_before"))
    section = F.lit(0) if len(sections) == 1 else F.when(F.col("_rank") >= sections[1], sections[1]).otherwise(0)
    edges = (
        ranked.withColumn("_section", section.cast("bigint"))
        .filter((F.col("_rank") - F.col("_section")) % align == 0)
        .groupBy("_section", F.floor(F.col("_before") / unit + F.col("_rank") / most_rows).alias("_slot"))
        .agg(F.min(F.struct("_rank", "_key")).alias("e"))
    )
    at = sorted((r["e"]["_rank"], r["e"]["_key"]) for r in edges.collect())
    if not at or at[0][0] != 0:
        raise RuntimeError("the table changed while its keys were being ranked")
    return [r for r, _ in at], [(k,) if len(keys) == 1 else tuple(k) for _, k in at[1:]]


def place(df: DataFrame, layout: Layout) -> DataFrame:
    """Send rows to their buckets and number them: adds ``bucket`` and ``ord``."""
    keys = list(layout.keys)
    moved = df.withColumn(BUCKET, layout.bucket()).repartitionById(layout.buckets, F.col(BUCKET))
    inside = Window.partitionBy(BUCKET).orderBy(*keys)
    first = F.get(literal_array(layout.first_ordinals(), "bigint"), F.col(BUCKET))
    repeated = F.lag(layout.key).over(inside).eqNullSafe(layout.key)
    number = first + F.row_number().over(inside) - 1
    message = F.lit(_key_error(keys))
    return moved.withColumn(ORD, F.when(repeated, F.raise_error(message)).otherwise(number))


def with_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    align: int = 1,
    min_rows: int = MIN_BUCKET_ROWS,
    max_rows: int = BUCKET_ROWS,
    length: str | None = None,
) -> DataFrame:
    """Add ``ord`` (0-based rank by ``keys``) and ``bucket`` (rows that travel together)."""
    return place(df, lay_out(df, keys, align, min_rows=min_rows, max_rows=max_rows, length=length))


def split_point(rows: int, pct: float) -> int:
    """Rows in the first ``pct`` percent, halves rounded to even."""
    return max(0, min(rows, round(rows * pct / 100)))


def _key_error(keys: Sequence[str]) -> str:
    return f"order keys {', '.join(keys)} must be unique and not null"


def _rows_with_keys(df: DataFrame, keys: Sequence[str]) -> int:
    """Number of rows; a NULL in a key, which has no rank, is an error."""
    known = F.count(F.when(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]), 1))
    row = df.agg(F.count(F.lit(1)).alias("rows"), known.alias("known")).first()
    if row["rows"] != row["known"]:
        raise ValueError(_key_error(keys))
    return row["rows"]


def _before(df: DataFrame, keys: Sequence[str], rows: int, rank: int) -> Column:
    """True for the first ``rank`` rows: one comparison with one constant key, which is
    checked by counting the rows below it (narrow, and pruned by the same comparison)."""
    if rank <= 0:
        return F.lit(False)
    if rank >= rows:
        return F.lit(True)
    (bound,) = keys_at_ranks(df, keys, rows, [rank])
    fields = [F.lit(v).cast(df.schema[k].dataType) for k, v in zip(keys, bound)]
    if len(keys) == 1:
        first = F.col(keys[0]) < fields[0]
    else:
        limit = F.struct(*[f.alias(k) for f, k in zip(fields, keys)])
        # The first comparison follows from the second; unlike it, it can reach the scan.
        first = (F.col(keys[0]) <= fields[0]) & (_key(keys) < limit)
    # Rows that share the boundary key cannot be told apart: no constant cuts between them.
    if df.filter(first).count() != rank:
        raise ValueError(_key_error(keys))
    return first


def percent_split(df: DataFrame, keys: Sequence[str], pct: float = 5) -> DataFrame:
    """Label the first ``pct`` percent ``validation`` and the rest ``train``.

    A NULL in ``keys``, or a key that is repeated at the boundary, is an error. The rows
    themselves are not moved.
    """
    refuse_stream(df, "percent_split")
    rows = _rows_with_keys(df, keys)
    first = _before(df, keys, rows, split_point(rows, pct))
    return df.withColumn(SPLIT, F.when(first, F.lit("validation")).otherwise(F.lit("train")))


def ordered_split(
    df: DataFrame,
    keys: Sequence[str],
    pct: float = 5,
    align: int = 1,
    min_rows: int = MIN_BUCKET_ROWS,
    max_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Percent split and ordinals in one exchange: ``ord`` restarts in each split."""
    return place_splits(df, *split_layout(df, keys, pct, align, min_rows, max_rows))


def split_layout(
    df: DataFrame,
    keys: Sequence[str],
    pct: float,
    align: int = 1,
    min_rows: int = MIN_BUCKET_ROWS,
    max_rows: int = BUCKET_ROWS,
    length: str | None = None,
    max_length: int = BUCKET_LENGTH,
) -> tuple[Layout, int]:
    """Buckets of a table of which the first ``pct`` percent are a split of their own, and
    the rows in it."""
    refuse_stream(df, "ordered_split")
    rows = df.select(*keys).count()
    cut = split_point(rows, pct)
    return lay_out(df, keys, align, cut, rows, min_rows, max_rows, length, max_length), cut


def place_splits(df: DataFrame, layout: Layout, cut: int) -> DataFrame:
    """:func:`place`, and the split of each row."""
    if len(layout.sections) == 1:
        return place(df, layout).withColumn(SPLIT, F.lit("validation" if cut else "train"))
    boundary = bisect_right(layout.starts, cut - 1)
    label = F.when(F.col(BUCKET) < boundary, F.lit("validation")).otherwise(F.lit("train"))
    return place(df, layout).withColumn(SPLIT, label)


def cap(df: DataFrame, n: int | None, keys: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows; ``None``, 0 and negative values keep all.

    By ``ord`` where the table has it, else by the key of row ``n`` (a plain filter that
    reaches the scan). NULL keys, and keys repeated at the boundary, are errors.
    """
    if n is None or n <= 0:
        return df
    refuse_stream(df, "cap")
    if keys is None:
        return df.filter(F.col(ORD) < n)
    rows = _rows_with_keys(df, keys)
    return df if n >= rows else df.filter(_before(df, keys, rows, n))


def shuffle_key(seed: int, keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def with_shuffle_key(df: DataFrame, seed: int, keys: Sequence[str]) -> DataFrame:
    return df.withColumn("_shuffle", shuffle_key(seed, keys))


def shuffle_layout(hashed: DataFrame, keys: Sequence[str], max_rows: int = BUCKET_ROWS) -> Layout:
    """Buckets of rows in the order of their digests (column ``_shuffle``).

    Digests are uniform, so runs of cells (their first digits) make even buckets, and one
    narrow pass that counts the cells tells where each bucket starts. No rank is needed.
    """
    refuse_stream(hashed, "ordering rows")
    cell = F.substring("_shuffle", 1, CELL_DIGITS).alias("cell")
    counts = {r["cell"]: r["n"] for r in hashed.groupBy(cell).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = sum(counts.values())
    tasks = 2 * hashed.sparkSession.sparkContext.defaultParallelism
    size = max(min(max_rows, -(-rows // tasks)), MIN_BUCKET_ROWS, -(-rows // (MAX_BUCKETS // 2)))
    starts, bounds, seen = [0], [], 0
    for name in sorted(counts):
        if seen - starts[-1] >= size:
            starts.append(seen)
            bounds.append((name,))
        seen += counts[name]
    return Layout(("_shuffle", *keys), "string", rows, (0,), tuple(starts), tuple(bounds), ("_shuffle",))


def seeded_shuffle(df: DataFrame, seed: int, keys: Sequence[str]) -> DataFrame:
    """New ``ord`` by the digest of seed and key: the same order for any partitioning. One
    pass over the keys and one exchange; a NULL key is an error."""
    hashed = with_shuffle_key(df, seed, keys)
    return place(hashed, shuffle_layout(hashed, keys)).drop("_shuffle")


def peek(df: DataFrame, n: int = 2) -> DataFrame:
    """First ``n`` rows by ``ord``, for a look."""
    refuse_stream(df, "peek")
    return df.orderBy(ORD).limit(n)
