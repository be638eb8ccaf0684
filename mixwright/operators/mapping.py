"""The caller's own functions over a table, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Bytes of rows that are handed to the caller's function at once: as Python values, and as the
# lists made of them, they take many times that.
PIECE_BYTES = 1_000_000


def pieces(rows: pa.Array | pa.RecordBatch) -> Iterator:
    """Consecutive parts of a batch with about ``PIECE_BYTES``, or one row if that is more."""
    if len(rows) <= 1 or rows.nbytes <= PIECE_BYTES:
        yield rows
        return
    half = len(rows) // 2
    yield from pieces(rows.slice(0, half))
    yield from pieces(rows.slice(half))


def _struct(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: StructType | str) -> DataFrame:
    """``fn`` on each row (dict to dict). Column expressions are faster where they exist."""
    return map_batches(df, _each(fn), schema)


def _each(fn: Callable[[dict], dict]) -> Callable[[dict[str, list]], dict[str, list]]:
    def on_batch(columns: dict[str, list]) -> dict[str, list]:
        names = list(columns)
        made = [fn(dict(zip(names, values))) for values in zip(*columns.values())]
        return {key: [row[key] for row in made] for key in (made[0] if made else {})}

    return on_batch


def map_batches(
    df: DataFrame,
    fn: Callable[[dict[str, list]], dict[str, list]],
    schema: StructType | str,
    tasks: int | None = None,
) -> DataFrame:
    """``fn`` on batches of rows (dict of columns to dict of columns).

    The result may have another number of rows. Where a batch starts and ends is not part
    of the meaning: it has some ``PIECE_BYTES`` at most. ``tasks`` spreads the input over that many tasks first.
    """
    shape = _struct(schema)
    arrow = to_arrow_schema(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for part in pieces(batch):
                made = fn(part.to_pydict())
                if made:
                    arrays = [pa.array(made[f.name], f.type) for f in arrow]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    source = df.repartition(tasks) if tasks else df
    return source.mapInArrow(run, shape)


def encode_with(text: Column, load: Callable[[], Callable[[list[str]], list[list[int]]]]) -> Column:
    """Token ids from the caller's tokenizer.

    ``load`` runs once per Python task and returns a function from texts to id lists; ship
    its files with ``SparkContext.addFile`` and open them there. The function gets texts of
    some ``PIECE_BYTES`` at a time.
    """
    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenize = load()
        for texts in batches:
            for part in pieces(texts):
                yield pa.array(tokenize(part.to_pylist()), pa.list_(pa.int32()))

    return encode(text)
