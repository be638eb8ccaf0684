"""Packing a stream micro-batch by micro-batch, with ordinals over the whole stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mixwright.operators.ordering import cap
from mixwright.plans.training_mix import MixConfig, packed_corpus
from mixwright.schema import ORD, SPLIT

_LEDGER = "split string, first bigint, blocks bigint"


def pack_stream(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    keys: Sequence[str],
    config: MixConfig = MixConfig(),
    text: str = "text",
    trigger: dict | None = None,
    length: str | None = None,
) -> StreamingQuery:
    """Pack each micro-batch on its own and write it to ``sink/batch_id=<n>``.

    The remainder rule of a batch of rows needs nothing from earlier ones, so there is no
    state but the number of blocks so far. It is kept in a ledger beside the blocks: the
    entry of a micro-batch says where its blocks begin and how many there are, by split, so
    that ``ord`` goes on without a gap from one micro-batch to the next, and each needs the
    entry before its own only. A micro-batch that is run again after a failure reads that
    same entry and replaces its own directory and entry, so every block is written once and
    keeps its ordinal. ``max_blocks`` holds for the whole stream. A sink that was begun
    without a ledger cannot be continued.

    Each micro-batch is a finite table, so every encoder works here, also one whose
    vocabulary is joined. ``length`` is that of ``packed_corpus``.
    """
    if not stream.isStreaming:
        raise ValueError("pack_stream needs a streaming DataFrame")
    sink = sink.rstrip("/")
    stored = [] if length is None else [length]

    def pack(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        begins = _next_ordinals(spark, sink, batch_id)
        # Held once: the passes over keys and lengths would each read the source again.
        held = rows.select(*keys, text, *stored).persist()
        try:
            packed = packed_corpus(held, keys, config, text, length)
            entry = [(s, begins.get(s, 0), packed.sizes.get(s, 0)) for s in {**begins, **packed.sizes}]
            ledger = spark.createDataFrame(entry, _LEDGER).coalesce(1)
            ledger.write.mode("overwrite").json(_entry(sink, batch_id))
            numbered = packed.blocks.withColumn(ORD, F.col(ORD) + _begin(begins)).drop("bucket")
            blocks = cap(numbered, config.max_blocks)
            blocks.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        finally:
            held.unpersist()

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(pack)
        .start()
    )


def _entry(sink: str, batch_id: int) -> str:
    return f"{sink}/_ledger/batch_id={batch_id}"


def _next_ordinals(spark: SparkSession, sink: str, batch_id: int) -> dict[str | None, int]:
    """Where each split goes on, by the entry of the micro-batch before (a row a split)."""
    if batch_id == 0:
        return {}
    before = spark.read.schema(_LEDGER).json(_entry(sink, batch_id - 1)).collect()
    return {r["split"]: r["first"] + r["blocks"] for r in before}


def _begin(begins: dict[str | None, int]):
    """First ordinal of a block's split (one literal where there are no splits)."""
    begin = F.lit(begins.get(None, 0)).cast("bigint")
    for split, at in begins.items():
        if split is not None:
            begin = F.when(F.col(SPLIT) == split, F.lit(at)).otherwise(begin)
    return begin


def read_packed(stream_sink: str, spark: SparkSession) -> DataFrame:
    """Blocks written so far, with the ``batch_id`` of the micro-batch they came from."""
    return spark.read.parquet(stream_sink).withColumn("batch_id", F.col("batch_id").cast("bigint"))
