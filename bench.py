"""Headline queries, timed warm. Prints one JSON line.

Environment: BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 5).
Every query computes all its columns and rows (``noop`` sink); times include planning and
the key passes. The value is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixwright.functions.tokens import codepoint_count, words
from mixwright.operators.mixing import pad_batches
from mixwright.operators.pairs import pairs_from_turns
from mixwright.operators.vocabulary import build_vocab, encode_vocab
from mixwright.plans.training_mix import (
    MixConfig,
    corpus_blocks,
    instruction_examples,
    training_mix,
)
from mixwright.session import spread

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
CONFIG = MixConfig(block_size=1024, max_len=400)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def headline(spark: SparkSession) -> dict:
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    pair_keys = ["conv_id", "turn"]

    def mixed() -> DataFrame:
        return training_mix(documents, ["doc_id"], pairs_from_turns(turns), pair_keys, CONFIG)

    def coded() -> DataFrame:
        source = spread(documents, ["doc_id"])
        rows = source.select("doc_id", words(F.col("text")).alias("words"))
        return encode_vocab(rows, "words", build_vocab(rows, "words", 5000), ["doc_id"])

    return {
        "pt_pack_blocks": lambda: corpus_blocks(documents, ["doc_id"], CONFIG),
        "sft_examples": lambda: instruction_examples(pairs_from_turns(turns), pair_keys, CONFIG),
        "mix": mixed,
        "vocab_encode": coded,
        "padded_batches": lambda: pad_batches(mixed(), 2),
    }


def main() -> None:
    spark = session()
    times: dict[str, float] = {}
    for name, build in headline(spark).items():
        runs = []
        for _ in range(RUNS + 1):
            begin = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(runs[1:]), 3)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tokens = documents.agg(F.sum(codepoint_count(F.col("text"), 1))).first()[0]
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs, summed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
                "pack_tokens_per_sec": round(tokens / times["pt_pack_blocks"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
