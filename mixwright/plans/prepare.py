"""From raw inputs to written training and evaluation sets, with their reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from mixwright.functions.tokens import codepoints_to_text
from mixwright.operators.mixing import mix, unpadded
from mixwright.operators.ordering import cap
from mixwright.plans.reports import (
    RunConfig,
    fit_unigram,
    loader_plan,
    perplexity,
    score_unigram,
    step_plan,
)
from mixwright.plans.training_mix import MixConfig, instruction_examples, packed_corpus
from mixwright.schema import EXAMPLE_SCHEMA, ORD, SPLIT, SpecialIds, require_split, split_of
from mixwright.session import land
from mixwright.sinks.examples import TASK_IDS, TASK_ROWS, Padding, write_examples, write_metrics
from mixwright.sources.files import FILE_KEYS, scan_corpus, scan_corpus_table, scan_sft, stored_by_scan

# Fixed value: the part of the training rows that is held out where no validation input is given.
DEFAULT_PCT = 5

KEPT_SCHEMA = StructType(
    [StructField("source", StringType()), StructField(ORD, LongType())]
    + EXAMPLE_SCHEMA.fields
    + [StructField(SPLIT, StringType()), StructField("shard", IntegerType())]
)


@dataclass(frozen=True)
class Prepared:
    """The written sets. ``evaluation`` holds instruction rows only; corpus blocks held out
    are kept apart. Absent inputs give ``None``."""

    train: DataFrame
    evaluation: DataFrame | None
    corpus_validation: DataFrame | None


def prepare(
    spark: SparkSession,
    out: str,
    pt_train: str | None = None,
    pt_validation: str | None = None,
    sft_train: str | None = None,
    sft_validation: str | None = None,
    config: MixConfig = MixConfig(),
    run: RunConfig = RunConfig(),
    pair_keys: Sequence[str] = FILE_KEYS,
    max_eval_blocks: int | None = None,
    shards: int | None = None,
    keep_linebreaks: bool = True,
    form: str = "auto",
    pad: int | None = None,
    pt_keys: Sequence[str] | None = None,
    pt_length: str | None = None,
) -> Prepared:
    """Read, split, pack, mask, merge and write; reports go to ``out/reports``: step and
    loader plan, counts, repaired rows, a look at the first rows of each source and set
    (with their text, where the encoder can give it) and, with evaluation rows, their loss
    and perplexity under the unigram baseline of the training set. Counts are observed while
    the sets are written. An input that is named but empty is an error.

    With ``pad``, sets are written in padded batches of so many rows (``batch_id``,
    ``width``). With ``pt_keys``, a unique key, the corpus inputs are Parquet paths or table
    names; ``pt_length`` may then name a stored column with the code points of the text.

    Either source may be absent. Without a corpus validation folder the first
    ``config.validation_pct`` percent (5 by default) of the corpus rows is held out.
    ``pair_keys`` name a unique key where instruction pairs come from a table. ``form`` is
    how JSON files are written (see ``scan_json``): "lines" or "array" spares the driver a
    look at every file.
    """
    if pt_keys is None:
        corpus = scan_corpus(spark, pt_train, pt_validation, keep_linebreaks, config.on_null, form)
        if corpus is not None and not stored_by_scan(spark, [pt_train, pt_validation], form, config.on_null):
            corpus = land(corpus)
    else:
        corpus = scan_corpus_table(spark, pt_train, pt_validation, [*pt_keys, *([pt_length] if pt_length else [])])
    if corpus is None and sft_train is None:
        raise ValueError("a training dataset is required: both sources are absent")
    if corpus is not None:
        require_split(corpus, "train")
    keys = list(pt_keys or FILE_KEYS)
    blocks, n_blocks, held, n_held = _NOTHING if corpus is None else _corpus(corpus, keys, pt_length, config)
    if blocks is not None and config.max_blocks is not None and config.max_blocks > 0:
        blocks, n_blocks = cap(blocks, config.max_blocks), min(n_blocks, config.max_blocks)

    examples = evaluation = None
    n_examples = n_evaluation = 0
    if sft_train is not None:
        pairs = land(scan_sft(spark, sft_train, sft_validation, config.on_null, form))
        sizes = {r[SPLIT]: r["n"] for r in pairs.groupBy(SPLIT).agg(F.count("*").alias("n")).collect()}
        n_examples, n_evaluation = sizes.get("train", 0), sizes.get("validation", 0)
        train_pairs = require_split(pairs, "train")
        if sft_validation is not None:
            require_split(pairs, "validation")
        examples = instruction_examples(train_pairs, pair_keys, config)
        write_metrics(step_plan(train_pairs, run, n_examples), f"{out}/reports/step_plan")
        if sft_validation is not None:
            # A JSON validation set next to a table has file positions as its only key.
            evaluation = instruction_examples(split_of(pairs, "validation"), FILE_KEYS, config)

    rows = None if config.on_masked == "drop" else n_blocks + n_examples
    mixed = mix(blocks, examples, n_blocks, keep=["repaired"])
    longest = config.max_len if corpus is None else max(config.block, config.max_len)
    task_rows = max(1, min(TASK_ROWS, TASK_IDS // longest))
    sink = _Sink(spark, shards, pad, config.special, task_rows)
    train, seen = sink.keep(mixed, f"{out}/train", "train", rows)
    counts = [(s, seen[f"{s}_rows"], seen[f"{s}_tokens"] or 0) for s in ("pt", "sft") if seen[f"{s}_rows"]]
    schema = "source string, n_rows bigint, n_tokens bigint"
    write_metrics(spark.createDataFrame(counts, schema).coalesce(1), f"{out}/reports/train_counts")
    if examples is not None:
        repaired = spark.createDataFrame([(seen["sft_rows"], seen["repaired"])], "n_rows bigint, n_repaired bigint")
        write_metrics(repaired, f"{out}/reports/repaired")
    n_train = seen["pt_rows"] + seen["sft_rows"]
    write_metrics(loader_plan(train, run, n_train), f"{out}/reports/loader_plan")
    looks = [_look(train, "train", 0, min(n_blocks, 1)), _look(train, "train", n_blocks, n_blocks + 2)]
    if evaluation is not None:
        rows = None if config.on_masked == "drop" else n_evaluation
        kept = mix(None, evaluation, keep=["repaired"])
        evaluation, _ = sink.keep(kept, f"{out}/evaluation", "validation", rows)
        plain = unpadded if pad is not None else lambda df: df
        losses = score_unigram(plain(evaluation), fit_unigram(plain(train)), "labels", [ORD])
        write_metrics(perplexity(losses, "eval_loss"), f"{out}/reports/eval")
        looks.append(_look(evaluation, "evaluation", 0, 2))
    if held is not None:
        if max_eval_blocks is not None and max_eval_blocks > 0:
            held, n_held = cap(held, max_eval_blocks), min(n_held, max_eval_blocks)
        held, _ = sink.keep(mix(held, None), f"{out}/corpus_validation", "validation", n_held)
        looks.append(_look(held, "corpus_validation", 0, 1))
    shown = reduce(DataFrame.unionByName, looks)
    if config.encoder is None:
        shown = shown.withColumn("text", codepoints_to_text(F.col("input_ids"), config.special))
    elif hasattr(config.encoder, "decode"):
        shown = config.encoder.decode(shown.withColumn("_ids", F.col("input_ids")), "_ids", "text")
    write_metrics(shown, f"{out}/reports/peek")
    return Prepared(train, evaluation, held)


def _look(df: DataFrame, name: str, first: int, end: int) -> DataFrame:
    """Rows ``first`` to ``end``, without padding: a filter that skips other files."""
    rows = df.filter((F.col(ORD) >= first) & (F.col(ORD) < end))
    rows = unpadded(rows) if "width" in df.columns else rows
    return rows.select(F.lit(name).alias("set"), "source", ORD, "input_ids", "labels")


@dataclass(frozen=True)
class _Sink:
    spark: SparkSession
    shards: int | None
    pad: int | None
    special: SpecialIds
    task_rows: int

    def keep(self, df: DataFrame, path: str, split: str, rows: int | None) -> tuple[DataFrame, dict]:
        """Write one set and read it back, with what was observed. ``rows`` is its size where
        that is known."""
        sizes = None if rows is None else {split: rows}
        padding = None if self.pad is None else Padding(self.pad, special=self.special)
        repaired = F.col("repaired") if "repaired" in df.columns else F.lit(False)
        watch = {"repaired": F.count(F.when(repaired, 1))}
        for source in ("pt", "sft"):
            here = F.col("source") == source
            watch |= {f"{source}_rows": F.count(F.when(here, 1)), f"{source}_tokens": F.sum(F.when(here, F.size("input_ids").cast("bigint")))}
        named = df.withColumn(SPLIT, F.lit(split))
        dropped = [c for c in ("repaired",) if c in df.columns]
        seen = write_examples(
            named, path, shards=self.shards, rows=sizes, pad=padding, watch=watch, drop=dropped, task_rows=self.task_rows,
            placed=self.pad is None,
        )
        fields = list(KEPT_SCHEMA.fields)
        if self.pad is not None:
            fields += [StructField("batch_id", LongType()), StructField("width", IntegerType())]
        return self.spark.read.schema(StructType(fields)).parquet(path), seen


_NOTHING = (None, 0, None, 0)


def _corpus(
    corpus: DataFrame, keys: Sequence[str], length: str | None, config: MixConfig
) -> tuple[DataFrame | None, int, DataFrame | None, int]:
    """Training blocks and their number, blocks held out and their number."""
    given = {r[SPLIT] for r in corpus.select(SPLIT).distinct().collect()}
    if given == {"train"}:
        pct = DEFAULT_PCT if config.validation_pct is None else config.validation_pct
        packed = packed_corpus(corpus, keys, replace(config, validation_pct=pct), length=length)
        parts = [(split_of(packed.blocks, s), packed.sizes.get(s, 0)) for s in ("train", "validation")]
        return (*parts[0], *parts[1])
    whole = replace(config, validation_pct=None)
    sets = {s: packed_corpus(split_of(corpus, s), keys, whole, length=length) for s in sorted(given)}
    parts = [
        (sets[s].blocks, sets[s].sizes.get(None, 0)) if s in sets else (None, 0)
        for s in ("train", "validation")
    ]
    return (*parts[0], *parts[1])
