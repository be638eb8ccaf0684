"""The whole preparation, from two tables to one ordered training set."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.functions.tokens import codepoint_count, codepoints
from mixwright.operators.mixing import Placed, mix, pad_placed
from mixwright.operators.ordering import (
    BUCKET_LENGTH,
    BUCKET_ROWS,
    cap,
    lay_out,
    place,
    place_splits,
    shuffle_layout,
    split_layout,
    with_shuffle_key,
)
from mixwright.operators.packing import PACK_ROWS, Packed, pack_and_count, resolve_block_size
from mixwright.operators.sft import DEFAULT_TEMPLATE, build_sft, mask_examples, prompt_text
from mixwright.plans.encoders import Encoder
from mixwright.schema import ORD, SPLIT, SpecialIds, require_values, split_of
from mixwright.session import land


@dataclass(frozen=True)
class MixConfig:
    """Settings of a mix. Corpus blocks and instruction rows have separate lengths.

    ``encoder`` makes the ids of both sources (see ``plans.encoders``); without one, ids are
    code points, made where they are needed. With ``model_max`` the block length follows the
    model: ``block_size`` (or the model's own length, if that is None) is cut to it.
    One task orders and packs at most ``bucket_rows`` rows and about ``bucket_tokens`` tokens.
    """

    block_size: int | None = 1024
    pack_rows: int = PACK_ROWS
    max_len: int = 512
    template: str = DEFAULT_TEMPLATE
    seed: int = 1234
    validation_pct: float | None = None
    max_blocks: int | None = None
    special: SpecialIds = SpecialIds()
    add_bos: bool = True
    on_null: str = "fail"
    on_masked: str = "repair"
    encoder: Encoder | None = None
    model_max: int | None = None
    bucket_rows: int = BUCKET_ROWS
    bucket_tokens: int = BUCKET_LENGTH

    @property
    def block(self) -> int:
        if self.model_max is not None:
            return resolve_block_size(self.block_size, self.model_max)
        if self.block_size is None:
            raise ValueError("block_size is needed where no model_max is given")
        return self.block_size


def corpus_blocks(
    corpus: DataFrame,
    keys: Sequence[str],
    config: MixConfig = MixConfig(),
    text: str = "text",
    length: str | None = None,
) -> DataFrame:
    """Blocks of :func:`packed_corpus`, at most ``max_blocks`` of each split."""
    return cap(packed_corpus(corpus, keys, config, text, length).blocks, config.max_blocks)


def packed_corpus(
    corpus: DataFrame,
    keys: Sequence[str],
    config: MixConfig = MixConfig(),
    text: str = "text",
    length: str | None = None,
) -> Packed:
    """Text rows to blocks with one exchange, which carries text rather than tokens.

    With ``validation_pct`` the first rows become a ``validation`` split that is packed
    apart from ``train``. ``length`` names a stored column with the code points of the text:
    ordering and counting then read that column, and the text is read once. Without it,
    lengths are stored first, so the text is read twice however many passes there are.
    """
    bos = config.special.bos if config.add_bos else None
    if config.encoder is None:
        stored = [] if length is None else [length]
        rows = require_values(corpus.select(*keys, text, *stored), [text, *stored], config.on_null)
        if length is None:
            rows = rows.withColumn("n_tokens", codepoint_count(F.col(text), bos))
            counted = land(rows.select(*keys, "n_tokens"))
        else:
            rows = rows.withColumn("n_tokens", F.col(length).cast("int") + int(bos is not None))
            kept = corpus if config.on_null == "fail" else corpus.filter(F.col(text).isNotNull())
            narrow = require_values(kept.select(*keys, length), [length], config.on_null)
            counted = narrow.select(*keys, (F.col(length).cast("int") + int(bos is not None)).alias("n_tokens"))
        made = {"tokens": codepoints(F.col(text), bos, config.special), "carry": [text]}
    else:
        # Stored once: counting and packing read the ids, the encoder is not run again.
        rows = require_values(corpus.select(*keys, text), [text], config.on_null)
        coded = config.encoder(rows, text, "input_ids")
        if bos is not None:
            coded = coded.withColumn("input_ids", F.concat(F.array(F.lit(bos)), "input_ids"))
        rows = land(coded.withColumn("n_tokens", F.size("input_ids")))
        counted = rows.select(*keys, "n_tokens")
        made = {"tokens": "input_ids"}
    by_length = {"length": "n_tokens", "max_length": config.bucket_tokens}
    sizes = {"align": config.pack_rows, "min_rows": 1, "max_rows": config.bucket_rows}
    if config.validation_pct is None:
        layout = lay_out(counted, keys, **sizes, **by_length)
        placed, lengths = place(rows, layout), place(counted, layout)
    else:
        layout, cut = split_layout(counted, keys, config.validation_pct, **sizes, **by_length)
        placed, lengths = place_splits(rows, layout, cut), place_splits(counted, layout, cut)
    return pack_and_count(placed, config.block, config.pack_rows, length="n_tokens", counted=lengths, **made)


def instruction_examples(
    pairs: DataFrame, keys: Sequence[str], config: MixConfig = MixConfig()
) -> DataFrame:
    """Pairs in seeded order as masked examples (see :func:`placed_examples`)."""
    return placed_examples(pairs, keys, config).rows


def placed_examples(pairs: DataFrame, keys: Sequence[str], config: MixConfig = MixConfig()) -> Placed:
    """Pairs in seeded order as masked examples, and where they are.

    The pairs are stored once with their digests, so that the plan behind them runs once;
    text is shuffled, tokens are made after. Rows that are to be left out (see ``on_null``
    and ``on_masked``) go before the shuffle, so that ``ord`` has no gaps.
    """
    columns = ["instruction", "output"]
    rows = require_values(pairs.select(*keys, *columns), columns, config.on_null)
    if config.encoder is None:
        n_prompt = codepoint_count(prompt_text(F.col("instruction"), config.template))
        rows = rows.withColumns({"_n_prompt": n_prompt, "_n_output": codepoint_count(F.lower("output"))})
    else:
        rows = _encoded_pairs(rows, keys, config)
        rows = rows.withColumns({"_n_prompt": F.size("_prompt"), "_n_output": F.size("_output")})
    if config.on_masked == "drop":
        # Nothing is visible exactly if the prompt alone fills the row: eos would follow it.
        rows = rows.filter(F.col("_n_prompt") < config.max_len - 1)
    stored = land(with_shuffle_key(rows, config.seed, keys))
    layout = shuffle_layout(stored, keys)
    placed = place(stored, layout).drop("_shuffle", "_n_prompt", "_n_output")
    if config.encoder is None:
        built = build_sft(
            placed,
            config.max_len,
            config.special,
            config.template,
            on_null=config.on_null,
            on_masked=config.on_masked,
        )
    else:
        built = mask_examples(placed, "_prompt", "_output", config.max_len, config.special, config.on_masked)
        built = built.drop("_prompt", "_output")
    n = F.least(F.lit(config.max_len - 1), F.col("_n_prompt") + F.col("_n_output") + 1).cast("bigint")
    numbered = place(stored.select("_shuffle", *keys, n.alias("n")), layout)
    spans = numbered.select(F.col(ORD).alias("first"), F.col(ORD).alias("last"), "n")
    return Placed(built, layout.rows, layout.first_ordinals(), spans)


def _encoded_pairs(rows: DataFrame, keys: Sequence[str], config: MixConfig) -> DataFrame:
    """Both sides of the pairs as ids, which the encoder makes once."""
    texts = rows.select(
        *keys,
        prompt_text(F.col("instruction"), config.template).alias("_prompt_text"),
        F.lower("output").alias("_output_text"),
    )
    return config.encoder(config.encoder(texts, "_prompt_text", "_prompt"), "_output_text", "_output")


def _placed_blocks(
    corpus: DataFrame, keys: Sequence[str], config: MixConfig, length: str | None
) -> Placed:
    """Training blocks, at most ``max_blocks``."""
    packed = packed_corpus(corpus, keys, config, length=length)
    split = None if config.validation_pct is None else "train"
    rows, spans = packed.blocks, packed.spans
    if split is not None:
        rows, spans = split_of(rows, split), split_of(spans, split).drop(SPLIT)
    n = packed.sizes.get(split, 0)
    if config.max_blocks is not None and config.max_blocks > 0:
        rows, n = cap(rows, config.max_blocks), min(n, config.max_blocks)
        last = F.least("last", F.lit(config.max_blocks - 1)).alias("last")
        spans = spans.filter(F.col("first") < config.max_blocks).select("first", last, "n")
    firsts = [f for f in packed.firsts.get(split, []) if f < n]
    return Placed(rows, n, firsts, spans)


def _parts(
    corpus: DataFrame | None,
    corpus_keys: Sequence[str],
    pairs: DataFrame | None,
    pair_keys: Sequence[str],
    config: MixConfig,
    length: str | None,
) -> dict[str, Placed]:
    parts = {}
    if corpus is not None:
        parts["pt"] = _placed_blocks(corpus, corpus_keys, config, length)
    if pairs is not None:
        parts["sft"] = placed_examples(pairs, pair_keys, config)
    return parts


def training_mix(
    corpus: DataFrame | None,
    corpus_keys: Sequence[str],
    pairs: DataFrame | None,
    pair_keys: Sequence[str],
    config: MixConfig = MixConfig(),
    length: str | None = None,
) -> DataFrame:
    """Training rows of both sources: blocks first, then shuffled instruction examples.
    ``length`` is that of :func:`packed_corpus`."""
    parts = _parts(corpus, corpus_keys, pairs, pair_keys, config, length)
    pt, sft = parts.get("pt"), parts.get("sft")
    return mix(pt and pt.rows, sft and sft.rows, pt.n_rows if pt else 0)


def padded_mix(
    corpus: DataFrame | None,
    corpus_keys: Sequence[str],
    pairs: DataFrame | None,
    pair_keys: Sequence[str],
    batch_size: int,
    multiple: int = 8,
    config: MixConfig = MixConfig(),
    length: str | None = None,
) -> DataFrame:
    """:func:`training_mix` in padded batches, without another exchange of arrays."""
    parts = _parts(corpus, corpus_keys, pairs, pair_keys, config, length)
    return pad_placed(parts, batch_size, multiple, config.special)
