"""

Array columns are reported as lengths and digests of the joined ids, so that two engines
can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mixwright.functions import tokens as tok
from mixwright.operators.mapping import map_batches, map_rows
from mixwright.operators.mixing import pad_batches
from mixwright.operators.ordering import (
    cap,
    ordered_split,
    peek,
    percent_split,
    seeded_shuffle,
    with_ordinal,
)
from mixwright.operators.packing import pack_blocks, resolve_block_size
from mixwright.operators.pairs import pairs_from_turns
from mixwright.operators.sft import build_sft, render_prompt
from mixwright.operators.tokenize import decode, encode_codepoints, encode_with, split_words
from mixwright.operators.vocabulary import build_vocab, encode_vocab
from mixwright.plans.encoders import tokenizer_encoder, vocabulary_encoder
from mixwright.plans.prepare import prepare
from mixwright.plans.reports import (
    RunConfig,
    fit_unigram,
    loader_plan,
    mix_counts,
    perplexity,
    score_unigram,
    step_plan,
)
from mixwright.plans.training_mix import (
    MixConfig,
    corpus_blocks,
    instruction_examples,
    padded_mix,
    training_mix,
)
from mixwright.schema import SpecialIds, split_of, with_attention_mask
from mixwright.session import new_folder, spread
from mixwright.sinks.examples import rows_at, write_examples, write_metrics
from mixwright.sources.files import is_folder, scan_corpus, scan_sft, scan_text
from mixwright.sources.json_objects import scan_json_objects
from mixwright.sources.tables import corpus_from_table
from mixwright.streaming.packing import pack_stream, read_packed

DOC = ["doc_id"]
PAIR = ["conv_id", "turn"]

try:
    import corpus_pipeline
    from mixwright.llm import queries as llm
except ImportError as missing:
    # The folder is optional; an error inside it is not hidden.
    if missing.name not in ("corpus_pipeline", "mixwright.llm"):
        raise
    corpus_pipeline = llm = None

CONFIG = MixConfig(block_size=1024, pack_rows=1000, max_len=400, seed=1234)
VOCAB_SIZE = 5000
OWN_SPECIAL = SpecialIds(pad=9, bos=5, eos=100, unk=7)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", "text")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_from_turns(_read(spark, sf_dir, "conversations"))


def _digest(ids: str | Column) -> Column:
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.md5(F.array_join(ids.cast("array<string>"), ","))


def _n(ids: str) -> Column:
    return F.size(ids).cast("bigint")


def _example_report(df: DataFrame, *keep: str) -> DataFrame:
    """Lengths and digests; labels that equal the ids are not digested a second time."""
    first = df.select(
        *keep,
        _n("input_ids").alias("n_ids"),
        _digest("input_ids").alias("ids_md5"),
        _digest("attention_mask").alias("mask_md5"),
        F.when(~F.col("labels").eqNullSafe(F.col("input_ids")), F.col("labels")).alias("_own"),
        F.col("labels").eqNullSafe(F.col("input_ids")).alias("_same"),
    )
    labels = F.when(F.col("_same"), F.col("ids_md5")).otherwise(_digest("_own"))
    return first.select(*keep, "n_ids", "ids_md5", "mask_md5", labels.alias("labels_md5"))


# --- corpus -----------------------------------------------------------------------------


def pt_pack_blocks(spark, sf_dir):
    return _example_report(
        corpus_blocks(_documents(spark, sf_dir), DOC, CONFIG), "ord", "batch", "block"
    )


def pt_pack_array_tokens(spark, sf_dir):
    """Packing of ready token arrays in batches of 7 rows, length taken from the arrays."""
    rows = with_ordinal(_documents(spark, sf_dir), DOC, align=7)
    coded = rows.withColumn("input_ids", tok.codepoints(F.col("text")))
    size = resolve_block_size(64, 2048)
    return _example_report(pack_blocks(coded, size, 7), "ord", "batch", "block")


def pt_pack_short(spark, sf_dir):
    """A block longer than any batch: each batch keeps its one short block."""
    config = MixConfig(block_size=10_000_000, pack_rows=300, add_bos=False)
    return _example_report(
        corpus_blocks(_documents(spark, sf_dir), DOC, config), "ord", "batch", "block"
    )


def pt_pack_splits(spark, sf_dir):
    config = MixConfig(block_size=512, pack_rows=100, validation_pct=5)
    blocks = corpus_blocks(_documents(spark, sf_dir), DOC, config)
    return _example_report(blocks, "split", "ord", "batch", "block")


def pt_first_blocks(spark, sf_dir):
    config = MixConfig(block_size=1024, max_blocks=50)
    return _example_report(corpus_blocks(_documents(spark, sf_dir), DOC, config), "ord")


def codepoint_tokens(spark, sf_dir):
    rows = with_attention_mask(encode_codepoints(_documents(spark, sf_dir), "text", add_bos=True))
    return rows.select(
        "doc_id",
        _n("input_ids").alias("n_ids"),
        _digest("input_ids").alias("ids_md5"),
        _digest("attention_mask").alias("mask_md5"),
    )


def decode_round_trip(spark, sf_dir):
    coded = encode_codepoints(_documents(spark, sf_dir), "text", add_bos=True).drop("text")
    return decode(coded, "input_ids")


# --- order ------------------------------------------------------------------------------


def row_ordinals(spark, sf_dir):
    turns = _read(spark, sf_dir, "conversations").select(*PAIR)
    return with_ordinal(turns, PAIR).select(*PAIR, "ord")


def corpus_rows(spark, sf_dir):
    rows = corpus_from_table(_read(spark, sf_dir, "documents"), "doc_id")
    return with_ordinal(rows, ["row_id"]).select("row_id", "ord", F.md5("text").alias("text_md5"))


def percent_split_rows(spark, sf_dir):
    return percent_split(_documents(spark, sf_dir).select("doc_id"), DOC, 5)


def split_ordinals(spark, sf_dir):
    rows = ordered_split(_documents(spark, sf_dir).select("doc_id"), DOC, 7)
    return rows.select("doc_id", "split", "ord")


def split_selection(spark, sf_dir):
    return split_of(percent_split(_documents(spark, sf_dir), DOC, 5), "validation").select(
        "doc_id", F.md5("text").alias("text_md5")
    )


def first_n(spark, sf_dir):
    return cap(_documents(spark, sf_dir), 100, DOC).select("doc_id", F.md5("text").alias("text_md5"))


def shuffled_pairs(spark, sf_dir):
    return seeded_shuffle(_pairs(spark, sf_dir).select(*PAIR), 1234, PAIR).select(*PAIR, "ord")


def peek_examples(spark, sf_dir):
    return _example_report(
        peek(instruction_examples(_pairs(spark, sf_dir), PAIR, CONFIG)), *PAIR, "ord"
    )


# --- instructions -----------------------------------------------------------------------


def turn_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


def prompts(spark, sf_dir):
    return render_prompt(_pairs(spark, sf_dir), CONFIG.template).select(*PAIR, "prompt")


def sft_examples(spark, sf_dir):
    rows = instruction_examples(_pairs(spark, sf_dir), PAIR, CONFIG)
    return _example_report(rows, *PAIR, "ord", "repaired")


def sft_repaired(spark, sf_dir):
    rows = build_sft(_pairs(spark, sf_dir), max_len=60).filter("repaired")
    return _example_report(rows, *PAIR)


def sft_drop_masked(spark, sf_dir):
    rows = build_sft(_pairs(spark, sf_dir), max_len=60, on_masked="drop")
    return _example_report(rows, *PAIR)


# --- mix --------------------------------------------------------------------------------


def _mixed(spark, sf_dir):
    return training_mix(
        _documents(spark, sf_dir), DOC, _pairs(spark, sf_dir), PAIR, CONFIG
    )


def mix(spark, sf_dir):
    return _example_report(_mixed(spark, sf_dir), "source", "ord")


def padded_batches(spark, sf_dir):
    """Batches of the mix, padded where its rows are."""
    rows = padded_mix(
        _documents(spark, sf_dir), DOC, _pairs(spark, sf_dir), PAIR, batch_size=2, multiple=8, config=CONFIG
    )
    return _example_report(rows, "source", "ord", "batch_id", "width")


def padded_any_table(spark, sf_dir):
    """The same for a table of which only ``ord`` is known."""
    rows = pad_batches(_mixed(spark, sf_dir), batch_size=2, multiple=8)
    return _example_report(rows, "source", "ord", "batch_id", "width")


def padded_wide_batches(spark, sf_dir):
    """Batches of 64 over short blocks and long examples, whose edges fall anywhere."""
    config = replace(CONFIG, block_size=256, pack_rows=3, max_len=600)
    rows = padded_mix(_documents(spark, sf_dir), DOC, _pairs(spark, sf_dir), PAIR, 64, 16, config)
    return _example_report(rows, "source", "ord", "batch_id", "width")


def mix_stored_lengths(spark, sf_dir):
    """The mix by the stored lengths of the texts, which are then read once."""
    rows = training_mix(
        _read(spark, sf_dir, "documents"), DOC, _pairs(spark, sf_dir), PAIR, CONFIG, length="n_chars"
    )
    return _example_report(rows, "source", "ord")


def _ord_tokenizer():
    """Stands for a caller's tokenizer; its special ids are not the usual ones."""
    return lambda texts: [[ord(ch) + OWN_SPECIAL.codepoint_offset for ch in text] for text in texts]


def mix_own_tokenizer(spark, sf_dir):
    """The mix with a caller's tokenizer and other special ids; blocks follow a model's length."""
    config = replace(
        CONFIG, encoder=tokenizer_encoder(_ord_tokenizer), special=OWN_SPECIAL, block_size=4096, model_max=1024
    )
    rows = training_mix(_documents(spark, sf_dir), DOC, _pairs(spark, sf_dir), PAIR, config)
    return _example_report(rows, "source", "ord")


def special_ids(spark, sf_dir):
    """Code points with other special ids: instruction examples, and text from ids again."""
    rows = build_sft(_pairs(spark, sf_dir), CONFIG.max_len, OWN_SPECIAL)
    text = F.md5(tok.codepoints_to_text(F.col("input_ids"), OWN_SPECIAL))
    return _example_report(rows.withColumn("text_md5", text), *PAIR, "text_md5")


def mix_vocabulary(spark, sf_dir):
    """The mix on word ids."""
    documents = _documents(spark, sf_dir)
    vocab = build_vocab(_worded(spark, sf_dir), "words", VOCAB_SIZE)
    config = replace(CONFIG, encoder=vocabulary_encoder(vocab), block_size=128, add_bos=False, max_len=100)
    return _example_report(training_mix(documents, DOC, _pairs(spark, sf_dir), PAIR, config), "source", "ord")


def mix_counts_report(spark, sf_dir):
    return mix_counts(_mixed(spark, sf_dir))


def step_plan_report(spark, sf_dir):
    return step_plan(_pairs(spark, sf_dir), RunConfig())


def loader_plan_report(spark, sf_dir):
    return loader_plan(_mixed(spark, sf_dir), RunConfig())


# --- vocabulary -------------------------------------------------------------------------


def _worded(spark, sf_dir):
    rows = spread(_documents(spark, sf_dir), DOC)
    return split_words(rows, "text", out="words").drop("text")


def word_split(spark, sf_dir):
    return _worded(spark, sf_dir).select(
        "doc_id", _n("words").alias("n_words"), F.md5(F.array_join("words", " ")).alias("words_md5")
    )


def vocab_top(spark, sf_dir):
    return build_vocab(_worded(spark, sf_dir), "words", VOCAB_SIZE)


def vocab_encode(spark, sf_dir):
    rows = _worded(spark, sf_dir)
    coded = encode_vocab(rows, "words", build_vocab(rows, "words", VOCAB_SIZE), DOC)
    return coded.select("doc_id", _n("input_ids").alias("n_ids"), _digest("input_ids").alias("ids_md5"))


def vocab_encode_joined(spark, sf_dir):
    """The same with 500 entries inline and the misses joined, as for huge vocabularies."""
    rows = _worded(spark, sf_dir)
    vocab = build_vocab(rows, "words", VOCAB_SIZE)
    coded = encode_vocab(rows, "words", vocab, DOC, inline=500, broadcast=1000)
    return coded.select("doc_id", _n("input_ids").alias("n_ids"), _digest("input_ids").alias("ids_md5"))


def vocab_encode_broadcast(spark, sf_dir):
    """The same with the vocabulary broadcast, as for vocabularies of middle size."""
    rows = _worded(spark, sf_dir)
    vocab = build_vocab(rows, "words", VOCAB_SIZE)
    coded = encode_vocab(rows, "words", vocab, DOC, inline=500)
    return coded.select("doc_id", _n("input_ids").alias("n_ids"), _digest("input_ids").alias("ids_md5"))


def vocab_decode(spark, sf_dir):
    rows = _worded(spark, sf_dir)
    vocab = build_vocab(rows, "words", VOCAB_SIZE)
    coded = encode_vocab(rows, "words", vocab, DOC)
    return decode(coded, "input_ids", vocab, DOC).select("doc_id", F.md5("text").alias("text_md5"))


# --- evaluation -------------------------------------------------------------------------


def _answers(spark, sf_dir):
    return _pairs(spark, sf_dir).select(*PAIR, tok.words(F.lower("output")).alias("words"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"eval_loss": F.round("eval_loss", 6), "perplexity": F.round("perplexity", 4)}
    )


def unigram_perplexity(spark, sf_dir):
    model = fit_unigram(_worded(spark, sf_dir), "words")
    return _rounded(score_unigram(_answers(spark, sf_dir), model, "words"))


def unigram_by_conversation(spark, sf_dir):
    model = fit_unigram(_worded(spark, sf_dir), "words")
    return _rounded(score_unigram(_answers(spark, sf_dir), model, "words", ["conv_id"]))


def label_perplexity(spark, sf_dir):
    """Fit on the ids of the mix, score the visible labels of the instruction rows, then
    average the losses of the rows."""
    mixed = _mixed(spark, sf_dir)
    model = fit_unigram(mixed)
    rows = instruction_examples(_pairs(spark, sf_dir), PAIR, CONFIG)
    losses = score_unigram(rows, model, "labels", PAIR)
    return _rounded(perplexity(losses, "eval_loss"))


# --- caller's functions -----------------------------------------------------------------


def mapped_rows(spark, sf_dir):
    def measure(row):
        return {"doc_id": row["doc_id"], "n_chars": len(row["text"])}

    return map_rows(_documents(spark, sf_dir), measure, "doc_id bigint, n_chars bigint")


def mapped_batches(spark, sf_dir):
    def lines(batch):
        split = [(d, t.split("\n")) for d, t in zip(batch["doc_id"], batch["text"])]
        return {
            "doc_id": [d for d, parts in split for _ in parts],
            "line_no": [i for _, parts in split for i in range(len(parts))],
            "line": [part for _, parts in split for part in parts],
        }

    return map_batches(
        _documents(spark, sf_dir), lines, "doc_id bigint, line_no bigint, line string", tasks=8
    )


def byo_tokenizer(spark, sf_dir):
    def load():
        return lambda texts: [[ord(ch) + 3 for ch in text] for text in texts]

    coded = encode_with(_documents(spark, sf_dir), "text", load, out="ids")
    return coded.select("doc_id", _n("ids").alias("n_ids"), _digest("ids").alias("ids_md5"))


# --- files and streams ------------------------------------------------------------------


def text_scan(spark, sf_dir):
    folder = new_folder(spark, "text")
    documents = _read(spark, sf_dir, "documents")
    documents.select("lang", "text").write.partitionBy("lang").text(folder)
    return scan_text(spark, folder).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def corpus_scan(spark, sf_dir):
    """Text folders for both splits through type guard and format dispatch."""
    train, held = new_folder(spark, "train"), new_folder(spark, "held")
    rows = percent_split(_documents(spark, sf_dir), DOC, 5)
    split_of(rows, "train").select("text").write.text(train)
    split_of(rows, "validation").select("text").write.text(held)
    scanned = scan_corpus(spark, train, held, keep_linebreaks=False)
    return scanned.groupBy("split", "text").agg(F.count(F.lit(1)).alias("n"))


def json_scan(spark, sf_dir):
    folder = new_folder(spark, "json")
    _documents(spark, sf_dir).write.json(folder)
    return scan_corpus(spark, folder).select("split", F.md5("text").alias("text_md5"))


def json_arrays(spark, sf_dir):
    """Arrays that are cut into many byte ranges, and files of single objects beside them."""
    folder = new_folder(spark, "arrays")
    documents = _documents(spark, sf_dir)

    def listed(batches):
        yield pa.RecordBatch.from_pydict({"value": ["["]})
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"value": pc.binary_join_element_wise(batch.column("value"), "", ",")})
        yield pa.RecordBatch.from_pydict({"value": ['{"doc_id": -1, "text": "end"}]']})

    objects = documents.select(F.to_json(F.struct("doc_id", "text")).alias("value"))
    objects.filter(F.col("value").rlike('^.doc_id..[0-9]*[02468],')).mapInArrow(listed, "value string").write.text(f"{folder}/a")
    objects.filter(~F.col("value").rlike('^.doc_id..[0-9]*[02468],')).write.text(f"{folder}/b")
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])
    rows = scan_json_objects(spark, folder, schema, "*.txt")
    return rows.filter("doc_id >= 0").select("doc_id", F.md5("text").alias("text_md5"))


def sft_scan(spark, sf_dir):
    base = new_folder(spark, "sft")
    train, held = f"{base}/train.jsonl", f"{base}/held.json"
    pairs = _pairs(spark, sf_dir)
    pairs.select("instruction", "output").write.json(train)
    pairs.select("instruction", "output").write.json(held)
    rows = scan_sft(spark, train, held)
    return rows.select("split", F.md5("instruction").alias("i_md5"), F.md5("output").alias("o_md5"))


def sft_table_scan(spark, sf_dir):
    folder = new_folder(spark, "pairs")
    _pairs(spark, sf_dir).write.parquet(folder)
    rows = scan_sft(spark, folder)
    return rows.select(*PAIR, "split", F.md5("instruction").alias("i_md5"), F.md5("output").alias("o_md5"))


def _sunk(spark, sf_dir, fmt):
    folder = new_folder(spark, "examples")
    mixed = _mixed(spark, sf_dir)
    write_examples(mixed, folder, fmt, shards=4)
    rows = spark.read.format(fmt).schema(mixed.schema.add("split", "string").add("shard", "integer")).load(folder)
    return _example_report(rows.withColumn("shard", F.col("shard").cast("bigint")), "split", "shard", "source", "ord")


def example_sink(spark, sf_dir):
    return _sunk(spark, sf_dir, "parquet")


def example_sink_json(spark, sf_dir):
    return _sunk(spark, sf_dir, "json")


def metrics_sink(spark, sf_dir):
    folder = new_folder(spark, "metrics")
    write_metrics(mix_counts(_mixed(spark, sf_dir)), folder)
    return spark.read.schema("source string, n_rows bigint, n_tokens bigint").json(folder)


def prepared_counts(spark, sf_dir):
    """Raw JSON folders to written sets. Each document is its own packing batch here, so
    that the counts do not depend on the order of the files."""
    base = new_folder(spark, "raw")
    corpus, pairs, out = f"{base}/corpus", f"{base}/pairs.jsonl", f"{base}/out"
    _documents(spark, sf_dir).select("text").write.json(corpus)
    _pairs(spark, sf_dir).select("instruction", "output").write.json(pairs)
    config = MixConfig(block_size=1024, pack_rows=1, max_len=400)
    sets = prepare(spark, out, corpus, corpus, pairs, pairs, config)
    named = {
        "train": sets.train,
        "evaluation": sets.evaluation,
        "corpus_validation": sets.corpus_validation,
    }
    parts = [mix_counts(df.drop("split")).withColumn("name", F.lit(n)) for n, df in named.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _prepared(spark, sf_dir, **settings):
    """The given documents table and all pairs as written sets."""
    base = new_folder(spark, "sets")
    documents, pairs = f"{sf_dir}/documents.parquet", f"{base}/pairs"
    _pairs(spark, sf_dir).write.parquet(pairs)
    return prepare(
        spark, f"{base}/out", documents, None, pairs, None, replace(CONFIG, validation_pct=5), pair_keys=PAIR,
        pt_keys=DOC, pt_length="n_chars", shards=4, **settings,
    ), f"{base}/out"


def prepared_sets(spark, sf_dir):
    """The training set and the held-out blocks of a table, in full."""
    sets, _ = _prepared(spark, sf_dir)
    parts = [sets.train.withColumn("name", F.lit("train")), sets.corpus_validation.withColumn("name", F.lit("held"))]
    return _example_report(parts[0].unionByName(parts[1]), "name", "source", "ord")


def prepared_padded(spark, sf_dir):
    """The training set in padded batches of 16, as it is written."""
    sets, _ = _prepared(spark, sf_dir, pad=16)
    return _example_report(sets.train, "source", "ord", "batch_id", "width")


def prepared_reports(spark, sf_dir):
    """What is counted while the padded set is written."""
    _, out = _prepared(spark, sf_dir, pad=16)
    counts = spark.read.schema("source string, n_rows bigint, n_tokens bigint").json(f"{out}/reports/train_counts")
    repaired = spark.read.schema("n_rows bigint, n_repaired bigint").json(f"{out}/reports/repaired")
    return counts.unionByName(repaired.select(F.lit("repaired").alias("source"), "n_rows", F.col("n_repaired").alias("n_tokens")))


def rows_by_ordinal(spark, sf_dir):
    """Single rows of a written set: first, last, and those at every 250th place."""
    folder = new_folder(spark, "examples")
    mixed = _mixed(spark, sf_dir)
    n = write_examples(mixed, folder, shards=8, watch={"n": F.count(F.lit(1))})["n"]
    return _example_report(rows_at(spark, folder, sorted({*range(0, n, 250), n - 1})), "source", "ord")


def stream_pack(spark, sf_dir):
    source = f"{sf_dir}/documents.parquet"
    reader = spark.readStream.schema(spark.read.parquet(source).schema)
    if is_folder(spark, source):
        stream = reader.parquet(source)
    else:
        stream = reader.option("pathGlobFilter", "documents.parquet").parquet(sf_dir)
    sink, state = new_folder(spark, "packed"), new_folder(spark, "state")
    pack_stream(stream, sink, state, DOC, CONFIG).awaitTermination()
    return _example_report(read_packed(sink, spark), "batch_id", "ord", "batch", "block")


def stream_deliveries(spark, sf_dir):
    """Documents that arrive one language at a time, a micro-batch each; the stream is
    stopped and taken up again for every delivery. Ordinals go on over all of them."""
    source, sink, state = (new_folder(spark, n) for n in ("deliveries", "packed", "state"))
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    for lang in [r["lang"] for r in docs.select("lang").distinct().orderBy("lang").collect()]:
        docs.filter(F.col("lang").eqNullSafe(lang)).write.mode("append").parquet(source)
        stream = spark.readStream.schema(docs.schema).parquet(source)
        pack_stream(stream, sink, state, DOC, CONFIG).awaitTermination()
    return _example_report(read_packed(sink, spark), "batch_id", "ord", "batch", "block")


def stream_sft(spark, sf_dir):
    source, sink, state = (new_folder(spark, n) for n in ("turns", "sft", "state"))
    _pairs(spark, sf_dir).write.json(source)
    schema = "conv_id bigint, turn bigint, instruction string, output string"
    built = build_sft(spark.readStream.schema(schema).json(source), CONFIG.max_len)
    query = (
        built.writeStream.option("checkpointLocation", state)
        .trigger(availableNow=True)
        .format("parquet")
        .start(sink)
    )
    query.awaitTermination()
    return _example_report(spark.read.parquet(sink), *PAIR, "repaired")


_QUERIES = [
    pt_pack_blocks,
    pt_pack_array_tokens,
    pt_pack_short,
    pt_pack_splits,
    pt_first_blocks,
    codepoint_tokens,
    decode_round_trip,
    row_ordinals,
    corpus_rows,
    percent_split_rows,
    split_ordinals,
    split_selection,
    first_n,
    shuffled_pairs,
    peek_examples,
    turn_pairs,
    prompts,
    sft_examples,
    sft_repaired,
    sft_drop_masked,
    mix,
    mix_stored_lengths,
    padded_batches,
    padded_any_table,
    padded_wide_batches,
    mix_own_tokenizer,
    mix_vocabulary,
    special_ids,
    mix_counts_report,
    step_plan_report,
    loader_plan_report,
    word_split,
    vocab_top,
    vocab_encode,
    vocab_encode_broadcast,
    vocab_encode_joined,
    vocab_decode,
    unigram_perplexity,
    unigram_by_conversation,
    label_perplexity,
    mapped_rows,
    mapped_batches,
    byo_tokenizer,
    text_scan,
    corpus_scan,
    json_scan,
    json_arrays,
    sft_scan,
    sft_table_scan,
    example_sink,
    example_sink_json,
    metrics_sink,
    prepared_counts,
    prepared_sets,
    prepared_padded,
    prepared_reports,
    rows_by_ordinal,
    stream_pack,
    stream_deliveries,
    stream_sft,
]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the mixed training set of sf0.001."""
    return mix(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {q.__name__: q for q in _QUERIES}
    if llm is not None:
        found |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return found


# --- oracles ----------------------------------------------------------------------------


def _sql_ids(text: str, offset: int = 3) -> str:
    return (
        f"list_transform(list_filter(string_split({text}, ''), lambda c: c <> ''), "
        f"lambda c: unicode(c) + {offset})"
    )


def _sql_md5(ids: str) -> str:
    return f"md5(array_to_string({ids}, ','))"


_EXAMPLE_SQL = f"""
    len(input_ids) AS n_ids, {_sql_md5("input_ids")} AS ids_md5,
    {_sql_md5("attention_mask")} AS mask_md5, {_sql_md5("labels")} AS labels_md5
"""

_DOCS_SQL = "docs AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS rk FROM documents)"


def _blocks_sql(
    block: int,
    rows: int,
    bos: bool,
    pct: int | None = None,
    ids: str = _sql_ids("text"),
    bos_id: int = 1,
    split: str | None = None,
) -> str:
    """CTEs up to ``blocks(split, ord, batch, block, input_ids, attention_mask, labels)``."""
    lead = f"list_concat([{bos_id}], {{}})" if bos else "{}"
    if split is not None:
        pass
    elif pct is None:
        split = "SELECT 'train' AS split, rk AS ord, text FROM docs"
    else:
        split = f"""SELECT CASE WHEN rk < cut THEN 'validation' ELSE 'train' END AS split,
            CASE WHEN rk < cut THEN rk ELSE rk - cut END AS ord, text
            FROM docs, (SELECT CAST(round_even(count(*) * {pct} / 100.0, 0) AS BIGINT) AS cut FROM documents)"""
    return f"""{_DOCS_SQL},
    parts AS ({split}),
    coded AS (SELECT split, ord, {lead.format(ids)} AS ids FROM parts),
    single AS (SELECT split, ord, ord // {rows} AS batch, unnest(ids) AS t,
        unnest(range(1, len(ids) + 1)) AS p FROM coded),
    placed AS (SELECT split, batch, t,
        row_number() OVER (PARTITION BY split, batch ORDER BY ord, p) - 1 AS g,
        count(*) OVER (PARTITION BY split, batch) AS total FROM single),
    grouped AS (SELECT split, batch, g // {block} AS block, list(t ORDER BY g) AS input_ids
        FROM placed WHERE total < {block} OR g < (total // {block}) * {block} GROUP BY ALL),
    blocks AS (SELECT split, row_number() OVER (PARTITION BY split ORDER BY batch, block) - 1 AS ord,
        batch, block, input_ids, list_transform(input_ids, lambda x: 1) AS attention_mask,
        input_ids AS labels FROM grouped)"""


_PAIRS_SQL = """pairs AS (SELECT conv_id, turn, text AS instruction, next_text AS output FROM (
        SELECT *, lead(text) OVER w AS next_text, lead(role) OVER w AS next_role
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
        WHERE role = 'user' AND next_role = 'assistant')"""

_PROMPT_SQL = "'Question: ' || lower(instruction) || chr(10) || 'Answer: '"


def _sft_sql(max_len: int, prompt: str = "", output: str = "", eos: int = 2) -> str:
    """CTEs up to ``sft(conv_id, turn, ord, repaired, ...)``."""
    keep = max_len - 1
    return f"""{_PAIRS_SQL},
    sides AS (SELECT conv_id, turn, {prompt or _sql_ids(_PROMPT_SQL)} AS p, {output or _sql_ids("lower(output)")} AS o,
        row_number() OVER (ORDER BY md5('1234:' || conv_id || ':' || turn), conv_id, turn) - 1 AS ord
        FROM pairs),
    cut AS (SELECT conv_id, turn, ord,
        list_concat(list_concat(p, o), [{eos}])[1:{keep}] AS input_ids,
        list_concat(list_concat(list_transform(p, lambda x: -100), o), [{eos}])[1:{keep}] AS raw FROM sides),
    marked AS (SELECT *, list_max(raw) <= -100 AS hidden FROM cut),
    sft AS (SELECT conv_id, turn, ord, input_ids, hidden, hidden AND len(raw) > 18 AS repaired,
        list_transform(input_ids, lambda x: 1) AS attention_mask,
        CASE WHEN hidden THEN list_transform(raw, lambda x, i:
            CASE WHEN i BETWEEN 19 AND 24 THEN input_ids[i] ELSE x END) ELSE raw END AS labels FROM marked)"""


def _mix_sql(parts: str = "") -> str:
    return f"""{parts or _blocks_sql(1024, 1000, True) + ", " + _sft_sql(400)},
    mixed AS (SELECT 'pt' AS source, ord, input_ids, attention_mask, labels FROM blocks
        UNION ALL SELECT 'sft', ord + (SELECT count(*) FROM blocks), input_ids, attention_mask, labels
        FROM sft)"""


_WORD_SQL = r"regexp_extract_all({}, '([\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s])', 1)"
_WORDS_SQL = f"worded AS (SELECT doc_id, {_WORD_SQL.format('text')} AS words FROM documents)"
_VOCAB_SQL = f"""{_WORDS_SQL},
    counts AS (SELECT token, count(*) AS n FROM (SELECT unnest(words) AS token FROM worded) GROUP BY token),
    vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INTEGER) AS id, n
        FROM counts QUALIFY row_number() OVER (ORDER BY n DESC, token) <= {VOCAB_SIZE})"""
_CODED_SQL = f"""{_VOCAB_SQL},
    long AS (SELECT doc_id, unnest(words) AS token, unnest(range(1, len(words) + 1)) AS p FROM worded),
    coded AS (SELECT doc_id, p, long.token, coalesce(id, 3) AS id, id IS NULL AS missing
        FROM long LEFT JOIN vocab ON long.token = vocab.token)"""
_ENCODE_SQL = f"""WITH {_CODED_SQL}
    SELECT d.doc_id, count(id) AS n_ids, md5(coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY p), '')) AS ids_md5
    FROM documents d LEFT JOIN coded c ON d.doc_id = c.doc_id GROUP BY d.doc_id"""


_OWN_MIX = ", ".join(
    (
        _blocks_sql(1024, 1000, True, ids=_sql_ids("text", 100), bos_id=5),
        _sft_sql(400, _sql_ids(_PROMPT_SQL, 100), _sql_ids("lower(output)", 100), 100),
    )
)


def _vocab_mix_sql() -> str:
    """The mix on word ids: documents and both sides of the pairs are looked up by a join."""
    blocks = _blocks_sql(128, 1000, False, ids="(SELECT ids FROM doc_ids d WHERE d.rk = parts.ord)")
    side = "(SELECT ids FROM pair_ids i WHERE i.side = '{}' AND i.conv_id = pairs.conv_id AND i.turn = pairs.turn)"
    sft = _sft_sql(100, side.format("p"), side.format("o")).removeprefix(f"{_PAIRS_SQL},")
    words = _CODED_SQL.replace("coded AS (SELECT doc_id, p", "word_ids AS (SELECT doc_id, p")
    return f"""{words}, {_PAIRS_SQL},
    doc_ids AS (SELECT rk, coalesce(ids, []) AS ids FROM
        (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rk FROM documents)
        LEFT JOIN (SELECT doc_id, list(id ORDER BY p) AS ids FROM word_ids GROUP BY doc_id) USING (doc_id)),
    sided AS (SELECT conv_id, turn, 'p' AS side, {_WORD_SQL.format(_PROMPT_SQL)} AS words FROM pairs
        UNION ALL SELECT conv_id, turn, 'o', {_WORD_SQL.format("lower(output)")} FROM pairs),
    side_words AS (SELECT conv_id, turn, side, unnest(words) AS token, unnest(range(1, len(words) + 1)) AS p FROM sided),
    pair_ids AS (SELECT conv_id, turn, side, coalesce(list(i ORDER BY p) FILTER (WHERE i IS NOT NULL), []) AS ids FROM
        (SELECT s.conv_id, s.turn, s.side, w.p, CASE WHEN w.p IS NOT NULL THEN coalesce(v.id, 3) END AS i
            FROM sided s LEFT JOIN side_words w USING (conv_id, turn, side) LEFT JOIN vocab v ON v.token = w.token)
        GROUP BY ALL),
    {_mix_sql(blocks + ", " + sft)}"""


def _unigram_sql(by: str) -> str:
    return f"""WITH {_WORDS_SQL}, {_PAIRS_SQL},
    model AS (SELECT token, count(*) AS n FROM (SELECT unnest(words) AS token FROM worded) GROUP BY token),
    space AS (SELECT sum(n) + count(*) + 1 AS s FROM model),
    seen AS (SELECT conv_id, unnest({_WORD_SQL.format("lower(output)")}) AS token FROM pairs),
    scored AS (SELECT conv_id, -ln((coalesce(n, 0) + 1) / CAST(s AS DOUBLE)) AS loss
        FROM seen LEFT JOIN model ON seen.token = model.token, space)
    SELECT {by + "," if by else ""} round(avg(loss), 6) AS eval_loss,
        round(exp(avg(loss)), 4) AS perplexity, count(*) AS n_tokens
    FROM scored {"GROUP BY " + by if by else ""}"""


# The corpus with 5 percent held out, and all pairs.
_SETS_SQL = _mix_sql(
    _blocks_sql(1024, 1000, True, 5).replace("blocks AS (SELECT split", "all_blocks AS (SELECT split")
    + ", blocks AS (SELECT * FROM all_blocks WHERE split = 'train'), "
    + _sft_sql(400)
)


def _padded_sql(mixed: str, batch: int, multiple: int) -> str:
    def padded(column: str, pad: int) -> str:
        return f"list_concat(list_transform(range(width - len(input_ids)), lambda x: {pad}), {column}) AS {column}"

    return f"""WITH {mixed},
        wide AS (SELECT *, ord // {batch} AS batch_id, CAST((max(len(input_ids)) OVER (PARTITION BY ord // {batch})
            + {multiple - 1}) // {multiple} * {multiple} AS INTEGER) AS width FROM mixed),
        padded AS (SELECT source, ord, batch_id, width,
            {padded("attention_mask", 0)}, {padded("labels", -100)},
            list_concat(list_transform(range(width - len(input_ids)), lambda x: 0), input_ids) AS wide_ids FROM wide)
        SELECT source, ord, batch_id, width, {_EXAMPLE_SQL.replace("input_ids", "wide_ids")} FROM padded"""


def _sunk_sql() -> str:
    return f"""WITH {_mix_sql()}, c AS (SELECT (count(*) + 3) // 4 AS per FROM mixed)
        SELECT 'train' AS split, ord // per AS shard, source, ord, {_EXAMPLE_SQL} FROM mixed, c"""


_LINES_SQL = "SELECT unnest(string_split(text, chr(10))) AS line"


def oracle_sql() -> dict[str, str]:
    found = _own_oracles()
    if llm is not None:
        found |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _own_oracles() -> dict[str, str]:
    blocks = f"SELECT ord, batch, block, {_EXAMPLE_SQL} FROM blocks"
    sft_row = f"SELECT conv_id, turn, {_EXAMPLE_SQL} FROM sft"
    split_label = """CASE WHEN rk < round_even((SELECT count(*) FROM documents) * {} / 100.0, 0)
        THEN 'validation' ELSE 'train' END"""
    return {
        "pt_pack_blocks": f"WITH {_blocks_sql(1024, 1000, True)} {blocks}",
        "pt_pack_array_tokens": f"WITH {_blocks_sql(64, 7, False)} {blocks}",
        "pt_pack_short": f"WITH {_blocks_sql(10_000_000, 300, False)} {blocks}",
        "pt_pack_splits": f"""WITH {_blocks_sql(512, 100, True, 5)}
            SELECT split, ord, batch, block, {_EXAMPLE_SQL} FROM blocks""",
        "pt_first_blocks": f"""WITH {_blocks_sql(1024, 1000, True)}
            SELECT ord, {_EXAMPLE_SQL} FROM blocks WHERE ord < 50""",
        "codepoint_tokens": f"""WITH coded AS (SELECT doc_id, list_concat([1], {_sql_ids("text")}) AS ids
            FROM documents) SELECT doc_id, len(ids) AS n_ids, {_sql_md5("ids")} AS ids_md5,
            {_sql_md5("list_transform(ids, lambda x: 1)")} AS mask_md5 FROM coded""",
        "decode_round_trip": "SELECT doc_id, text FROM documents",
        "row_ordinals": """SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS ord
            FROM conversations""",
        "corpus_rows": f"WITH {_DOCS_SQL} SELECT doc_id AS row_id, rk AS ord, md5(text) AS text_md5 FROM docs",
        "percent_split_rows": f"WITH {_DOCS_SQL} SELECT doc_id, {split_label.format(5)} AS split FROM docs",
        "split_ordinals": f"""WITH {_DOCS_SQL}, labelled AS (
            SELECT doc_id, rk, {split_label.format(7)} AS split FROM docs)
            SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY rk) - 1 AS ord FROM labelled""",
        "split_selection": f"""WITH {_DOCS_SQL} SELECT doc_id, md5(text) AS text_md5 FROM docs
            WHERE {split_label.format(5)} = 'validation'""",
        "first_n": "SELECT doc_id, md5(text) AS text_md5 FROM documents ORDER BY doc_id LIMIT 100",
        "shuffled_pairs": f"""WITH {_PAIRS_SQL} SELECT conv_id, turn, row_number() OVER (
            ORDER BY md5('1234:' || conv_id || ':' || turn), conv_id, turn) - 1 AS ord FROM pairs""",
        "peek_examples": f"""WITH {_sft_sql(400)}
            SELECT conv_id, turn, ord, {_EXAMPLE_SQL} FROM sft WHERE ord < 2""",
        "turn_pairs": f"WITH {_PAIRS_SQL} SELECT conv_id, turn, instruction, output FROM pairs",
        "prompts": f"WITH {_PAIRS_SQL} SELECT conv_id, turn, {_PROMPT_SQL} AS prompt FROM pairs",
        "sft_examples": f"""WITH {_sft_sql(400)}
            SELECT conv_id, turn, ord, repaired, {_EXAMPLE_SQL} FROM sft""",
        "sft_repaired": f"WITH {_sft_sql(60)} {sft_row} WHERE repaired",
        "sft_drop_masked": f"WITH {_sft_sql(60)} {sft_row} WHERE NOT hidden",
        "mix": f"WITH {_mix_sql()} SELECT source, ord, {_EXAMPLE_SQL} FROM mixed",
        "mix_own_tokenizer": f"""WITH {_mix_sql(_OWN_MIX)} SELECT source, ord, {_EXAMPLE_SQL} FROM mixed""",
        "mix_vocabulary": f"""WITH {_vocab_mix_sql()} SELECT source, ord, {_EXAMPLE_SQL} FROM mixed""",
        "special_ids": f"""WITH {_sft_sql(400, _sql_ids(_PROMPT_SQL, 100), _sql_ids("lower(output)", 100), 100)}
            SELECT conv_id, turn, md5(coalesce(array_to_string(list_transform(list_filter(input_ids,
                lambda x: x > 100), lambda x: chr(x - 100)), ''), '')) AS text_md5, {_EXAMPLE_SQL} FROM sft""",
        "mix_stored_lengths": f"WITH {_mix_sql()} SELECT source, ord, {_EXAMPLE_SQL} FROM mixed",
        "padded_batches": _padded_sql(_mix_sql(), 2, 8),
        "padded_any_table": _padded_sql(_mix_sql(), 2, 8),
        "padded_wide_batches": _padded_sql(_mix_sql(_blocks_sql(256, 3, True) + ", " + _sft_sql(600)), 64, 16),
        "mix_counts_report": f"""WITH {_mix_sql()} SELECT source, count(*) AS n_rows,
            CAST(sum(len(input_ids)) AS BIGINT) AS n_tokens FROM mixed GROUP BY source""",
        "step_plan_report": f"""WITH {_PAIRS_SQL}, c AS (SELECT count(*) AS n_rows, 64::BIGINT AS batch_size FROM pairs),
            t AS (SELECT *, ((n_rows + 63) // 64) * 4.0::DOUBLE AS t_total FROM c)
            SELECT n_rows, batch_size, t_total, CAST(greatest(floor(t_total / 2), 5) AS BIGINT) AS eval_steps,
            CAST(greatest(floor(t_total / 2), 5) AS BIGINT) AS save_steps,
            CAST(floor(t_total * 0.1::DOUBLE) AS BIGINT) AS warmup_steps FROM t""",
        "loader_plan_report": f"""WITH {_mix_sql()}, c AS (SELECT count(*) AS n_rows FROM mixed),
            l AS (SELECT *, (n_rows + 15) // 16 AS loader_length FROM c)
            SELECT n_rows, loader_length, loader_length // 4 AS updates_per_epoch, 64::BIGINT AS total_batch,
            n_rows * 4.0::DOUBLE AS n_samples, 4 * (loader_length // 4) AS max_steps FROM l""",
        "word_split": f"""WITH {_WORDS_SQL} SELECT doc_id, len(words) AS n_words,
            md5(array_to_string(words, ' ')) AS words_md5 FROM worded""",
        "vocab_top": f"WITH {_VOCAB_SQL} SELECT token, id, n FROM vocab",
        "vocab_encode": _ENCODE_SQL,
        "vocab_encode_broadcast": _ENCODE_SQL,
        "vocab_encode_joined": _ENCODE_SQL,
        "vocab_decode": f"""WITH {_CODED_SQL} SELECT d.doc_id,
            md5(coalesce(string_agg(token, ' ' ORDER BY p) FILTER (WHERE NOT missing), '')) AS text_md5
            FROM documents d LEFT JOIN coded c ON d.doc_id = c.doc_id GROUP BY d.doc_id""",
        "unigram_perplexity": _unigram_sql(""),
        "unigram_by_conversation": _unigram_sql("conv_id"),
        "label_perplexity": f"""WITH {_mix_sql()},
            model AS (SELECT token, count(*) AS n FROM (SELECT unnest(input_ids) AS token FROM mixed) GROUP BY token),
            space AS (SELECT sum(n) + count(*) + 1 AS s FROM model),
            seen AS (SELECT conv_id, turn, unnest(list_filter(labels, lambda x: x <> -100)) AS token FROM sft),
            scored AS (SELECT conv_id, turn, avg(-ln((coalesce(n, 0) + 1) / CAST(s AS DOUBLE))) AS loss
                FROM seen LEFT JOIN model ON seen.token = model.token, space GROUP BY conv_id, turn)
            SELECT round(avg(loss), 6) AS eval_loss, round(exp(avg(loss)), 4) AS perplexity,
                count(*) AS eval_samples FROM scored""",
        "mapped_rows": "SELECT doc_id, length(text) AS n_chars FROM documents",
        "mapped_batches": """SELECT doc_id, unnest(range(len(lines))) AS line_no, unnest(lines) AS line
            FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)""",
        "byo_tokenizer": f"""WITH coded AS (SELECT doc_id, {_sql_ids("text")} AS ids FROM documents)
            SELECT doc_id, len(ids) AS n_ids, {_sql_md5("ids")} AS ids_md5 FROM coded""",
        "text_scan": f"""SELECT line || chr(10) AS text, count(*) AS n FROM ({_LINES_SQL} FROM documents)
            GROUP BY line""",
        "corpus_scan": f"""WITH {_DOCS_SQL}, lines AS (
            SELECT {split_label.format(5)} AS split, unnest(string_split(text, chr(10))) AS text FROM docs)
            SELECT split, text, count(*) AS n FROM lines GROUP BY split, text""",
        "json_scan": "SELECT 'train' AS split, md5(text) AS text_md5 FROM documents",
        "json_arrays": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
        "sft_scan": f"""WITH {_PAIRS_SQL}, both_splits AS (SELECT 'train' AS split, * FROM pairs
            UNION ALL SELECT 'validation', * FROM pairs)
            SELECT split, md5(instruction) AS i_md5, md5(output) AS o_md5 FROM both_splits""",
        "sft_table_scan": f"""WITH {_PAIRS_SQL} SELECT conv_id, turn, 'train' AS split,
            md5(instruction) AS i_md5, md5(output) AS o_md5 FROM pairs""",
        "example_sink": _sunk_sql(),
        "example_sink_json": _sunk_sql(),
        "metrics_sink": f"""WITH {_mix_sql()} SELECT source, count(*) AS n_rows,
            CAST(sum(len(input_ids)) AS BIGINT) AS n_tokens FROM mixed GROUP BY source""",
        "prepared_counts": f"""WITH {_blocks_sql(1024, 1, True)}, {_sft_sql(400)},
            pt AS (SELECT 'pt' AS source, count(*) AS n_rows, CAST(sum(len(input_ids)) AS BIGINT) AS n_tokens
                FROM blocks),
            it AS (SELECT 'sft' AS source, count(*) AS n_rows, CAST(sum(len(input_ids)) AS BIGINT) AS n_tokens
                FROM sft)
            SELECT 'train' AS name, * FROM pt UNION ALL SELECT 'train', * FROM it
            UNION ALL SELECT 'evaluation', * FROM it UNION ALL SELECT 'corpus_validation', * FROM pt""",
        "prepared_sets": f"""WITH {_SETS_SQL}
            SELECT 'train' AS name, source, ord, {_EXAMPLE_SQL} FROM mixed UNION ALL
            SELECT 'held', 'pt', ord, {_EXAMPLE_SQL} FROM all_blocks WHERE split = 'validation'""",
        "prepared_padded": _padded_sql(_SETS_SQL, 16, 8),
        "prepared_reports": f"""WITH {_SETS_SQL} SELECT source, count(*) AS n_rows,
                CAST(sum(len(input_ids)) AS BIGINT) AS n_tokens FROM mixed GROUP BY source
            UNION ALL SELECT 'repaired', count(*), CAST(count(*) FILTER (WHERE repaired) AS BIGINT) FROM sft""",
        "rows_by_ordinal": f"""WITH {_mix_sql()} SELECT source, ord, {_EXAMPLE_SQL} FROM mixed
            WHERE ord % 250 = 0 OR ord = (SELECT max(ord) FROM mixed)""",
        "stream_pack": f"""WITH {_blocks_sql(1024, 1000, True)}
            SELECT 0::BIGINT AS batch_id, ord, batch, block, {_EXAMPLE_SQL} FROM blocks""",
        "stream_deliveries": f"""WITH {_blocks_sql(1024, 1000, True, split='''SELECT lang AS split, text,
                row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS ord FROM documents''')},
            made AS (SELECT lang, (SELECT count(*) FROM blocks WHERE split IS NOT DISTINCT FROM lang) AS n
                FROM (SELECT DISTINCT lang FROM documents)),
            begun AS (SELECT lang, row_number() OVER w - 1 AS batch_id, sum(n) OVER w - n AS first
                FROM made WINDOW w AS (ORDER BY lang NULLS FIRST))
            SELECT batch_id, CAST(ord + first AS BIGINT) AS ord, batch, block, {_EXAMPLE_SQL}
            FROM blocks JOIN begun ON split IS NOT DISTINCT FROM lang""",
        "stream_sft": f"""WITH {_sft_sql(400)}
            SELECT conv_id, turn, repaired, {_EXAMPLE_SQL} FROM sft""",
    }
