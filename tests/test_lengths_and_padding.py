"""Buckets by length, stored lengths, and padding without moving arrays."""

import random

import pytest
from pyspark.sql import functions as F

from mixwright.operators import ordering
from mixwright.operators.mixing import pad_batches
from mixwright.operators.ordering import lay_out, place, shuffle_layout, split_layout, with_shuffle_key
from mixwright.operators.packing import pack_blocks
from mixwright.plans.training_mix import MixConfig, corpus_blocks, padded_mix, training_mix


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line and "ReusedExchange" not in line for line in plan.splitlines())


def skewed(rng, n):
    return [(i, rng.choice([0, 1, 5, 40, 400]) if i % 50 else 3_000) for i in range(n)]


@pytest.mark.parametrize("one_task", [40, 200_000])
@pytest.mark.parametrize("align,cut", [(1, 0), (7, 0), (5, 333)])
def test_buckets_by_length(spark, monkeypatch, one_task, align, cut):
    monkeypatch.setattr(ordering, "ONE_TASK_KEYS", one_task)
    rows = skewed(random.Random(align), 1_000)
    target = 6_000
    df = spark.createDataFrame(rows, "id bigint, n int").repartition(4)
    layout = lay_out(df, ["id"], align, cut, min_rows=1, max_rows=300, length="n", max_length=target)
    assert layout.starts[0] == 0 and list(layout.starts) == sorted(set(layout.starts))
    ends = [*layout.starts[1:], len(rows)]
    for low, high in zip(layout.starts, ends):
        section = cut if cut and low >= cut else 0
        assert (low - section) % align == 0
        last = sum(n for _, n in rows[high - align : high])
        assert sum(n for _, n in rows[low:high]) - last < target and high - low <= 300 + align
    if cut:
        assert cut in layout.starts
    found = place(df, layout).collect()
    assert sorted((r.id, r.ord) for r in found) == [(i, i - (cut if cut and i >= cut else 0)) for i, _ in rows]
    sums = {}
    for r in found:
        sums[r.bucket] = sums.get(r.bucket, 0) + r.n
    groups = [sum(n for _, n in rows[i : i + align]) for i in range(0, len(rows), align)]
    assert max(sums.values()) <= 2 * max(target, *groups)


def test_rows_without_length(spark):
    df = spark.createDataFrame([(i, 0) for i in range(500)], "id int, n int")
    layout = lay_out(df, ["id"], length="n", min_rows=1, max_rows=100)
    assert layout.starts == (0, 100, 200, 300, 400)
    assert lay_out(df.limit(0), ["id"], length="n").starts == (0,)


def test_split_by_length(spark):
    df = spark.createDataFrame(skewed(random.Random(3), 200), "id bigint, n int")
    layout, cut = split_layout(df, ["id"], 10, 3, 1, 50, "n", 500)
    assert cut == 20 and 20 in layout.starts


def test_shuffle_needs_no_ranks(spark, monkeypatch):
    monkeypatch.setattr(ordering, "MIN_BUCKET_ROWS", 10)
    df = with_shuffle_key(spark.range(2_000), 5, ["id"])
    layout = shuffle_layout(df, ["id"], max_rows=100)
    assert len(layout.starts) > 10
    got = place(df, layout).orderBy("ord").collect()
    assert [r.ord for r in got] == list(range(2_000))
    assert [r._shuffle for r in got] == sorted(r._shuffle for r in got)
    assert max(b - a for a, b in zip(layout.starts, layout.starts[1:])) <= 110


def texts(rng, n):
    return [(i, "x" * rng.choice([0, 1, 3, 30, 200])) for i in range(n)]


@pytest.mark.parametrize("batch,block,pack,max_len", [(1, 16, 3, 9), (4, 16, 1, 40), (7, 64, 2, 200), (50, 8, 5, 20)])
def test_padding_in_place_equals_padding_by_batch(spark, monkeypatch, batch, block, pack, max_len):
    monkeypatch.setattr(ordering, "MIN_BUCKET_ROWS", 3)
    rng = random.Random(batch)
    docs = spark.createDataFrame([(i, t) for i, t in texts(rng, 90)], "doc int, text string")
    pairs = spark.createDataFrame([(i, "q" * rng.randrange(20), t) for i, t in texts(rng, 60)], "k int, instruction string, output string")
    config = MixConfig(block_size=block, pack_rows=pack, max_len=max_len, bucket_rows=6, template="{instruction}")
    for given in ((docs, pairs), (docs, None), (None, pairs)):
        mixed = training_mix(given[0], ["doc"], given[1], ["k"], config)
        wide = padded_mix(given[0], ["doc"], given[1], ["k"], batch, 8, config)
        columns = ["source", "ord", "batch_id", "width", "input_ids", "attention_mask", "labels"]
        want = pad_batches(mixed, batch, 8).select(*columns).orderBy("ord").collect()
        assert wide.select(*columns).orderBy("ord").collect() == want


def test_padding_with_caps_and_splits(spark, monkeypatch):
    rng = random.Random(4)
    docs = spark.createDataFrame(texts(rng, 80), "doc int, text string")
    pairs = spark.createDataFrame([(i, "q", t) for i, t in texts(rng, 20)], "k int, instruction string, output string")
    for cap in (None, 5, 33):
        config = MixConfig(block_size=32, pack_rows=2, max_len=50, bucket_rows=8, validation_pct=10, max_blocks=cap, on_masked="drop")
        mixed = training_mix(docs, ["doc"], pairs, ["k"], config)
        wide = padded_mix(docs, ["doc"], pairs, ["k"], 6, 8, config)
        columns = ["source", "ord", "batch_id", "width", "input_ids", "labels"]
        assert wide.select(*columns).orderBy("ord").collect() == pad_batches(mixed, 6, 8).select(*columns).orderBy("ord").collect()


def test_padding_in_place_has_no_exchange_of_its_own(spark):
    docs = spark.createDataFrame([(i, "word " * 50) for i in range(40)], "doc int, text string")
    pairs = spark.createDataFrame([(i, "ask", "answer") for i in range(9)], "k int, instruction string, output string")
    config = MixConfig(block_size=64, pack_rows=3, bucket_rows=6)
    mixed = training_mix(docs, ["doc"], pairs, ["k"], config)
    wide = padded_mix(docs, ["doc"], pairs, ["k"], 4, 8, config)
    assert exchanges(wide) == exchanges(mixed)
    assert exchanges(pad_batches(mixed, 4)) > exchanges(mixed)


def test_stored_lengths(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame(texts(rng, 50), "doc int, text string").withColumn("size", F.length("text"))
    config = MixConfig(block_size=32, pack_rows=4, bucket_rows=9)
    want = corpus_blocks(docs, ["doc"], config).orderBy("ord").collect()
    got = corpus_blocks(docs, ["doc"], config, length="size")
    assert got.orderBy("ord").collect() == want
    wrong = docs.withColumn("size", F.when(F.col("doc") == 7, 1_000).otherwise(F.col("size")))
    with pytest.raises(Exception, match="not the number of its tokens"):
        corpus_blocks(wrong, ["doc"], config, length="size").collect()


def test_stored_lengths_spare_the_text(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, "t" * i) for i in range(50)], "doc int, text string").withColumn("size", F.length("text")).write.parquet(path)
    plan = corpus_blocks(spark.read.parquet(path), ["doc"], MixConfig(block_size=8, pack_rows=4), length="size")
    read = [line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line]
    assert sum("text:string" in line for line in read) == 1


def test_length_of_ready_arrays_is_checked(spark):
    rows = spark.createDataFrame([(0, [1, 2, 3], 2)], "ord bigint, input_ids array<int>, n int")
    with pytest.raises(Exception, match="not the number of its tokens"):
        pack_blocks(rows, 2, 1, length="n").collect()
