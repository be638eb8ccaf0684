import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mixwright.operators.ordering import ordered_split, with_ordinal
from mixwright.operators.packing import blocks_in, pack_and_count, pack_blocks, resolve_block_size
from mixwright.plans.training_mix import MixConfig, corpus_blocks

SCHEMA = "ord bigint, input_ids array<int>"


def assert_packed(got, lists, block, rows):
    """Holds ``got`` against what packing promises: batch after batch, its blocks are a
    prefix of the batch's tokens; only a batch with less than one block has a short one;
    what is lost is less than a block, and nothing if the batch is short."""
    left = list(got)
    for first in range(0, len(lists), rows):
        tokens = [t for ids in lists[first : first + rows] for t in ids]
        used = 0
        while left and used < len(tokens) and (len(tokens) < block or used + block <= len(tokens)):
            piece = left.pop(0)
            assert len(piece) == block or (used == 0 and len(piece) == len(tokens) < block)
            assert tokens[used : used + len(piece)] == piece
            used += len(piece)
        lost = len(tokens) - used
        assert lost == 0 if len(tokens) < block else lost < block
    assert not left


def packed(df):
    rows = df.orderBy("ord").collect()
    assert [r.ord for r in rows] == list(range(len(rows)))
    for r in rows:
        assert r.labels == r.input_ids and r.attention_mask == [1] * len(r.input_ids)
    return [r.input_ids for r in rows]


def numbered(lists):
    return [(i, ids) for i, ids in enumerate(lists)]


CASES = {
    "exact": ([[1, 2], [3, 4]], 4, 2),
    "below": ([[1], [2]], 4, 2),
    "above": ([[1, 2, 3], [4, 5]], 4, 2),
    "one token blocks": ([[1, 2], [], [3]], 1, 2),
    "empty rows": ([[], [1, 2], [], [3]], 2, 3),
    "empty batch": ([[1], [2], [], [], [3]], 2, 2),
    "long row": ([list(range(50))], 8, 1000),
    "one row batches": ([[1, 2, 3], [4], [5, 6]], 2, 1),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    lists, block, rows = CASES[name]
    df = spark.createDataFrame(numbered(lists), SCHEMA)
    assert_packed(packed(pack_blocks(df, block, rows)), lists, block, rows)


BY_HAND = {
    "exact": [[1, 2, 3, 4]],
    "below": [[1, 2]],
    "above": [[1, 2, 3, 4]],
    "one token blocks": [[1], [2], [3]],
    "empty rows": [[1, 2], [3]],
    "empty batch": [[1, 2], [3]],
    "one row batches": [[1, 2], [4], [5, 6]],
}


@pytest.mark.parametrize("name", BY_HAND)
def test_cases_by_hand(spark, name):
    lists, block, rows = CASES[name]
    df = spark.createDataFrame(numbered(lists), SCHEMA)
    assert packed(pack_blocks(df, block, rows)) == BY_HAND[name]


def test_no_rows(spark):
    assert pack_blocks(spark.createDataFrame([], SCHEMA), 4, 2).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    lists=st.lists(st.lists(st.integers(0, 9), max_size=7), max_size=25),
    block=st.integers(1, 9),
    rows=st.integers(1, 6),
)
def test_random_lists(spark, lists, block, rows):
    df = spark.createDataFrame(numbered(lists), SCHEMA)
    assert_packed(packed(pack_blocks(df, block, rows)), lists, block, rows)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_partitions_do_not_matter_and_tokens_are_conserved(spark, parts):
    rng = random.Random(3)
    lists = [[rng.randrange(100) for _ in range(rng.randrange(40))] for _ in range(200)]
    df = spark.createDataFrame(numbered(lists), SCHEMA).repartition(parts)
    got = packed(pack_blocks(df, 16, 9))
    assert_packed(got, lists, 16, 9)
    lost = sum(sum(map(len, lists[i : i + 9])) % 16 for i in range(0, 200, 9))
    assert sum(map(len, got)) == sum(map(len, lists)) - lost


def test_splits_are_packed_apart(spark):
    rng = random.Random(5)
    lists = [[rng.randrange(100) for _ in range(rng.randrange(1, 30))] for _ in range(90)]
    df = spark.createDataFrame(numbered(lists), "id bigint, input_ids array<int>")
    placed = ordered_split(df, ["id"], 10, align=4, min_rows=8)
    result = pack_and_count(placed, 8, 4)
    for source in (placed, placed.drop("bucket")):
        blocks = pack_blocks(source, 8, 4)
        parts = {s: packed(blocks.filter(F.col("split") == s)) for s in ("validation", "train")}
        assert_packed(parts["validation"], lists[:9], 8, 4)
        assert_packed(parts["train"], lists[9:], 8, 4)
        assert result.sizes == {s: len(made) for s, made in parts.items()}


@pytest.mark.parametrize("bos", [True, False])
def test_corpus_text(spark, bos):
    texts = ["héllo\nworld", "", "\U0001f600 ok", "x" * 40, "end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    coded = [[1] * bos + [ord(c) + 3 for c in t] for t in texts]
    config = MixConfig(block_size=7, pack_rows=2, add_bos=bos)
    blocks = corpus_blocks(df, ["doc"], config)
    whole = packed(blocks)
    assert_packed(whole, coded, 7, 2)
    capped = corpus_blocks(df, ["doc"], MixConfig(block_size=7, pack_rows=2, add_bos=bos, max_blocks=3))
    assert packed(capped) == whole[:3]


def test_null_text(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc int, text string")
    with pytest.raises(Exception, match="NULL in column text"):
        corpus_blocks(df, ["doc"]).collect()
    kept = corpus_blocks(df, ["doc"], MixConfig(on_null="drop", add_bos=False))
    assert packed(kept) == [[100, 101]]


def test_one_exchange_and_narrow_counting(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = spark.range(100).select("id", F.lit("some text").alias("text"), F.lit(1).alias("other"))
    rows.write.parquet(path)
    blocks = corpus_blocks(spark.read.parquet(path), ["id"], MixConfig(block_size=8, pack_rows=10))
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "ReadSchema: struct<id:bigint,text:string>" in plan


def test_block_size_rule():
    with pytest.warns(UserWarning):
        assert resolve_block_size(None, 4096) == 4096
    with pytest.warns(UserWarning):
        assert resolve_block_size(1024, 512) == 512
    assert resolve_block_size(1024, 2048) == 1024
    assert resolve_block_size(None, 2048) == 2048


@pytest.mark.parametrize("total,expected", [(0, 0), (1, 1), (3, 1), (4, 1), (7, 1), (8, 2)])
def test_blocks_in(spark, total, expected):
    assert spark.range(1).select(blocks_in(F.lit(total), 4).alias("n")).first().n == expected


def test_dense_order_is_kept_over_many_buckets(spark):
    lists = [[i] * (i % 5) for i in range(400)]
    df = spark.createDataFrame(numbered(lists), "id bigint, input_ids array<int>")
    placed = with_ordinal(df, ["id"], align=6, min_rows=12)
    assert placed.select("bucket").distinct().count() > 5
    assert_packed(packed(pack_blocks(placed, 4, 6)), lists, 4, 6)
