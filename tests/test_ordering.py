import random

import pytest
from pyspark.sql import functions as F

from mixwright.operators import ordering
from mixwright.operators.ordering import (
    cap,
    keys_at_ranks,
    lay_out,
    ordered_split,
    peek,
    percent_split,
    place,
    seeded_shuffle,
    split_point,
    with_ordinal,
)


@pytest.fixture
def small_buckets(monkeypatch):
    """Ranking by range instead of in one task, at test size."""
    monkeypatch.setattr(ordering, "ONE_TASK_KEYS", 50)


def _frame(spark, rows, schema, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_ordinals_of_a_composite_key_with_one_hot_value(spark, small_buckets, parts):
    rng = random.Random(1)
    rows = [(7, t) for t in range(400)] + [(c, t) for c in range(40) for t in range(20) if c != 7]
    rng.shuffle(rows)
    df = _frame(spark, rows, "conv bigint, turn bigint", parts)
    got = with_ordinal(df, ["conv", "turn"], min_rows=30).collect()
    expected = {key: i for i, key in enumerate(sorted(rows))}
    assert {(r.conv, r.turn): r.ord for r in got} == expected
    sizes = {}
    for r in got:
        sizes[r.bucket] = sizes.get(r.bucket, 0) + 1
    assert len(sizes) > 1 and max(sizes.values()) <= 160


@pytest.mark.parametrize("shuffles", ["1", "7"])
def test_ordinals_do_not_depend_on_shuffle_partitions(spark, small_buckets, shuffles):
    words = sorted({"".join(random.Random(i).choices("abéz\U0001f600\"\\", k=4)) for i in range(300)})
    df = _frame(spark, [(w,) for w in words], "name string", 5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    try:
        got = {r.name: r.ord for r in with_ordinal(df, ["name"], min_rows=20).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {w: i for i, w in enumerate(words)}


def test_buckets_are_aligned_per_section(spark, small_buckets):
    df = spark.range(1003)
    layout = lay_out(df, ["id"], align=10, cut=55, min_rows=20)
    placed = place(df, layout).groupBy("bucket").agg(F.min("id").alias("lo"), F.min("ord").alias("o"))
    for r in placed.collect():
        assert r.o % 10 == 0
        assert r.o == r.lo - (55 if r.lo >= 55 else 0)


def test_keys_at_ranks(spark, small_buckets):
    df = spark.range(0, 5000, 5).repartition(4)
    assert keys_at_ranks(df, ["id"], 1000, [0, 17, 999]) == [(0,), (85,), (4995,)]
    assert keys_at_ranks(df, ["id"], 1000, []) == []


def test_repeated_and_null_keys_fail(spark):
    with pytest.raises(Exception, match="must be unique"):
        with_ordinal(spark.createDataFrame([(1,), (2,), (1,)], "k int"), ["k"]).collect()
    with pytest.raises(TypeError):
        with_ordinal(spark.createDataFrame([(1.0,)], "k double"), ["k"])


@pytest.mark.parametrize("n", [0, 1, 10, 30, 50, 101, 1000])
@pytest.mark.parametrize("pct", [0, 5, 33, 100])
def test_split_point_matches_spark_rounding(spark, n, pct):
    got = spark.range(1).select(F.bround(F.lit(n) * pct / F.lit(100)).cast("long").alias("x")).first().x
    assert split_point(n, pct) == got


@pytest.mark.parametrize("n", [0, 1, 10, 30, 50, 101])
def test_percent_split_and_ordered_split(spark, n):
    df = spark.range(n).select((F.col("id") * 3).alias("k")).repartition(2)
    cut = round(n * 5 / 100)
    labels = {r.k: r.split for r in percent_split(df, ["k"], 5).collect()}
    assert labels == {i * 3: "validation" if i < cut else "train" for i in range(n)}
    ords = {r.k: (r.split, r.ord) for r in ordered_split(df, ["k"], 5, align=4, min_rows=4).collect()}
    assert ords == {
        i * 3: ("validation", i) if i < cut else ("train", i - cut) for i in range(n)
    }


def test_percent_split_moves_no_rows_and_cap_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(500).withColumn("x", F.lit("a")).write.parquet(path)
    df = spark.read.parquet(path)
    plan = percent_split(df, ["id"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    capped = cap(df, 20, ["id"])
    assert "LessThan(id,20)" in capped._jdf.queryExecution().executedPlan().toString()
    assert capped.count() == 20


@pytest.mark.parametrize("n,expected", [(None, 9), (0, 9), (-1, 9), (4, 4), (9, 9), (100, 9)])
def test_cap(spark, n, expected):
    rows = spark.range(9)
    assert cap(rows, n, ["id"]).count() == expected
    assert cap(with_ordinal(rows, ["id"]), n).count() == expected


def test_cap_of_a_composite_key(spark):
    rows = [(c, t) for c in range(5) for t in range(4)]
    got = cap(_frame(spark, rows, "c int, t bigint"), 7, ["c", "t"]).collect()
    assert sorted((r.c, r.t) for r in got) == rows[:7]


def test_seeded_shuffle_is_a_stable_permutation(spark, small_buckets):
    import hashlib

    df = spark.range(300)
    expected = sorted(range(300), key=lambda k: (hashlib.md5(f"9:{k}".encode()).hexdigest(), k))
    for parts in (1, 5):
        got = seeded_shuffle(df.repartition(parts), 9, ["id"]).orderBy("ord").collect()
        assert [r.id for r in got] == expected
    assert [r.id for r in peek(seeded_shuffle(df, 9, ["id"]), 2).collect()] == expected[:2]
    other = seeded_shuffle(df, 10, ["id"]).orderBy("ord").collect()
    assert [r.id for r in other] != expected


def test_streams_are_refused(spark):
    stream = spark.readStream.format("rate").load()
    for call in (
        lambda: with_ordinal(stream, ["value"]),
        lambda: percent_split(stream, ["value"]),
        lambda: ordered_split(stream, ["value"]),
        lambda: cap(stream, 3),
        lambda: peek(stream),
    ):
        with pytest.raises(ValueError, match="finite"):
            call()


@pytest.mark.parametrize("keys", [[1, 2, 2, 2, 3, 4], [None, 2, 3, 4]])
def test_cap_and_split_refuse_unclear_boundaries(spark, keys):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, x int")
    for call in (lambda: ordering.cap(df, 3, ["k"]), lambda: ordering.percent_split(df, ["k"], 50)):
        with pytest.raises(ValueError, match="unique and not null"):
            call().collect()


def test_cap_by_two_keys_with_repeats_elsewhere(spark):
    rows = [(1, "a"), (1, "b"), (2, "a"), (3, "a"), (3, "a")]
    df = spark.createDataFrame(rows, "k int, s string")
    assert sorted(tuple(r) for r in ordering.cap(df, 2, ["k", "s"]).collect()) == rows[:2]
