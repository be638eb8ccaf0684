import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mixwright.operators import vocabulary
from mixwright.operators.vocabulary import build_vocab, decode_vocab, encode_vocab


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    names = [f"w{i}" for i in range(60)] + ["é", "\"q\"", "\\"]
    docs = [(i, [names[min(int(rng.expovariate(0.08)), 62)] for _ in range(rng.randrange(30))]) for i in range(80)]
    docs.append((80, []))
    docs.append((81, ["w0"] * 900))
    return docs, spark.createDataFrame(docs, "doc int, words array<string>").repartition(3)


def expected_vocab(docs, size):
    counts = Counter(w for _, words in docs for w in words)
    return sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:size]


@pytest.mark.parametrize("one_task", [100_000, 0])
@pytest.mark.parametrize("size", [1, 10, 40, 500])
def test_build(corpus, size, one_task, monkeypatch):
    monkeypatch.setattr(vocabulary, "ONE_TASK_ENTRIES", one_task)
    docs, df = corpus
    got = build_vocab(df, "words", size).orderBy("id").collect()
    assert [(r.token, r.n) for r in got] == expected_vocab(docs, size)
    assert [r.id for r in got] == list(range(4, 4 + len(got)))


@pytest.mark.parametrize(
    "inline,broadcast", [(100, 200), (40, 40), (5, 200), (5, 40), (5, 6), (1, 2)]
)
def test_encode_by_size_of_the_vocabulary(corpus, inline, broadcast):
    docs, df = corpus
    vocab = build_vocab(df, "words", 40)
    ids = {token: 4 + i for i, (token, _) in enumerate(expected_vocab(docs, 40))}
    extra = df.withColumn("also", F.col("doc") + 1)
    coded = encode_vocab(extra, "words", vocab, ["doc"], inline=inline, broadcast=broadcast).collect()
    assert all(r.also == r.doc + 1 for r in coded)
    got = {r.doc: r.input_ids for r in coded}
    assert got == {d: [ids.get(w, 3) for w in words] for d, words in docs}


@pytest.mark.parametrize("inline", [40, 5])
def test_decode(corpus, inline):
    docs, df = corpus
    vocab = build_vocab(df, "words", 40)
    known = {t for t, _ in expected_vocab(docs, 40)}
    coded = encode_vocab(df, "words", vocab, ["doc"])
    got = {r.doc: r.text for r in decode_vocab(coded, "input_ids", vocab, ["doc"], inline=inline).collect()}
    assert got == {d: " ".join(w for w in words if w in known) for d, words in docs}


WAYS = {"inline": (100, 200), "broadcast": (5, 200), "joined": (5, 6)}


@pytest.mark.parametrize("way", WAYS)
def test_one_answer_for_every_size(corpus, spark, way):
    """Repeated and NULL keys, NULL arrays and NULL elements, extra columns."""
    inline, broadcast = WAYS[way]
    entries = [(f"w{i}", i + 4 if i else 2_000_000_000) for i in range(40)]
    vocab = spark.createDataFrame(entries, "token string, id int")
    rows = [(1, ["w1", "w2"], "x"), (1, ["w39"], "y"), (1, ["w39"], "y"), (None, ["w0", "no"], "z"), (2, None, "n"),
            (3, [], "e"), (4, ["w3", None, "w38"], "m"), (5, ["none"] * 50 + ["w37"] * 50, "hot")]
    ids = dict(entries)
    df = spark.createDataFrame(rows, "k int, words array<string>, item string").repartition(3)
    coded = encode_vocab(df, "words", vocab, ["k"], inline=inline, broadcast=broadcast)
    want = [(k, tag, None if w is None else [ids.get(x, 3) for x in w]) for k, w, tag in rows]
    got = [(r.k, r.item, r.input_ids) for r in coded.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    back = decode_vocab(coded, "input_ids", vocab, ["k"], inline=inline, broadcast=broadcast)
    want = [(k, tag, None if w is None else " ".join(x for x in w if x in ids)) for k, w, tag in rows]
    assert sorted(((r.k, r.item, r.text) for r in back.collect()), key=repr) == sorted(want, key=repr)


def test_broadcast_encoding_moves_no_row(corpus):
    _, df = corpus
    vocab = build_vocab(df, "words", 40)
    coded = encode_vocab(df, "words", vocab, inline=5)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning" not in plan and "MapInArrow" in plan


def test_joined_encoding_joins_by_salted_token(corpus, spark):
    _, df = corpus
    vocab = build_vocab(df, "words", 40)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        coded = encode_vocab(df, "words", vocab, inline=5, broadcast=6)
        plan = coded._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_salt" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_small_vocabulary_needs_no_exchange(corpus, spark):
    _, df = corpus
    vocab = build_vocab(df, "words", 40)
    plan = encode_vocab(df, "words", vocab, ["doc"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_common_misses_are_not_joined(corpus, spark, hot, monkeypatch):
    """The commonest word is in no vocabulary, or far behind in it: only rarer ones are joined."""
    monkeypatch.setattr(vocabulary, "HOT_MISSES", hot)
    docs, df = corpus
    counts = Counter(w for _, words in docs for w in words)
    order = sorted(counts, key=lambda w: (-counts[w], w))
    ids = {w: 4 + i for i, w in enumerate(reversed(order[1:]))}
    vocab = spark.createDataFrame(list(ids.items()), "token string, id int")
    missed = df.select(F.explode("words").alias("item"))
    found, _ = vocabulary._hot_misses(missed, vocab.select(F.col("token").alias("item"), F.col("id").alias("value")))
    assert order[0] in found and len(found) == min(hot, len(counts))
    coded = encode_vocab(df, "words", vocab, inline=5, broadcast=6).collect()
    assert {r.doc: r.input_ids for r in coded} == {d: [ids.get(w, 3) for w in words] for d, words in docs}


def test_joined_values_are_bound_once_a_row(spark):
    """The map of the joined values of a row is made outside of the loop over its elements."""
    vocab = spark.createDataFrame([(f"w{i}", i + 4) for i in range(3_000)], "token string, id int")
    df = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(3_999)), lambda i: F.concat(F.lit("w"), i)).alias("t"))
    coded = encode_vocab(df, "t", vocab, inline=3, broadcast=5)
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(array(map_from_entries(" in plan
    assert coded.first().input_ids == [i + 4 for i in range(3_000)] + [3] * 1_000
