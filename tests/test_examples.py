import random

import pytest
from pyspark.sql import functions as F

from mixwright.functions.tokens import codepoints, codepoints_to_text, words
from mixwright.operators.mixing import mix, pad_batches
from mixwright.operators.pairs import pairs_from_turns
from mixwright.operators.sft import build_sft, mask_examples, prompt_text
from mixwright.plans.training_mix import MixConfig, instruction_examples, training_mix
from mixwright.schema import EXAMPLE_SCHEMA, require_split, split_of


MASK_SCHEMA = "ord bigint, p array<int>, o array<int>"
P20, O3 = list(range(100, 120)), [7, 8, 9]
HIDDEN = [-100]

# prompt, output, max_len -> ids, labels, repaired; written by hand.
MASKED = {
    "all fits": ([5, 6], [7], 10, [5, 6, 7, 2], [-100, -100, 7, 2], False),
    "end is cut": ([5, 6], [7, 8], 5, [5, 6, 7, 8], [-100, -100, 7, 8], False),
    "short and all hidden": ([5, 6, 7], [8], 4, [5, 6, 7], HIDDEN * 3, False),
    "no prompt": ([], [7], 10, [7, 2], [7, 2], False),
    "no output": ([5], [], 10, [5, 2], [-100, 2], False),
    "nothing": ([], [], 1, [], [], False),
    "repaired": (P20, O3, 21, P20, HIDDEN * 18 + [118, 119], True),
    "too short to repair": (P20, O3, 19, P20[:18], HIDDEN * 18, False),
    "repaired in part": (P20 + P20, O3, 31, P20 + P20[:10], HIDDEN * 18 + [118, 119, 100, 101, 102, 103] + HIDDEN * 6, True),
}


@pytest.mark.parametrize("name", MASKED)
def test_masking_by_hand(spark, name):
    p, o, max_len, ids, labels, repaired = MASKED[name]
    df = spark.createDataFrame([(0, p, o)], MASK_SCHEMA)
    r = mask_examples(df, "p", "o", max_len).first()
    assert (r.input_ids, r.labels, r.repaired) == (ids, labels, repaired)
    assert r.attention_mask == [1] * len(ids)
    kept = mask_examples(df, "p", "o", max_len, on_masked="drop").count()
    assert kept == (not repaired and any(x != -100 for x in labels))


@pytest.mark.parametrize("max_len", [1, 2, 10, 19, 20, 22, 25, 30, 64])
def test_masking_properties(spark, max_len):
    rng = random.Random(max_len)
    rows = {
        i: ([rng.randrange(3, 90) for _ in range(rng.randrange(40))],
            [rng.randrange(3, 90) for _ in range(rng.choice([0, 0, 1, 5, 30]))])
        for i in range(150)
    }
    df = spark.createDataFrame([(i, p, o) for i, (p, o) in rows.items()], MASK_SCHEMA)
    for r in mask_examples(df, "p", "o", max_len).collect():
        p, o = rows[r.ord]
        n = len(r.input_ids)
        assert n == min(max_len - 1, len(p) + len(o) + 1) == len(r.labels)
        # Ids are the start of the prompt, then of the output, then the end mark.
        assert r.input_ids[: len(p)] == p[:n] and r.input_ids[len(p) : len(p) + len(o)] == o[: max(0, n - len(p))]
        seen = [i for i, x in enumerate(r.labels) if x != -100]
        assert all(r.labels[i] == r.input_ids[i] for i in seen)
        if r.repaired:
            assert n <= len(p) and seen == [i for i in range(18, 24) if i < n] and seen
        else:
            assert seen == list(range(len(p), n)) and (seen or n <= 18)


def test_rendering(spark):
    df = spark.createDataFrame([("ÀB c", "YES")], "instruction string, output string")
    row = df.select(prompt_text(F.col("instruction"), "Q: {instruction} A: ").alias("t")).first()
    assert row.t == "Q: àb c A: "
    ids = build_sft(df, template="Q: {instruction} A: ").first().input_ids
    assert ids == [ord(c) + 3 for c in "Q: àb c A: yes"] + [2]
    with pytest.raises(ValueError):
        prompt_text(F.col("instruction"), "no slot")


def test_null_policy(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "c")], "k int, instruction string, output string")
    with pytest.raises(Exception, match="NULL in column output"):
        build_sft(df).collect()
    assert [r.k for r in build_sft(df, on_null="drop").collect()] == [2]
    # Rows removed before the check cannot make it fail, wherever later filters end up.
    assert build_sft(df.filter("k = 2")).filter("not repaired").count() == 1


@pytest.mark.parametrize("min_rows", [5, 8_000])
def test_pairs(spark, min_rows):
    rng = random.Random(2)
    rows = []
    for conv in range(12):
        for i in range(60 if conv == 3 else 7):
            role = rng.choice(["user", "assistant", "system"])
            rows.append((conv, i * 2, role, f"{conv}-{i}"))
    ordered = sorted(rows)
    expected = {
        (a[0], a[1], a[3], b[3])
        for a, b in zip(ordered, ordered[1:])
        if a[0] == b[0] and a[2] == "user" and b[2] == "assistant"
    }
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = pairs_from_turns(df.repartition(3), min_rows=min_rows).collect()
    assert len(got) == len(expected)
    assert {tuple(r) for r in got} == expected


@pytest.mark.parametrize("batch,multiple", [(1, 8), (2, 8), (4, 3)])
def test_padding(spark, batch, multiple):
    lengths = [1, 7, 8, 9, 16, 17, 3, 0, 24]
    rows = [(i, list(range(1, n + 1)), [1] * n, [-100] * (n // 2) + list(range(n - n // 2)))
            for i, n in enumerate(lengths)]
    df = spark.createDataFrame(
        rows, "ord bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"
    )
    got = {r.ord: r for r in pad_batches(df.repartition(3), batch, multiple).collect()}
    for i, ids, mask, labels in rows:
        mates = lengths[i // batch * batch : (i // batch + 1) * batch]
        width = -(-max(mates) // multiple) * multiple
        gap = width - len(ids)
        r = got[i]
        assert r.width == width and r.batch_id == i // batch
        assert r.input_ids == [0] * gap + ids
        assert r.attention_mask == [0] * gap + mask
        assert r.labels == [-100] * gap + labels


def test_mix_keeps_duplicates_and_order(spark):
    same = [(0, [1], [1], [1]), (1, [1], [1], [1])]
    schema = "ord bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"
    part = spark.createDataFrame(same, schema)
    rows = mix(part, part).orderBy("ord").collect()
    assert [(r.source, r.ord) for r in rows] == [("pt", 0), ("pt", 1), ("sft", 2), ("sft", 3)]
    assert mix(None, part).count() == 2 and mix(part, None).count() == 2
    with pytest.raises(ValueError):
        mix(None, None)


def test_whole_mix(spark):
    docs = spark.createDataFrame([(i, "text %d" % i) for i in range(50)], "doc int, text string")
    pairs = spark.createDataFrame([(i, "ask", "answer") for i in range(9)], "k int, instruction string, output string")
    config = MixConfig(block_size=16, pack_rows=5, max_len=64, validation_pct=10, max_blocks=10)
    rows = training_mix(docs, ["doc"], pairs, ["k"], config).orderBy("ord").collect()
    assert [r.ord for r in rows] == list(range(19))
    assert [r.source for r in rows] == ["pt"] * 10 + ["sft"] * 9
    assert set(EXAMPLE_SCHEMA.fieldNames()) <= set(rows[0].asDict())
    assert all(len(r.input_ids) == len(r.labels) == len(r.attention_mask) for r in rows)


def test_left_out_rows_leave_no_gaps(spark):
    rows = [(i, "q" * (i * 3 % 50), "a") for i in range(60)] + [(60, None, "a")]
    pairs = spark.createDataFrame(rows, "k int, instruction string, output string")
    template = "{instruction}"
    for max_len in (1, 2, 20, 40):
        config = MixConfig(max_len=max_len, template=template, on_null="drop", on_masked="drop")
        got = instruction_examples(pairs, ["k"], config).orderBy("ord").collect()
        direct = build_sft(pairs, max_len, template=template, on_null="drop", on_masked="drop")
        assert {(r.k, tuple(r.labels)) for r in got} == {(r.k, tuple(r.labels)) for r in direct.collect()}
        assert [r.ord for r in got] == list(range(len(got)))
    with pytest.raises(Exception, match="NULL in column instruction"):
        instruction_examples(pairs, ["k"], MixConfig(on_masked="drop")).collect()


def test_code_points_round_trip(spark):
    texts = ["", "abc", "\n\t é", "\U0001f600x", "日本"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for bos in (None, 1):
        rows = df.select("t", codepoints(F.col("t"), bos).alias("i")).withColumn("b", codepoints_to_text(F.col("i")))
        for r in rows.collect():
            assert r.i == [1] * (bos is not None) + [ord(c) + 3 for c in r.t]
            assert r.b == r.t


def test_words(spark):
    df = spark.createDataFrame([("It's  2 été, ok!",), ("",), (" \n",)], "t string")
    assert [r.w for r in df.select(words(F.col("t")).alias("w")).collect()] == [
        ["It", "'", "s", "2", "été", ",", "ok", "!"], [], []
    ]


def test_split_selection(spark):
    df = spark.createDataFrame([("train", 1)], "split string, x int")
    assert require_split(df, "train").count() == 1
    with pytest.raises(ValueError, match="validation"):
        require_split(df, "validation")
    with pytest.raises(ValueError):
        split_of(df.drop("split"), "train")
