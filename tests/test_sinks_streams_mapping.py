import pathlib
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mixwright.operators.mapping import encode_with, map_batches, map_rows
from mixwright.operators.mixing import pad_batches, unpadded
from mixwright.operators.sft import build_sft
from mixwright.plans.encoders import vocabulary_encoder
from mixwright.plans.reports import perplexity
from mixwright.plans.training_mix import MixConfig, corpus_blocks
from mixwright.sinks.examples import Padding, _smaller, rows_at, write_examples, write_metrics
from mixwright.streaming.packing import pack_stream, read_packed


@pytest.mark.parametrize("fmt", ["parquet", "json"])
@pytest.mark.parametrize("shards", [1, 3, 50])
def test_example_shards(spark, tmp_path, fmt, shards):
    path = str(tmp_path / "out")
    rows = [("train", i) for i in range(40)] + [("validation", i) for i in range(7)]
    df = spark.createDataFrame(rows, "split string, ord bigint").repartition(5)
    write_examples(df, path, fmt, shards)
    for split, n in (("train", 40), ("validation", 7)):
        back = []
        folders = sorted(pathlib.Path(path, f"split={split}").iterdir(), key=lambda p: int(p.name[6:]))
        for folder in folders:
            files = list(folder.glob("part-*"))
            assert len(files) == 1
            back += [r.ord for r in spark.read.format(fmt).load(str(folder)).collect()]
        assert back == list(range(n))
        assert len(folders) <= shards


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_sink_keeps_nulls(spark, tmp_path, fmt):
    rows = [(0, [1, 2], [1, 1], None), (1, [1, 2], None, [1, 2]), (2, [1], [0], [-100]), (3, [], [], []), (4, [7], [1], [7])]
    schema = "ord bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"
    write_examples(spark.createDataFrame(rows, schema), str(tmp_path / "o"), fmt, 2)
    back = spark.read.format(fmt).schema(schema).load(str(tmp_path / "o")).orderBy("ord").collect()
    assert [tuple(r)[:4] for r in back] == rows


def test_padding_keeps_null_labels(spark):
    rows = [(0, [1, 2], [1, 1], None), (1, [1], [1], [1])]
    schema = "ord bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"
    back = pad_batches(spark.createDataFrame(rows, schema), 2, 4).orderBy("ord").collect()
    assert [r.labels for r in back] == [None, [-100, -100, -100, 1]]


def test_metrics(spark, tmp_path):
    path = str(tmp_path / "m")
    write_metrics(perplexity(spark.createDataFrame([(1.0,)], "loss double")), path)
    assert len(list(pathlib.Path(path).glob("part-*"))) == 1
    assert spark.read.json(path).first().eval_samples == 1


def test_stateless_steps_on_a_stream(spark, tmp_path):
    rows = [(i, f"Ask {i}", f"Answer {i}") for i in range(20)]
    schema = "k int, instruction string, output string"
    batch = spark.createDataFrame(rows, schema)
    batch.write.json(str(tmp_path / "in"))
    stream = build_sft(spark.readStream.schema(schema).json(str(tmp_path / "in")), 30)
    query = stream.writeStream.format("memory").queryName("built").trigger(availableNow=True).start()
    query.awaitTermination()
    key = lambda r: r.k
    assert sorted(spark.table("built").collect(), key=key) == sorted(build_sft(batch, 30).collect(), key=key)


def test_pack_stream_and_replay(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "doc int, text string"
    config = MixConfig(block_size=16, pack_rows=3)
    parts = [
        spark.createDataFrame([(b * 10 + i, f"text {b} {i}") for i in range(7)], schema)
        for b in range(3)
    ]

    def run():
        stream = spark.readStream.schema(schema).json(source)
        pack_stream(stream, sink, state, ["doc"], config).awaitTermination()

    for part in parts:
        part.coalesce(1).write.mode("append").json(source)
        run()

    def rows():
        found = read_packed(sink, spark).select("batch_id", "ord", "input_ids").collect()
        return sorted((r.batch_id, r.ord, r.input_ids) for r in found)

    expected = []
    for b, part in enumerate(parts):
        blocks = corpus_blocks(part, ["doc"], config).orderBy("ord").collect()
        expected += [(b, len(expected) + i, r.input_ids) for i, r in enumerate(blocks)]
    assert [at for _, at, _ in rows()] == list(range(len(expected)))
    assert rows() == expected
    # The last commit record is moved away, as after a failure between write and commit.
    record = pathlib.Path(state, "commits", "2")
    record.rename(tmp_path / "moved")
    checksum = pathlib.Path(state, "commits", ".2.crc")
    if checksum.exists():
        checksum.rename(tmp_path / "moved.crc")
    run()
    assert rows() == expected


def deliver(spark, folder, parts, keys, config, **more):
    """Each part as a micro-batch of its own."""
    source, sink, state = (str(folder / n) for n in ("in", "out", "state"))
    for part in parts:
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(parts[0].schema).parquet(source)
        pack_stream(stream, sink, state, keys, config, **more).awaitTermination()
    return read_packed(sink, spark)


def test_pack_stream_with_splits_and_a_cap(spark, tmp_path):
    """Each split has ordinals of its own, an empty delivery and one without a block change
    nothing, and the cap holds for the whole stream."""
    schema = "doc int, text string, size int"
    texts = [[f"delivery {b} row {i}" * (i % 3) for i in range(n)] for b, n in enumerate([9, 0, 1, 11])]
    parts = [spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(ts)], schema) for ts in texts]
    config = MixConfig(block_size=8, pack_rows=2, validation_pct=30, add_bos=False, max_blocks=20)
    found = deliver(spark, tmp_path, parts, ["doc"], config, length="size")
    expected, begun = [], {}
    for part in parts:
        free = replace(config, max_blocks=None)
        for r in corpus_blocks(part, ["doc"], free).orderBy("split", "ord").collect():
            begun[r.split] = begun.get(r.split, -1) + 1
            if begun[r.split] < 20:
                expected.append((r.split, begun[r.split], r.input_ids))
    got = sorted((r.split, r.ord, r.input_ids) for r in found.collect())
    assert got == sorted(expected) and len(got) > 25


def test_pack_stream_with_a_joined_vocabulary(spark, tmp_path):
    """A vocabulary beyond the broadcast size, which lacks the commonest word of the stream."""
    vocab = spark.createDataFrame([(f"w{i}", i + 4) for i in range(1, 40)], "token string, id int")
    encoder = vocabulary_encoder(vocab, inline=3, broadcast=5)
    config = MixConfig(block_size=4, pack_rows=5, add_bos=False, encoder=encoder)
    rows = [[(i, "w0 " * 30 + f"w{i} w{i + b}") for i in range(10)] for b in range(2)]
    parts = [spark.createDataFrame(r, "doc int, text string") for r in rows]
    found = deliver(spark, tmp_path, parts, ["doc"], config).orderBy("ord").collect()
    want = []
    for part in rows:
        ids = [[int(w[1:]) + 4 if w != "w0" else 3 for w in t.split()] for _, t in part]
        for batch in (sum(ids[:5], []), sum(ids[5:], [])):
            want += [batch[i : i + 4] for i in range(0, len(batch) - 3, 4)]
    assert [r.input_ids for r in found] == want and [r.ord for r in found] == list(range(len(want)))


def test_pack_stream_refuses_tables(spark, tmp_path):
    with pytest.raises(ValueError):
        pack_stream(spark.range(1), str(tmp_path), str(tmp_path), ["id"])


def test_map_rows_and_batches(spark):
    df = spark.createDataFrame([(i, "ab" * i) for i in range(9)], "k int, t string").repartition(3)
    got = map_rows(df, lambda r: {"k": r["k"], "n": len(r["t"])}, "k int, n int").collect()
    assert sorted(tuple(r) for r in got) == [(i, 2 * i) for i in range(9)]

    def twice_even(batch):
        keep = [k for k in batch["k"] if k % 2 == 0]
        return {"k": keep + keep}

    got = map_batches(df, twice_even, "k int", tasks=2)
    assert sorted(r.k for r in got.collect()) == sorted([0, 2, 4, 6, 8] * 2)


def test_own_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    tokenizer = Tokenizer(models.WordLevel(unk_token="?"))
    tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
    texts = ["a b c", "c b zz", ""]
    tokenizer.train_from_iterator(texts[:1], trainers.WordLevelTrainer(special_tokens=["?"]))
    path = tmp_path / "own-tokenizer.json"
    tokenizer.save(str(path))
    spark.sparkContext.addFile(str(path))

    def load():
        from pyspark import SparkFiles

        own = Tokenizer.from_file(SparkFiles.get("own-tokenizer.json"))
        return lambda batch: [e.ids for e in own.encode_batch(batch, add_special_tokens=False)]

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.ids for r in df.select("t", encode_with(F.col("t"), load).alias("ids")).collect()}
    assert got == {t: tokenizer.encode(t, add_special_tokens=False).ids for t in texts}


def test_rows_by_ordinal(spark, tmp_path):
    path = str(tmp_path / "o")
    df = spark.createDataFrame([(i, [i]) for i in range(100)], "ord bigint, input_ids array<int>").repartition(3)
    seen = write_examples(df, path, shards=10, watch={"n": F.count(F.lit(1)), "top": F.max("ord")})
    assert seen == {"n": 100, "top": 99}
    found = rows_at(spark, path, [7, 95, 7, 0])
    assert sorted(r.ord for r in found.collect()) == [0, 7, 95]
    assert len(found.inputFiles()) == 2
    assert rows_at(spark, path, []).count() == 0
    with pytest.raises(IndexError):
        rows_at(spark, path, [100])
    with pytest.raises(ValueError, match="validation"):
        rows_at(spark, path, [1], "validation")


def test_padded_shards(spark, tmp_path):
    path = str(tmp_path / "o")
    rows = [(i, list(range(i % 13)), [1] * (i % 13), None if i == 5 else [-100] * (i % 13)) for i in range(50)]
    schema = "ord bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"
    df = spark.createDataFrame(rows, schema).repartition(4)
    write_examples(df, path, shards=4, pad=Padding(6, 4), watch={"n": F.sum(F.size("input_ids"))})
    columns = ["ord", "batch_id", "width", "input_ids", "attention_mask", "labels"]
    got = spark.read.parquet(path)
    assert got.select(*columns).orderBy("ord").collect() == pad_batches(df, 6, 4).select(*columns).orderBy("ord").collect()
    assert got.groupBy("batch_id").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0
    plain = unpadded(got).orderBy("ord").collect()
    assert [(r.ord, r.input_ids, r.attention_mask, r.labels) for r in plain] == rows


@pytest.mark.parametrize("pad", [None, Padding(6, 4)])
def test_large_shards_are_written_by_several_tasks(spark, tmp_path, pad):
    """However few shards there are, a task writes at most ``task_rows`` rows, batches whole."""
    path = str(tmp_path / "o")
    rows = [(i, list(range(i % 13)), [1] * (i % 13), [-100] * (i % 13)) for i in range(100)]
    schema = "ord bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"
    df = spark.createDataFrame(rows, schema).repartition(4)
    seen = write_examples(df, path, shards=2, pad=pad, watch={"n": F.count(F.lit(1))}, task_rows=18)
    assert seen == {"n": 100}
    back = spark.read.parquet(path).withColumn("file", F.input_file_name())
    per = 50 if pad is None else 54
    assert {(r.shard, r.ord // per) for r in back.collect()} == {(0, 0), (1, 1)}
    files = back.groupBy("file").agg(F.min("ord").alias("a"), F.max("ord").alias("z"), F.count("*").alias("n")).collect()
    assert len(files) == 6 and all(r.n <= 18 and r.z - r.a + 1 == r.n for r in files)
    columns = ["ord", "input_ids", "attention_mask", "labels"]
    want = df if pad is None else pad_batches(df, 6, 4)
    assert back.select(*columns).orderBy("ord").collect() == want.select(*columns).orderBy("ord").collect()


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_tasks_are_bounded_by_default(spark, tmp_path, fmt):
    """Few shards of many rows, written as the sink queries write them: no settings but ``shards``."""
    path, n = str(tmp_path / "o"), 20_000
    ids = F.array(F.col("id").cast("int"), (F.col("id") + 1).cast("int"))
    own = F.col("id") % 3 == 0
    df = spark.range(n, numPartitions=3).select(
        F.col("id").alias("ord"), ids.alias("input_ids"), F.array(F.lit(1), F.lit(1)).alias("attention_mask"),
        F.when(own, F.array(F.lit(-100), (F.col("id") + 1).cast("int"))).otherwise(ids).alias("labels"),
    )
    write_examples(df, path, fmt, shards=2)
    columns = df.columns
    schema = "ord bigint, input_ids array<int>, attention_mask array<int>, labels array<int>, split string, shard int"
    back = spark.read.format(fmt).schema(schema).load(path)
    rows = back.withColumn("file", F.input_file_name())
    files = rows.groupBy("shard", "file").agg(F.min("ord").alias("a"), F.max("ord").alias("z"), F.count("*").alias("n")).collect()
    assert sorted((r.shard, r.a, r.n) for r in files) == [(0, 0, 8192), (0, 8192, 1808), (1, 10_000, 8192), (1, 18_192, 1808)]
    assert all(r.z - r.a + 1 == r.n for r in files)
    order = lambda rows: sorted(map(tuple, rows.select(columns).collect()))
    assert order(back) == order(df)


def test_json_shards_are_compressed(spark, tmp_path):
    """Mask and labels, which repeat what the ids say, take next to no room on disk."""
    path, n, width = str(tmp_path / "o"), 500, 256
    ids = F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: (F.xxhash64("id", i) % 100 + 200).cast("int"))
    df = spark.range(n).select(F.col("id").alias("ord"), ids.alias("input_ids")).withColumns(
        {"attention_mask": F.transform("input_ids", lambda i: F.lit(1)), "labels": F.col("input_ids")}
    )
    write_examples(df, path, "json", shards=2)
    files = list(pathlib.Path(path).glob("split=train/shard=*/part-*"))
    assert len(files) == 2 and sum(f.stat().st_size for f in files) < 3 * n * width
    schema = "ord bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"
    back = spark.read.schema(schema).json(path).select(df.columns)
    assert back.orderBy("ord").collect() == df.orderBy("ord").collect()
    assert rows_at(spark, path, [77]).first().input_ids == df.filter("ord = 77").first().input_ids


IDS = [
    [], None, [None], [5, None, -100], [127, -127], [128], [-128], [32_767, -32_767, 1], [32_768], [-32_768],
    [2**31 - 1, -(2**31), None, 0], [7] * 3,
]


def test_ids_travel_in_few_bytes(spark):
    """A row's ids are in one column, that of the smallest type that holds them all."""
    df = spark.createDataFrame([(i, ids, IDS[-1 - i]) for i, ids in enumerate(IDS)], "ord bigint, input_ids array<int>, labels array<int>")
    small, wide = _smaller(df)
    for name in ("input_ids", "labels"):
        kinds = [f"_tinyint_{name}", f"_smallint_{name}", name]
        rows = df.withColumns(small).orderBy("ord").collect()
        assert [[k for k, c in enumerate(kinds) if r[c] is not None] for r in rows][:: 1 if name == "input_ids" else -1] == [
            [0], [], [0], [0], [0], [1], [1], [1], [2], [2], [2], [0],
        ]
    back = df.withColumns(small).withColumns(wide).select(df.columns)
    assert back.dtypes == df.dtypes and back.orderBy("ord").collect() == df.orderBy("ord").collect()


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_sink_keeps_ids_of_any_size(spark, tmp_path, fmt):
    schema = "ord bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"
    rows = [(i, ids, None if ids is None else [1] * len(ids), IDS[i - 5]) for i, ids in enumerate(IDS)]
    write_examples(spark.createDataFrame(rows, schema), str(tmp_path / "o"), fmt, 2)
    back = spark.read.format(fmt).schema(schema).load(str(tmp_path / "o")).orderBy("ord").collect()
    assert [tuple(r)[:4] for r in back] == rows
    # Ids of another type travel as they are.
    write_examples(spark.createDataFrame([(0, [2**40])], "ord bigint, input_ids array<bigint>"), str(tmp_path / "b"), fmt, 1)
    assert spark.read.format(fmt).schema("input_ids array<bigint>").load(str(tmp_path / "b")).first().input_ids == [2**40]


def test_more_ordinals_than_a_plan_lists(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("mixwright.sinks.examples.MOST_ORDINALS", 3)
    path = str(tmp_path / "o")
    df = spark.createDataFrame([(i, [i]) for i in range(100)], "ord bigint, input_ids array<int>")
    write_examples(df, path, shards=10)
    found = rows_at(spark, path, [7, 95, 7, 0, 8])
    assert sorted((r.ord, r.input_ids) for r in found.collect()) == [(i, [i]) for i in (0, 7, 8, 95)]
    assert len(found.inputFiles()) == 2


def test_functions_get_bounded_pieces(spark):
    """What a function gets at once has a bounded size, however long the texts are."""
    df = spark.range(60).select("id", F.repeat(F.lit("x"), F.when(F.col("id") == 7, 3_000_000).otherwise(90_000).cast("int")).alias("t")).coalesce(1)

    def seen(batch):
        return {"id": batch["id"], "n": [sum(map(len, batch["t"]))] * len(batch["id"])}

    got = {r.id: r.n for r in map_batches(df, seen, "id bigint, n bigint").collect()}
    assert sorted(got) == list(range(60)) and got[7] == 3_000_000
    assert max(n for k, n in got.items() if k != 7) <= 1_000_000

    def load():
        return lambda texts: [[sum(map(len, texts)), len(t)] for t in texts]

    rows = {r.id: r.ids for r in df.select("id", encode_with(F.col("t"), load).alias("ids")).collect()}
    assert {k: v[1] for k, v in rows.items()} == {k: 3_000_000 if k == 7 else 90_000 for k in range(60)}
    assert max(v[0] for k, v in rows.items() if k != 7) <= 1_000_000


def test_placed_rows_are_written_where_they_lie(spark, tmp_path):
    """Rows in runs of consecutive ordinals make no exchange; shards, index and counts are the same."""
    path = str(tmp_path / "o")
    rows = [(i, list(range(i % 13)), [1] * (i % 13), [-100] * (i % 13)) for i in range(100)]
    schema = "ord bigint, input_ids array<int>, attention_mask array<int>, labels array<int>"
    df = spark.createDataFrame(rows, schema).repartitionByRange(3, "ord")
    seen = write_examples(df, path, shards=4, rows={"train": 100}, watch={"n": F.count(F.lit(1))}, placed=True)
    assert seen == {"n": 100}
    back = spark.read.parquet(path)
    assert all(r.shard == r.ord // 25 for r in back.collect())
    assert len(back.inputFiles()) <= 4 + 3
    assert [tuple(r)[:4] for r in back.orderBy("ord").collect()] == rows
    assert [r.ord for r in rows_at(spark, path, [25, 99]).orderBy("ord").collect()] == [25, 99]
    with pytest.raises(ValueError, match="exchange"):
        write_examples(df, path, pad=Padding(6), placed=True)
