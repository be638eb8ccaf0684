import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mixwright.operators.mixing import unpadded
from mixwright.plans.prepare import prepare
from mixwright.plans.training_mix import MixConfig
from mixwright.session import land
from tests.test_packing import assert_packed

CONFIG = MixConfig(block_size=16, pack_rows=4, max_len=40, add_bos=False)


@pytest.fixture
def inputs(tmp_path):
    corpus = tmp_path / "corpus"
    corpus.mkdir()
    lines = [f"line number {i}" for i in range(40)]
    (corpus / "a.txt").write_text("\n".join(lines[:25]) + "\n")
    (corpus / "b.txt").write_text("\n".join(lines[25:]) + "\n")
    pairs = tmp_path / "pairs.jsonl"
    pairs.write_text("\n".join(json.dumps({"instruction": f"q{i}", "output": f"a{i}"}) for i in range(10)))
    coded = [[ord(c) + 3 for c in line + "\n"] for line in lines]
    return str(corpus), str(pairs), coded


def ids(df, source):
    return [r.input_ids for r in df.filter(df.source == source).orderBy("ord").collect()]


def test_both_sources_with_a_percent_split(spark, inputs, tmp_path):
    corpus, pairs, coded = inputs
    out = str(tmp_path / "out")
    sets = prepare(spark, out, pt_train=corpus, sft_train=pairs, sft_validation=pairs, config=CONFIG)
    made = ids(sets.train, "pt")
    assert_packed(made, coded[2:], 16, 4)
    assert len(ids(sets.train, "sft")) == len(ids(sets.evaluation, "sft")) == 10
    assert_packed(ids(sets.corpus_validation, "pt"), coded[:2], 16, 4)
    assert sorted(r.ord for r in sets.train.collect()) == list(range(len(made) + 10))
    assert spark.read.json(f"{out}/reports/step_plan").first().n_rows == 10
    assert spark.read.json(f"{out}/reports/loader_plan").first().n_rows == len(made) + 10
    assert spark.read.json(f"{out}/reports/train_counts").count() == 2


def test_given_validation_and_caps(spark, inputs, tmp_path):
    corpus, pairs, coded = inputs
    config = MixConfig(block_size=16, pack_rows=4, add_bos=False, max_blocks=5)
    sets = prepare(
        spark, str(tmp_path / "out"), corpus, corpus, pairs, config=config, max_eval_blocks=3
    )
    whole = prepare(spark, str(tmp_path / "whole"), corpus, corpus, config=replace(config, max_blocks=None))
    made = ids(whole.train, "pt")
    assert_packed(made, coded, 16, 4)
    assert ids(sets.train, "pt") == made[:5]
    assert ids(sets.corpus_validation, "pt") == made[:3]
    assert sets.evaluation is None
    assert sorted(r.ord for r in sets.train.collect()) == list(range(15))


def test_single_sources(spark, inputs, tmp_path):
    corpus, pairs, _ = inputs
    only = prepare(spark, str(tmp_path / "a"), pt_train=corpus, config=CONFIG)
    assert {r.source for r in only.train.collect()} == {"pt"} and only.evaluation is None
    only = prepare(spark, str(tmp_path / "b"), pt_train="/none", sft_train=pairs, config=CONFIG)
    assert {r.source for r in only.train.collect()} == {"sft"} and only.corpus_validation is None
    with pytest.raises(ValueError, match="required"):
        prepare(spark, str(tmp_path / "c"))
    spark.createDataFrame([(i, "q", "a") for i in range(4)], "k int, instruction string, output string") \
        .createOrReplaceTempView("table_pairs")
    mixed = prepare(
        spark, str(tmp_path / "d"), sft_train="table_pairs", sft_validation=pairs,
        config=CONFIG, pair_keys=["k"],
    )
    assert mixed.train.count() == 4 and mixed.evaluation.count() == 10


@pytest.mark.parametrize("kind, landed", [("json", False), ("txt", True)])
def test_scanned_objects_are_stored_once(spark, tmp_path, monkeypatch, kind, landed):
    """The scan of JSON objects stores its rows; ``prepare`` does not write the texts again."""
    texts = [f"text {i}" * 5 for i in range(30)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    frame.write.format("json" if kind == "json" else "text").save(str(tmp_path / "corpus"))
    stored = []

    def watched(df, *more):
        stored.append("text" in df.columns)
        return land(df, *more)

    monkeypatch.setattr("mixwright.plans.prepare.land", watched)
    config = MixConfig(block_size=8, pack_rows=1, add_bos=False)
    sets = prepare(spark, str(tmp_path / "out"), str(tmp_path / "corpus"), str(tmp_path / "corpus"), config=config, keep_linebreaks=False)
    assert any(stored) == landed
    got = [r.input_ids for r in sets.train.orderBy("ord").collect()]
    want = [[ord(c) + 3 for c in t[i : i + 8]] for t in texts for i in range(0, len(t) - 7, 8)]
    assert sorted(got) == sorted(want)


def test_padded_sets_are_written_by_bounded_tasks(spark, inputs, tmp_path, monkeypatch):
    """One shard, but no task holds more rows than its share; the reports count every row once."""
    monkeypatch.setattr("mixwright.plans.prepare.TASK_IDS", 400, raising=False)
    corpus, pairs, _ = inputs
    out = str(tmp_path / "out")
    sets = prepare(spark, out, corpus, sft_train=pairs, config=CONFIG, shards=1, pad=4)
    plain = prepare(spark, str(tmp_path / "plain"), corpus, sft_train=pairs, config=CONFIG, shards=1)
    files = sets.train.withColumn("file", F.input_file_name()).groupBy("file").agg(F.count("*").alias("n"), F.countDistinct("shard").alias("s")).collect()
    n = sets.train.count()
    # 400 // max_len 40 = 10 rows, rounded up to whole batches of 4.
    assert len(files) == -(-n // 12) > 3 and all(r.n <= 12 and r.s == 1 for r in files)
    order = lambda df: [(r.source, r.ord, r.input_ids, r.labels) for r in df.orderBy("ord").collect()]
    assert order(unpadded(sets.train)) == order(plain.train)
    counts = {r.source: (r.n_rows, r.n_tokens) for r in spark.read.json(f"{out}/reports/train_counts").collect()}
    made = {s: ids(plain.train, s) for s in ("pt", "sft")}
    assert counts == {s: (len(rows), sum(map(len, rows))) for s, rows in made.items()}
    repaired = spark.read.json(f"{out}/reports/repaired").first()
    assert (repaired.n_rows, repaired.n_repaired) == (10, 0)
