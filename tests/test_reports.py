import math
from collections import Counter

import pytest

from mixwright.plans.reports import (
    RunConfig,
    fit_unigram,
    loader_plan,
    mix_counts,
    perplexity,
    score_unigram,
    step_plan,
)


@pytest.mark.parametrize("n", [0, 1, 64, 65, 233, 10_000])
@pytest.mark.parametrize(
    "config",
    [RunConfig(), RunConfig(3, 1, 2, 2.5, 0.0, 17), RunConfig(1, 2, 5, 3, 0.03)],
)
def test_step_and_loader_plan(spark, n, config):
    df = spark.range(n)
    r = step_plan(df, config).first()
    batch = config.per_device * config.world * config.accumulation
    total = math.ceil(n / batch) * config.epochs
    assert (r.n_rows, r.batch_size, r.t_total) == (n, batch, total)
    assert r.eval_steps == r.save_steps == max(total // 2, 5)
    warmup = int(total * config.warmup_ratio) if config.warmup_ratio > 0 else config.warmup_steps
    assert r.warmup_steps == warmup
    r = loader_plan(df, config).first()
    loader = math.ceil(n / (config.per_device * config.world))
    updates = loader // config.accumulation
    assert (r.loader_length, r.updates_per_epoch, r.total_batch) == (loader, updates, batch)
    assert (r.n_samples, r.max_steps) == (n * config.epochs, math.ceil(config.epochs * updates))


def test_perplexity(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("big", 711.0)], "grp string, loss double")
    rows = {r.grp: r for r in perplexity(df, "loss", ["grp"]).collect()}
    assert rows["a"].perplexity == pytest.approx(math.exp(1.5)) and rows["a"].eval_samples == 2
    assert rows["big"].perplexity == math.inf
    assert perplexity(df).first().eval_samples == 3


def test_unigram(spark):
    fit = [[1, 1, 1, 2], [2, 3], []]
    held = [("x", [-100, 1, 9, 1]), ("y", [3]), ("x", [-100])]
    model = fit_unigram(spark.createDataFrame([(f,) for f in fit], "input_ids array<int>"))
    counts = Counter(t for f in fit for t in f)
    space = sum(counts.values()) + len(counts) + 1

    def loss(token):
        return -math.log((counts[token] + 1) / space)

    df = spark.createDataFrame(held, "g string, labels array<int>")
    rows = {r.g: r for r in score_unigram(df, model, by=["g"]).collect()}
    assert rows["x"].eval_loss == pytest.approx((2 * loss(1) + loss(9)) / 3)
    assert rows["x"].n_tokens == 3 and rows["y"].eval_loss == pytest.approx(loss(3))
    whole = score_unigram(df, model).first()
    assert whole.perplexity == pytest.approx(math.exp((2 * loss(1) + loss(9) + loss(3)) / 4))


def test_mix_counts(spark):
    df = spark.createDataFrame(
        [("train", "pt", [1, 2]), ("train", "pt", []), ("validation", "sft", [1])],
        "split string, source string, input_ids array<int>",
    )
    got = {(r.split, r.source): (r.n_rows, r.n_tokens) for r in mix_counts(df).collect()}
    assert got == {("train", "pt"): (2, 2), ("validation", "sft"): (1, 1)}
