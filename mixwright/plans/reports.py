"""Counts, step plans, perplexity and the unigram baseline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.functions.numbers import ceil_div, whole_div
from mixwright.schema import IGNORE_INDEX, refuse_stream
from mixwright.session import cut_lineage

SALTS = 16


@dataclass(frozen=True)
class RunConfig:
    """Settings that the step plans need."""

    per_device: int = 2
    world: int = 8
    accumulation: int = 4
    epochs: float = 4
    warmup_ratio: float = 0.1
    warmup_steps: int = 0

    @property
    def rows_per_step(self) -> int:
        return self.per_device * self.world * self.accumulation


def mix_counts(df: DataFrame, tokens: str = "input_ids") -> DataFrame:
    """Rows and tokens per split and source (whichever of the two columns exist)."""
    by = [c for c in ("split", "source") if c in df.columns]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.size(tokens).cast("bigint")), F.lit(0)).alias("n_tokens"),
    )


def _counted(df: DataFrame, rows: int | None) -> DataFrame:
    if rows is not None:
        return df.sparkSession.range(1).select(F.lit(rows).cast("bigint").alias("n_rows"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def step_plan(df: DataFrame, config: RunConfig = RunConfig(), rows: int | None = None) -> DataFrame:
    """Steps, evaluation interval and warm-up from the number of instruction rows (``rows``
    where it is known)."""
    refuse_stream(df, "step_plan")
    total = ceil_div(F.col("n_rows"), config.rows_per_step) * F.lit(float(config.epochs))
    interval = F.greatest(F.floor(F.col("t_total") / 2), F.lit(5)).cast("bigint")
    warmup = (
        F.floor(F.col("t_total") * config.warmup_ratio)
        if config.warmup_ratio > 0
        else F.lit(config.warmup_steps)
    )
    return (
        _counted(df, rows)
        .withColumn("batch_size", F.lit(config.rows_per_step).cast("bigint"))
        .withColumn("t_total", total)
        .withColumns(
            {
                "eval_steps": interval,
                "save_steps": interval,
                "warmup_steps": warmup.cast("bigint"),
            }
        )
    )


def loader_plan(df: DataFrame, config: RunConfig = RunConfig(), rows: int | None = None) -> DataFrame:
    """Updates, samples and optimization steps from the merged row count (``rows`` where it
    is known)."""
    refuse_stream(df, "loader_plan")
    loader = ceil_div(F.col("n_rows"), config.per_device * config.world)
    epochs = F.lit(float(config.epochs))
    return (
        _counted(df, rows)
        .withColumn("loader_length", loader)
        .withColumn("updates_per_epoch", whole_div(F.col("loader_length"), config.accumulation))
        .withColumn("total_batch", F.lit(config.rows_per_step).cast("bigint"))
        .withColumn("n_samples", F.col("n_rows") * epochs)
        .withColumn("max_steps", F.ceil(epochs * F.col("updates_per_epoch")).cast("bigint"))
    )


def perplexity(df: DataFrame, loss: str = "loss", by: Sequence[str] = ()) -> DataFrame:
    """Mean loss, its exponential (infinite on overflow) and the rows scored."""
    return df.groupBy(*by).agg(
        F.avg(loss).alias("eval_loss"),
        F.exp(F.avg(loss)).alias("perplexity"),
        F.count(loss).alias("eval_samples"),
    )


def fit_unigram(df: DataFrame, tokens: str = "input_ids") -> DataFrame:
    """(token, n): how often each token occurs."""
    counted = df.select(F.explode_outer(tokens).alias("token")).groupBy("token")
    return cut_lineage(counted.agg(F.count(F.lit(1)).alias("n")).filter("token is not null"))


def _visible(labels: Column, kind: str) -> Column:
    if kind == "string":
        return labels
    return F.filter(labels, lambda x: x != IGNORE_INDEX)


def score_unigram(
    df: DataFrame, model: DataFrame, labels: str = "labels", by: Sequence[str] = ()
) -> DataFrame:
    """Add-one loss of the visible labels, per ``by`` group.

    Equal tokens of a group are counted before they meet the model, so the join sees each
    (group, token) once however common the token is.
    """
    refuse_stream(df, "score_unigram")
    by = list(by)
    totals = model.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("token").alias("v")).first()
    space = float(totals["n"] + totals["v"] + 1)
    kind = df.schema[labels].dataType.elementType.simpleString()
    seen = (
        df.select(*by, F.explode_outer(_visible(F.col(labels), kind)).alias("token"))
        .filter("token is not null")
        .groupBy(*by, "token")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    if by:
        # A common token has a row for each group: they are spread over SALTS tasks.
        salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
        salted = seen.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)))
        joined = salted.join(model.withColumn("_salt", salts), ["token", "_salt"], "left")
    else:
        joined = seen.join(model, "token", "left")
    loss = -F.log((F.coalesce("n", F.lit(0)) + 1) / F.lit(space))
    weighted = F.sum(F.col("times") * loss) / F.sum("times")
    return joined.groupBy(*by).agg(
        weighted.alias("eval_loss"),
        F.exp(weighted).alias("perplexity"),
        F.sum("times").alias("n_tokens"),
    )
