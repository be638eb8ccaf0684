"""A quality classifier on document statistics.

Method: random Fourier features approximate a Gaussian kernel over standardised statistics
of a text; each partition sums its part of the normal equations, the sums are added, and a
ridge solution gives raw scores. Isotonic calibration turns them into probabilities: it is
fitted on out-of-fold scores (each learning fold scored by the model of the other one),
binned by their value, so neither rows nor scores are collected.

All sums are of whole multiples of a small power of two, so they are exact in floating
point and do not depend on the order in which tasks end: reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import HELD_OUT_FOLD, fold_of, land, learning_labels

FEATURES = 192  # random Fourier features
RIDGE = 1.0
BINS = 2048
LOW, HIGH = -0.5, 1.5  # raw scores are binned between these
SEED = 20_240_229
_UNIT = 2.0**12

_CLASSES = {
    "lower": range(ord("a"), ord("z") + 1),
    "upper": range(ord("A"), ord("Z") + 1),
    "digit": range(ord("0"), ord("9") + 1),
    "wide": range(0x80, 0x100),
    "blank": (9, 11, 12, 13, 32),
    "stop": b".,;:",
    "loud": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*^~@<>{}[]\\/_=+`",
    "quote": b"\"'()-",
}
_CLASS_OF = np.zeros((256, len(_CLASSES)))
for _i, _members in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_members), _i] = 1.0
STATISTICS = len(_CLASSES) + 12


def statistics_of(text: str) -> np.ndarray:
    """Statistics of the whole text; the empty text has its own fixed vector (zeros)."""
    out = np.zeros(STATISTICS)
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    out[: len(_CLASSES)] = counts @ _CLASS_OF / len(raw)
    words = text.split()
    lines = text.split("\n")
    n, m = max(1, len(words)), len(lines)
    kinds = set(words)
    letters = max(1.0, float(counts @ (_CLASS_OF[:, 0] + _CLASS_OF[:, 1] + _CLASS_OF[:, 3])))
    out[len(_CLASSES) :] = (
        math.log1p(len(raw)),
        math.log1p(len(words)),
        len(raw) / n / 10,
        len(kinds) / n,
        math.log1p(m),
        math.log1p(n / m),
        len(set(lines)) / m,
        float(counts @ _CLASS_OF[:, 1]) / letters,
        float(counts @ _CLASS_OF[:, 6]) / n,
        float(counts @ _CLASS_OF[:, 8]) / n,
        float(counts[ord("|")]) / n,
        float(counts[ord(".")]) / n,
    )
    return out


@dataclass(frozen=True)
class Model:
    """Everything a task needs to score: about half a megabyte at most."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[int, np.ndarray] = field(default_factory=dict)
    at: np.ndarray | None = None  # calibration knots: raw score -> probability
    value: np.ndarray | None = None


def _fourier(seed: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(0, 1 / math.sqrt(STATISTICS), (STATISTICS, features)), rng.uniform(0, 2 * math.pi, features)


def features_of(stats: np.ndarray, model: Model, seed: int, features: int) -> np.ndarray:
    """Rounded random Fourier features and a constant, one row for each text."""
    omega, phase = _fourier(seed, features)
    x = np.clip((stats - model.mean) / model.scale, -8, 8)
    z = np.cos(x @ omega + phase)
    return np.concatenate([np.round(z * _UNIT) / _UNIT, np.ones((len(stats), 1))], axis=1)


def _stack(column) -> np.ndarray:
    rows = [np.asarray(v, dtype=np.float64) for v in column]
    return np.stack(rows) if rows else np.zeros((0, STATISTICS))


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        stats = [np.round(statistics_of(t or "") * _UNIT) / _UNIT for t in batch["text"]]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "stats": stats})


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) of each row; the only step that reads texts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(_measure, f"doc_id {kind}, stats array<double>")


def _standard(known: DataFrame) -> Model:
    """Mean and deviation of each statistic over the learning rows (exact sums)."""
    sums = []
    for i in range(STATISTICS):
        value = F.get("stats", F.lit(i))
        sums += [F.sum(value).alias(f"s{i}"), F.sum(value * value).alias(f"q{i}")]
    row = known.agg(F.count("*").alias("n"), *sums).first()
    n = max(1, row["n"])
    mean = np.array([(row[f"s{i}"] or 0.0) / n for i in range(STATISTICS)])
    square = np.array([(row[f"q{i}"] or 0.0) / n for i in range(STATISTICS)])
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return Model(mean, np.where(deviation > 1e-6, deviation, 1.0))


def _normal_equations(model: Model, seed: int, features: int):
    """Per partition and fold: the rows of [Z'Z | Z'y], one output row for each."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            z = features_of(_stack(batch["stats"]), model, seed, features)
            y = batch["y"].to_numpy(np.float64)
            folds = batch["fold"].to_numpy()
            for fold in np.unique(folds):
                of = z[folds == fold]
                part = of.T @ np.concatenate([of, y[folds == fold, None]], axis=1)
                total[int(fold)] = total.get(int(fold), 0) + part
        for fold, matrix in total.items():
            yield pd.DataFrame({"fold": fold, "i": np.arange(len(matrix)), "sums": list(matrix)})

    return sums


def _add(group: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {"fold": group["fold"].iloc[:1], "i": group["i"].iloc[:1], "sums": [np.sum(np.stack(list(group["sums"])), axis=0)]}
    )


def _solve(matrix: np.ndarray, ridge: float) -> np.ndarray:
    gram = matrix[:, :-1] + ridge * np.eye(len(matrix))
    gram[-1, -1] -= ridge * (1 - 1e-6)  # the constant is hardly shrunk
    return np.linalg.solve(gram, matrix[:, -1])


def _fit_weights(known: DataFrame, model: Model, ridge: float, seed: int, features: int) -> dict[int, np.ndarray]:
    """Weights of each learning fold, and of all of them under -1."""
    parts = known.mapInPandas(_normal_equations(model, seed, features), "fold int, i int, sums array<double>")
    added = parts.groupBy("fold", "i").applyInPandas(_add, "fold int, i int, sums array<double>")
    matrices: dict[int, np.ndarray] = {}
    for row in added.collect():  # folds times (features + 1) rows
        matrices.setdefault(row["fold"], np.zeros((features + 1, features + 2)))[row["i"]] = row["sums"]
    if not matrices:
        return {}
    matrices[-1] = sum(matrices.values())
    return {fold: _solve(m, ridge) for fold, m in matrices.items()}


def isotonic(at: np.ndarray, weight: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a rising map from score to share of positives.

    Knots are the weighted centres of the pooled blocks; between them the map is linear, so
    different scores mostly stay different.
    """
    blocks: list[list[float]] = []  # weight, positives, weighted score
    for a, w, p in zip(at, weight, positive):
        blocks.append([w, p, w * a])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w2, p2, s2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w2, blocks[-1][1] + p2, blocks[-1][2] + s2]
    knots = np.array([b[2] / b[0] for b in blocks])
    # Shares are drawn a little inwards, so that no block claims certainty.
    values = np.array([(b[1] + 0.5 * positive.sum() / weight.sum()) / (b[0] + 0.5) for b in blocks])
    return knots, np.maximum.accumulate(values)


def _raw(z: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.clip(z @ weights, LOW, HIGH)


def _bin_scores(model: Model, seed: int, features: int):
    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = features_of(_stack(batch["stats"]), model, seed, features)
            folds = batch["fold"].to_numpy()
            raw = np.zeros(len(z))
            for fold in np.unique(folds):
                other = next((w for f, w in model.weights.items() if f not in (-1, int(fold))), model.weights[-1])
                raw[folds == fold] = _raw(z[folds == fold], other)
            bins = np.minimum(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), BINS - 1)
            yield pd.DataFrame({"bin": bins, "y": batch["y"]})

    return binned


def fit(known: DataFrame, ridge: float = RIDGE, seed: int = SEED, features: int = FEATURES) -> Model:
    """Fit on ``known(stats, fold, y)``: all learning rows take part."""
    model = _standard(known)
    weights = _fit_weights(known, model, ridge, seed, features)
    model = Model(model.mean, model.scale, weights)
    if not weights:
        return model
    counted = (
        known.mapInPandas(_bin_scores(model, seed, features), "bin int, y int")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.sum("y").alias("positive"))
        .orderBy("bin")
        .collect()  # at most BINS rows
    )
    at = LOW + (np.array([r["bin"] for r in counted]) + 0.5) * (HIGH - LOW) / BINS
    n, positive = (np.array([float(r[c]) for r in counted]) for c in ("n", "positive"))
    knots, values = isotonic(at, n, positive)
    return Model(model.mean, model.scale, weights, knots, values)


def scores_of(stats: np.ndarray, model: Model, seed: int, features: int) -> np.ndarray:
    if model.at is None:
        return np.full(len(stats), 0.5)
    raw = _raw(features_of(stats, model, seed, features), model.weights[-1])
    return np.clip(np.interp(raw, model.at, model.value), 0, 1)


def _score(model: Model, seed: int, features: int):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = scores_of(_stack(batch["stats"]), model, seed, features)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scores})

    return score


def _fit_on(docs: DataFrame, labels: DataFrame, ridge: float, seed: int, features: int) -> tuple[Model, DataFrame]:
    measured = land(measure(docs))
    known = land(measured.join(learning_labels(labels, "quality"), "doc_id").select("stats", "fold", "y"))
    return fit(known, ridge, seed, features), measured


def score_quality(
    docs: DataFrame, labels: DataFrame, ridge: float = RIDGE, seed: int = SEED, features: int = FEATURES
) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, held_out, score, predicted.

    Null and empty texts are scored by the statistics of an empty text. A doc_id that
    occurs several times learns from each of its rows; repeated labels count once (see
    ``learning_labels``). Without a label all scores are 0.5, with labels of one kind they
    are close to that kind. Extra columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    model, measured = _fit_on(docs, labels, ridge, seed, features)
    scored = measured.mapInPandas(_score(model, seed, features), f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        (fold_of() == HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, ridge: float = RIDGE, seed: int = SEED, features: int = FEATURES
) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, columns unchanged. Texts are
    scored where they are read and filtered there; nothing is shuffled but statistics."""
    model, _ = _fit_on(docs, labels, ridge, seed, features)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        stats = _stack([np.round(statistics_of(t or "") * _UNIT) / _UNIT for t in texts])
        return pd.Series(scores_of(stats, model, seed, features))

    return docs.filter(score(F.col("text").cast("string")) >= 0.5)
