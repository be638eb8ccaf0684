"""Toxic passages by maximum-scoring segments, and a toxicity score for each document.

Method: token log-odds with an informative Dirichlet prior are learned from labelled
documents. A document is a sequence of token scores (those of the lexicon, and a constant
below zero for all other tokens); a linear-time scan finds all its maximal scoring
segments. Scores of the best segment follow an extreme-value law whose location rises with
the logarithm of the length; its parameters, fitted on clean labelled documents, turn the
best segment into a tail probability, and the significant segments together into the
evidence of the document. A calibration on labelled documents maps evidence to a score.

The labelled sample that the model is fitted on is bounded (``SAMPLE`` rows, smallest
hashes first); everything else covers all documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import HELD_OUT_FOLD, fold_of, land, learning_labels

SAMPLE = 20_000  # labelled rows that the model is fitted on
PRIOR = 0.1  # weight of the prior, as a share of all tokens
OTHER = -0.25  # score of a token outside the lexicon
LEAST_Z = 2.5  # least certainty (in deviations) of a lexicon entry
STEMS = (8, 6)  # longer tokens also stand for their first letters
STEM = "~"
SIGNIFICANT = 0.01
LEAST_LENGTH = 10
_TOKEN = re.compile(r"[^\W_]+")
_CACHE = 200_000


def tokens_of(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def _forms(token: str) -> list[str]:
    return [token, *(STEM + token[:n] for n in STEMS if len(token) > n)]


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    other: float = OTHER
    # Best clean segment: location a + b * ln(length), scale s.
    location: tuple[float, float] = (0.0, 0.0)
    scale: float = 1.0
    at: tuple[float, ...] = ()
    value: tuple[float, ...] = ()
    share: float = 0.5


def segments(places: list[int], scores: list[float], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence of token scores.

    ``places`` and ``scores`` are the tokens with a positive score; every other token has
    the score ``other`` < 0. The usual one-pass scan: each positive token opens a segment,
    which is merged with an earlier one while that one starts lower and ends lower. Every
    segment is pushed once and merged once, so time is linear.
    """
    stack: list[list] = []  # start, end, sum before start, sum at end, link
    total, last = 0.0, 0
    for place, score in zip(places, scores):
        total += other * (place - last)
        last = place + 1
        entry = [place, place + 1, total, total + score, -1]
        total += score
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= entry[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= entry[3]:
                entry[4] = j
                stack.append(entry)
                break
            entry = [stack[j][0], entry[1], stack[j][2], entry[3], -1]
            del stack[j:]
    return [(s, e, r - left) for s, e, left, r, _ in stack]


class Reader:
    """Token scores of texts, remembered for the tokens seen lately."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def score(self, token: str) -> float | None:
        if len(self.known) > _CACHE:
            self.known.clear()
        lexicon = self.model.lexicon
        found = next((lexicon[f] for f in _forms(token) if f in lexicon), None)
        self.known[token] = found
        return found

    def segments(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        tokens = tokens_of(text)
        known, places, scores = self.known, [], []
        for place, token in enumerate(tokens):
            s = known[token] if token in known else self.score(token)
            if s is not None:
                places.append(place)
                scores.append(s)
        return segments(places, scores, self.model.other), len(tokens)

    def tail(self, score: float, length: int) -> float:
        """Probability that a clean text of this length has a segment of this score."""
        a, b = self.model.location
        x = (score - a - b * math.log(max(length, LEAST_LENGTH))) / self.model.scale
        return -math.expm1(-math.exp(min(50.0, -x)))

    def evidence(self, text: str) -> tuple[float, float, int]:
        """Evidence of a text, its best segment score, its length. The evidence adds up
        -ln(tail) of the best segment and of every other significant one."""
        found, length = self.segments(text)
        if not found:
            return 0.0, 0.0, length
        scores = sorted((s for _, _, s in found), reverse=True)
        tails = [max(self.tail(s, length), 1e-300) for s in scores]
        parts = [-math.log(t) for i, t in enumerate(tails) if i == 0 or t < SIGNIFICANT]
        return float(sum(parts)), scores[0], length


# --- fitting ----------------------------------------------------------------------------


def _sample(labels: DataFrame, size: int) -> list[tuple]:
    """(doc_id, fold, label) of at most ``size`` learning rows, smallest hashes first."""
    rows = learning_labels(labels, "toxic").orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    return [tuple(r) for r in rows.select("doc_id", "fold", "y").collect()]


def _count_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(fold, form, n0, n1): occurrences in clean and toxic texts, summed for each batch.
    Stems under the marker ``STEM``; the empty form counts all tokens."""
    for batch in batches:
        counts: dict[tuple[int, str], list[int]] = {}
        for text, fold, y in zip(batch["text"], batch["fold"], batch["y"]):
            for token in tokens_of(text or ""):
                for form in ("", *_forms(token)):
                    counts.setdefault((fold, form), [0, 0])[y] += 1
        rows = [(*key, *n) for key, n in counts.items()]
        yield pd.DataFrame(rows, columns=["fold", "form", "n0", "n1"])


def log_odds(counts: DataFrame, clean: int, toxic: int, prior: float = PRIOR) -> DataFrame:
    """(form, odds, z): log-odds ratios of toxic to clean use, under a Dirichlet prior that
    weighs ``prior`` times all tokens and has the shape of both classes together."""
    weight = prior * (clean + toxic)
    a = F.lit(prior) * (F.col("n0") + F.col("n1"))
    odds = lambda n, of: F.log((n + a) / (F.lit(of + weight) - n - a))
    ratio = odds(F.col("n1"), toxic) - odds(F.col("n0"), clean)
    spread = F.sqrt(1 / (F.col("n1") + a) + 1 / (F.col("n0") + a))
    return counts.select("form", ratio.alias("odds"), (ratio / spread).alias("z"))


def _lexicon(counts: DataFrame) -> dict[str, float]:
    """All sure toxic forms of ``counts(form, n0, n1)``. Their number is bounded by the
    sampled rows alone: a form is sure only if it was counted several times there."""
    whole = counts.filter("form = ''").first()
    if whole is None or not whole["n0"] or not whole["n1"]:
        return {}
    scored = log_odds(counts.filter("form <> '' and n1 > 0"), whole["n0"], whole["n1"])
    sure = scored.filter((F.col("z") >= LEAST_Z) & (F.col("odds") >= 1.0))
    return {r["form"]: r["odds"] for r in sure.collect()}


def _gumbel(best: np.ndarray, length: np.ndarray) -> tuple[tuple[float, float], float]:
    """Location (a + b ln length, b not below 0) and scale of clean best scores, by moments."""
    if not len(best):
        return (0.0, 0.0), 1.0
    x = np.log(np.maximum(length, LEAST_LENGTH))
    b = max(0.0, float(np.cov(x, best, bias=True)[0, 1] / max(np.var(x), 1e-9)))
    rest = best - b * x
    scale = max(float(np.std(rest)) * math.sqrt(6) / math.pi, 0.25)
    return (float(np.mean(rest)) - 0.5772156649 * scale, b), scale


def _calibration(evidence: np.ndarray, y: np.ndarray) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Rising map from evidence to the share of toxic documents (pooled neighbours)."""
    order = np.argsort(evidence, kind="stable")
    at, first = np.unique(evidence[order], return_index=True)
    n = np.diff(np.append(first, len(order)))
    positive = np.add.reduceat(y[order].astype(float), first)
    blocks: list[list[float]] = []
    for a, w, p in zip(at, n, positive):
        blocks.append([w, p, a, a])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w2, p2, _, hi = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w2, blocks[-1][1] + p2, blocks[-1][2], hi]
    share = float(np.mean(y))
    places, values = [], []
    for w, p, lo, hi in blocks:
        v = (p + share) / (w + 1)
        for a in (lo, hi) if hi > lo else (lo,):
            places.append(float(a))
            values.append(v)
    values = list(np.maximum.accumulate(values))
    if places:  # evidence beyond all that was seen still rises a little
        places.append(places[-1] * 4 + 50)
        values.append(min(1.0, values[-1] + 0.5 * (1 - values[-1])))
    return tuple(places), tuple(values)


def _weigh(shared):
    """Evidence of each row under the model of its fold."""

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        readers = {fold: Reader(model) for fold, model in shared.value.items()}
        for batch in batches:
            found = [readers[f].evidence(t or "") for t, f in zip(batch["text"], batch["fold"])]
            out = pd.DataFrame(found, columns=["evidence", "best", "length"])
            yield out.assign(y=batch["y"].to_numpy())

    return weigh


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the texts of at most ``sample`` labelled learning rows.

    Their ids and labels (bounded by ``sample``) are sent to the tasks; their texts are read
    once and landed. The extreme-value law and the calibration are fitted on evidence that
    the lexicon of the other learning fold gives, the lexicon of the model on both.
    """
    spark = docs.sparkSession
    chosen = _sample(labels, sample)
    if len({y for _, _, y in chosen}) < 2:
        return Model(share=float(chosen[0][2]) if chosen else 0.5)
    share = sum(y for _, _, y in chosen) / len(chosen)
    kind = docs.schema["doc_id"].dataType.simpleString()
    small = spark.createDataFrame(chosen, f"doc_id {kind}, fold int, y int")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = land(rows.join(F.broadcast(small), "doc_id").select("text", "fold", "y"))
    counts = land(
        known.mapInPandas(_count_tokens, "fold int, form string, n0 bigint, n1 bigint")
        .groupBy("form", "fold")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )
    both = counts.groupBy("form").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    whole = _lexicon(both)
    folds = sorted({fold for _, fold, _ in chosen})
    apart = {fold: _lexicon(counts.filter(F.col("fold") == fold)) for fold in folds}
    # Each fold is weighed by the lexicon of the other one, if there is one.
    others = {fold: next((words for f, words in apart.items() if f != fold and words), whole) for fold in folds}

    def weighed(location: tuple[float, float], scale: float) -> pd.DataFrame:
        models = {fold: Model(words, OTHER, location, scale) for fold, words in others.items()}
        shared = spark.sparkContext.broadcast(models)
        columns = "evidence double, best double, length bigint, y int"
        return known.mapInPandas(_weigh(shared), columns).toPandas()  # a row for each sampled text

    seen = weighed((0.0, 0.0), 1.0)
    clean = seen[seen["y"] == 0]
    location, scale = _gumbel(clean["best"].to_numpy(), clean["length"].to_numpy())
    seen = weighed(location, scale)
    if not len(seen):
        return Model(share=share)
    at, value = _calibration(seen["evidence"].to_numpy(), seen["y"].to_numpy())
    return Model(whole, OTHER, location, scale, at, value, share)


# --- scoring ----------------------------------------------------------------------------


def _score(shared):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        reader = Reader(model)
        for batch in batches:
            found = [reader.evidence(t or "")[0] for t in batch["text"]]
            scores = np.interp(found, model.at, model.value) if model.at else np.full(len(found), model.share)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scores, "evidence": np.array(found, float)})

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, held_out, score, predicted, evidence.

    Null and empty texts have no segment, so the evidence 0. Repeated labels of a doc_id
    count once. Without labels all scores are 0.5; with labels of one kind all scores are
    that kind. Extra columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    scored = rows.mapInPandas(_score(shared), f"doc_id {kind}, score double, evidence double")
    return scored.select(
        "doc_id",
        (fold_of() == HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "evidence",
    )


def _passages(shared, significant: float):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                text = text or ""
                found, length = reader.segments(text)
                if not found:
                    continue
                spans = [m.span() for m in _TOKEN.finditer(text)]
                same = len(spans) == length  # lower-casing may change how a text is cut
                for start, end, score in found:
                    tail = reader.tail(score, length)
                    if tail < significant:
                        where = (spans[start][0], spans[end - 1][1]) if same else (None, None)
                        rows.append((doc_id, start, end, *where, score, tail))
            names = ["doc_id", "first_token", "end_token", "start", "end", "segment_score", "tail"]
            out = pd.DataFrame(rows, columns=names)
            for name in ("start", "end"):
                out[name] = pd.array(out[name].tolist(), dtype="Int64")
            yield out

    return find


def toxic_passages(
    docs: DataFrame, labels: DataFrame, significant: float = SIGNIFICANT, sample: int = SAMPLE
) -> DataFrame:
    """Every significant segment: its tokens, code points, score and tail probability."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(
        _passages(shared, significant),
        f"doc_id {kind}, first_token int, end_token int, start bigint, end bigint, "
        "segment_score double, tail double",
    )
