import random
import zlib
from collections import Counter

import numpy as np
import pytest

from mixwright.llm import quality, toxicity
from tests.llm.helpers import DOCS, docs_frame, odd_docs, sentence

LABELS = "doc_id bigint, quality int, toxic int"
BAD = "idiot moron scum trash".split()


def labelled(seed=1, n=500):
    rng = random.Random(seed)
    rows, labels = odd_docs(seed), []
    for i in range(1000, 1000 + n):
        text = " ".join(sentence(rng, rng.randrange(5, 40)) for _ in range(3))
        good, toxic = rng.random() < 0.7, rng.random() < 0.3
        if not good:
            text = text.replace(" ", "### ").upper() if rng.random() < 0.5 else " | ".join(text.split())
        if toxic:
            words = text.split()
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(BAD) for _ in range(rng.randrange(2, 5))]
            text = " ".join(words)
        rows.append((i, text, "en", "a", len(text)))
        labels.append((i, int(good), int(toxic)))
    labels += [labels[0], labels[0], (1001, None, None), (None, 1, 1), (99999, 1, 0)]
    return rows, labels


def is_held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.mark.parametrize(
    "score,target,threshold",
    [(quality.score_quality, 1, 0.5), (toxicity.score_toxicity, 2, 0.7)],
)
def test_held_out_accuracy(spark, score, target, threshold):
    rows, labels = labelled()
    df = docs_frame(spark, rows)
    marks = spark.createDataFrame(labels, LABELS)
    got = score(df, marks).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    assert all(r.held_out == is_held(r.doc_id) for r in got)
    truth = {row[0]: row[target] for row in labels if row[0] is not None and row[1] is not None}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and np.mean([p == y for p, y in held]) >= 0.95
    # Labels of held-out rows are never learned from, and reruns agree.
    flipped = [(d, 1 - q, 1 - t) if d is not None and q is not None and is_held(d) else (d, q, t) for d, q, t in labels]
    again = score(df.repartition(5), spark.createDataFrame(flipped, LABELS)).collect()
    assert {(r.doc_id, round(r.score, 9)) for r in got} == {(r.doc_id, round(r.score, 9)) for r in again}


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_few_labels(spark, score):
    rows = odd_docs(2)
    df = docs_frame(spark, rows)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in score(df, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 1) for i in range(30)], LABELS)
    assert all(r.score > 0.9 for r in score(df, ones).collect())
    assert score(spark.createDataFrame([], DOCS), ones).count() == 0


def test_keep_good(spark):
    rows, labels = labelled(3)
    df, marks = docs_frame(spark, rows), spark.createDataFrame(labels, LABELS)
    kept = quality.keep_good(df, marks)
    assert kept.columns == df.columns
    scored = quality.score_quality(df, marks).filter("predicted = 1").select("doc_id").collect()
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(r.doc_id for r in scored)


def test_isotonic():
    rng = np.random.default_rng(1)
    at, weight = np.arange(50.0), rng.integers(1, 9, 50).astype(float)
    positive = np.floor(weight * np.clip(at / 50 + rng.normal(0, 0.3, 50), 0, 1))
    knots, values = quality.isotonic(at, weight, positive)
    assert (np.diff(knots) > 0).all() and (np.diff(values) >= 0).all() and values.min() >= 0 and values.max() <= 1


def plain_segments(scores):
    """Maximal scoring segments by definition: take the best, then left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or total > best[2] + 1e-9 or (abs(total - best[2]) <= 1e-9 and j + 1 - i < best[1] - best[0])):
                best = (i, j + 1, total)
    if best is None:
        return []
    left = plain_segments(scores[: best[0]])
    right = [(s + best[1], e + best[1], v) for s, e, v in plain_segments(scores[best[1] :])]
    return left + [best] + right


def test_segments():
    rng = random.Random(4)
    for _ in range(300):
        scores = [rng.choice([-0.25] * 3 + [0.7, 1.3, 2.1]) for _ in range(rng.randrange(40))]
        places = [i for i, s in enumerate(scores) if s > 0]
        got = toxicity.segments(places, [scores[i] for i in places], -0.25)
        assert [(s, e, round(v, 6)) for s, e, v in got] == [(s, e, round(v, 6)) for s, e, v in plain_segments(scores)]


def test_passages(spark):
    rows, labels = labelled(5)
    marks = spark.createDataFrame(labels, LABELS)
    text = "Clean words at first. " * 20 + "idiot moron idiot scum" + " and clean words at last." * 20
    df = docs_frame(spark, [*rows, (5000, text, "en", "a", 1)])
    (found,) = toxicity.toxic_passages(df, marks).filter("doc_id = 5000").collect()
    assert text[found.start : found.end] == "idiot moron idiot scum" and found.tail < 0.01
