"""Small tables and plain-Python references."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "alpha beta gamma delta river stone cloud tree house green seven open light paper table".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def odd_docs(seed=1, n=60):
    """Texts with copies, shared lines, nulls, empties, a very long one and repeated rows."""
    rng = random.Random(seed)
    shared = "This line is shared by many documents."
    rows = []
    for i in range(n):
        lines = [sentence(rng, rng.randrange(3, 30)) for _ in range(rng.randrange(1, 6))]
        if i % 3 == 0:
            lines.insert(0, shared)
        rows.append((i, "\n".join(lines), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None]), 1))
    rows += [(n + i, rows[i][1], "en", "hot", 1) for i in range(12)]
    rows += [(n + 20, None, None, None, None), (n + 21, "", "en", "a", 0), (n + 22, "\n\n \t\n", "en", "a", 4)]
    rows += [(n + 23, " ".join(rng.choice(WORDS) for _ in range(30_000)), "en", "a", 1)]
    rows += [rows[5], rows[5], (None, "A text without an id, which is allowed.", "en", "a", 1)]
    rows += [(n + 24, "ÀÉ 中文 \U0001f600 text K", "zh", "b", 1)]
    return rows


def docs_frame(spark, rows, extra=True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if extra:  # names that operators use for their own columns
        for name in ("row", "size", "hash", "line", "shard", "slot", "fp", "score", "node", "h", "at", "cell", "base"):
            df = df.withColumn(name, F.lit("clash"))
    return df
