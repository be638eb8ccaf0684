import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from mixwright.llm import periodic, queries
from tests.llm.helpers import DOCS, docs_frame, odd_docs

BLANKS = " \t\n\x0b\x0c\r"


def smallest_period(s):
    fail, k = [0] * len(s), 0
    for i in range(1, len(s)):
        while k and s[i] != s[k]:
            k = fail[k - 1]
        k += s[i] == s[k]
        fail[i] = k
    return len(s) - fail[-1]


def plain_runs(s, least=12):
    """All maximal stretches with each period, of which those with that smallest period stay."""
    out, n = set(), len(s)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            size = j - i + q
            if size >= max(least, 2 * q) and smallest_period(s[i : i + size]) == q:
                out.add((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_words(doc_id, text):
    words = [w for w in re.split(f"[{BLANKS}]+", text or "") if w]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def plain_row(doc_id, text):
    words = plain_words(doc_id, text)
    runs = plain_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    shown = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *shown, sha(lines), sha(kept))


def some_sequences():
    rng = random.Random(5)
    for _ in range(250):
        n, kinds = rng.randrange(0, 70), rng.choice([1, 2, 2, 3, 4, 9])
        yield [rng.randrange(1, kinds + 1) for _ in range(n)]
    for _ in range(150):  # repeats, with noise, side by side
        s = []
        while len(s) < 60:
            root = [rng.randrange(1, 4) for _ in range(rng.randrange(1, 9))]
            s += (root * rng.randrange(1, 6))[: rng.randrange(1, 40)]
            if rng.random() < 0.3:
                s.append(rng.randrange(1, 6))
        yield s
    fib = [[1], [1, 2]]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    yield fib[-1]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    for s in some_sequences():
        want = plain_runs(s, least)
        assert sorted(periodic.runs_of(s, least), key=lambda r: (r[0], r[2])) == want
        if least > 3:  # zones lose nothing
            assert periodic.runs_in(np.array(s, np.uint64), least) == want


def test_lce_by_suffix_tree():
    rng = random.Random(1)
    for kinds in (1, 2, 5):
        s = [rng.randrange(1, kinds + 1) for _ in range(80)]
        tree = periodic.SuffixTree(s)
        pairs = [(a, b) for a in range(81) for b in range(81) if a != b]
        got = tree.lce(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
        for (a, b), n in zip(pairs, got):
            want = 0
            while a + want < 80 and b + want < 80 and s[a + want] == s[b + want]:
                want += 1
            assert n == want
        assert [tree.rank[i] for i in sorted(range(81), key=lambda i: s[i:])] == list(range(81))


def test_query_equals_brute_force_on_odd_rows(spark, tmp_path):
    rows = [r for r in odd_docs(4) if r[1] is None or len(r[1]) < 20_000]
    rng = random.Random(8)
    for i in range(120):
        words = [rng.choice(["a", "b", "Ç", "c c", "d"]) for _ in range(rng.randrange(1, 90))]
        rows.append((1000 + i, rng.choice([" ", "\n", " \t "]).join(words * rng.choice([1, 1, 2, 4])), "en", "s", 1))
    rows.append((5000, "same " * 3000, "en", "s", 1))
    docs_frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_periodic_runs(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((plain_row(r[0], r[1]) for r in rows), key=repr)


def test_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0


def test_long_periodic_text():
    rng = random.Random(3)
    root = [rng.randrange(1, 9) for _ in range(20_000)]
    s = np.array([rng.randrange(1, 9) for _ in range(50)] + root * 3, np.uint64)
    start, size, period = max(periodic.runs_in(s), key=lambda r: r[1])
    assert period == 20_000 and start + size == len(s) and 45 <= start <= 50
