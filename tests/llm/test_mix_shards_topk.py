import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from mixwright.llm import mixing, sharding, topk
from tests.llm.helpers import DOCS, docs_frame, odd_docs

# --- mixing -----------------------------------------------------------------------------


def plain_targets(sizes, weights=(3, 1, 2), percent=150, repeats=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    room, targets, open_now = Fraction(percent * sum(sizes.values()), 100), {}, set(names)
    while open_now:
        level = room / sum(weight[s] for s in open_now)
        full = {s for s in open_now if weight[s] * level > repeats * sizes[s]}
        for s in full or open_now:
            targets[s] = Fraction(repeats * sizes[s]) if full else weight[s] * level
        room -= sum(targets[s] for s in full)
        open_now -= full or set(open_now)
    return targets


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    rows = odd_docs(seed)
    got = mixing.plan_mix(docs_frame(spark, rows)).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((d, s, size(t)) for d, t, _, s, _ in rows)
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += size(t)
        largest[s] = max(largest[s], size(t))
    targets = plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(targets[r.source]), rel=1e-12)
        assert r.taken == r.times * r.size and 0 <= r.times <= 2
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 3 * largest[s] / 2
    again = mixing.plan_mix(docs_frame(spark, rows).repartition(5)).collect()
    assert Counter(got) == Counter(again)


def test_mix_of_many_sources(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(0, 60), None, f"s{rng.randrange(40)}", 1) for i in range(600)]
    got = mixing.plan_mix(docs_frame(spark, rows)).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
    targets = plain_targets(sizes)
    assert all(r.target == pytest.approx(float(targets[r.source])) for r in got)
    for s in sizes:
        assert abs(sum(r.taken for r in got if r.source == s) - targets[s]) <= 60


def test_apply_mix(spark):
    rows = odd_docs(3)
    df = docs_frame(spark, rows)
    plan = Counter()
    for r in mixing.plan_mix(df).collect():
        plan[r.doc_id, r.source] += r.times
    mixed = mixing.apply_mix(df)
    assert mixed.columns == df.columns
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == +plan
    empty = spark.createDataFrame([], DOCS)
    assert mixing.plan_mix(empty).count() == 0 and mixing.apply_mix(empty).count() == 0
    blank = docs_frame(spark, [(1, None, None, None, None), (2, "", "en", "a", 0)])
    assert {r.taken for r in mixing.plan_mix(blank).collect()} == {0}


# --- shards -----------------------------------------------------------------------------


def check_shards(rows, got, leaves):
    size = lambda t: len((t or "").encode()) + 1
    want = Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    load, slots = defaultdict(int), defaultdict(list)
    for r in got:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(load) <= set(range(leaves))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [load[i] for i in range(leaves)]


@pytest.mark.parametrize("leaves", [1, 5, 8])
def test_shards(spark, leaves):
    rng = random.Random(leaves)
    rows = [
        (i, "x" * int(rng.expovariate(0.002)), rng.choice(["en", "fr", None]), rng.choice(["a"] * 6 + ["b", None]), 1)
        for i in range(1500)
    ]
    rows += [(2000 + i, "copy of one text " * 9, "en", "a", 1) for i in range(700)]  # a hot group
    df = docs_frame(spark, rows)
    load = check_shards(rows, sharding.shard_documents(df, leaves=leaves).collect(), leaves)
    largest = max(len(t) for _, t, *_ in rows) + 1
    assert max(load) - min(load) <= 2 * largest * math.ceil(math.log2(leaves) + 1)
    # Another partitioning gives the same shards and slots.
    one, two = (sharding.shard_documents(d, leaves=leaves).collect() for d in (df, df.repartition(7)))
    assert Counter(one) == Counter(two)


def plain_tree(points, leaves):
    """points: (size, (d0, d1, ..)); shard of each."""
    out = [0] * len(points)
    unit = float(1 << sharding.POINT_BITS)

    def split(members, first, n):
        if n == 1 or not members:
            for m in members:
                out[m] = first
            return
        total = sum(points[m][0] for m in members)
        wide = []
        for d in range(len(points[0][1])):
            s = sum(points[m][0] * (points[m][1][d] / unit) for m in members)
            q = sum(points[m][0] * (points[m][1][d] / unit) ** 2 for m in members)
            wide.append(round(q / total - (s / total) ** 2, 9))
        dim, goal = wide.index(max(wide)), total * (n // 2) / n
        order = sorted({points[m][1][dim] for m in members})
        reached = 0
        for value in order:
            here = sum(points[m][0] for m in members if points[m][1][dim] == value)
            reached += here
            if reached >= goal:
                break
        cut = value + int(reached - goal < goal - (reached - here))
        split([m for m in members if points[m][1][dim] < cut], first, n // 2)
        split([m for m in members if points[m][1][dim] >= cut], first + n // 2, n - n // 2)

    split(list(range(len(points))), 0, leaves)
    return out


@pytest.mark.parametrize("seed, leaves", [(1, 8), (2, 5), (3, 3)])
def test_tree_equals_plain_tree(spark, seed, leaves):
    rng = random.Random(seed)
    rows = [
        (i, "t" * int(rng.expovariate(0.01)) + str(i // 2), rng.choice(["en", "fr", "de", None]), rng.choice("abcdef"), 1)
        for i in range(400)
    ]
    found = sharding.measured(docs_frame(spark, rows))
    total = found.agg({"size": "sum"}).first()[0]
    points = sharding.located(found, total, sharding.GROUP_SHARE * total / leaves).cache()
    plain = points.collect()
    want = plain_tree([(p.size, (p.d0, p.d1, p.d2)) for p in plain], leaves)
    got = {r.doc_id: r.shard for r in sharding.kd_tree(points, leaves).collect()}
    assert got == {p.doc_id: shard for p, shard in zip(plain, want)}


def test_shards_follow_metadata_and_keep_copies(spark, monkeypatch):
    monkeypatch.setattr(sharding, "GROUP_SHARE", 0.2)
    rng = random.Random(4)
    langs = ["en", "fr", "de", "es"]
    rows = [(i, f"text {i // 3} " * (1 + i // 3 % 9), rng.choice(langs), rng.choice("abcdefgh"), 1) for i in range(1200)]
    got = {r.doc_id: r.shard for r in sharding.shard_documents(docs_frame(spark, rows), leaves=8).collect()}
    assert all(got[i] == got[i // 3 * 3] for i in got)  # equal texts share a shard
    lengths = {}
    for i, text, *_ in rows:
        lengths.setdefault(got[i], set()).add(i // 3 % 9)
    assert any(len(v) <= 6 for v in lengths.values())  # shards hold a range of lengths


def test_shards_of_odd_rows(spark):
    rows = odd_docs(5)
    check_shards(rows, sharding.shard_documents(docs_frame(spark, rows), leaves=8).collect(), 8)
    total = sum(len((t or "").encode()) + 1 for _, t, *_ in rows)
    by_bytes = sharding.shard_documents(docs_frame(spark, rows), target_bytes=total // 3 + 1)
    check_shards(rows, by_bytes.collect(), 3)
    narrow = docs_frame(spark, rows, extra=False).select("doc_id", "text")
    check_shards(rows, sharding.shard_documents(narrow, leaves=4).collect(), 4)
    same = [(7, "same", "en", "a", 1)] * 20
    check_shards(same, sharding.shard_documents(docs_frame(spark, same), leaves=4).collect(), 4)
    assert sharding.shard_documents(spark.createDataFrame([], DOCS), leaves=8).count() == 0


# --- top-k ------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain_top_k(rows, queries, k, scale=1024):
    whole = lambda v: [math.floor(scale * x) for x in v]
    fine = lambda i, v: i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    known = {(i, tuple(whole(v))) for i, v in rows if fine(i, v)}
    out = set()
    for q, w in {(i, tuple(whole(v))) for i, v in queries if fine(i, v)}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, v in known if i != q and len(v) == len(w))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return out


def f32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


@pytest.mark.parametrize("shard_rows, task_queries", [(40, 20_000), (10_000, 20_000), (40, 3), (10_000, 2)])
def test_top_k(spark, shard_rows, task_queries):
    rng = random.Random(shard_rows)
    rows = [(i, [f32(rng.gauss(0, 0.2)) for _ in range(8)]) for i in range(700)]
    rows += [(700 + i, rows[3][1]) for i in range(90)]  # ties
    rows += [(800, None), (900, [f32(1.0), None] + [0.0] * 6), (1000, [float("nan")] * 8), (1100, [float("inf")] * 8)]
    rows += [(None, rows[0][1]), rows[5], rows[5], (1200, [0.0] * 8), (1300, [0.5, 0.5]), (1301, [0.25, 0.5]), (1400, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS).selectExpr("*", "1 as rank", "2 as score", "3 as shard", "4 as v")
    got = topk.exact_top_k(df, topk.queries_of(df), 10, shard_rows=shard_rows, task_queries=task_queries)
    queries = [(i, v) for i, v in rows if i is not None and i % 100 == 0]
    assert {tuple(r) for r in got.collect()} == plain_top_k(rows, queries, 10)


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 1), (100, [-1.0], 1)], VECTORS)
    got = {tuple(r) for r in topk.exact_top_k(df, topk.queries_of(df), shard_rows=1).collect()}
    assert got == {(0, 1, 1, 2**21), (0, 2, 100, -(2**20)), (100, 1, 0, -(2**20)), (100, 2, 1, -(2**21))}
    empty = spark.createDataFrame([], VECTORS)
    assert topk.exact_top_k(empty, topk.queries_of(empty)).count() == 0


def test_large_numbers_are_exact():
    import numpy as np

    rng = random.Random(2)
    vectors = np.array([[rng.randrange(-(2**28), 2**28) for _ in range(5)] for _ in range(300)], dtype=np.int64)
    tree = topk.BallTree(np.arange(300), vectors, leaf_rows=16)
    assert not tree.exact
    for q in range(0, 300, 37):
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(v, vectors[q])), i) for i, v in enumerate(vectors) if i != q)
        assert tree.search(q, vectors[q], 7, None) == [(-s, i) for s, i in scored[:7]]
