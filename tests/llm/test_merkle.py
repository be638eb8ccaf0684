import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from mixwright.llm import merkle
from tests.llm.helpers import DOCS, docs_frame, odd_docs


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def plain_path(levels, pos):
    steps = []
    for level in levels[:-1]:
        first = pos // 8 * 8
        steps.append(("".join(level[first:pos]), "".join(level[pos + 1 : first + 8])))
        pos //= 8
    return steps


def lowered(row):
    text = row[1]
    hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
    if text is None or not hit:
        return text
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_audit(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    def leaf(row, text):
        return h("".join(enc(v) for v in (row[0], row[3], row[2], row[4], text)))

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row, row[1]), leaf(row, lowered(row)), row[0]))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: r[:3])
        trees[lang] = plain_levels([r[2] for r in groups[lang]])
    upper = plain_levels([trees[lang][-1][0] for lang in langs])
    root, out = upper[-1][0], []
    for at, lang in enumerate(langs):
        for pos, (_, _, own, claim, doc_id) in enumerate(groups[lang]):
            path = plain_path(trees[lang], pos) + plain_path(upper, at)
            back = claim
            for before, after in path:
                back = h(before + back + after)
            siblings = h("".join(b + a for b, a in path))
            out.append((doc_id, own, trees[lang][-1][0], root, siblings, back, back == root))
    return out


def check(spark, frame, rows):
    got = merkle.audit(frame, merkle.tampered_text())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_audit(rows), key=repr)


def test_equals_brute_force_on_odd_rows(spark):
    rows = odd_docs(3)
    check(spark, docs_frame(spark, rows), rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 512, 513, 1200])
def test_sizes_around_the_stored_levels(spark, n):
    rng = random.Random(n)
    rows = [(rng.randrange(10**6), f"Text {i}", "en", "s", i) for i in range(n)] + [(7, "Solo", "fr", None, 1)]
    check(spark, spark.createDataFrame(rows, DOCS), rows)


def test_many_groups(spark):
    langs = [None, "", "é", "-", "10:x", "z" * 12] + [f"l{i}" for i in range(600)]
    rows = [(i, "T" if i % 5 else None, lang, "s", i) for i, lang in enumerate(langs)]
    check(spark, spark.createDataFrame(rows, DOCS).repartition(5), rows)


def test_empty_table(spark):
    assert merkle.audit(spark.createDataFrame([], DOCS), merkle.tampered_text()).count() == 0


def test_only_some_levels_are_stored(spark, tmp_path):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(1200)]
    manifest = merkle.build_manifest(merkle.leaves(spark.createDataFrame(rows, DOCS)), str(tmp_path / "m"))
    sizes = [spark.read.parquet(p).count() for p in manifest.levels]
    assert sizes == [1200, 3]  # levels 0 and 3; 150 and 19 nodes of levels 1 and 2 are not stored
    path = merkle.proofs(spark, manifest).select(F.size("path").alias("n")).distinct().collect()
    assert [r.n for r in path] == [4]


def test_no_text_is_read_for_proofs(spark, tmp_path):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(20)]
    manifest = merkle.build_manifest(merkle.leaves(spark.createDataFrame(rows, DOCS)), str(tmp_path / "m"))
    found = merkle.proofs(spark, manifest).withColumn("back", merkle.folded(F.col("h"), F.col("path")))
    assert found.filter("back = root").count() == 20
