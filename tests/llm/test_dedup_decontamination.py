import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from mixwright.llm import decontamination, simhash
from tests.llm.helpers import DOCS, docs_frame, odd_docs, sentence


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Component of each key of {key: fingerprint}, all pairs."""
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def near_rows(seed=1):
    rng = random.Random(seed)
    rows = odd_docs(seed)
    long = [sentence(rng, 400) for _ in range(3)]
    for j, text in enumerate(long):
        words = text.split()
        for i in range(25):
            changed = list(words)
            changed[rng.randrange(400)] = f"w{i}"
            rows.append((1000 + 100 * j + i, " ".join(changed), "en", "a", 1))
    return rows


def test_near_duplicates(spark):
    rows = near_rows()
    got = simhash.near_duplicates(docs_frame(spark, rows))
    assert got.columns == ["doc_id", "row", "fingerprint", "component_id"]
    prints = {d: plain_fingerprint(t) for d, t, *_ in rows if d is not None}
    parts = plain_components(prints)
    want = [(d, f"{plain_fingerprint(t):016x}", parts.get(d)) for d, t, *_ in rows]
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == Counter(want)
    assert len(set(parts.values())) < len(parts)


@pytest.mark.parametrize("distance", [0, 1, 3, 5])
def test_near_pairs(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = {0, 2**64 - 1}
    for b in base:
        for _ in range(40):
            flips = rng.sample(range(64), rng.randrange(7))
            prints.add(b ^ sum(1 << f for f in flips))
    signed = {p: p - 2**64 if p >= 2**63 else p for p in prints}
    df = spark.createDataFrame([(v,) for v in signed.values()], "fp bigint")
    got = {tuple(sorted(r)) for r in simhash.near_pairs(df, distance).collect()}
    want = {tuple(sorted((signed[a], signed[b]))) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= distance}
    assert got == want


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    chain = list(range(40))
    rng.shuffle(chain)
    edges = {(min(a, b), max(a, b)) for a, b in zip(chain, chain[1:])} | {(100, 100 + i) for i in range(1, 30)}
    df = spark.createDataFrame(sorted(edges), "a bigint, b bigint")
    got = {r.node: r.root for r in simhash.components(df).collect()}
    assert got == {i: 0 for i in range(40)} | {100 + i: 100 for i in range(30)}


def test_keep_first(spark):
    rows = near_rows(2)
    df = docs_frame(spark, rows)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    prints = {d: plain_fingerprint(t) for d, t, *_ in rows if d is not None}
    want = Counter(plain_components(prints).values()).keys()
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert ids == Counter({**{d: 1 for d in want}, None: 1})
    assert simhash.keep_first(spark.createDataFrame([], DOCS)).count() == 0


# --- benchmark --------------------------------------------------------------------------

ITEM = "A train leaves Boston with 120 people and travels for 3 hours while Anna counts 120 cows near the old river bridge."


def contaminated(spark, texts, items, **settings):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    df = df.selectExpr("*", "1 as h", "2 as at", "3 as slots", "4 as row")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id bigint, text string")
    bench = bench.selectExpr("*", "1 as h", "2 as doc_id")
    rows = decontamination.find_leaks(df, bench, **settings).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def test_exact_and_parametrised(spark):
    changed = ITEM.replace("120", "75").replace("Boston", "Denver").replace("Anna", "Maria").replace("3 hours", "9 hours")
    mixed_up = ITEM.replace("with 120", "with 75")  # 120 stands for two values now
    other = "Some words that have nothing to do with it, and then a long end of the text that nobody asked for at all."
    texts = [f"Before it. {ITEM} After it.", changed, mixed_up, other, None, "", ITEM.upper()[:10]]
    found = contaminated(spark, texts, [ITEM, "", None, "two words"])
    assert set(found) == {(0, 0), (1, 0)}
    assert found[0, 0].exchanged == 0 and found[1, 0].exchanged >= 3


def test_items_of_few_literals(spark):
    items = ["What is 12 + 15 ?", "5 km", "7 8 9 10 11"]
    texts = ["Tell me: what is 12 + 15? Yes.", "what is 12 + 16", "it says 7 8 9 10 11 there", "7 8 9 10 12", "5 km"]
    assert set(contaminated(spark, texts, items)) == {(0, 0), (2, 2)}


def test_two_values_may_become_one(spark):
    item = "If Tom has 3 red apples and buys 5 green pears then how many fruits does he have in his basket"
    found = contaminated(spark, [item.replace("3", "4").replace("5", "4"), item.replace("3 red", "4 red five")], [item])
    assert (0, 0) in found and found[0, 0].coverage == 1.0 and found[0, 0].exchanged == 2


def test_names_of_several_words(spark):
    item = "Then young Mary gave 3 old books to her friend Paul who lives in a house near the lake"
    texts = [item.replace("Mary", "Mary Anne Lee").replace("Paul", "Jean Luc"), item.replace("Mary", "Eve").replace("3", "14")]
    found = contaminated(spark, texts, [item])
    assert set(found) == {(0, 0), (1, 0)} and found[0, 0].coverage == found[1, 0].coverage == 1.0


def test_amounts_of_both_orders(spark):
    item = "A new bag costs $12.50 in the shop and a pair of old shoes costs 8 dollars more than that"
    texts = [
        item.replace("$12.50", "12.50 dollars").replace("8 dollars", "$8"),
        item.replace("$12.50", "€ 7").replace("8 dollars", "9 €"),
        item.replace("$12.50", "nothing").replace("8 dollars", "a bit"),
    ]
    found = contaminated(spark, texts, [item])
    assert set(found) == {(0, 0), (1, 0)} and found[0, 0].coverage == found[1, 0].coverage == 1.0


def test_reparameterised_questions_are_found(spark):
    """Random items with slots, exchanged throughout by a map of values; and the same with one
    value that is exchanged in two ways, which is no copy."""
    rng = random.Random(12)
    names, units = ["Anna", "Boris", "Clara", "Dimitri"], ["km", "kg", "hours", "dollars"]
    words = [w for w in sentence(rng, 400).lower().rstrip(".").split()]

    def made(values, people, shape):
        out = []
        for kind, k in shape:
            if kind == "w":
                out.append(k)
            else:
                out += [str(values[k]), units[k]] if kind == "n" else ["the", people[k]]
        return " ".join(out)

    items, texts, odd = [], [], []
    for _ in range(40):
        shape = [(rng.choice("wwwwnp"), 0) for _ in range(rng.randrange(14, 40))]
        shape = [("w", rng.choice(words)) if kind == "w" else (kind, rng.randrange(3)) for kind, _ in shape]
        people = rng.sample(names, 3)
        items.append(made(rng.sample(range(2, 99), 3), people, shape))
        other = made([rng.randrange(100, 999) for _ in range(3)], [p + "x" for p in people], shape)
        texts.append(" ".join(rng.sample(words, 5)) + " and so " + other + " " + " ".join(rng.sample(words, 5)))
        torn = [rng.choice(words) if kind == "w" else None for kind, _ in shape]
        odd.append(" ".join(t or str(rng.randrange(9)) for t in torn))
    found = set(contaminated(spark, texts + odd, items))
    right = {(i, i) for i in range(40)}
    assert len(found & right) >= 36  # recall of at least 0.9
    assert not {d for d, _ in found if d >= 40}


def test_coverage_and_repeats(spark):
    words = "one quick brown fox jumps over the lazy dog while nine red birds sing loudly under a very old oak tree".split()
    item = " ".join(words)
    texts = [" ".join(words[:8]), " ".join(words[:16]), item + " " + item, item, item]
    found = contaminated(spark, texts, [item, item])
    assert {d for d, _ in found} == {1, 2, 3, 4} and {i for _, i in found} == {0}
    assert found[2, 0].coverage == 1.0


def test_short_items(spark):
    found = contaminated(spark, ["we like green tea a lot", "green tea", "x we like it"], ["like green tea", "tea", "5 km"])
    assert set(found) == {(0, 0)}


def test_shuffled_join_gives_the_same(spark):
    rng = random.Random(8)
    items = [sentence(rng, rng.randrange(5, 40)) for _ in range(15)]
    texts = [sentence(rng, 20) + " " + rng.choice(items) + " " + sentence(rng, 20) for _ in range(40)]
    assert contaminated(spark, texts, items) == contaminated(spark, texts, items, broadcast_windows=0)


def test_equals_brute_force(spark):
    """Texts without slots: a leak is a run of shared windows on one diagonal."""
    rng = random.Random(9)
    items = [sentence(rng, rng.randrange(8, 40)).lower() for _ in range(12)]
    texts = []
    for _ in range(60):
        words = rng.choice(items).rstrip(".").split()
        lo = rng.randrange(len(words))
        part = words[lo : lo + rng.randrange(1, 40)]
        texts.append(" ".join(sentence(rng, 9).lower().rstrip(".").split() + part + sentence(rng, 9).lower().rstrip(".").split()))
    want = set()
    for d, text in enumerate(texts):
        t = text.split()
        for i, item in enumerate(items):
            w = item.rstrip(".").split()
            total = len(w) - 7
            hits = Counter(
                a - b for a in range(len(t) - 7) for b in range(total) if t[a : a + 8] == w[b : b + 8]
            )
            if any(n / total >= 0.5 for n in hits.values()):
                want.add((d, i))
    assert set(contaminated(spark, texts, items)) == want and want


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_keep_first_with_repeated_ids_and_clashing_names(spark, limit, monkeypatch):
    """An id that leads one group and is a copy in another, equal rows, names of our own."""
    monkeypatch.setattr(simhash, "BROADCAST_IDS", limit)
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in ("alpha", "beta", "gamma"))
    rows = [(2, a), (2, b), (1, b), (3, a), (4, c), (4, c), (None, a), (None, None), (5, a), (5, c)]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string")
    df = plain.select("*", *[F.lit(0).alias(n) for n in ("id", "row", "n", "leads", "_id", "component_id")])
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(2, a), (1, b), (4, c), (None, a), (None, None)], key=repr)


@pytest.mark.parametrize("limit", [0, 500_000])
def test_keep_clean_by_broadcast_and_by_shuffle(spark, limit, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_LEAKS", limit)
    item = "Tom has 12 red apples and buys 5 more at the market how many apples are there now"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    rows = [(1, item), (1, "other words entirely"), (None, item), (None, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_row", F.lit(1)).withColumn("_id", F.lit(2))
    kept = decontamination.keep_clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, "other words entirely"), (None, None), (2, "")], key=repr
    )


def test_keep_clean(spark):
    rows = odd_docs(4)
    df = docs_frame(spark, [*rows, (900, f"x y. {ITEM} z", "en", "a", 1), (None, ITEM, "en", "a", 1)])
    bench = spark.createDataFrame([(0, ITEM)], "item_id bigint, text string")
    kept = decontamination.keep_clean(df, bench)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, *_ in rows)
    assert decontamination.keep_clean(df, bench.limit(0)).count() == len(rows) + 2
