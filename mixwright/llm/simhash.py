"""SimHash fingerprints, and groups of documents whose fingerprints nearly agree.

Linking is multi-index hashing: a fingerprint of 64 bits is cut into two segments of 32.
If two fingerprints differ in at most ``distance`` bits, one segment differs in at most
``distance // 2``. The table of a segment holds every distinct fingerprint under its
segment value; the Hamming ball of that small radius around each segment value is
enumerated, table matches are fetched by an equi-join, and the complete distance of each
match is verified. A pair is met from one side only: a flipped bit is always one that is
set by the flip. Copies share a fingerprint and take part once.

Links and components stay distributed; components are found by alternating large-star and
small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import land, row_key

# Fixed values of the contract.
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
HASH_SEED = 42
BITS, SEGMENTS = 64, 2
SEGMENT_BITS = BITS // SEGMENTS

BROADCAST_IDS = 1_000_000  # dropped ids that go to every task; beyond, a shuffled join

_BIT = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_OFFSETS = np.arange(8, dtype=np.int64) * 256
_PLACE = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
_CHUNK = 200_000


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8. Bytes lower-case A-Z alone and split at blanks below U+0080 alone."""
    return (text or "").encode().lower().split()


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a whole text, in chunks of shingles so that memory stays bounded.

    Bits of the hashes are counted through the 256 values of each of their 8 bytes."""
    words = words_of(text)
    if not words:
        return 0
    shingles = max(1, len(words) - size + 1)
    seen = np.zeros((8, 256), np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, shingles, _CHUNK):
        part = range(lo, min(lo + _CHUNK, shingles))
        hashes = [digest(b" ".join(words[i : i + size]), HASH_SEED) for i in part]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        seen += np.bincount((octets + _OFFSETS).ravel(), minlength=2048).reshape(8, 256)
    counts = (seen @ _BIT).ravel()
    return int(_PLACE[2 * counts > shingles].sum())


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _fingerprints(size: int):
    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = _signed([fingerprint(t, size) for t in batch["text"]])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "row": batch["row"], "fp": bits})

    return take


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, row, fp): the fingerprint as a signed number, ``row`` standing for the content."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("row", row_key("doc_id", "text"))
    return keyed.mapInPandas(_fingerprints(size), f"doc_id {kind}, row bigint, fp bigint")


def _ball(radius: int) -> list[int]:
    """Flips of at most ``radius`` bits of a segment, as masks."""
    return [
        sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(SEGMENT_BITS), r)
    ]


def near_pairs(distinct: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """All pairs (a, b) of ``distinct(fp)`` that differ in 1 to ``distance`` bits, a < b."""
    low = (1 << SEGMENT_BITS) - 1
    table = distinct.select(
        "fp",
        F.posexplode(
            F.array(F.col("fp").bitwiseAND(low), F.shiftrightunsigned("fp", SEGMENT_BITS))
        ).alias("segment", "value"),
    )
    flips = F.array(*[F.lit(m).cast("bigint") for m in _ball(distance // SEGMENTS)])
    probes = (
        table.withColumn("flip", F.explode(flips))
        # One side probes: the one in which the lowest flipped bit is not set.
        .filter(F.col("value").bitwiseAND(F.col("flip")).bitwiseAND(-F.col("flip")) == 0)
        .select("segment", F.col("value").bitwiseXOR(F.col("flip")).alias("value"), F.col("fp").alias("probe"), "flip")
    )
    met = probes.join(table, ["segment", "value"]).filter(
        ((F.col("flip") != 0) | (F.col("probe") < F.col("fp")))
        & (F.bit_count(F.col("probe").bitwiseXOR(F.col("fp"))) <= distance)
    )
    return met.select(F.least("probe", "fp").alias("a"), F.greatest("probe", "fp").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; the root is the smallest node of its
    component. Each step lands its edges, so lineage stays short and lost executors cost
    one step at most."""
    edges = land(edges)
    while True:
        star = land(_small_star(_large_star(edges)))
        if _same(star, edges):
            break
        edges = star
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select("a", "a").distinct()
    )


def _same(new: DataFrame, old: DataFrame) -> bool:
    """Whether two sets of distinct edges agree: they have as many rows, and as many of
    both together."""
    sign = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(sign(new)) == tuple(sign(old))


def _linked_to(directed: DataFrame) -> DataFrame:
    """Adds ``least``: the smallest of u and its neighbours."""
    least = directed.groupBy("u").agg(F.min("v").alias("m"))
    return directed.join(least, "u").select("u", "v", F.least("m", "u").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to its smallest neighbour. Edges are (a < b)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    found = _linked_to(both).filter("v > u")
    return found.select(F.col("least").alias("a"), F.col("v").alias("b")).filter("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the smallest of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    found = _linked_to(down)
    pairs = found.select(F.col("least").alias("a"), F.col("v").alias("b")).union(
        found.select(F.col("least").alias("a"), F.col("u").alias("b"))
    )
    return pairs.filter("a < b").distinct()


def _grouped(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint of ``prints(doc_id, fp)``."""
    kinds = land(prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_pairs(kinds.select("fp"), distance))
    rooted = kinds.join(roots, kinds["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(named, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, row, fingerprint (16 hex digits) and
    component_id, the smallest doc_id that can be reached over links (its own included).

    Null and empty texts have the fingerprint zero and are linked like any other. Rows with
    a null doc_id get a fingerprint but take no part in the groups (component_id null).
    Equal rows get equal results. Extra columns are ignored; an empty table gives an empty
    result.
    """
    prints = land(fingerprints(docs, size))
    groups = _grouped(prints.select("doc_id", "fp"), distance)
    joined = prints.join(groups, "fp", "left")
    return joined.select(
        "doc_id",
        "row",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each group, the one with the smallest doc_id, columns unchanged.

    Where several rows share that doc_id, the one with the smallest content hash stays, of
    fully equal rows one. Rows without a doc_id are in no group and stay.

    Groups are known by ids alone. The ids to drop are counted: up to ``BROADCAST_IDS`` they
    go to every task and no text is moved; beyond, texts are shuffled by id. Repeated ids are
    rare and are picked apart only where there are any.
    """
    found = land(near_duplicates(docs, size, distance).select("doc_id", "row", "component_id"))
    leads = F.col("doc_id") == F.col("component_id")
    by_id = found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(leads).alias("leads"), F.min(F.when(leads, F.col("row"))).alias("row"), F.count("*").alias("n")
    )
    ids = land(by_id.filter("not leads or n > 1"))
    sizes = ids.agg(F.count("*").alias("n"), F.count(F.when(F.col("leads"), 1)).alias("repeated")).first()
    known = ids if sizes["n"] > BROADCAST_IDS else F.broadcast(ids)
    kept = docs.join(known, docs["doc_id"] == known["id"], "left_anti")
    if not sizes["repeated"]:
        return kept
    chosen = known.filter("leads")
    same = (docs["doc_id"] == chosen["id"]) & (F.xxhash64(docs["doc_id"], docs["text"].cast("string")) == chosen["row"])
    return kept.union(docs.join(chosen, same, "left_semi").dropDuplicates(["doc_id"]))
