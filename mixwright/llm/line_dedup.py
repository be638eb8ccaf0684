"""Lines that occur in several documents are kept in the first of them only.

Method: two Bloom filters. Every map task sends the filter positions of its lines, packed
by filter segment; the task that owns a segment sets the bits of the once-seen filter and,
where a bit is already set by another document, the bit of the twice-seen filter. Only the
twice-seen filter is broadcast, and its size has a fixed upper bound. Documents without a
suspected line are finished where they are read. Suspected lines alone are shuffled (as
SHA-256 digests, not as text) for the exact count and the choice of the first document.

A filter that is too full makes more lines suspected, never a wrong result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import BLANKS, land, row_key

MIN_CODE_POINTS = 10
SEGMENT_BITS = 23
MAX_FILTER_BITS = 29  # the broadcast filter never exceeds 2**29 bits, 64 MB
PROBES = 2
HOT_LINES = 1000  # at most so many repeated lines are broadcast: those above 1/1000 of all pairs

_STRIPPED = BLANKS.encode()


def line_keys(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text and the key of each, in UTF-8 (bytes lower-case A-Z alone)."""
    lines = (text or "").encode().split(b"\n")
    return lines, [line.strip(_STRIPPED).lower() for line in lines]


def _is_long(key: bytes, least: int) -> bool:
    """Whether a key has ``least`` code points, of four bytes at most each."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _long_keys(text: str | None, least: int) -> set[bytes]:
    return {k for k in line_keys(text)[1] if _is_long(k, least)}


def _positions(keys: list[bytes], bits: int) -> np.ndarray:
    """``PROBES`` filter positions of each key, from the halves of one 64-bit hash."""
    hashed = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
    step = (hashed >> np.uint64(32)) | np.uint64(1)
    mask = np.uint64((1 << bits) - 1)
    return np.stack([(hashed + np.uint64(i) * step) & mask for i in range(PROBES)], axis=1)


def _packed_positions(least: int, bits: int):
    """Map side: (segment, seen, again) with the sorted positions that one document, or
    more than one, of this batch sets."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[bytes, int] = {}
            for text in batch["text"]:
                for key in _long_keys(text, least):
                    seen[key] = seen.get(key, 0) + 1
            if not seen:
                continue
            places = _positions(list(seen), bits)
            repeated = np.fromiter((n > 1 for n in seen.values()), bool, len(seen))
            flat, counts = np.unique(places[~repeated].ravel(), return_counts=True)
            again = np.unique(np.concatenate([flat[counts > 1], places[repeated].ravel()]))
            rows = []
            both = np.concatenate([flat, again])
            for segment in np.unique(both >> np.uint64(SEGMENT_BITS)):
                lo, hi = (np.uint64(int(segment + k) << SEGMENT_BITS) for k in (np.uint64(0), np.uint64(1)))
                parts = [
                    (a[np.searchsorted(a, lo) : np.searchsorted(a, hi)] - lo).astype("<u4").tobytes()
                    for a in (flat, again)
                ]
                rows.append((int(segment), *parts))
            yield pd.DataFrame(rows, columns=["segment", "seen", "again"])

    return pack


def _combine(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Owner of some segments: the twice-seen positions of each. Holds two filters of
    2**SEGMENT_BITS bits at a time, as the rows come sorted by segment."""

    def close(segment, once, twice):
        bits = np.packbits(twice, bitorder="little")
        at = np.flatnonzero(bits)
        return pd.DataFrame(
            {"segment": [segment], "at": [at.astype("<u4").tobytes()], "byte": [bits[at].tobytes()]}
        )

    current, once, twice = None, None, None
    for batch in rows:
        for segment, seen, again in zip(batch["segment"], batch["seen"], batch["again"]):
            if segment != current:
                if current is not None:
                    yield close(current, once, twice)
                current = segment
                once, twice = (np.zeros(1 << SEGMENT_BITS, bool) for _ in range(2))
            seen, again = np.frombuffer(seen, "<u4"), np.frombuffer(again, "<u4")
            twice[seen[once[seen]]] = True
            twice[again] = True
            once[seen] = True
            once[again] = True
    if current is not None:
        yield close(current, once, twice)


def filter_bits(lines: int) -> int:
    """About 16 bits a line, at least one segment, at most the fixed bound."""
    return max(SEGMENT_BITS, min(MAX_FILTER_BITS, int(16 * max(1, lines) - 1).bit_length()))


def twice_seen_filter(docs: DataFrame, least: int, bits: int) -> np.ndarray:
    """The twice-seen filter as bytes. What reaches the driver is at most 5 bytes for each
    filter byte that is not zero, segment after segment."""
    packed = docs.select("text").mapInPandas(
        _packed_positions(least, bits), "segment int, seen binary, again binary"
    )
    owners = 1 << max(0, bits - SEGMENT_BITS)
    owned = packed.repartition(owners, "segment").sortWithinPartitions("segment")
    found = owned.mapInPandas(_combine, "segment int, at binary, byte binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in found.toLocalIterator():
        base = int(row["segment"]) << (SEGMENT_BITS - 3)
        out[base + np.frombuffer(row["at"], "<u4").astype(np.int64)] = np.frombuffer(row["byte"], np.uint8)
    return out


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _probe(shared, least: int, bits: int):
    """Per document: suspected line digests. A document without any is finished here and
    does not carry its text on."""

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        twice = shared.value
        for batch in batches:
            keys_of = [list(_long_keys(t, least)) for t in batch["text"]]
            flat = [k for keys in keys_of for k in keys]
            if flat:
                places = _positions(flat, bits).astype(np.int64)
                hit = ((twice[places >> 3] >> (places & 7)) & 1).all(axis=1)
            else:
                hit = np.zeros(0, bool)
            out, at = [], 0
            for text, keys in zip(batch["text"], keys_of):
                suspects = [k for k, h in zip(keys, hit[at : at + len(keys)]) if h]
                at += len(keys)
                digests = [hashlib.sha256(k).digest() for k in suspects]
                text = text or ""
                done = not suspects
                out.append((text.count("\n") + 1, digests, None if done else text, _sha(text) if done else None))
            frame = pd.DataFrame(out, columns=["n_lines", "suspects", "text", "kept_sha256"])
            frame.insert(0, "doc_id", batch["doc_id"].values)
            frame.insert(1, "row", batch["row"].values)
            yield frame

    return probe


def _finish(least: int, with_text: bool):
    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dropped_lines, shas, kept_texts = [], [], []
            for text, sha, drop in zip(batch["text"], batch["kept_sha256"], batch["dropped"]):
                if text is None:
                    dropped_lines.append(0)
                    shas.append(sha)
                    kept_texts.append(None)
                    continue
                gone = set() if drop is None else {bytes(d) for d in drop}
                lines, keys = line_keys(text)
                kept = [
                    line
                    for line, key in zip(lines, keys)
                    if not gone or not _is_long(key, least) or hashlib.sha256(key).digest() not in gone
                ]
                joined = b"\n".join(kept)
                dropped_lines.append(len(lines) - len(kept))
                shas.append(hashlib.sha256(joined).hexdigest())
                kept_texts.append(joined.decode() if with_text else None)
            out = pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_lines": batch["n_lines"],
                    "n_dropped": dropped_lines,
                    "kept_sha256": shas,
                }
            )
            if with_text:
                out["kept_text"] = kept_texts
            yield out

    return finish


def _with_first(pairs: DataFrame, repeats: DataFrame) -> DataFrame:
    """``pairs`` of repeated lines with their first document.

    A line that many documents share would bring all of them to one task. Lines with more
    than one pair in ``HOT_LINES`` are fewer than ``HOT_LINES``, whatever the data, so they
    are broadcast; the rest is shuffled by line."""
    most = pairs.count() // HOT_LINES
    hot = F.broadcast(repeats.filter(F.col("n") > most).select("line", "first_doc"))
    rare = repeats.filter(F.col("n") <= most).select("line", "first_doc")
    shuffled = pairs.join(hot.select("line"), "line", "left_anti").join(rare, "line")
    return pairs.join(hot, "line").unionByName(shuffled)


def dedup_lines(docs: DataFrame, least: int = MIN_CODE_POINTS, with_text: bool = False) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: n_lines, n_dropped and the digest of what is kept.

    Lines are split at ``\\n``; null and empty texts are one empty line. Keys of at least
    ``least`` code points that occur in two or more documents stay in the smallest doc_id
    only (all their lines there). Rows that share a doc_id are one document for the count,
    and each of them keeps or drops by that doc_id. Rows with a null doc_id count as one
    document that comes after all others. Other columns are ignored. ``with_text`` adds
    ``kept_text`` (null where the text is unchanged). An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    breaks = F.length("text") - F.length(F.translate("text", "\n", ""))
    lines = rows.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1).alias("n")).first()["n"] or 0
    bits = filter_bits(lines)
    shared = spark.sparkContext.broadcast(twice_seen_filter(rows, least, bits))
    keyed = rows.withColumn("row", row_key("doc_id", "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    probed = keyed.mapInPandas(
        _probe(shared, least, bits),
        f"doc_id {kind}, row bigint, n_lines bigint, suspects array<binary>, text string, kept_sha256 string",
    )
    pairs = land(probed.select("doc_id", "row", F.explode("suspects").alias("line")))
    counted = pairs.groupBy("line").agg(
        F.count("*").alias("n"),
        F.min("doc_id").alias("first_doc"),
        (F.max("doc_id").isNotNull() & (F.min("doc_id") < F.max("doc_id"))
         | (F.max(F.col("doc_id").isNull()) & F.min("doc_id").isNotNull())).alias("repeated"),
    )
    repeats = land(counted.filter("repeated").select("line", "first_doc", "n"))
    gone = (
        _with_first(pairs, repeats)
        .filter(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
        .groupBy(F.struct("doc_id", "row").alias("key"))
        .agg(F.collect_set("line").alias("dropped"))
    )
    joined = probed.drop("suspects").withColumn("key", F.struct("doc_id", "row")).join(gone, "key", "left").drop("key")
    result = f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string"
    if with_text:
        result += ", kept_text string"
    return joined.mapInPandas(_finish(least, with_text), result)
