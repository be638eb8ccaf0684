"""WARC archives: a writer that stores equal payloads once, and a salvage reader.

The writer puts one gzip member for each record into archive files, through Spark's own
file writer, so any store that Spark writes to will do. (Spark's text writer wants a
separator between rows: an empty gzip member, which unpacks to nothing.)

The salvage reader checks every record. After a failed check it searches for the next gzip
member or plain version line that starts a valid record, goes on from there, and logs the
bytes between as a quarantined gap. Inside a gzip member it does the same with the unpacked
bytes. A member that cannot be unpacked to its end gives what lies before the break. An
archive is read whole by one task, as Spark's binary reader does, so it must stay below that
reader's limit of 2 GB. The writer bounds the bytes of an archive: records of like length
share archives, and the longer they are the fewer an archive takes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixwright.llm.common import row_key

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
END = b"\r\n\r\n"
GZIP_MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
DATE = "2000-01-01T00:00:00Z"

LEAST_SHARED_BYTES = 1000
ARCHIVE_BYTES = 1 << 30  # of an archive, unless one record alone is longer
RECORDS_PER_ARCHIVE = 20_000  # of the shortest records
TIER = 16  # records of the next tier are up to so many times as long
HEAD_BYTES = 2048  # what a record has at most beside its payload and its target
PIECE = 16_384
_PAGE_ID = re.compile(r"<urn:page:(-?\d+)>")
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r?\n")
_STARTS = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")


def _digest_header(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_bytes(kind: str, page_id, url: str | None, body: bytes, digest: str, size: int, refers_to) -> bytes:
    """One record. A revisit has the HTTP head alone as its block."""
    block = HTTP_HEAD % size + (body if kind == "response" else b"")
    name = "null" if page_id is None else page_id
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    fields += [
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _digest_header(digest)),
        ("WARC-Block-Digest", _digest_header(hashlib.sha1(block).hexdigest())),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + END


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _plain_ids(values: pd.Series) -> list:
    return [None if pd.isna(v) else int(v) for v in values]


def _packed_responses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        members = [
            _member(record_bytes("response", page, url, body := (html or "").encode(), digest, len(body), None))
            for page, url, html, digest in zip(_plain_ids(b["page_id"]), b["url"], b["html"], b["digest"])
        ]
        yield pd.DataFrame({"row": b["row"], "member": members})


def _packed_revisits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        pages, targets = _plain_ids(b["page_id"]), _plain_ids(b["refers_to"])
        rows = zip(pages, b["url"], b["digest"], b["size"], targets)
        members = [_member(record_bytes("revisit", p, u, b"", d, int(n), to)) for p, u, d, n, to in rows]
        yield pd.DataFrame({"member": members})


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_SHARED_BYTES) -> None:
    """Write ``pages(page_id, url, html)`` as archives into ``folder``.

    A null html is an empty payload, a null url leaves out the target. Payloads of at least
    ``least`` bytes that are equal (by SHA-1) are stored once, with the largest page_id; the
    other pages become revisits of it. Smaller payloads, and pages without an id, are all
    responses; so are all rows that repeat the largest page_id itself. Other columns are
    ignored; an empty table writes no record.

    Payloads travel packed. Digests, sizes and ids alone are grouped and joined: the
    largest id is combined per task first, and the join back is one that Spark can split
    where a payload is common.

    An archive has at most ``ARCHIVE_BYTES``, or one record that alone is longer. The longest
    record is found first; each tier of lengths up to it is written by a job of its own, so
    tables of short pages take one.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.sha1(body.cast("binary")).alias("digest"),
        F.octet_length(body).cast("bigint").alias("size"),
    ).withColumn("row", row_key("page_id", "url", "digest"))
    target = 3 * F.coalesce(F.octet_length("url"), F.lit(0))  # escaped
    narrow = keyed.drop("html").filter((F.col("size") >= least) & F.col("page_id").isNotNull())
    chosen = narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    revisits = narrow.join(chosen.filter("n > 1").drop("n"), "digest").filter("page_id < refers_to")
    repeats = revisits.select("row").distinct()
    longest = keyed.agg(F.max(F.col("size") + target)).first()[0] or 0
    for i, (above, upto, records_each) in enumerate(_tiers(longest + HEAD_BYTES)):
        room = F.lit(HEAD_BYTES) + target
        long_ones = keyed.filter((room + F.col("size") > above) & (room + F.col("size") <= upto))
        responses = long_ones.mapInPandas(_packed_responses, "row bigint, member binary").join(repeats, "row", "left_anti")
        pointers = revisits.filter((room > above) & (room <= upto)).mapInPandas(_packed_revisits, "member binary")
        (
            responses.select("member")
            .unionByName(pointers)
            .select(F.col("member").cast("string").alias("value"))
            .write.option("lineSep", EMPTY_MEMBER)
            .option("encoding", "ISO-8859-1")
            .option("maxRecordsPerFile", records_each)
            .mode("append" if i else "overwrite")
            .text(folder)
        )


def _tiers(longest: int) -> list[tuple[int, int, int]]:
    """(above, up to, records of an archive) of the tiers of record lengths up to ``longest``."""
    above, upto = 0, ARCHIVE_BYTES // RECORDS_PER_ARCHIVE
    out = [(above, upto, RECORDS_PER_ARCHIVE)]
    while upto < longest:
        above, upto = upto, upto * TIER
        out.append((above, upto, max(1, ARCHIVE_BYTES // upto)))
    return out


# --- reading ----------------------------------------------------------------------------


@dataclass
class Found:
    """A record (``kind`` is its type), or a quarantined gap (``kind`` is ``gap``).

    ``start`` and ``end`` are bytes of the archive: those of the whole member for what lies
    in one, with the bytes of the unpacked member in ``inner_start`` and ``inner_end`` (null
    where the member broke off). ``problem`` says what is wrong with a gap, or with the
    member that a record was recovered from.
    """

    kind: str
    start: int
    end: int
    page_id: int | None = None
    payload: bytes | None = None
    digest: str | None = None
    size: int | None = None
    refers_to: int | None = None
    uri: str | None = None
    problem: str | None = None
    inner_start: int | None = None
    inner_end: int | None = None


def _id_of(value: str | None) -> int | None:
    hit = _PAGE_ID.fullmatch(value or "")
    return int(hit[1]) if hit else None


def _parse(data: bytes, at: int, sure: bool = True) -> tuple[Found | None, int, str]:
    """A checked record at ``at`` of unpacked bytes: (record, its end, problem). Unless the
    bytes are ``sure``, it must have a block digest."""
    if not _VERSION_LINE.match(data, at):
        return None, at, "no version line"
    head_end = data.find(END, at)
    if head_end < 0:
        return None, at, "header without an end"
    if _VERSION_LINE.search(data, at + 1, head_end):
        return None, at, "header runs into another record"
    lines = data[at:head_end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    length = fields.get("content-length", "")
    if not length.isdigit():
        return None, at, "no content length"
    start = head_end + len(END)
    end = start + int(length)
    if data[end : end + len(END)] != END:
        return None, at, "block does not end where it should"
    block = data[start:end]
    told = fields.get("warc-block-digest")
    if not told and not sure:
        return None, at, "no block digest in a broken member"
    if told and told != _digest_header(hashlib.sha1(block).hexdigest()):
        return None, at, "block digest differs"
    kind = fields.get("warc-type", "")
    is_http = fields.get("content-type", "").startswith("application/http")
    http, _, body = block.partition(END) if is_http else (b"", b"", block)
    payload_told = fields.get("warc-payload-digest", "")
    found = Found(
        kind, at, end + len(END), _id_of(fields.get("warc-record-id")), body,
        hashlib.sha1(body).hexdigest(), len(body), _id_of(fields.get("warc-refers-to")),
        fields.get("warc-target-uri"),
    )
    if kind == "revisit":
        size = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
        found.payload, found.size = None, int(size[1]) if size else None
        found.digest = base64.b32decode(payload_told[5:]).hex() if payload_told.startswith("sha1:") else None
    elif payload_told and payload_told != _digest_header(found.digest):
        return None, at, "payload digest differs"
    return found, found.end, ""


def _unpack(data: bytes, at: int) -> tuple[bytes, int, str]:
    """The member at ``at``: (its bytes, its end, problem). With a problem, the bytes are
    those before the break and the end is the break. Fed in pieces, because what follows a
    member is copied when it ends."""
    packer, out, fed = zlib.decompressobj(31), [], at
    try:
        while fed < len(data) and not packer.eof:
            piece = data[fed : fed + PIECE]
            out.append(packer.decompress(piece))
            fed += len(piece)
    except zlib.error as e:
        tail, broken = _up_to_the_break(data, at, fed)
        return b"".join([*out, tail]), broken, f"gzip: {e}"
    if not packer.eof:
        return b"".join(out), len(data), "gzip: member without an end"
    return b"".join(out), fed - len(packer.unused_data), ""


def _up_to_the_break(data: bytes, at: int, last: int) -> tuple[bytes, int]:
    """What the piece at ``last``, whose unpacking failed, gives byte by byte, and where it fails."""
    packer, out = zlib.decompressobj(31), []
    for i in range(at, last, PIECE):
        packer.decompress(data[i : min(i + PIECE, last)])
    try:
        for i in range(last, min(last + PIECE, len(data))):
            out.append(packer.decompress(data[i : i + 1]))
    except zlib.error:
        pass
    return b"".join(out), last + len(out)


def _inside(inner: bytes, sure: bool) -> tuple[list[Found], list[Found]]:
    """(records, gaps) of unpacked bytes, by the version lines in them. Where the bytes are
    not ``sure``, a record needs a block digest."""
    records, lost, at, bad, why = [], [], 0, None, ""

    def lose(until: int) -> None:
        if bad is not None:
            lost.append(Found("gap", bad, until, problem=why, inner_start=bad, inner_end=until))

    while at < len(inner):
        record, end, problem = _parse(inner, at, sure)
        if record is not None:
            lose(at)
            record.inner_start, record.inner_end = at, end
            records.append(record)
            at, bad = end, None
            continue
        if bad is None:
            bad, why = at, problem
        following = _VERSION_LINE.search(inner, at + 1)
        at = following.start() if following else len(inner)
    lose(len(inner))
    return records, lost


@dataclass
class _Read:
    """What starts at a place: records and inner gaps, the end (null if the member broke or
    nothing is valid), how far a broken member gave records, and what is wrong."""

    found: list[Found]
    end: int | None
    reach: int
    problem: str = ""


def _read_at(data: bytes, at: int) -> _Read:
    if data[at : at + 3] != GZIP_MAGIC:
        record, end, problem = _parse(data, at)
        return _Read([record], end, end) if record else _Read([], None, at, problem)
    inner, end, broken = _unpack(data, at)
    records, lost = _inside(inner, sure=not broken)
    if not broken:
        if lost and not records:
            return _Read([], None, at, lost[0].problem)
        for f in records + lost:
            f.start, f.end = at, end
        return _Read(records + lost, end, end)
    # The checksum of the member is lost, so a record counts only by its own digest. If the
    # data are wrong but every record passes, the damage is in a header: nothing is sure.
    cut_short = end == len(data)
    if not records or not (lost or cut_short):
        return _Read([], None, end if records else at, broken)
    for r in records:
        r.problem = f"from a broken member, {broken}"
    whole = max(r.inner_end for r in records)
    lost = [f for f in lost if f.inner_end < whole]
    lost.append(Found("gap", at, end, problem=broken, inner_start=whole))
    return _Read(records + lost, None, end, broken)


def _without(held: list[Found], found: list[Found]) -> list[Found]:
    """What a broken member gave, less the records that a later member in its range gives
    itself (it ran over into that member's stored bytes)."""
    own = lambda f: (f.kind, f.page_id, f.digest, f.size, f.uri)
    again = {own(f) for f in found if f.kind != "gap"}
    records = [f for f in held if f.kind != "gap" and own(f) not in again]
    if len(records) == sum(f.kind != "gap" for f in held):
        return held
    whole = max((r.inner_end for r in records), default=0)
    tail = held[-1]
    tail.inner_start = whole
    return records + [f for f in held[:-1] if f.kind == "gap" and f.inner_end <= whole] + [tail]


def salvage(data: bytes) -> Iterator[Found]:
    """All valid records of an archive and the gaps between them.

    Every byte belongs to a plain record, to a member or to a gap outside of members, and
    these never overlap. What is found in one member shares its range (a broken member ends
    where the next valid record or member starts) and is told apart by inner offsets, which
    do not overlap either. A record of a broken member is given only if its block digest
    holds.
    """
    at, bad, why = 0, None, ""
    held: list[Found] = []  # of a broken member at ``bad``, until its end is known
    reach = 0

    def close(until: int) -> list[Found]:
        for f in held:
            f.start, f.end = bad, until
        return held or ([] if bad is None else [Found("gap", bad, until, problem=why)])

    while at < len(data):
        got = _read_at(data, at)
        # Plain bytes inside what a broken member unpacked are that member's own records.
        own = at < reach and data[at : at + 3] != GZIP_MAGIC
        if got.found and at < reach and not own:
            held = _without(held, got.found) if held else held
        if got.end is not None and not own:
            yield from close(at)
            yield from got.found
            at, bad, held, reach = got.end, None, [], 0
            continue
        if got.found and not own:
            yield from close(at)
            bad, held = at, got.found
        elif bad is None:
            bad, why = at, got.problem
        reach = reach if own else max(reach, got.reach)
        following = _STARTS.search(data, at + 1)
        at = following.start() if following else len(data)
    yield from close(len(data))


_FIELDS = [
    "kind", "start", "end", "page_id", "digest", "size", "refers_to", "uri", "problem", "inner_start", "inner_end",
]
_SALVAGED = (
    "archive string, kind string, start bigint, end bigint, page_id bigint, digest string, size bigint, "
    "refers_to bigint, uri string, problem string, inner_start bigint, inner_end bigint"
)


def _salvage_batches(with_payload: bool):
    fields = [*_FIELDS, "payload"] if with_payload else _FIELDS

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["path"], batch["content"]):
                rows = [[getattr(f, name) for name in fields] for f in salvage(content)]
                out = pd.DataFrame(rows, columns=fields)
                for name in ("page_id", "size", "refers_to", "inner_start", "inner_end"):
                    out[name] = pd.array(out[name].tolist(), dtype="Int64")
                out.insert(0, "archive", archive)
                yield out

    return read


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """One row for each record and each quarantined gap (kind ``gap``, byte range from
    ``start`` to ``end``, inner range in a member, ``problem``) of the archives in ``folder``."""
    schema = _SALVAGED + (", payload binary" if with_payload else "")
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInPandas(_salvage_batches(with_payload), schema)


def records(salvaged: DataFrame) -> DataFrame:
    return salvaged.filter("kind <> 'gap'")


def gaps(salvaged: DataFrame) -> DataFrame:
    return salvaged.filter("kind = 'gap'").select("archive", "start", "end", "inner_start", "inner_end", "problem")

