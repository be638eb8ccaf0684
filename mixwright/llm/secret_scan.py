"""Secrets in texts, and credentials that come in several parts.

Base kinds are found by patterns (fixed values below). Beyond them there are weak
candidates: names of accounts, bare random-looking tokens and endpoints. Alone they mean
nothing. An interval join links parts of one text that lie within a scope of code points:
a weak account name or token is reported only where a part of the complementary kind is in
its scope, an endpoint only where both an identifier and a secret are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import land, row_key

# The base patterns, the least lengths, and the order of the kinds.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "account", "bare", "endpoint")

ACCOUNT = re.compile(
    r"""(?i:access_?key_?id|client_?id|account_?id|user_?name|user_?id|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]{4,})""",
    re.ASCII,
)
BARE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""https?://[^\s"'<>|,;)]+""")
SCOPE = 200
LEAST_RUN = 20
_IDENTIFIERS, _SECRETS = ("access", "account"), ("assign", "hex", "bare")
_WEAK = ("account", "bare", "endpoint")

_SPAN = "struct<start:bigint,k:int,end:bigint>"


def _has_long_word(text: str) -> bool:
    return any(len(w) >= LEAST_RUN for w in text.split())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, sorted. The patterns run only where a
    word that announces a value, or a long word, is in the text at all."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if _has_long_word(text):
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _random_looking(token: str) -> bool:
    return bool(re.search("[a-z]", token) and re.search("[A-Z]", token) and re.search("[0-9]", token))


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak candidates outside the base spans. Every rule needs a base part or a bare token,
    so texts with neither have no candidate."""
    found = []
    if base or _has_long_word(text):
        found = [(m.start(), 4, m.end()) for m in BARE.finditer(text) if _random_looking(m[0])]
    if not base and not found:
        return []
    found += [(m.start(), 3, m.end()) for m in ACCOUNT.finditer(text)]
    found += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    # One sweep over both sorted lists: base spans are few, and so are the candidates.
    inside, at, reach = [], 0, 0
    for start, k, end in sorted(found):
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= start:
            inside.append((start, k, end))
    return inside


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        base = [base_spans(t or "") for t in batch["text"]]
        weak = [weak_spans(t or "", b) for t, b in zip(batch["text"], base)]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "row": batch["row"], "base": base, "weak": weak})


def _is(kind: Column, names: tuple[str, ...]) -> Column:
    return kind.isin([KINDS.index(n) for n in names])


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak candidates of ``parts(row, start, k, end)`` that have complementary parts within
    ``scope`` code points (gap between the spans).

    Interval join by cells of ``scope`` code points: what a cell holds is first reduced to
    its last end and first start for each role, so a candidate meets at most three rows
    however many parts a cell has. Parts longer than a cell count in every cell they touch.
    """
    cells = parts.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope)))
    )
    roles = (
        cells.filter(~_is(F.col("k"), ("endpoint",)))
        .withColumn("secret", _is(F.col("k"), _SECRETS))
        .groupBy("row", "cell", "secret")
        .agg(F.min("start").alias("first"), F.max("end").alias("last"))
    )
    weak = parts.filter(_is(F.col("k"), _WEAK)).distinct()
    near = weak.withColumn(
        "cell",
        F.explode(F.sequence(F.floor(F.col("start") / scope) - 1, F.floor((F.col("end") - 1) / scope) + 1)),
    )
    close = (F.col("first") - F.col("end") <= scope) & (F.col("start") - F.col("last") <= scope)
    linked = (
        near.join(roles, ["row", "cell"])
        .filter(close)
        .groupBy("row", "start", "k", "end")
        .agg(F.max("secret").alias("by_secret"), F.max(~F.col("secret")).alias("by_identifier"))
    )
    kept = (
        F.when(_is(F.col("k"), ("account",)), F.col("by_secret"))
        .when(_is(F.col("k"), ("bare",)), F.col("by_identifier"))
        .otherwise(F.col("by_secret") & F.col("by_identifier"))
    )
    return linked.filter(kept).select("row", "start", "k", "end")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, ``base`` and ``spans`` (arrays of
    (start, k, end) sorted by start, then kind; code points, end exclusive).

    Null and empty texts have no spans. Texts are scanned whole. Rows are told apart by
    their content, so repeated rows and ids keep a result each; extra columns are ignored;
    an empty table gives an empty result. Only texts that hold a weak candidate and another
    part reach the join.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("row", row_key("doc_id", "text"))
    schema = f"doc_id {kind}, row bigint, base array<{_SPAN}>, weak array<{_SPAN}>"
    scanned = land(keyed.mapInPandas(_scan, schema))
    several = scanned.filter((F.size("weak") > 0) & (F.size("base") + F.size("weak") > 1))
    key = F.struct("doc_id", "row").alias("row")
    parts = several.select(key, F.explode(F.concat("base", "weak")).alias("s")).select("row", "s.*")
    linked = link_parts(parts, scope).groupBy("row").agg(
        F.collect_set(F.struct("start", "k", "end")).alias("added")
    )
    none = F.array().cast(f"array<{_SPAN}>")
    return scanned.withColumn("row", key).join(linked, "row", "left").select(
        "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans")
    )


def span_digest(spans: Column) -> Column:
    return F.sha2(_listed(spans).cast("binary"), 256)


def span_list(spans: Column) -> Column:
    return _listed(spans)


def count_kind(spans: Column, name: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["k"] == KINDS.index(name))).cast("bigint")


def listed(spans: list[tuple[int, int, int]]) -> str:
    """The same list in plain Python, for checks."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def digest(spans: list[tuple[int, int, int]]) -> str:
    return hashlib.sha256(listed(spans).encode()).hexdigest()
