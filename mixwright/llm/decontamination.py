"""Benchmark decontamination by templates.

A text becomes a template: numbers, names and units are replaced by typed placeholders.
Windows of template tokens are hashed and joined with those of the benchmark; windows that
lie on one diagonal of a document and an item (same offset) belong together. Their slots
are then compared: each value of the item must have one value in the document (two values
may become the same one). So a question is found again when its numbers or names were
exchanged throughout, and two texts that merely share a form are not. An item that is
almost all placeholders is a form that many texts share, so it is found as it stands only.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import land, row_key

WIDTH = 8  # template tokens of a window
LEAST_LITERALS = 3  # tokens of a window that are no placeholders
LEAST_TOKENS = 4  # tokens of an item without such a window, which is found as it stands
COVERAGE = 0.5  # share of an item's windows that a document must hold
BROADCAST_WINDOWS = 500_000  # benchmark windows that are broadcast; beyond, a shuffled join
BROADCAST_LEAKS = 500_000  # leaked rows that are broadcast; beyond, a shuffled join

# Words that count as units after a number.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t lb lbs oz ml cl l s ms sec min h hr hrs d kb mb gb tb "
    "hz khz mhz ghz w kw v kv a j kj kcal cal usd eur gbp dollars dollar euros euro cents cent "
    "percent degrees years year months month weeks week days day hours hour minutes minute "
    "seconds second miles mile meters meter metres metre feet foot inches inch pounds pound "
    "grams gram liters liter litres litre"
).split()
# Characters that part tokens (inside brackets of a pattern). Others that are no letters
# stay in their token, in documents and items alike.
PARTING = r"\x00\x03-\x20\u00a0.,;:!?\"'()\[\]{}<>|/\\*#&@^~`_+=\-\u2010-\u201f\u2026\u00ab\u00bb\u00bf\u00a1"
_NAME, _UNIT = "\u0001", "\u0002"  # marks of names and units inside a text
_NAMES = r"\p{Lu}(?<=[\p{L}\p{N},;:)] \p{Lu})[\p{L}\p{M}]+"
_UNITS = r"(?<=[0-9])( ?)(?i:(" + "|".join(UNITS) + r"))(?![\p{L}\p{N}])"
_AMOUNTS = r"([$€£]) ?([0-9](?:[0-9.,]*[0-9])?)"  # signs before a number, which others write behind it
_SIGNS = f"(?<!{_UNIT})([%$€£°])"
_INNER = r"(?<=[0-9])[.,:/](?=[0-9])"

_PLACEHOLDERS = {"name": 1, "unit": 2, "number": 3}  # template codes, in place of hashes


def _marked(text: Column) -> Column:
    """The text with marks before names and units, lower-cased. Most texts have no digit and
    take part in the step for names alone."""
    plain = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _NAMES, _NAME + "$0")
    # Amounts first, as "in" after one with a sign is no unit.
    behind = F.regexp_replace(F.regexp_replace(plain, _AMOUNTS, "$2 " + _UNIT + "$1 "), _UNITS, " " + _UNIT + "$2")
    united = F.regexp_replace(behind, _SIGNS, " " + _UNIT + "$1 ")
    return F.lower(F.when(plain.rlike("[0-9]"), F.regexp_replace(united, _INNER, "\u007f")).otherwise(plain))


def _code(token: Column) -> Column:
    """Template code of a token: a hash, or the code of a placeholder."""
    first = F.ascii(token)
    return (
        F.when(first > 57, F.xxhash64(token))
        .when(first >= 48, F.lit(_PLACEHOLDERS["number"]).cast("bigint"))
        .when(first == 1, F.lit(_PLACEHOLDERS["name"]).cast("bigint"))
        .when(first == 2, F.lit(_PLACEHOLDERS["unit"]).cast("bigint"))
        .otherwise(F.xxhash64(token))
    )


def _is_slot(code: Column) -> Column:
    return code.between(1, len(_PLACEHOLDERS))


def templates(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, ``tokens``, ``codes`` (a template code for each token) and ``slotted``
    (false where no digit or mark is in the text, so no slot)."""
    marked = df.select(*keys, _marked(F.col(text)).alias("marked"))
    parted = F.array_remove(F.split("marked", f"[{PARTING}]+"), "")
    # Names that follow one another are one name, known by its first part.
    named = lambda t: t.startswith(_NAME)
    folded = lambda ts: F.filter(ts, lambda t, i: ~(named(t) & F.coalesce(named(F.get(ts, i - 1)), F.lit(False))))
    several = F.col("marked").rlike(f"{_NAME}[^{PARTING}]* {_NAME}")
    tokens = marked.select(
        *keys,
        F.when(several, F.get(F.transform(F.array(parted), folded), F.lit(0))).otherwise(parted).alias("tokens"),
        F.col("marked").rlike(r"[0-9\x01\x02]").alias("slotted"),
    )
    codes = F.when(F.col("slotted"), F.transform("tokens", _code)).otherwise(F.transform("tokens", lambda t: F.xxhash64(t)))
    return tokens.select(*keys, "tokens", codes.alias("codes"), "slotted")


def _hashes(length: int) -> Column:
    """Hashes of all windows of ``length`` codes. Windows of 2, 4, 8 ... codes are made from
    two halves, so each doubling is one step for each token. (Elements of other lengths
    are fetched one by one: a slice costs time in proportion to the whole array.)"""
    if length & (length - 1) == 0:
        out, reach = F.col("codes"), 1
        while reach < length:
            out, reach = _paired(out, reach), 2 * reach
        return F.slice(out, 1, F.size("codes") - length + 1)
    last = F.size("codes") - length
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("codes", i + k) for k in range(length)]))


def _paired(hashes: Column, apart: int) -> Column:
    """Each element hashed with the one ``apart`` further on. (The one-element array binds
    the input, which would be computed twice otherwise.)"""
    shifted = lambda h: F.zip_with(h, F.slice(h, apart + 1, F.size(h)), lambda x, y: F.xxhash64(x, y))
    return F.get(F.transform(F.array(hashes), shifted), F.lit(0))


def _windows_of(length: int) -> Column:
    """Struct array (at, h, slots) of the windows of one length; ``slots`` holds hashes of
    what fills the slots (0 for literals), null where the text has no slot at all."""

    def slot(i: Column) -> Column:
        code, token = F.get("codes", i), F.get("tokens", i)
        return F.when(_is_slot(code), F.xxhash64(token)).otherwise(F.lit(0).cast("bigint"))

    def window(h: Column, i: Column) -> Column:
        slots = F.when(F.col("slotted"), F.array(*[slot(i + k) for k in range(length)]))
        return F.struct(i.alias("at"), h.alias("h"), slots.alias("slots"))

    none = F.array().cast("array<struct<at:int,h:bigint,slots:array<bigint>>>")
    return F.when(F.size("codes") >= length, F.transform(_hashes(length), window)).otherwise(none)


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH, literals: int = LEAST_LITERALS) -> DataFrame:
    """(item_id, h, item_at, length, item_slots, item_windows, exact): windows of the items.

    Items with equal texts count once (smallest id). An item shorter than ``width`` is one
    window of its own length. Windows with fewer than ``literals`` literal tokens say
    little and are left out. An item that has no other window, and at least
    ``LEAST_TOKENS`` tokens, keeps all of them and is marked ``exact``.
    """
    items = (
        benchmark.select(F.col("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .groupBy("text")
        .agg(F.min("item_id").alias("item_id"))
    )
    coded = templates(items, ["item_id"]).withColumn("length", F.least(F.size("codes"), F.lit(width)))
    by_length = F.coalesce(*[F.when(F.col("length") == n, _windows_of(n)) for n in range(1, width + 1)])
    cut = coded.filter("length > 0").select("item_id", "length", F.inline(by_length))
    none = F.array().cast("array<bigint>")
    open_slots = F.size(F.filter(F.coalesce("slots", none), lambda v: v != 0))
    judged = cut.select(
        "h", "item_id", F.col("at").alias("item_at"), "length", F.col("slots").alias("item_slots"),
        (F.col("length") - open_slots >= literals).alias("telling"),
    )
    counts = judged.groupBy("item_id").agg(
        F.count(F.when(F.col("telling"), 1)).alias("n_telling"), F.count("*").alias("n"), F.max("length").alias("longest")
    )
    exact = F.col("n_telling") == 0
    kept = judged.join(counts, "item_id").filter(F.col("telling") | (exact & (F.col("longest") >= LEAST_TOKENS)))
    return kept.select(
        "item_id", "h", "item_at", "length", "item_slots",
        F.when(exact, F.col("n")).otherwise(F.col("n_telling")).alias("item_windows"), exact.alias("exact"),
    )


def document_windows(docs: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """(keys, at, h, slots) for every window of every document."""
    parts = [_windows_of(n) for n in lengths]
    return templates(docs, keys).select(*keys, F.inline(F.concat(*parts) if len(parts) > 1 else parts[0]))


def _pairs() -> Column:
    """(item value, document value) of the slots of a matched window."""
    none = F.array().cast("array<struct<i:bigint,d:bigint>>")
    pairs = F.zip_with("item_slots", "slots", lambda i, d: F.struct(i.alias("i"), d.alias("d")))
    return F.coalesce(F.filter(pairs, lambda p: p["i"] != 0), none)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    coverage: float = COVERAGE,
    literals: int = LEAST_LITERALS,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """Contaminated rows only: doc_id, row, item_id, windows (matched), item_windows,
    coverage, exchanged (slots whose value differs).

    A document holds an item if the windows on one diagonal, with consistent slots, cover at
    least ``coverage`` of the item's windows; all of them, with equal values, where the item
    is ``exact``. Null and empty texts match nothing; a text is held whole by one task, some
    100 bytes for each token. Rows that
    are equal are reported once. Null doc_ids are reported as such. Extra columns are
    ignored; empty tables give an empty result.

    The benchmark's windows are counted first. Up to ``broadcast_windows`` they are
    broadcast, so document windows are joined where they are made; beyond, both sides are
    shuffled. The result is the same.
    """
    items = land(benchmark_windows(benchmark, width, literals))
    sizes = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    lengths = sorted(sizes) or [width]  # at most ``width`` of them
    keyed = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("row", row_key("doc_id", "text"))
    known = F.broadcast(items) if sum(sizes.values()) <= broadcast_windows else items
    matched = document_windows(keyed, ["doc_id", "row"], lengths).join(known.drop("length"), "h")
    placed = matched.select(
        "doc_id", "row", "item_id", "item_at", "item_windows", "exact",
        (F.col("at") - F.col("item_at")).alias("offset"), _pairs().alias("pairs"),
    )
    unchanged = F.forall("pairs", lambda p: p["i"] == p["d"])
    placed = placed.filter(~F.col("exact") | unchanged)
    diagonal = placed.groupBy("doc_id", "row", "item_id", "item_windows", "exact", "offset").agg(
        F.collect_set("item_at").alias("ats"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
    )
    one_value = F.size(F.array_distinct(F.transform("pairs", lambda p: p["i"]))) == F.size("pairs")
    share = F.size("ats") / F.col("item_windows")
    exchanged = F.size(F.filter("pairs", lambda p: p["i"] != p["d"]))
    best = F.max(F.struct(share.alias("coverage"), F.size("ats").cast("bigint").alias("windows"), exchanged.cast("bigint").alias("exchanged")))
    return (
        diagonal.filter(one_value & (share >= F.when(F.col("exact"), 1.0).otherwise(coverage)))
        .groupBy("doc_id", "row", "item_id", "item_windows")
        .agg(best.alias("b"))
        .select("doc_id", "row", "item_id", "b.windows", "item_windows", "b.coverage", "b.exchanged")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns unchanged. What leaks is
    found and counted first; up to ``BROADCAST_LEAKS`` rows (ids and hashes) are broadcast,
    so that no text is moved for them. Beyond, both sides are shuffled by the hash."""
    leaks = find_leaks(docs, benchmark, **settings)
    found = land(leaks.select(F.col("doc_id").alias("_id"), F.col("row").alias("_leaked")).distinct())
    known = F.broadcast(found) if found.count() <= BROADCAST_LEAKS else found
    row = F.xxhash64(docs["doc_id"], docs["text"].cast("string"))
    leaked = (row == known["_leaked"]) & docs["doc_id"].eqNullSafe(known["_id"])
    return docs.join(known, leaked, "left_anti")
