"""Quality rules by counts, and by perplexity under an n-gram model of the corpus.

The model is an interpolated modified Kneser-Ney model over characters (``ORDER`` of them),
one for each language. Spark counts the n-grams of all texts: tasks sum what they see, sums
are added by n-gram. Everything else (continuation counts, discounts, backoff weights,
probabilities) is joins and aggregates of those counts. The result is stored in sorted hash
arrays: an n-gram is a 64-bit code (16 bits a character, so codes never collide), and
shards of the model hold sorted codes with their log probabilities.

Texts are dealt to two folds by their content, and a text is scored by the counts of the
other fold: neither it nor its copies vouch for themselves. So the n-grams to be scored are
those counted in the text's own fold, and their probabilities are computed once, as a
table; a text only looks its n-grams up.

The most frequent entries, up to a number that is checked, go to every task. Where the model
is larger, what a text does not find there is joined with the other shards.

Bands: in each language, distinct texts that pass the counting rules give the quartiles of
the log perplexity; texts too far above (noise) or below (boilerplate) are rejected.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from mixwright.llm.common import BLANKS, WORD, land

ORDER = 4  # characters of an n-gram, at most 4
CHAR_BITS = 16
# Characters beyond 16 bits are folded into the private-use characters.
PRIVATE, PRIVATE_CHARS = 0xE000, 6400
PIECE = 2_000_000  # characters that a task looks at together
HELD_ENTRIES = 2_000_000  # n-grams that a task sums before it passes them on
HEAD_ENTRIES = 4_000_000  # entries that go to every task: 64 MB
SHARD_ENTRIES = 50_000
UNIT = 1_000_000  # log probabilities are whole millionths, so sums do not depend on order
BIN = 1000  # histogram bins of the log perplexity, for each nat
BAND = 10.0  # quartile distances from the median to either end of a band
INTERNED = 1_000_000
LEAST_DISCOUNT = 0.1

# Fixed values of the counting rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
REPEAT_WINDOW = 3
MOST_REPEATED = 50  # percent of the words

_WORD = re.compile(WORD)
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# --- counting rules ---------------------------------------------------------------------


def _repeated_words(numbers: np.ndarray, kinds: int) -> int:
    """Words in windows of ``REPEAT_WINDOW`` that occur twice or more in the text."""
    n = len(numbers) - REPEAT_WINDOW + 1
    if n < 2:
        return 0
    code = numbers[:n].astype(np.int64)
    for k in range(1, REPEAT_WINDOW):
        if int(code.max()) + 1 >= 2**62 // kinds:
            code = np.unique(code, return_inverse=True)[1]
        code = code * kinds + numbers[k : k + n]
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    edge = np.zeros(len(numbers) + 1, np.int64)
    starts = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    edge[starts] += 1
    edge[starts + REPEAT_WINDOW] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str, number: defaultdict | None = None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = _WORD.findall(text)
    number = defaultdict(count().__next__) if number is None else number
    numbered = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        again,
        _repeated_words(numbered, len(number) + 1),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


# --- n-grams in tasks -------------------------------------------------------------------


def _pieces(texts: list[str], order: int) -> Iterator[list[tuple[int, str]]]:
    """Texts in groups of some ``PIECE`` characters: (number of the text, text). Longer texts
    come in pieces that overlap, so that each n-gram is in one piece."""
    held: list[tuple[int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        for low in range(0, max(1, len(text) - order + 1), PIECE):
            part = text[low : low + PIECE + order - 1]
            held.append((i, part))
            size += len(part)
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def codes_of(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of the texts, and how many each text has."""
    sizes = np.array([len(t) for t in texts], np.int64)
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    far = chars > 0xFFFF
    if far.any():
        chars[far] = PRIVATE + chars[far] % PRIVATE_CHARS
    made = np.maximum(0, sizes - order + 1)
    n = len(chars) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), made
    codes = np.zeros(n, np.uint64)
    for k in range(order):
        codes = (codes << np.uint64(CHAR_BITS)) | chars[k : k + n]
    # Windows over the end of a text belong to none.
    inside = np.ones(len(chars), bool)
    ends = np.cumsum(sizes)
    for k in range(1, order):
        inside[np.maximum(ends - k, ends - sizes)[sizes > 0]] = False
    return codes[inside[:n]].view(np.int64), made


def _summed(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, with their sums."""
    if counts is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    if counts is None:
        return codes[first], np.diff(np.append(first, len(codes)))
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_grams(order: int):
    schema = pa.schema([("lang", pa.string()), ("fold", pa.int32()), ("code", pa.int64()), ("n", pa.int64())])

    def emit(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, fold), parts in held.items():
            codes, n = _summed(np.concatenate([c for c, _ in parts]), np.concatenate([m for _, m in parts]))
            columns = [pa.array([lang] * len(codes)), pa.array(np.full(len(codes), fold, np.int32)), pa.array(codes), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0
        for batch in batches:
            groups: dict[tuple, list[str]] = {}
            for lang, fold, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "fold", "text"))):
                groups.setdefault((lang, fold), []).append(text)
            for key, texts in groups.items():
                for pieces in _pieces(texts, order):
                    own = held.setdefault(key, [])
                    own.append(_summed(codes_of([t for _, t in pieces], order)[0]))
                    size += len(own[-1][0])
                    if len(own) > 8:
                        size -= sum(len(c) for c, _ in own)
                        own[:] = [_summed(np.concatenate([c for c, _ in own]), np.concatenate([m for _, m in own]))]
                        size += len(own[0][0])
            if size > HELD_ENTRIES:
                yield from emit(held)
                held, size = {}, 0
        yield from emit(held)

    return scan


# --- the model --------------------------------------------------------------------------


def _prepared(docs: DataFrame) -> DataFrame:
    """(doc_id, row, lang, fold, text): text and language without nulls, fold by content."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), lang), F.lit("")).alias("lang"),
        F.pmod(F.xxhash64(text), F.lit(2)).cast("int").alias("fold"),
        F.xxhash64(text).alias("content"),
        text.alias("text"),
    )


def count_grams(prepared: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, fold, code, n): how often each n-gram occurs in all texts."""
    rows = prepared.select("lang", "fold", "text")
    seen = rows.mapInArrow(_count_grams(order), "lang string, fold int, code bigint, n bigint")
    return seen.groupBy("lang", "fold", "code").agg(F.sum("n").alias("n"))


def _mask(chars: int) -> int:
    return (1 << (CHAR_BITS * chars)) - 1


def _discounts(grams: DataFrame) -> DataFrame:
    """(lang, fold, d1, d2, d3): the modified Kneser-Ney discounts of n-grams that occur
    once, twice, and more often, from the numbers of n-grams that occur 1 to 4 times; at least
    ``LEAST_DISCOUNT``, so that what was not seen keeps a share. Where one of these numbers is
    zero, the discount is that of absolute discounting by a half."""
    times = [F.sum(F.when(F.col("n") == i, 1).otherwise(0)).alias(f"t{i}") for i in range(1, 5)]
    found = grams.groupBy("lang", "fold").agg(*times)
    y = F.col("t1") / (F.col("t1") + 2 * F.col("t2"))
    out = []
    for i in (1, 2, 3):
        raw = i - (i + 1) * y * F.col(f"t{i + 1}") / F.col(f"t{i}")
        known = (F.col("t1") > 0) & (F.col(f"t{i}") > 0)
        out.append(F.when(known, F.greatest(F.lit(LEAST_DISCOUNT), F.least(F.lit(float(i)), raw))).otherwise(F.lit(0.5)).alias(f"d{i}"))
    return found.select("lang", "fold", *out)


def _other_fold(df: DataFrame) -> DataFrame:
    return df.withColumn("fold", 1 - F.col("fold"))


def probabilities(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, fold, code, n, logp): for the n-grams counted in a fold, their log probability
    under the model of the other fold, in ``1 / UNIT``, given their first characters.

    Lower orders count continuations: the distinct characters in front of an n-gram. An
    n-gram that the other fold does not have gets its backoff share alone; a language that
    the other fold lacks has the uniform distribution.
    """
    tables = {order: grams.select("lang", "fold", "code", "n")}
    for k in reversed(range(1, order)):
        shorter = tables[k + 1].select("lang", "fold", F.col("code").bitwiseAND(_mask(k)).alias("code"))
        tables[k] = land(shorter.groupBy("lang", "fold", "code").agg(F.count("*").alias("n")))
    uniform = 1.0 / (1 << CHAR_BITS)
    lower = None
    for k in range(1, order + 1):
        model = _other_fold(tables[k])
        discounts = F.broadcast(_discounts(model))  # a row for each language and fold
        discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        shares = model.join(discounts, ["lang", "fold"])
        context = F.shiftrightunsigned("code", CHAR_BITS) if k > 1 else F.lit(0).cast("bigint")
        contexts = shares.groupBy("lang", "fold", context.alias("context")).agg(
            F.sum("n").cast("double").alias("total"),
            *[F.sum(F.when(F.least("n", F.lit(3)) == i, 1).otherwise(0)).alias(f"c{i}") for i in (1, 2, 3)],
            *[F.first(f"d{i}").alias(f"d{i}") for i in (1, 2, 3)],
            F.count("*").alias("kinds"),
        )
        weighed = contexts.select(
            "lang", "fold", "context", "total", "kinds",
            (sum(F.col(f"d{i}") * F.col(f"c{i}") for i in (1, 2, 3)) / F.col("total")).alias("backoff"),
        )
        own = shares.select("lang", "fold", "code", (F.col("n") - discount).alias("kept"))
        wanted = tables[k].withColumn("context", context).join(own, ["lang", "fold", "code"], "left")
        if k == 1:
            below = F.coalesce(1.0 / (F.col("kinds") + 1), F.lit(uniform))
            joined = wanted.join(F.broadcast(weighed), ["lang", "fold", "context"], "left")
        else:
            below = F.col("low")
            shorter = lower.select("lang", "fold", F.col("code").alias("suffix"), F.col("p").alias("low"))
            joined = (
                wanted.withColumn("suffix", F.col("code").bitwiseAND(_mask(k - 1)))
                .join(weighed, ["lang", "fold", "context"], "left")
                .join(shorter, ["lang", "fold", "suffix"])
            )
        mixed = F.coalesce("kept", F.lit(0.0)) / F.col("total") + F.col("backoff") * below
        chance = F.when(F.col("total").isNull(), below).otherwise(mixed)
        lower = joined.select("lang", "fold", "code", "n", chance.alias("p"))
        if k < order:
            lower = land(lower)
    logp = F.round(F.log(F.greatest("p", F.lit(1e-12))) * UNIT).cast("int")
    return lower.select("lang", "fold", "code", "n", logp.alias("logp"))


def hash_arrays(table: DataFrame, entries: int) -> DataFrame:
    """(lang, fold, shard, codes, logps): the model as sorted arrays of some
    ``SHARD_ENTRIES`` entries."""
    shards = max(1, -(-entries // SHARD_ENTRIES))
    shard = F.pmod(F.xxhash64("code"), F.lit(shards)).cast("int").alias("shard")
    sorted_entries = F.sort_array(F.collect_list(F.struct("code", "logp"))).alias("e")
    rows = table.groupBy("lang", "fold", shard).agg(sorted_entries)
    return rows.select("lang", "fold", "shard", F.col("e.code").alias("codes"), F.col("e.logp").alias("logps"))


def _head(table: DataFrame, entries: int, head_entries: int) -> Column:
    """Condition that holds for the most frequent entries, at most ``head_entries``."""
    if entries <= head_entries:
        return F.lit(True)
    magnitude = F.floor(F.log2("n"))
    found = table.groupBy(magnitude.alias("m")).agg(F.count("*").alias("k")).collect()
    least, kept = 64, 0
    for row in sorted(found, key=lambda r: -r["m"]):
        if kept + row["k"] > head_entries:
            break
        least, kept = row["m"], kept + row["k"]
    return magnitude >= least


def _loaded(arrays: DataFrame) -> dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]:
    """Sorted codes and log probabilities of each language and fold. The caller has bounded
    the number of entries."""
    parts: dict[tuple[str, int], list] = {}
    for batch in arrays.select("lang", "fold", "codes", "logps").toArrow().to_batches():
        for i in range(batch.num_rows):
            codes, logps = (batch.column(c)[i].values.to_numpy() for c in ("codes", "logps"))
            parts.setdefault((batch.column("lang")[i].as_py(), batch.column("fold")[i].as_py()), []).append((codes, logps))
    out = {}
    for key, found in parts.items():
        codes, logps = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        order = np.argsort(codes)
        out[key] = codes[order], logps[order].astype(np.int32)
    return out


# --- scores -----------------------------------------------------------------------------

_MISS = "struct<code:bigint,n:bigint>"


def _score(order: int, shared, doc_id: pa.Field):
    misses = pa.list_(pa.struct([("code", pa.int64()), ("n", pa.int64())]))
    schema = pa.schema(
        [doc_id, ("lang", pa.string()), ("fold", pa.int32()), ("content", pa.int64())]
        + [(c, pa.int64()) for c in _BASE]
        + [("grams", pa.int64()), ("found", pa.int64()), ("misses", misses)]
    )

    def look_up(model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list]:
        """n-grams of each text, sum of the log probabilities found, and what is missing."""
        grams, found = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        missing: list[list] = [[] for _ in texts]
        codes, logps = model if model is not None else (np.zeros(0, np.int64), np.zeros(0, np.int32))
        for pieces in _pieces(texts, order):
            wanted, made = codes_of([t for _, t in pieces], order)
            at = np.searchsorted(codes, wanted)
            at[at == len(codes)] = 0
            known = codes[at] == wanted if len(codes) else np.zeros(len(wanted), bool)
            values = np.where(known, logps[at] if len(codes) else 0, 0).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(values)])
            ends = np.cumsum(made)
            owners = np.array([i for i, _ in pieces])
            np.add.at(grams, owners, made)
            np.add.at(found, owners, sums[ends] - sums[ends - made])
            for p in np.unique(np.searchsorted(ends, np.flatnonzero(~known), side="right")).tolist():
                part = slice(ends[p] - made[p], ends[p])
                missing[owners[p]].append(_summed(wanted[part][~known[part]]))
        merged = []
        for parts in missing:
            if not parts:
                merged.append([])
                continue
            codes_missed, n = _summed(np.concatenate([c for c, _ in parts]), np.concatenate([m for _, m in parts]))
            merged.append([{"code": c, "n": m} for c, m in zip(codes_missed.tolist(), n.tolist())])
        return grams, found, merged

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        number = defaultdict(count().__next__)
        for batch in batches:
            texts, langs, folds = (batch.column(c).to_pylist() for c in ("text", "lang", "fold"))
            base = []
            for text in texts:
                if len(number) > INTERNED:
                    number = defaultdict(count().__next__)
                base.append(base_counts(text, number))
            groups: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(langs, folds)):
                groups.setdefault(key, []).append(i)
            grams, found = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            missing: list[list] = [[]] * len(texts)
            for key, rows in groups.items():
                grams[rows], found[rows], own = look_up(models.get(key), [texts[i] for i in rows])
                for i, m in zip(rows, own):
                    missing[i] = m
            kept = [batch.column(c) for c in ("doc_id", "lang", "fold", "content")]
            counted = [pa.array([b[i] for b in base], pa.int64()) for i in range(len(_BASE))]
            rest = [pa.array(grams), pa.array(found), pa.array(missing, misses)]
            columns = [c.cast(f.type) for c, f in zip([*kept, *counted, *rest], schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return scan


def score(prepared: DataFrame, table: DataFrame, order: int = ORDER, head_entries: int = HEAD_ENTRIES) -> DataFrame:
    """Rows of ``prepared`` without their texts, with the counts of the rules, ``grams`` and
    ``loss``: the mean negative log probability of a character, null without n-grams."""
    spark = prepared.sparkSession
    table = land(table)
    entries = table.count()
    frequent = _head(table, entries, head_entries)
    arrays = land(hash_arrays(table, entries))
    if entries <= head_entries:
        head = arrays
    else:
        head = hash_arrays(table.filter(frequent), head_entries)
    shared = spark.sparkContext.broadcast(_loaded(head))
    kind = prepared.schema["doc_id"].dataType.simpleString()
    counted = ", ".join(f"{c} bigint" for c in _BASE)
    schema = (
        f"doc_id {kind}, lang string, fold int, content bigint, {counted}, "
        f"grams bigint, found bigint, misses array<{_MISS}>"
    )
    rows = prepared.select("doc_id", "lang", "fold", "content", "text")
    arrow = pa.field("doc_id", to_arrow_type(prepared.schema["doc_id"].dataType))
    scored = rows.mapInArrow(_score(order, shared, arrow), schema)
    total = F.col("found")
    if entries > head_entries:
        # Frequent n-grams never get here, so no code is hot.
        scored = land(scored.withColumn("_row", F.monotonically_increasing_id()))
        asked = scored.select("_row", "lang", "fold", F.explode("misses").alias("m"))
        rest = table.filter(~frequent).select("lang", "fold", "code", "logp")
        answers = asked.select("_row", "lang", "fold", "m.code", "m.n").join(rest, ["lang", "fold", "code"])
        sums = answers.groupBy("_row").agg(F.sum(F.col("n") * F.col("logp")).alias("rest"))
        scored = scored.join(sums, "_row", "left")
        total = total + F.coalesce("rest", F.lit(0))
    loss = F.when(F.col("grams") > 0, -total / (F.col("grams") * UNIT))
    return scored.select("doc_id", "lang", "content", *_BASE, "grams", loss.alias("loss"))


def bands(scored: DataFrame, width: float = BAND) -> DataFrame:
    """(lang, low, high): bounds of the loss in each language. Distinct texts that pass the
    counting rules have one vote each; quartiles are exact to one bin."""
    voters = scored.filter(~base_failed() & F.col("loss").isNotNull())
    votes = voters.select("lang", "content", F.floor(F.col("loss") * BIN).alias("bin")).distinct()
    histogram = votes.groupBy("lang", "bin").agg(F.count("*").alias("k"))
    # At most some 28,000 bins (no log probability is below that of 1e-12) for a language.
    upto = Window.partitionBy("lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    shares = histogram.withColumn("upto", F.sum("k").over(upto)).withColumn(
        "all", F.sum("k").over(Window.partitionBy("lang"))
    )
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, F.col("bin"))) / BIN
    found = shares.groupBy("lang").agg(*[quartile(q).alias(f"q{q}") for q in (1, 2, 3)])
    low = F.col("q2") - width * F.greatest(F.col("q2") - F.col("q1"), F.lit(2 / BIN))
    high = F.col("q2") + width * F.greatest(F.col("q3") - F.col("q2"), F.lit(2 / BIN))
    return found.select("lang", low.alias("low"), high.alias("high"))


def apply_rules(
    docs: DataFrame, order: int = ORDER, width: float = BAND, head_entries: int = HEAD_ENTRIES
) -> DataFrame:
    """Per row of ``docs(doc_id, text, lang)``: doc_id, the counts of the rules, base_failed,
    kept, perplexity, low and high (the band, as perplexities).

    A text is kept if it passes the counting rules and its perplexity lies in the band of its
    language. Null and empty texts fail the rules; a missing or null lang is a language of
    its own; a text too short for an n-gram has no perplexity and is judged by the rules
    alone. Texts of any length are read whole, in pieces. Equal rows get equal results; null
    ids are kept as they are; extra columns are ignored; an empty table gives an empty
    result.
    """
    if not 2 <= order <= 64 // CHAR_BITS:
        raise ValueError(f"order must be 2 to {64 // CHAR_BITS}")
    prepared = _prepared(docs)
    grams = land(count_grams(prepared, order))
    scored = land(score(prepared, probabilities(grams, order), order, head_entries))
    # A row for each language.
    judged = scored.join(F.broadcast(bands(scored, width)), "lang", "left")
    outside = (F.col("loss") < F.col("low")) | (F.col("loss") > F.col("high"))
    return judged.select(
        "doc_id",
        *_BASE,
        base_failed().alias("base_failed"),
        (~base_failed() & ~F.coalesce(outside, F.lit(False))).alias("kept"),
        F.exp("loss").alias("perplexity"),
        F.exp("low").alias("low"),
        F.exp("high").alias("high"),
    )
