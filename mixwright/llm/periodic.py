"""Periodic runs of words, and texts without their repetitions.

A run is a maximal stretch of words with smallest period q that holds its period at least
twice. By the runs theorem every run has a Lyndon root that is the longest Lyndon word at
its first position, in the order of the words or in the reversed order. So a text of n
words has at most 2n candidates (position, period), each of which is extended in both
directions by the longest common extension (LCE) of two positions. Extensions to the right
are answered by the suffix tree of the text, those to the left by that of its reversal:
trees are built by Ukkonen's algorithm, and an LCE is the depth of the lowest common
ancestor of two leaves, a range minimum over the Euler tour, in constant time.

Texts are independent, so the work is one pass over the table. A run of at least 12 words
repeats its first ``SEED`` words after one period, and all its words are covered by such
repeats; trees are therefore built for the stretches that repeated seeds cover (whole texts
where all is repeated). This loses nothing and spares texts without any repetition.
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
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from mixwright.llm.common import WORD

LEAST = 12  # words of the shortest run
SEED = 6  # at most half of LEAST
INTERNED = 1_000_000  # words that a task numbers before it begins anew
_WORD = re.compile(WORD)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])


class SuffixTree:
    """Suffix tree of a sequence of symbols >= 1, and LCEs of its positions."""

    def __init__(self, symbols: list[int]) -> None:
        self.size = len(symbols)
        self._rank_leaves(*self._build([*symbols, 0]))

    def _build(self, s: list[int]) -> tuple[dict[int, int], int, list[int], list[int], list[int]]:
        """Ukkonen's algorithm. ``s`` ends with its only 0. Edges are kept in one table, by
        node * kinds + first symbol; node 0 is the root."""
        n, kinds = len(s), max(s) + 1
        edges: dict[int, int] = {}
        start, end, link, suffix = [0], [0], [0], [-1]
        node = edge = length = waiting = 0
        for i, symbol in enumerate(s):
            waiting += 1
            last = 0
            while waiting:
                if not length:
                    edge = i
                key = node * kinds + s[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    suffix.append(i - waiting + 1)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    begin = start[child]
                    span = end[child] - begin
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if s[begin + length] == symbol:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    middle = len(start)
                    edges[key] = middle
                    edges[middle * kinds + symbol] = middle + 1
                    edges[middle * kinds + s[begin + length]] = child
                    start += (begin, i)
                    end += (begin + length, n)
                    link += (0, 0)
                    suffix += (-1, i - waiting + 1)
                    start[child] = begin + length
                    if last:
                        link[last] = middle
                    last = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        return edges, kinds, start, end, suffix

    def _rank_leaves(self, edges: dict[int, int], kinds: int, start: list[int], end: list[int], suffix: list[int]) -> None:
        """Euler tour in the order of the symbols. Of the nodes that the tour visits between
        two leaves, only the shallowest can be an answer, so it alone is kept."""
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        children = np.fromiter(edges.values(), np.int64, len(edges))[order].tolist()
        first = np.searchsorted(keys[order], np.arange(len(start) + 1) * kinds).tolist()
        leaves: list[int] = []
        between: list[int] = []
        shallowest = 0
        todo = [(0, 0, 0)]  # node, its depth, that of the node visited before it
        while todo:
            node, depth, before = todo.pop()
            shallowest = min(shallowest, before)
            low, high = first[node], first[node + 1]
            if low == high:
                leaves.append(suffix[node])
                between.append(shallowest)
                shallowest = depth
                continue
            for child in reversed(children[low:high]):
                todo.append((child, depth + end[child] - start[child], depth))
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        table = [np.array(between, np.int32)]
        while 2 ** len(table) <= len(leaves):
            half = 2 ** (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self._minima = table

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``a`` and ``b`` (a != b)."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self._minima[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k)) + 1])
        return out


def _next_smaller(values: list[int]) -> np.ndarray:
    """For each place the next one with a smaller value, or the end."""
    out, open_places = [len(values)] * len(values), []
    for i, value in enumerate(values):
        while open_places and values[open_places[-1]] > value:
            out[open_places.pop()] = i
        open_places.append(i)
    return np.array(out, np.int64)


def runs_of(symbols: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` symbols, by start, then
    period. Symbols are integers >= 1."""
    n = len(symbols)
    if n < 2:
        return []
    right = SuffixTree(symbols)
    # The longest Lyndon word at a place ends where the next smaller suffix begins. In the
    # reversed order the end mark is the largest symbol: words that reach it hold it.
    rank = right.rank[:n].tolist()
    ends = _next_smaller(rank)
    reverse_ends = _next_smaller([-r for r in rank])
    inside = np.flatnonzero(reverse_ends < n)
    left = SuffixTree(symbols[::-1])
    at = np.concatenate([np.arange(n), inside])
    period = np.concatenate([ends, reverse_ends[inside]]) - at
    on = right.lce(at, at + period)  # position n is that of the end mark
    back = np.zeros(len(at), np.int64)
    inner = np.flatnonzero(at > 0)
    i, p = at[inner], period[inner]
    back[inner] = left.lce(n - i, n - i - p)
    start, length = at - back, back + period + on
    long_enough = length >= np.maximum(least, 2 * period)
    found = np.stack([start, period, length])[:, long_enough]
    return [(s, size, q) for s, q, size in np.unique(found, axis=1).T.tolist()]


def zones(words: np.ndarray, seed: int = SEED) -> list[tuple[int, int]]:
    """Stretches (start, end) that are covered by repeated seeds, until nothing shrinks. All
    runs of at least twice ``seed`` words lie inside one of them."""
    out, todo = [], [(0, len(words))]
    while todo:
        low, high = todo.pop()
        if high - low < 2 * seed:
            continue
        part = words[low:high]
        grams = np.zeros(len(part) - seed + 1, np.uint64)
        for k in range(seed):
            grams = (grams ^ part[k : k + len(grams)]) * _MIX
            grams ^= grams >> np.uint64(29)
        order = np.argsort(grams, kind="stable")
        same = grams[order[1:]] == grams[order[:-1]]
        if not same.any():
            continue
        edge = np.zeros(len(part) + 1, np.int64)
        repeated = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
        np.add.at(edge, repeated, 1)
        np.add.at(edge, repeated + seed, -1)
        covered = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
        turns = np.flatnonzero(covered[1:] != covered[:-1])
        found = [(low + int(a), low + int(b)) for a, b in zip(turns[::2], turns[1::2])]
        if found == [(low, high)]:
            out.append((low, high))
        else:
            todo += found
    return sorted(out)


def runs_in(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Runs of a text given as numbered words."""
    out = []
    for low, high in zones(words, min(SEED, least // 2)):
        symbols = np.unique(words[low:high], return_inverse=True)[1] + 1
        out += [(low + s, size, q) for s, size, q in runs_of(symbols.tolist(), least)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by blanks."""
    if not runs:
        return " ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        edge[start + period] += 1
        edge[start + size] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return " ".join([words[i] for i in kept.tolist()])


def _scan(least: int, schema: pa.Schema):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = defaultdict(count(1).__next__)
        for batch in batches:
            flat: list[tuple[int, int, int]] = []
            offsets, sizes, texts = [0], [], []
            for text in batch.column("text"):
                if len(number) > INTERNED:
                    number = defaultdict(count(1).__next__)
                words = _WORD.findall(text.as_py() or "")
                numbered = np.fromiter(map(number.__getitem__, words), np.uint64, len(words))
                runs = runs_in(numbered, least)
                flat += runs
                offsets.append(len(flat))
                sizes.append(len(words))
                texts.append(collapsed(words, runs))
            fields = [pa.array([r[i] for r in flat], pa.int64()) for i in range(3)]
            runs = pa.StructArray.from_arrays(fields, names=_RUN.fieldNames())
            listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs)
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), listed, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return scan


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_words, runs (array of start, length and
    period in words, by start, then period) and collapsed (the text without repetitions).

    Null and empty texts have no words, no runs, and an empty collapsed text. Whole texts
    are read; a zone of a million words takes some 0.5 GB of the task for as long as its
    trees live. Rows are kept as they are, so repeated rows and null ids have a result
    each; extra columns are ignored; an empty table gives an empty result.
    """
    if least < 2:
        raise ValueError("a run has at least 2 words")
    schema = StructType(
        [
            docs.schema["doc_id"],
            StructField("n_words", LongType()),
            StructField("runs", ArrayType(_RUN)),
            StructField("collapsed", StringType()),
        ]
    )
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(least, to_arrow_schema(schema)), schema)


def run_lines(runs: Column) -> Column:
    """``start,length,period`` and a line feed for each run."""
    one = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return F.array_join(F.transform(runs, one), "")


def longest_run(runs: Column) -> Column:
    """(length, start, period) of the longest run, ties to the smaller start, then period."""
    ranked = F.array_max(F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    return F.when(
        ranked.isNotNull(),
        F.struct(
            ranked["length"].alias("length"), (-ranked["col2"]).alias("start"), (-ranked["col3"]).alias("period")
        ),
    )


def planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` in which a tenth of the texts become periodic from some word on:
    with h the unsigned CRC-32 of the id, g = h div 10 and n words, texts with h mod 10 = 0
    repeat the p = 1 + (n - a) div (3 + g mod 8) words from word a = g mod n on."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def repeat(words: Column) -> Column:
        n, g = F.size(words).cast("bigint"), F.floor(crc / 10).cast("bigint")
        shape = F.struct((g % n).alias("a"), (F.lit(1) + F.floor((n - g % n) / (F.lit(3) + g % 8))).alias("p"))

        def place(s: Column) -> Column:
            at = lambda i: F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int")
            return F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(words, at(i))), " ")

        return F.when(n > 0, F.get(F.transform(F.array(shape), place), F.lit(0))).otherwise("")

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    # The one-element arrays bind their content, which each element would compute anew.
    changed = F.get(F.transform(F.array(words), repeat), F.lit(0))
    return docs.select("doc_id", F.when(crc % 10 == 0, changed).otherwise(text).alias("text"))
