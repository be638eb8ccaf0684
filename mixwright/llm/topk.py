"""Exact top-k by inner product with ball trees.

Candidates are dealt to shards; each shard builds a ball tree over its vectors. A query
visits nodes in the order of their upper bounds (inner product with the centre plus norm
times radius) and stops where the bound falls below its current kth score. Queries travel
in packed blocks. They first search one shard, their own; the kth scores found there are
shared with all other shards, which prune by them from the start.

Scores are exact integers: components are floor(scale * x).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mixwright.llm.common import land

SCALE = 1024
K = 10
SHARD_ROWS = 8192
TASK_QUERIES = 20_000  # queries that meet one shard in one task
BLOCK_QUERIES = 1024
LEAF_ROWS = 64
_EXACT = 2.0**52  # sums of products below this are exact in floating point


class BallTree:
    """Vectors of one shard. Nodes are halved along their widest component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.nodes: list[tuple] = []  # centre, radius, left, right, rows
        top = float(np.abs(self.vectors).max(initial=0))
        self.exact = top * top * max(1, vectors.shape[1]) < _EXACT
        if len(ids):
            self._build(np.arange(len(ids)), leaf_rows)

    def _build(self, rows: np.ndarray, leaf_rows: int) -> int:
        part = self.vectors[rows].astype(np.float64)
        centre = part.mean(axis=0)
        radius = float(np.sqrt(((part - centre) ** 2).sum(axis=1).max()))
        at = len(self.nodes)
        self.nodes.append(None)
        left = right = -1
        spread = part.max(axis=0) - part.min(axis=0) if part.shape[1] else np.zeros(1)
        if len(rows) > leaf_rows and spread.max() > 0:
            values = part[:, int(spread.argmax())]
            order = np.argsort(values, kind="stable")
            half = len(rows) // 2
            left = self._build(rows[order[:half]], leaf_rows)
            right = self._build(rows[order[half:]], leaf_rows)
        self.nodes[at] = (centre, radius, left, right, np.sort(rows) if left < 0 else None)
        return at

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner product over all nodes, a little above the exact ones."""
        if not hasattr(self, "_centres"):
            self._centres = np.stack([n[0] for n in self.nodes])
            self._radii = np.array([n[1] for n in self.nodes])
        q = query.astype(np.float64)
        raw = self._centres @ q + np.sqrt(q @ q) * self._radii
        return raw + 1e-9 * (np.abs(raw) + np.sqrt(q @ q) * (self._radii + np.sqrt((self._centres**2).sum(axis=1)))) + 1e-6

    def _scores(self, rows: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return (self.vectors[rows].astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
        return np.array([sum(int(a) * int(b) for a, b in zip(v, query)) for v in self.vectors[rows]], dtype=object)

    def search(self, query_id: int, query: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """(score, id) of the k best vectors, the query's own id left out; only scores of at
        least ``least`` matter. Best first, ties by id."""
        if not self.nodes:
            return []
        top = float(np.abs(query).max(initial=0))
        exact = self.exact and top * top * max(1, len(query)) < _EXACT
        bounds = self.bounds(query)
        best: list[tuple[int, int]] = []  # heap of (score, -id): the worst kept one first
        floor = least
        waiting = [(-bounds[0], 0)]
        while waiting:
            bound, at = heapq.heappop(waiting)
            if floor is not None and -bound < floor:
                break
            _, _, left, right, rows = self.nodes[at]
            if rows is None:
                for child in (left, right):
                    if floor is None or bounds[child] >= floor:
                        heapq.heappush(waiting, (-bounds[child], child))
                continue
            scores = self._scores(rows, query, exact)
            if len(rows) > 4 * k:  # the best of a large leaf, with all ties of the last
                cut = np.partition(scores, len(rows) - k - 1)[len(rows) - k - 1]
                rows, scores = rows[scores >= cut], scores[scores >= cut]
            for row, score in zip(rows, scores):
                one = (int(score), -int(self.ids[row]))
                if one[1] == -query_id or (floor is not None and one[0] < floor):
                    continue
                if len(best) < k:
                    heapq.heappush(best, one)
                elif one > best[0]:
                    heapq.heapreplace(best, one)
            if len(best) == k:
                floor = best[0][0] if floor is None else max(floor, best[0][0])
        return [(score, -minus) for score, minus in sorted(best, reverse=True)]


def whole_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v, dim) with whole components. Rows without an id, null vectors and vectors
    that hold a null, NaN or infinite component are left out; equal rows are kept once."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    known = table.select("vec_id", x.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(True))
    )
    whole = F.transform("embedding", lambda c: F.floor(c * scale).cast("bigint"))
    return known.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v"), F.size("embedding").alias("dim")).distinct()


def _pack_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Queries of one shard of queries, packed: one row for each block and dimension."""
    for batch in batches:
        for dim, part in batch.groupby("dim"):
            for lo in range(0, len(part), BLOCK_QUERIES):
                some = part.iloc[lo : lo + BLOCK_QUERIES]
                matrix = np.stack([np.asarray(v, dtype="<i8") for v in some["v"]]).reshape(len(some), int(dim))
                floors = some["floor"].astype("float64").to_numpy() if "floor" in some else np.full(len(some), np.nan)
                floors = np.where(np.abs(floors) < _EXACT, floors, np.nan)  # others prune nothing
                yield pd.DataFrame(
                    {
                        "home": [int(some["home"].iloc[0])],
                        "part": [int(some["part"].iloc[0])],
                        "dim": [int(dim)],
                        "ids": [some["vec_id"].to_numpy("<i8").tobytes()],
                        "queries": [matrix.tobytes()],
                        "floors": [floors.astype("<f8").tobytes()],
                    }
                )


_BLOCK = "home int, part int, dim int, ids binary, queries binary, floors binary"
_HITS = "query_id bigint, vec_id bigint, score bigint"


def _search_shard(k: int):
    def search(key, candidates: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        out: list[tuple[int, int, int]] = []
        if len(candidates) and len(blocks):
            dim = int(key[2])
            matrix = np.stack([np.asarray(v, dtype=np.int64) for v in candidates["v"]]).reshape(len(candidates), dim)
            tree = BallTree(candidates["vec_id"].to_numpy(np.int64), matrix)
            for ids, queries, floors in zip(blocks["ids"], blocks["queries"], blocks["floors"]):
                ids, floors = np.frombuffer(ids, "<i8"), np.frombuffer(floors, "<f8")
                queries = np.frombuffer(queries, "<i8").reshape(len(ids), dim)
                for query_id, query, least in zip(ids, queries, floors):
                    found = tree.search(int(query_id), query, k, None if np.isnan(least) else int(least))
                    out += [(int(query_id), vec_id, score) for score, vec_id in found]
        return pd.DataFrame(out, columns=names).astype("int64")

    return search


def _best(hits: DataFrame, k: int) -> DataFrame:
    """At most k hits for each query and shard come in, so no query has many."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _searched(candidates: DataFrame, blocks: DataFrame, k: int, chunks: int) -> DataFrame:
    """Hits of ``blocks(shard, chunk)``. A task has one shard and one chunk of the queries,
    so both of its sides are bounded; a shard goes to as many tasks as there are chunks."""
    if chunks > 1:
        dealt = candidates.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    else:
        dealt = candidates.withColumn("chunk", F.lit(0))
    cell = ["shard", "chunk", "dim"]
    return dealt.groupBy(*cell).cogroup(blocks.groupBy(*cell)).applyInPandas(_search_shard(k), _HITS)


def exact_top_k(
    candidates: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE,
    shard_rows: int = SHARD_ROWS, task_queries: int = TASK_QUERIES,
) -> DataFrame:
    """The k best of ``candidates(vec_id, embedding)`` for each row of
    ``queries(vec_id, embedding)``: query_id, rank (from 1), vec_id, score.

    Ties go to the smaller vec_id; candidates with the query's own id are left out. Vectors
    are compared with vectors of the same length only. Rows that repeat another one count
    once (see ``whole_vectors`` for rows that take no part). Scores beyond 64 bits are an
    error. Extra columns are ignored; empty tables give an empty result.
    """
    known = whole_vectors(candidates, scale)
    asked = whole_vectors(queries, scale)
    shards = max(1, -(-known.count() // shard_rows))
    n_asked = asked.count()
    # Queries are packed by home; homes with too many queries for one task have parts.
    parts, chunks = max(1, -(-n_asked // (shards * task_queries))), max(1, -(-n_asked // task_queries))
    dealt = known.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    homed = asked.withColumn("home", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn(
        "part", F.pmod(F.xxhash64(F.lit("part"), F.col("vec_id")), F.lit(parts)).cast("int")
    )
    first_blocks = _packed(homed).withColumn("shard", F.col("home")).withColumn("chunk", F.col("part"))
    own = land(_searched(dealt, first_blocks, k, parts))
    if shards == 1:
        return _best(own, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    # The kth score of each query so far; queries with fewer hits have no floor yet.
    floors = _best(own, k).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    others = _packed(homed.join(floors, "vec_id", "left")).withColumns(
        {
            "chunk": F.pmod(F.col("home") * parts + F.col("part"), F.lit(chunks)).cast("int"),
            "shard": F.explode(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home"))),
        }
    )
    hits = own.unionByName(_searched(dealt, others, k, chunks))
    return _best(hits, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _packed(homed: DataFrame) -> DataFrame:
    """Blocks of queries that share home and part."""
    return homed.repartition("home", "part").sortWithinPartitions("home", "part", "vec_id").mapInPandas(_one_home, _BLOCK)


def _one_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, part in batch.groupby(["home", "part"]):
            yield from _pack_blocks(iter([part]))


QUERY_EVERY = 100


def queries_of(table: DataFrame, every: int = QUERY_EVERY) -> DataFrame:
    return table.filter(F.col("vec_id") % every == 0)
