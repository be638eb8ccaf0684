"""Shards of near equal bytes by a k-d tree over document metadata.

A node is split along the metadata dimension in which its documents spread most, at the
weighted median (weights are bytes), until leaves reach the target. All nodes of a level
are split together. Medians are distributed: bytes are summed by node and value bucket,
the bucket that holds the median is found and only it is cut finer.

Dimensions are the length, the language and the source. Each is scaled by rank: a value is
the share of all bytes below it, so dimensions of any kind can be compared. Equal texts are
one point: they take the metadata of their group, and the low bits of a point are a hash of
the text, so no median falls between them. Only groups too large for even shards are cut,
by a hash of the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mixwright.llm.common import land

LAW = "bytes"
# A point on a dimension: the value, then a hash of the text, then (in large groups of equal
# texts) a hash of the id.
VALUE_BITS, TEXT_BITS, ID_BITS = 20, 24, 16
SIZE_BINS = 100  # bins of the length for each doubling
GROUP_SHARE = 0.01  # of a leaf's bytes: groups of equal texts up to this are never cut
POINT_BITS = VALUE_BITS + TEXT_BITS + ID_BITS
ROUND_BITS = 12
SLOT_ROWS = 50_000  # rows that one task numbers
BROADCAST_NODES = 1_000_000  # nodes of a level whose table is broadcast
LEVELS_PER_LANDING = 4


def byte_size(column: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0)) + 1).cast("bigint")


def _low_bits(hashed: Column, bits: int) -> Column:
    return hashed.bitwiseAND((1 << bits) - 1)


def _named(column: str) -> Column:
    """Categories by their first letters, so that neighbours in name are neighbours."""
    name = F.rpad(F.hex(F.substring(F.coalesce(F.col(column).cast("string"), F.lit("")), 1, 8).cast("binary")), 10, "0")
    first = F.conv(F.substring(name, 1, 3), 16, 10).cast("bigint")
    known = F.least(F.lit((1 << VALUE_BITS) - 1), F.shiftleft(first, 8) + _low_bits(F.xxhash64(F.col(column).cast("string")), 8))
    return F.when(F.col(column).isNull(), F.lit(0).cast("bigint")).otherwise(known)


CODES = ("c0", "c1", "c2")  # length, language, source: at most 2 ** VALUE_BITS values each


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, same, c0, c1, c2): metadata of each document; ``same`` is
    a hash of its text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    codes = [
        F.floor(F.log2(byte_size()) * SIZE_BINS).cast("bigint"),
        _named("lang") if "lang" in docs.columns else F.lit(0).cast("bigint"),
        _named("source") if "source" in docs.columns else F.lit(0).cast("bigint"),
    ]
    return docs.select(
        "doc_id",
        byte_size().alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("same"),
        *[c.alias(name) for c, name in zip(codes, CODES)],
    )


def _as_groups(rows: DataFrame, most_bytes: float) -> DataFrame:
    """Adds ``cut_by``: 0 in groups of equal texts of up to ``most_bytes``, which get the
    smallest codes of the group; a hash of the id in larger ones. Large groups are few (their
    bytes bound their number), so they are told by a broadcast and join nothing."""
    smallest = [F.min(c).alias(f"{c}_all") for c in CODES]
    groups = land(rows.groupBy("same").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), *smallest))
    large = F.broadcast(groups.filter(F.col("bytes") > most_bytes).select("same"))
    several = groups.filter((F.col("bytes") <= most_bytes) & (F.col("n") > 1)).select("same", *[f"{c}_all" for c in CODES])
    small = rows.join(large, "same", "left_anti").join(several, "same", "left")
    common = {c: F.coalesce(f"{c}_all", c) for c in CODES}
    small = small.withColumns(common).select(*rows.columns, F.lit(0).cast("bigint").alias("cut_by"))
    by_id = _low_bits(F.xxhash64("doc_id", "same"), ID_BITS).alias("cut_by")
    return small.unionByName(rows.join(large, "same", "left_semi").select(*rows.columns, by_id))


def located(rows: DataFrame, total: int, most_bytes: float) -> DataFrame:
    """(doc_id, size, text_crc32, d0, d1, d2): documents as points. Codes are replaced by the
    share of all bytes below the middle of their value: a table of at most 2 ** VALUE_BITS
    rows for each dimension, which is broadcast."""
    grouped = land(_as_groups(rows, most_bytes))
    ties = F.shiftleft(_low_bits(F.col("same"), TEXT_BITS), ID_BITS) + F.col("cut_by")
    out = grouped
    for i, code in enumerate(CODES):
        bytes_of = grouped.groupBy(code).agg(F.sum("size").alias("b"))
        upto = F.sum("b").over(Window.orderBy(code).rowsBetween(Window.unboundedPreceding, 0))
        share = (upto - F.col("b") / 2) / max(1, total) * ((1 << VALUE_BITS) - 1)
        ranks = bytes_of.select(code, F.floor(share).cast("bigint").alias(f"v{i}"))
        out = out.join(F.broadcast(ranks), code)
    points = [(F.shiftleft(f"v{i}", TEXT_BITS + ID_BITS) + ties).alias(f"d{i}") for i in range(len(CODES))]
    return out.select("doc_id", "size", "text_crc32", *points)


def _dimensions(points: DataFrame) -> list[str]:
    return [c for c in points.columns if c[0] == "d" and c[1:].isdigit()]


def _spread(dims: list[str]) -> list[Column]:
    """Weighted variance of each dimension, from sums."""
    unit = float(1 << POINT_BITS)
    sums = []
    for d in dims:
        x, w = F.col(d) / unit, F.col("size").cast("double")
        sums += [F.sum(w * x).alias(f"{d}_s"), F.sum(w * x * x).alias(f"{d}_q")]
    return sums


def _with_nodes(points: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Adds the columns of ``rows``, a tuple for each node beginning with its id, to the
    points of these nodes; other points are left out.

    A single node needs no join: its values are constants. Up to ``BROADCAST_NODES`` rows
    (numbers only, so some 40 MB) are broadcast; beyond, both sides are shuffled.
    """
    if len(rows) == 1:
        fields = [f.split() for f in schema.split(", ")][1:]
        values = [F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(rows[0][1:], fields)]
        return points.filter(F.col("node") == F.lit(rows[0][0])).select("*", *values)
    table = points.sparkSession.createDataFrame(rows, schema)
    return points.join(F.broadcast(table) if len(rows) <= BROADCAST_NODES else table, "node")


def _nodes(points: DataFrame, leaves_of: dict[int, int]) -> list[tuple[int, int, float]]:
    """(node, widest dimension, bytes that go left) of the nodes that are to be split; the
    driver sees one row a node."""
    dims = _dimensions(points)
    rows = points.groupBy("node").agg(F.sum("size").alias("bytes"), *_spread(dims)).collect()
    out = []
    for r in rows:
        w, leaves = float(r["bytes"]), leaves_of[r["node"]]
        # Rounded, so that the last digits of a sum never decide.
        wide = [round(r[f"{d}_q"] / w - (r[f"{d}_s"] / w) ** 2, 9) for d in dims]
        out.append((r["node"], wide.index(max(wide)), r["bytes"] * (leaves // 2) / leaves))
    return out


def _medians(points: DataFrame, nodes: list[tuple[int, int, float]]) -> dict[int, int]:
    """Cut point of each node: points below it go left. Exact for the given bits: each
    round refines the boundary bucket of each node only."""
    dims = F.array(*_dimensions(points))
    reached_of = {n: (0, 0, 0) for n, _, _ in nodes}  # bucket, bytes up to its end, bytes in it
    for bits in range(ROUND_BITS, POINT_BITS + 1, ROUND_BITS):
        frontier = []
        for n, dim, goal in nodes:
            bucket, reached, size = reached_of[n]
            frontier.append((n, dim, bucket, reached - size, goal))
        moved = _with_nodes(points, frontier, "node bigint, dim int, open bigint, below bigint, goal double")
        moved = moved.withColumn("point", F.get(dims, F.col("dim")))
        histogram = (
            moved.filter(F.shiftright("point", POINT_BITS - bits + ROUND_BITS) == F.col("open"))
            .groupBy("node", "below", "goal", F.shiftright("point", POINT_BITS - bits).alias("bucket"))
            .agg(F.sum("size").alias("size"))
        )
        running = F.col("below") + F.sum("size").over(Window.partitionBy("node").orderBy("bucket"))
        crossing = F.min(F.when(F.col("reached") >= F.col("goal"), F.struct("bucket", "reached", "size")))
        found = histogram.withColumn("reached", running).groupBy("node").agg(crossing.alias("c"))
        reached_of = {r["node"]: tuple(r["c"]) for r in found.collect()}
    out = {}
    for n, _, goal in nodes:
        bucket, reached, size = reached_of[n]
        out[n] = bucket + int(reached - goal < goal - (reached - size))
    return out


def kd_tree(points: DataFrame, leaves: int) -> DataFrame:
    """Adds ``shard`` (0 to ``leaves`` - 1, from left to right) to ``points``.

    Node ids are first shard * (leaves + 1) + number of leaves, so a node knows its range.
    Points of a node that is a leaf rest in ``done`` and are not read again. The compact
    points (no texts) are written after each ``LEVELS_PER_LANDING`` levels.
    """
    step = leaves + 1
    dims = F.array(*_dimensions(points))
    placed, done = points.withColumn("node", F.lit(leaves).cast("bigint")), []
    open_nodes, level = {leaves: leaves}, 0
    while leaves > 1 and open_nodes:
        level += 1
        nodes = _nodes(placed, open_nodes)
        if not nodes:  # equal points took one side, and the open nodes of the other are empty
            break
        cuts, rows, open_nodes = _medians(placed, nodes), [], {}
        for n, dim, _ in nodes:
            first, all_of = divmod(n, step)
            left = all_of // 2
            lower, upper = first * step + left, (first + left) * step + all_of - left
            rows.append((n, dim, cuts[n], lower, upper))
            open_nodes |= {k: k % step for k in (lower, upper)}
        split = _with_nodes(placed, rows, "node bigint, dim int, cut bigint, lower bigint, upper bigint")
        side = F.when(F.get(dims, F.col("dim")) < F.col("cut"), F.col("lower")).otherwise(F.col("upper"))
        placed = split.select(*points.columns, side.alias("node"))
        if level % LEVELS_PER_LANDING == 0:
            placed = land(placed)
        if min(open_nodes.values()) == 1:
            is_leaf = F.col("node") % step == 1
            done.append(placed.filter(is_leaf))
            placed = placed.filter(~is_leaf)
            open_nodes = {n: k for n, k in open_nodes.items() if k > 1}
    for part in done:
        placed = placed.unionByName(part)
    return placed.withColumn("shard", F.floor(F.col("node") / step).cast("int"))


def with_slots(placed: DataFrame, rows: int) -> DataFrame:
    """Adds ``slot``: a gapless number from 0 in each shard. Rows are numbered in cells of
    about ``SLOT_ROWS`` rows (a slice of the hash of a row's content), cells by running counts."""
    cells = max(1, -(-rows // SLOT_ROWS))
    celled = placed.withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(cells)).cast("int"))
    counts = celled.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("shard", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    numbered = celled.withColumn("_in_cell", F.row_number().over(inside) - 1)
    return numbered.join(firsts, ["shard", "cell"]).withColumn("slot", (F.col("first") + F.col("_in_cell")).cast("bigint"))


def leaves_for(total_bytes: int, target_bytes: int) -> int:
    return max(1, -(-total_bytes // target_bytes))


def shard_documents(docs: DataFrame, leaves: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Per row of ``docs(doc_id, text, lang, source)``: doc_id, size, text_crc32, shard, slot.

    Give the number of leaves, or the bytes that a leaf should have. Null texts have size
    1; missing and null lang or source are a category of their own. Equal texts share a
    shard, unless their group has more than ``GROUP_SHARE`` of a leaf's bytes; then it is cut
    by a hash of the ids (equal rows never are, and null ids share one point). A text larger
    than a leaf has a leaf to itself. Texts are read once, whole; extra columns are
    ignored; an empty table gives an empty result.
    """
    rows = land(measured(docs))
    whole = rows.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    if leaves is None:
        leaves = leaves_for(whole["bytes"] or 0, target_bytes)
    if whole["rows"]:
        points = land(located(rows, whole["bytes"], GROUP_SHARE * whole["bytes"] / leaves))
        placed = kd_tree(points, leaves)
    else:
        placed = rows.withColumn("shard", F.lit(0))
    return with_slots(land(placed.select("doc_id", "size", "text_crc32", "shard")), whole["rows"]).select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )
