"""A Merkle manifest of a dataset, and proofs that need few stored levels.

Rows are leaves. Each group (a language) has a tree whose nodes join runs of ``ARITY``
consecutive children; the roots of the groups, in order, are the leaves of the tree that
gives the root of the dataset. Only every ``KEPT_EVERY``-th level is written. A proof needs
the siblings on all levels: the missing nodes of each aligned subtree (``ARITY`` **
``KEPT_EVERY`` stored nodes below one stored node) are computed again from its stored
nodes, its siblings are read off, and the nodes are dropped. So storage is little more
than the leaves, and one subtree of 512 nodes is the most that a row ever holds.

Leaves get their place without a global sort in one task: they are range partitioned and
sorted, and what earlier partitions hold is counted. A place is stored before it is used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mixwright.llm.common import ascii_lower, land
from mixwright.session import new_folder

# Children of a node, digits of a digest, the leaf's fields in order.
ARITY = 8
DIGITS = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
KEPT_EVERY = 3  # levels from one stored level to the next
SUBTREE = ARITY**KEPT_EVERY
BROADCAST_ROWS = 200_000  # counts and group roots that are broadcast; beyond, joined
_STEP = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """``-`` for a null, else the UTF-8 bytes of the value, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_of(text: Column) -> Column:
    """Digest of a row's fields, with ``text`` in place of its text."""
    return digest(F.concat(*[field(F.col(c) if c != "text" else text) for c in FIELDS]))


def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def with_places(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``pos`` (0-based place in its group, in ``order``) and ``n`` (rows of the group).

    ``group`` and ``order`` make up the sort key: groups are neighbours in it. Rows that are
    alike in all of it are spread by their number in the (stored) input.
    """
    stored = land(rows.withColumn("_tie", F.monotonically_increasing_id()))
    sorted_rows = stored.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    placed = land(sorted_rows.drop("_tie").withColumn("_seq", F.monotonically_increasing_id()))
    # The number holds the partition in its upper bits and the place inside it below.
    part, at = F.shiftright("_seq", 33).alias("_part"), F.col("_seq").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumn("_part", part).withColumn("_at", at)
    counts = placed.groupBy(group, "_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    firsts = land(
        counts.select(
            F.col(group).alias("_group"),
            F.col("_part").alias("_of"),
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_rows").over(whole).alias("n"),
        )
    )
    joined = placed.join(
        _few(firsts, firsts.count()), (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_of"))
    )
    names = [c for c in rows.columns]
    return joined.select(*names, (F.col("_at") + F.col("_shift")).alias("pos"), "n")


def _runs(nodes: Column) -> Column:
    """The digests of each run of ``ARITY`` nodes, joined."""
    last = F.floor((F.size(nodes) - 1) / ARITY).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(nodes, i * ARITY + 1, ARITY), "")
    )


def _subtrees(level: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each aligned subtree: (group, sub, nodes, runs0, runs1, .., top, levels).

    ``nodes`` are its stored nodes in order (with ``keep``), ``runs_i`` the joined children on
    its i-th level, ``levels`` how many levels it spans (fewer than ``KEPT_EVERY`` only if it
    is the whole tree and small), ``top`` its uppermost node.
    """
    fields = F.struct("pos", "h", *keep)
    rows = level.groupBy("group", F.floor(F.col("pos") / SUBTREE).alias("sub"), "n").agg(
        F.sort_array(F.collect_list(fields)).alias("nodes")
    )
    found = rows.withColumn("_digests", F.col("nodes.h"))
    spans = F.lit(KEPT_EVERY)
    for fewer in reversed(range(KEPT_EVERY)):
        spans = F.when(F.col("n") <= ARITY**fewer, F.lit(fewer)).otherwise(spans)
    top = F.get("_digests", F.lit(0))
    for i in range(KEPT_EVERY):
        found = found.withColumn(f"runs{i}", _runs(F.col("_digests")))
        found = found.withColumn("_digests", F.transform(f"runs{i}", digest))
        found = found.withColumn(f"_top{i + 1}", F.get("_digests", F.lit(0)))
    tops = [top_at for top_at in (F.col(f"_top{i + 1}") for i in range(KEPT_EVERY))]
    found = found.withColumn("levels", spans)
    lone = F.get(F.col("nodes.h"), F.lit(0))
    top = F.coalesce(*[F.when(F.col("levels") == i + 1, t) for i, t in enumerate(tops)], lone)
    return found.withColumn("top", top).drop("_digests", *[f"_top{i + 1}" for i in range(KEPT_EVERY)])


def _grow(level: DataFrame, folder: str, keep: list[str]) -> tuple[list[str], str]:
    """Writes ``level(group, pos, n, h, *keep)`` and every ``KEPT_EVERY``-th level above it,
    and the root of each group. Returns the folders of the levels, lowest first, and that of
    the roots (group, h)."""
    spark, paths, roots = level.sparkSession, [], f"{folder}/roots"
    empty = level.select("group", "h").limit(0)
    empty.write.mode("overwrite").parquet(roots)
    while True:
        path = f"{folder}/level-{KEPT_EVERY * len(paths)}"
        level.write.mode("overwrite").parquet(path)
        paths.append(path)
        level = spark.read.schema(level.schema).parquet(path)
        large = F.col("n") > SUBTREE
        tops = _subtrees(level.select("group", "pos", "n", "h"), []).select("group", "sub", "n", "top")
        tops.filter(~large).select("group", F.col("top").alias("h")).write.mode("append").parquet(roots)
        if level.filter(large).isEmpty():
            return paths, roots
        level = tops.filter(large).select(
            "group",
            F.col("sub").cast("bigint").alias("pos"),
            F.ceil(F.col("n") / SUBTREE).cast("bigint").alias("n"),
            F.col("top").alias("h"),
        )


@dataclass(frozen=True)
class Manifest:
    """Folders of what is stored: levels of the groups' trees and of the tree above them
    (lowest first), the groups' roots, and the root of the dataset."""

    levels: list[str]
    roots: str
    upper_levels: list[str]
    root: str


def leaves(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """(doc_id, lang, h, claim): each row's leaf, and the leaf of the row with ``claimed`` as
    its text, which a proof is to be tried on (by default the row's own).

    Missing columns among ``FIELDS`` count as null.
    """
    for name in FIELDS:
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast("string"))
    text = F.col("text").cast("string")
    return docs.select(
        "doc_id",
        F.col("lang").cast("string").alias("lang"),
        leaf_of(text).alias("h"),
        leaf_of(text if claimed is None else claimed).alias("claim"),
    )


def build_manifest(rows: DataFrame, folder: str) -> Manifest:
    """Writes the manifest of ``rows`` (see :func:`leaves`) below ``folder``.

    Leaves ascend by doc_id within a language (null first), equal ids by their digest. A
    null language is a group of its own, before the others; groups are in the order of
    their UTF-8 bytes. Repeated rows are leaves of their own. An empty table has no root.
    """
    spark = rows.sparkSession
    named = rows.withColumn("group", field(F.col("lang")))
    placed = with_places(named, "group", ["lang", "doc_id", "h"])
    level = placed.select("group", "pos", "n", "h", "doc_id", "claim")
    paths, roots = _grow(level, f"{folder}/groups", ["doc_id", "claim"])
    subroots = spark.read.schema("group string, h string").parquet(roots)
    # A group's name without its length is the language, whose bytes give the order.
    lang = F.when(F.col("group") != "-", F.regexp_replace("group", "^[0-9]+:", ""))
    named = subroots.select(F.lit("").alias("group"), "h", F.col("group").alias("of"), lang.alias("lang"))
    upper = with_places(named, "group", ["lang", "of"])
    upper_paths, root = _grow(upper.select("group", "pos", "n", "h", "of"), f"{folder}/upper", ["of"])
    return Manifest(paths, roots, upper_paths, root)


def _path_in_subtree() -> Column:
    """What stands before and after the node at index ``i`` of its subtree, level by level."""
    steps = []
    for level in range(KEPT_EVERY):
        above = F.floor(F.col("i") / ARITY ** (level + 1)).cast("int")
        place = F.floor(F.col("i") / ARITY**level).cast("int") % ARITY
        run = F.get(f"runs{level}", above)
        before = F.substring(run, F.lit(1), place * DIGITS)
        after = F.substring(run, place * DIGITS + DIGITS + 1, F.length(run))
        steps.append(F.struct(before.alias("before"), after.alias("after")))
    return F.slice(F.array(*steps), F.lit(1), F.col("levels"))


def _proved(level: DataFrame, above: DataFrame, keep: list[str]) -> DataFrame:
    """Nodes of a stored level with their paths up to the root: (group, pos, h, *keep, path,
    *carried), given those of the stored level above, by (group, pos)."""
    carried = [c for c in above.columns if c not in ("group", "pos", "path")]
    upper = above.select(F.col("group").alias("_g"), F.col("pos").alias("_p"), F.col("path").alias("_up"), *carried)
    trees = _subtrees(level, keep)
    joined = trees.join(upper, (F.col("group") == F.col("_g")) & (F.col("sub") == F.col("_p")))
    # Paths are made node by node after this, so a row never holds those of a whole subtree.
    spread = joined.select(
        "group", "levels", "_up", *carried, *[f"runs{i}" for i in range(KEPT_EVERY)], F.posexplode("nodes").alias("i", "node")
    )
    return spread.select(
        "group", "node.pos", "node.h", *[f"node.{c}" for c in keep],
        F.concat(_path_in_subtree(), "_up").alias("path"), *carried,
    )


def _down(spark: SparkSession, paths: list[str], roots: DataFrame, keep: list[str]) -> DataFrame:
    """Paths of the nodes of the lowest level. ``roots`` has (group, path, ..) of the roots.

    A group's root lies above the stored level in which it is one subtree, so each level
    takes the groups that end there and the nodes of the level above.
    """
    above = None
    for i in reversed(range(len(paths))):
        level = spark.read.parquet(paths[i])
        ends = level.filter((F.col("pos") == 0) & (F.col("n") <= SUBTREE)).select("group")
        starts = roots.join(ends, "group").withColumn("pos", F.lit(0).cast("bigint"))
        starts = starts.select("group", "pos", "path", *[c for c in roots.columns if c not in ("group", "path")])
        above = starts if above is None else above.unionByName(starts)
        found = _proved(level, above, keep if i == 0 else [])
        if i:
            above = land(found.select(*above.columns))
    return found


def proofs(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """Per leaf: doc_id, h (its digest), claim, subroot, root and path, an array of what
    stands before and after the node in its run, from the leaf up to the root."""
    root = spark.read.schema("group string, h string").parquet(manifest.root)
    top = root.select("group", F.array().cast(_STEP).alias("path"), F.col("h").alias("root"))
    subroots = _down(spark, manifest.upper_levels, top, ["of"])
    starts = land(
        subroots.select(F.col("of").alias("group"), "path", F.col("h").alias("subroot"), "root")
    )
    found = _down(spark, manifest.levels, starts, ["doc_id", "claim"])
    return found.select("doc_id", "h", "claim", "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, from the leaf's to the root's, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: digest(F.concat(s["before"], h, s["after"])))


def tampered_text(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text, lower-cased (A-Z) in rows whose id's unsigned CRC-32 is divisible by 3."""
    hit = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 0
    plain = F.col(text).cast("string")
    return F.when(hit, ascii_lower(plain)).otherwise(plain)


def audit(docs: DataFrame, claimed: Column, folder: str | None = None) -> DataFrame:
    """Builds the manifest of ``docs``, then tries each row's proof on the row with the text
    ``claimed``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Null ids are leaves like others (before all ids); null fields and texts of any length
    are hashed as they are; columns beside ``FIELDS`` are ignored; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    manifest = build_manifest(leaves(docs, claimed), folder or new_folder(spark, "manifest"))
    found = proofs(spark, manifest)
    back = folded(F.col("claim"), F.col("path"))
    return found.select(
        "doc_id",
        F.col("h").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        back.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
