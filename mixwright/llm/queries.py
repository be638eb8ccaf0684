"""One query for each operator, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixwright.llm import (
    decontamination,
    line_dedup,
    merkle,
    mixing,
    periodic,
    perplexity,
    quality,
    secret_scan,
    sharding,
    simhash,
    topk,
    toxicity,
    warc,
)
from mixwright.llm.common import read_table
from mixwright.session import new_folder

SHARDS = 8


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("row")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages"), folder)
    found = warc.records(warc.read_archives(spark, folder))
    return found.select(
        "page_id",
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))
    counts = [secret_scan.count_kind(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select(
        "doc_id",
        *counts,
        secret_scan.span_digest(F.col("base")).alias("base_sha256"),
        secret_scan.span_list(F.col("spans")).alias("spans"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(read_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents")).drop("row")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard_documents(read_table(spark, sf_dir, "documents"), leaves=SHARDS)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, topk.queries_of(vectors))


def op11_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.apply_rules(read_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = periodic.planted_repeats(read_table(spark, sf_dir, "documents"))
    found = periodic.periodic_runs(documents).withColumn("best", periodic.longest_run(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(periodic.run_lines(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read_table(spark, sf_dir, "documents"), merkle.tampered_text())


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_decontamination,
    op2_line_dedup,
    op3_warc,
    op4_secret_scan,
    op5_quality,
    op6_mixing,
    op7_simhash,
    op8_sharding,
    op9_toxicity,
    op10_topk,
    op11_perplexity_rules,
    op12_periodic_runs,
    op13_merkle_manifest,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


_KEY_SQL = """translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

_LINES_SQL = f"""WITH parts AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
    keyed AS (SELECT doc_id, pos, line, {_KEY_SQL} AS k FROM parts),
    firsts AS (SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10
        GROUP BY k HAVING count(DISTINCT doc_id) > 1),
    marked AS (SELECT doc_id, pos, line, first_doc IS NOT NULL AND first_doc <> doc_id AS gone
        FROM keyed LEFT JOIN firsts USING (k))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id"""

_WARC_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS payload_digest FROM p),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to FROM m"""

_MIX_SQL = """WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
            CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash FROM documents),
    totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    dealt AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM totals),
    placed AS (SELECT *, row_number() OVER (ORDER BY source_size * (6 // w), source NULLS LAST) AS place,
        sum(source_size) OVER () AS total FROM dealt),
    summed AS (SELECT *, total * 150 - 200 * coalesce(sum(source_size) OVER (ORDER BY place
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
        sum(w) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_w FROM placed),
    level AS (SELECT place AS l_place, room AS l_room, rest_w AS l_w FROM summed
        WHERE room * w <= source_size * 200 * rest_w ORDER BY place LIMIT 1),
    targets AS (SELECT source, source_size, CASE WHEN place >= l_place
            THEN CAST(w * l_room AS DOUBLE) / CAST(100 * l_w AS DOUBLE)
            ELSE CAST(2 * source_size AS DOUBLE) END AS target
        FROM summed LEFT JOIN level ON true),
    budgets AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies
        FROM targets),
    cum AS (SELECT s.*, b.source_size, b.target, b.copies, b.target - b.copies * b.source_size AS budget,
            sum(size) OVER (PARTITION BY s.source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached,
            sum(size) OVER (PARTITION BY s.source, hash) AS own
        FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source),
    cut AS (SELECT *, reached - own AS below FROM cum)
    SELECT doc_id, size, source_size, target, CAST(size * (copies + CASE
            WHEN reached < budget THEN 1
            WHEN below < budget AND reached - budget < budget - below THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM cut"""

_TOPK_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
        FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


# CRC-32 (polynomial 0xEDB88320, reflected) of the decimal digits of doc_id.
_CRC_SQL = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT))),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _tree_sql(name: str, start: str) -> str:
    """Recursive CTE ``name(grp, level, pos, n, h)``: all nodes above the leaves ``start``."""
    return f"""{name} AS (
        SELECT grp, 0 AS level, pos, n, h FROM {start}
        UNION ALL
        SELECT grp, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM {name}
        WHERE n > 1 GROUP BY grp, level, pos // 8, n)"""


def _steps_sql(nodes: str, tree: str) -> str:
    """(grp, pos, level, before, after) of each leaf of ``nodes`` on each level of its tree."""
    return f"""SELECT a.grp, a.pos, t.level,
            coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (WHERE t.pos < a.pos // CAST(pow(8, t.level) AS BIGINT)), '') AS before,
            coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (WHERE t.pos > a.pos // CAST(pow(8, t.level) AS BIGINT)), '') AS after
        FROM {nodes} a JOIN {tree} t ON a.grp = t.grp AND t.n > 1
            AND t.pos // 8 = a.pos // CAST(pow(8, t.level + 1) AS BIGINT)
        GROUP BY a.grp, a.pos, t.level"""


_LEAF_SQL = "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"
_LOWER_SQL = f"""CASE WHEN {_CRC_SQL} % 3 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"""

_MERKLE_SQL = f"""WITH RECURSIVE hashed AS (SELECT doc_id, lang, {_field_sql("lang")} AS grp,
        {_LEAF_SQL.format(_field_sql("text"))} AS h, {_LEAF_SQL.format(_field_sql(f"({_LOWER_SQL})"))} AS claim
        FROM documents),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
        count(*) OVER (PARTITION BY grp) AS n FROM hashed),
    {_tree_sql("tree", "leaves")},
    subroots AS (SELECT '' AS grp, grp AS of, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
        FROM (SELECT grp, any_value(h) AS h FROM tree WHERE n = 1 GROUP BY grp) JOIN
            (SELECT DISTINCT grp, lang FROM hashed) USING (grp)),
    {_tree_sql("upper", "subroots")},
    low_steps AS ({_steps_sql("leaves", "tree")}),
    high_steps AS ({_steps_sql("subroots", "upper")}),
    steps AS (SELECT grp, pos, level, before, after FROM low_steps UNION ALL
        SELECT l.grp, l.pos, 1000 + s.level, s.before, s.after FROM leaves l JOIN subroots r ON l.grp = r.of
            JOIN high_steps s ON s.pos = r.pos),
    paths AS (SELECT grp, pos, sha256(string_agg(before || after, '' ORDER BY level)) AS proof,
        list(before ORDER BY level) AS befores, list(after ORDER BY level) AS afters FROM steps GROUP BY grp, pos),
    fold AS (SELECT l.grp, l.pos, 0 AS i, claim AS h, befores, afters FROM leaves l LEFT JOIN paths p ON l.grp = p.grp AND l.pos = p.pos
        UNION ALL SELECT grp, pos, i + 1, sha256(befores[i + 1] || h || afters[i + 1]), befores, afters
        FROM fold WHERE i < coalesce(len(befores), 0)),
    done AS (SELECT grp, pos, h FROM fold WHERE i = coalesce(len(befores), 0))
    SELECT doc_id, l.h AS leaf, r.h AS subroot, t.h AS root, coalesce(proof, sha256('')) AS proof_sha256,
        d.h AS folded_root, d.h = t.h AS verified
    FROM leaves l JOIN subroots r ON l.grp = r.of JOIN done d ON d.grp = l.grp AND d.pos = l.pos
        JOIN upper t ON t.n = 1 LEFT JOIN paths p ON p.grp = l.grp AND p.pos = l.pos"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": _LINES_SQL,
        "op3_warc": _WARC_SQL,
        "op6_mixing": _MIX_SQL,
        "op10_topk": _TOPK_SQL,
        "op13_merkle_manifest": _MERKLE_SQL,
    }
