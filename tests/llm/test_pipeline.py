import pathlib
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from mixwright.llm import queries
from tests.llm.helpers import docs_frame, odd_docs
from tests.llm.test_dedup_decontamination import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in pathlib.Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_sql(spark, con, name):
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    picks = ", ".join(columns)
    want = con.execute(f"SELECT {picks} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("name", queries.queries())
def test_columns(spark, name):
    wanted = {
        "op1_decontamination": ["doc_id", "item_id"],
        "op2_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        "op3_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        "op4_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        "op5_quality": ["doc_id", "held_out", "score", "predicted"],
        "op6_mixing": ["doc_id", "size", "source_size", "target", "taken"],
        "op7_simhash": ["doc_id", "fingerprint", "component_id"],
        "op8_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op9_toxicity": ["doc_id", "held_out", "score", "predicted"],
        "op10_topk": ["query_id", "rank", "vec_id", "score"],
        "op11_perplexity_rules": [
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        ],
        "op12_periodic_runs": [
            "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
        ],
        "op13_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    }[name]
    df = queries.queries()[name](spark, SF)
    assert df.columns[: len(wanted)] == wanted
    if name not in ("op1_decontamination", "op3_warc", "op10_topk"):
        assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_stages(spark, con):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns, rows = docs.columns, docs.collect()
    texts = {r.doc_id: r.text for r in rows}
    bench = [t for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        ids = Counter(r.doc_id for r in out.select("doc_id").collect())
        before = Counter(r.doc_id for r in docs.select("doc_id").collect())
        if name != "sharding":
            assert out.columns == columns
        if name == "quality_classifier":
            bad = {d for (d,) in con.execute("SELECT doc_id FROM labels WHERE quality = 0").fetchall()}
            good = {d for (d,) in con.execute("SELECT doc_id FROM labels WHERE quality = 1").fetchall()}
            assert len(bad & set(ids)) <= 0.2 * len(bad) and len(good - set(ids)) <= 0.05 * len(good)
        elif name == "simhash_near_dedup":
            parts = plain_components({d: plain_fingerprint(texts[d]) for d in before})
            assert ids == Counter(set(parts.values()))
        elif name == "benchmark_decontamination":
            assert not any(b in texts[d] for d in ids for b in bench)
            gone = set(before) - set(ids)
            assert all(any(b.split(".")[0] in texts[d] or b[10:60] in texts[d] for b in bench) for d in gone)
        elif name == "mix_sources":
            assert set(ids) <= set(before) and max(ids.values()) <= 2
        else:
            assert ids == before and {r.shard for r in out.collect()} == set(range(8))
        docs = out


def test_stages_on_odd_rows(spark, tmp_path):
    rows = odd_docs(6)
    for frame in (docs_frame(spark, rows), docs_frame(spark, rows).limit(0)):
        docs = frame
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{frame.count()}-{i}")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot"]
