"""JSON objects found in files that are cut anywhere."""

import json
import random

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from mixwright.operators.ordering import with_ordinal
from mixwright.session import land
from mixwright.sources import json_objects
from mixwright.sources.files import FILE_KEYS, scan_json
from mixwright.sources.json_objects import scan_json_objects

SCHEMA = StructType([StructField("text", StringType()), StructField("k", StringType())])


@pytest.fixture
def tiny_ranges(spark):
    """Byte ranges so small that objects lie over several of them."""
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.set(f"spark.sql.files.{name}", "400")
    yield
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


def odd_rows(rng, n):
    bits = ['"', "\\", "}", "{", "]", "[", ",", "\n", "a", "é", "\U0001f600", "\\\\", '\\"', "}}", " "]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 5, 60, 150])))
        row = {"text": text, "k": str(i), "other": {"deep": [{"er": text}, {}]}}
        rows.append(dict(rng.sample(sorted(row.items(), key=str), len(row))))
    return rows


def write(path, rows, form, ascii_only):
    dump = lambda r, **k: json.dumps(r, ensure_ascii=ascii_only, **k)
    text = {
        "lines": "\n".join(map(dump, rows)),
        "lines with an end": "".join(dump(r) + "\n" for r in rows),
        "array": dump(rows),
        "indented array": " \n" + dump(rows, indent=2) + "\n",
        "indented objects": "\n".join(dump(r, indent=1) for r in rows),
        "marked array": "﻿" + dump(rows),
    }[form]
    path.write_text(text, encoding="utf-8")


def read(df):
    found = [(r.k, r.text) for r in with_ordinal(land(df), FILE_KEYS).orderBy("ord").collect()]
    return found


@pytest.mark.parametrize("limit", [0, 200_000])
def test_all_forms_give_the_same_rows(spark, tmp_path, tiny_ranges, monkeypatch, limit):
    monkeypatch.setattr(json_objects, "BROADCAST_RANGES", limit)
    rng = random.Random(limit)
    want = []
    forms = ["lines", "lines with an end", "array", "indented array", "indented objects", "marked array"]
    for i, form in enumerate(forms):
        rows = odd_rows(rng, 6)
        write(tmp_path / f"{i}.json", rows, form, i % 2)
        want += [(r["k"], r["text"]) for r in rows]
    (tmp_path / "8.json").write_text("[]")
    (tmp_path / "9.json").write_text("")
    df = scan_json_objects(spark, str(tmp_path), SCHEMA, "*.json")
    assert read(df) == want


def test_one_array_is_many_tasks(spark, tmp_path, tiny_ranges):
    rows = odd_rows(random.Random(3), 25)
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    write(tmp_path / "a" / "x.json", rows, "array", False)
    write(tmp_path / "b" / "x.json", rows, "lines", False)
    array, lines = (scan_json_objects(spark, str(tmp_path / d), SCHEMA, "*.json") for d in "ab")
    assert array.select("block_start").distinct().count() > 5
    assert read(array) == read(lines) == [(r["k"], r["text"]) for r in rows]


def test_every_cut(spark, tmp_path):
    """The same file with byte ranges of a few bytes."""
    rows = [{"text": 'a"}{\\', "k": "0"}, {"text": "\\\\\"}", "k": "1"}, {"text": "", "k": "{"}]
    write(tmp_path / "x.json", rows, "array", False)
    try:
        for size in (16,):
            for name in ("maxPartitionBytes", "openCostInBytes"):
                spark.conf.set(f"spark.sql.files.{name}", str(size))
            assert read(scan_json_objects(spark, str(tmp_path), SCHEMA)) == [(r["k"], r["text"]) for r in rows]
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")


@pytest.mark.parametrize(
    "content",
    ['{"text": "broken', '{"text": "a", "k": "b"', '[{"text": "a"}, 5]', '"text"', '{"text": "a"} x', '{"text": a}', '[{"text": "a"}'
     + ', {"k": {"x": 1}', "}"],
)
def test_malformed_files(spark, tmp_path, content):
    (tmp_path / "x.json").write_text(content)
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_json_objects(spark, str(tmp_path), SCHEMA).collect()


def test_mixed_folder(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"text": "x"}]')
    (tmp_path / "b.json").write_text('{"text": "y"}\n{"text": "z"}')
    (tmp_path / "c.jsonl").write_text('{"text": "u"}\n')
    assert sorted(r.text for r in scan_json(spark, str(tmp_path)).collect()) == ["u", "x", "y", "z"]


def test_objects_are_sent_back_in_small_batches(spark):
    """A large Arrow batch of records is neither turned into Python values nor answered at once."""
    import pyarrow as pa

    records = [f'{{"k": {i}, "text": "{"x" * 9_000}"' for i in range(2_000)]
    n = len(records)
    told = {"path": ["p"] * n, "block": [0] * n, "line": list(range(n)), "value": records, "inside": [0] * n}
    told |= {"depth": [0] * n, "opener": pa.array([None] * n, pa.int64()), "open_end": [False] * n}
    sent = list(json_objects._objects(iter([pa.RecordBatch.from_pydict(told)])))
    assert [j for b in sent for j in b.column("json").to_pylist()] == [r + "}" for r in records]
    assert max(b.nbytes for b in sent) < 2 * json_objects.SENT_CHARS
