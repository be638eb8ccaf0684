import json

import pytest

from mixwright.operators.ordering import with_ordinal
from mixwright.session import land
from mixwright.sources import files
from mixwright.sources.files import (
    FILE_KEYS,
    check_same_type,
    scan_corpus,
    scan_json,
    scan_sft,
    scan_text,
)
from mixwright.sources.tables import corpus_from_table


@pytest.fixture
def tree(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "a.txt").write_bytes(b"one\n\nthree\r\n")
    (tmp_path / "sub" / "b.txt").write_bytes("été\nno end".encode())
    (tmp_path / "_hidden" / "c.txt").write_bytes(b"unseen\n")
    (tmp_path / "notes.md").write_text("not a corpus file")
    return tmp_path


def test_text_lines_in_order(spark, tree):
    rows = with_ordinal(land(scan_text(spark, str(tree))), FILE_KEYS).orderBy("ord").collect()
    assert [r.text for r in rows] == ["one\n", "\n", "three\r\n", "été\n", "no end\n"]
    plain = scan_text(spark, str(tree), keep_linebreaks=False).collect()
    assert sorted(r.text for r in plain) == sorted(["one", "", "three\r", "été", "no end"])


def test_file_order_over_many_partitions(spark, tmp_path):
    for name in "abc":
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        landed = land(scan_text(spark, str(tmp_path), keep_linebreaks=False))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = with_ordinal(landed, FILE_KEYS).orderBy("ord").collect()
    assert [r.text for r in rows] == [f"{n}{i}" for n in "abc" for i in range(4000)]


def test_json_arrays_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(" \n" + json.dumps([{"text": "x"}, {"text": "y"}], indent=1))
    (tmp_path / "b.json").write_text('{"text": "z", "other": 1}\n{"text": "u"}\n')
    assert sorted(r.text for r in scan_json(spark, str(tmp_path)).collect()) == ["u", "x", "y", "z"]
    only = scan_json(spark, str(tmp_path / "b.json"), form="lines").collect()
    assert [r.text for r in only] == ["z", "u"]
    (tmp_path / "c.json").write_text('{"text": "broken\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_json(spark, str(tmp_path)).collect()


def test_type_guard_and_dispatch(spark, tree, tmp_path):
    assert check_same_type(spark, [str(tree)]) == "txt"
    lines = tmp_path / "jl"
    lines.mkdir()
    (lines / "a.jsonl").write_text('{"text": "q"}\n')
    assert [r.text for r in scan_corpus(spark, str(lines)).collect()] == ["q"]
    (lines / "b.json").write_text('{"text": "r"}\n')
    with pytest.raises(ValueError, match="json.*jsonl"):
        scan_corpus(spark, str(lines))
    with pytest.raises(ValueError, match="one type"):
        check_same_type(spark, [str(tree / "sub"), str(tmp_path / "jl")])


def test_absent_folders(spark, tree, tmp_path):
    assert scan_corpus(spark, None, str(tmp_path / "nowhere")) is None
    both = scan_corpus(spark, str(tree / "sub"), str(tree / "sub"))
    assert {(r.split, r.text) for r in both.collect()} == {
        (s, t) for s in ("train", "validation") for t in ("été\n", "no end\n")
    }
    only = scan_corpus(spark, str(tmp_path / "nowhere"), str(tree / "sub"))
    assert {r.split for r in only.collect()} == {"validation"}
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        scan_corpus(spark, str(empty))


def test_json_without_text(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "q"}\n{"body": "r"}\n')
    with pytest.raises(Exception, match="NULL in column text"):
        scan_corpus(spark, str(tmp_path)).collect()
    assert scan_corpus(spark, str(tmp_path), on_null="drop").count() == 1


def test_told_form(spark, tmp_path, monkeypatch):
    rows = [{"text": "q"}, {"text": "r"}]
    pairs = [{"instruction": "a", "output": "b"}]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "p.json").write_text(json.dumps(pairs, indent=1))
    monkeypatch.setattr(files, "scan_json_objects", None)  # nobody looks into the files
    assert {r.text for r in scan_corpus(spark, str(tmp_path / "c"), form="lines").collect()} == {"q", "r"}
    assert scan_sft(spark, str(tmp_path / "p.json"), form="array").first().output == "b"


def test_sft_sources(spark, tmp_path):
    rows = [{"instruction": "a", "output": "b", "extra": 1}, {"instruction": "c", "output": "d"}]
    (tmp_path / "t.jsonl").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "v.txt").write_text(json.dumps(rows[:1]))
    got = scan_sft(spark, str(tmp_path / "t.jsonl"), str(tmp_path / "v.txt"))
    assert sorted((r.split, r.instruction, r.output) for r in got.collect()) == [
        ("train", "a", "b"), ("train", "c", "d"), ("validation", "a", "b")
    ]
    table = spark.createDataFrame([(1, "i", "o")], "k int, instruction string, output string")
    table.write.parquet(str(tmp_path / "p"))
    assert scan_sft(spark, str(tmp_path / "p")).first().k == 1
    table.createOrReplaceTempView("pair_view")
    assert scan_sft(spark, "pair_view").first().instruction == "i"
    for missing in ("/none/x.jsonl", "/none/dir"):
        with pytest.raises(FileNotFoundError):
            scan_sft(spark, missing)


def test_corpus_from_table(spark):
    df = spark.createDataFrame([(5, "x", 1)], "id bigint, body string, other int")
    assert corpus_from_table(df, "id", "body").first().asDict() == {"row_id": 5, "text": "x"}
