"""Raw text and JSON files.

Rows keep their place: ``path``, ``block_start`` (where the file split begins) and
``line`` (rising within the scan). Ordering by :data:`FILE_KEYS` restores file order. Line
numbers depend on how the scan was cut into tasks, so store them once with
:func:`mixwright.session.land` before ordering or packing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mixwright.schema import SPLIT, require_values
from mixwright.sources.json_objects import scan_json_objects

FILE_KEYS = ["path", "block_start", "line"]
CORPUS_TYPES = ("txt", "json", "jsonl")
CORPUS_SCHEMA = StructType([StructField("text", StringType())])
PAIR_SCHEMA = StructType(
    [StructField("instruction", StringType()), StructField("output", StringType())]
)


def _with_place(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(
        *columns,
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line"),
    )


def scan_text(spark: SparkSession, folder: str, keep_linebreaks: bool = True) -> DataFrame:
    """One row per line of every ``*.txt`` below ``folder``.

    Lines end at ``\\n``. With ``keep_linebreaks`` the row ends with it too, also the last
    row of a file without one.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.txt")
        .option("lineSep", "\n")
        .text(folder)
    )
    text = F.concat("value", F.lit("\n")) if keep_linebreaks else F.col("value")
    return _with_place(lines.withColumn("text", text), ["text"])


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the corpus files below ``folder``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{" + ",".join(CORPUS_TYPES) + "}")
        .load(folder)
        .select("path")
    )


def _kinds(spark: SparkSession, folder: str) -> set[str]:
    """The extensions of the corpus files below ``folder``; a handful reaches the driver."""
    extension = F.element_at(F.split("path", r"\."), -1)
    return {r["kind"] for r in _listing(spark, folder).select(extension.alias("kind")).distinct().collect()}


def check_same_type(spark: SparkSession, folders: Sequence[str]) -> str:
    """The one extension of all corpus files below ``folders``, else an error."""
    kinds = set()
    for folder in folders:
        found = _kinds(spark, folder)
        if not found:
            raise FileNotFoundError(f"no {', '.join(CORPUS_TYPES)} files below {folder}")
        kinds |= found
    if len(kinds) > 1:
        raise ValueError(f"corpus files must have one type, but got {sorted(kinds)}")
    return kinds.pop()


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def is_folder(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()


def scan_json(
    spark: SparkSession,
    folder: str,
    schema: StructType = CORPUS_SCHEMA,
    form: str = "auto",
) -> DataFrame:
    """Rows of every ``*.json`` and ``*.jsonl`` below ``folder``.

    ``.jsonl`` files hold one object per line. A ``.json`` file may also be an array. With
    ``form="auto"`` tasks find the objects themselves, in arrays of any size side by side
    (see :mod:`mixwright.sources.json_objects`). ``"lines"`` and ``"array"`` say that all
    files are alike, and spare the second scan; an array file is then one task's work.
    """
    if form not in ("auto", "lines", "array"):
        raise ValueError(f"form must be 'auto', 'lines' or 'array', not {form!r}")
    if form != "auto":
        return _with_place(_json_reader(spark, schema, form == "array", "*.{json,jsonl}").json(folder), schema.fieldNames())
    kinds = _kinds(spark, folder) & {"json", "jsonl"}
    if not kinds:
        raise FileNotFoundError(f"no json or jsonl files below {folder}")
    parts = []
    if "jsonl" in kinds:
        parts.append(_with_place(_json_reader(spark, schema, False, "*.jsonl").json(folder), schema.fieldNames()))
    if "json" in kinds:
        parts.append(scan_json_objects(spark, folder, schema, "*.json"))
    return reduce(DataFrame.unionByName, parts)


def _json_reader(spark: SparkSession, schema: StructType, arrays: bool, glob: str | None = None):
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", arrays)
    if glob is None:
        return reader
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob)


def scan_corpus(
    spark: SparkSession,
    train: str | None,
    validation: str | None = None,
    keep_linebreaks: bool = True,
    on_null: str = "fail",
    form: str = "auto",
) -> DataFrame | None:
    """Corpus rows with a ``split``. Folders that are absent are skipped; ``None`` when both
    are. All files, of both splits, have one type, which decides how they are read. ``form``
    is that of :func:`scan_json`."""
    wanted = {"train": train, "validation": validation}
    folders = {name: f for name, f in wanted.items() if f is not None and _exists(spark, f)}
    if not folders:
        return None
    kind = check_same_type(spark, list(folders.values()))
    parts = []
    for name, folder in folders.items():
        if kind == "txt":
            rows = scan_text(spark, folder, keep_linebreaks)
        else:
            rows = require_values(scan_json(spark, folder, form=form), ["text"], on_null)
        parts.append(rows.withColumn(SPLIT, F.lit(name)))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def stored_by_scan(spark: SparkSession, folders: Sequence[str | None], form: str, on_null: str) -> bool:
    """Whether :func:`scan_corpus` has stored the rows of these folders, line numbers included,
    and leaves out none of them: storing them once more would only write them twice."""
    found = [f for f in folders if f is not None and _exists(spark, f)]
    return form == "auto" and on_null == "fail" and bool(found) and check_same_type(spark, found) == "json"


def _table(spark: SparkSession, source: str) -> DataFrame:
    """A Parquet path or a table name."""
    if "/" not in source:
        return spark.table(source)
    if not _exists(spark, source):
        raise FileNotFoundError(f"{source} does not exist")
    return spark.read.parquet(source)


def scan_corpus_table(
    spark: SparkSession,
    train: str | None,
    validation: str | None = None,
    columns: Sequence[str] = (),
    text: str = "text",
) -> DataFrame | None:
    """Corpus rows of Parquet paths or tables: ``columns`` (a key, a stored length), the text
    and a ``split``. ``None`` when neither is named."""
    named = {"train": train, "validation": validation}
    parts = [
        _table(spark, source).select(*columns, F.col(text).alias("text")).withColumn(SPLIT, F.lit(name))
        for name, source in named.items()
        if source is not None
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


def scan_sft(
    spark: SparkSession,
    train: str,
    validation: str | None = None,
    on_null: str = "fail",
    form: str = "auto",
) -> DataFrame:
    """Instruction pairs with a ``split``.

    ``train`` is a JSON file or folder (named ``.json`` or ``.jsonl``), or else a Parquet
    path or a table name, in which case the table's own columns are kept as keys.
    ``validation`` is always JSON. ``form`` is that of :func:`scan_json`.
    """
    sources = {"train": _pairs(spark, train, form)}
    if validation is not None:
        if not _exists(spark, validation):
            raise FileNotFoundError(f"{validation} does not exist")
        sources["validation"] = _json_pairs(spark, validation, form)
    parts = [
        require_values(part, PAIR_SCHEMA.fieldNames(), on_null).withColumn(SPLIT, F.lit(name))
        for name, part in sources.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _json_pairs(spark: SparkSession, path: str, form: str) -> DataFrame:
    if is_folder(spark, path):
        return scan_json(spark, path, PAIR_SCHEMA, form)
    if form == "auto" and not path.endswith(".jsonl"):
        return scan_json_objects(spark, path, PAIR_SCHEMA)
    reader = _json_reader(spark, PAIR_SCHEMA, form == "array")
    return _with_place(reader.json(path), PAIR_SCHEMA.fieldNames())


def _pairs(spark: SparkSession, source: str, form: str) -> DataFrame:
    if source.endswith((".json", ".jsonl")):
        if not _exists(spark, source):
            raise FileNotFoundError(f"{source} does not exist")
        return _json_pairs(spark, source, form)
    return _table(spark, source)
