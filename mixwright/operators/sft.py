"""Loss-masked examples from instruction/output pairs."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.functions.tokens import codepoints
from mixwright.schema import (
    IGNORE_INDEX,
    REPAIR_END,
    REPAIR_START,
    SpecialIds,
    ones_like,
    require_values,
)

SLOT = "{instruction}"
DEFAULT_TEMPLATE = "Question: {instruction}\nAnswer: "


def prompt_text(instruction: Column, template: str = DEFAULT_TEMPLATE) -> Column:
    """Lower-cased instruction inside the template; the template keeps its case."""
    if template.count(SLOT) != 1:
        raise ValueError(f"a template holds {SLOT} exactly once")
    before, after = template.split(SLOT)
    return F.concat(F.lit(before), F.lower(instruction), F.lit(after))


def render_prompt(df: DataFrame, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    return df.withColumn("prompt", prompt_text(F.col("instruction"), template))


def mask_examples(
    df: DataFrame,
    prompt_ids: str,
    output_ids: str,
    max_len: int = 512,
    special: SpecialIds = SpecialIds(),
    on_masked: str = "repair",
) -> DataFrame:
    """Examples from token columns.

    Ids are prompt, output, eos; labels hide the prompt. Both are cut to ``max_len - 1``.
    A row whose labels are then all hidden gets positions 18..23 of its ids as labels
    (``on_masked="repair"``, reported in ``repaired``) or is left out (``"drop"``).
    """
    if max_len < 1:
        raise ValueError("max_len must be at least 1")
    if on_masked not in ("repair", "drop"):
        raise ValueError(f"on_masked must be 'repair' or 'drop', not {on_masked!r}")
    keep = max_len - 1
    prompt = F.col(prompt_ids)
    answer = F.concat(F.col(output_ids), F.array(F.lit(special.eos)))
    hidden = F.least(F.size(prompt), F.lit(keep))
    cut = df.withColumns(
        {
            "input_ids": F.slice(F.concat(prompt, answer), 1, keep),
            "_labels": F.concat(
                F.array_repeat(F.lit(IGNORE_INDEX), hidden),
                F.slice(answer, F.lit(1), F.lit(keep) - hidden),
            ),
        }
    )
    length = F.size("_labels")
    all_hidden = F.coalesce(F.array_max("_labels") <= IGNORE_INDEX, F.lit(True))
    if on_masked == "drop":
        cut = cut.filter(~all_hidden)
    mended = F.concat(
        F.slice("_labels", 1, REPAIR_START),
        F.slice("input_ids", REPAIR_START + 1, REPAIR_END - REPAIR_START),
        F.slice(F.col("_labels"), F.lit(REPAIR_END + 1), length),
    )
    repaired = all_hidden & (length > REPAIR_START)
    labels = F.when(repaired, mended).otherwise(F.col("_labels"))
    return cut.withColumns(
        {
            "attention_mask": ones_like(F.col("input_ids")),
            "labels": labels,
            "repaired": repaired,
        }
    ).drop("_labels")


def build_sft(
    df: DataFrame,
    max_len: int = 512,
    special: SpecialIds = SpecialIds(),
    template: str = DEFAULT_TEMPLATE,
    encode: Callable[[Column], Column] | None = None,
    on_null: str = "fail",
    on_masked: str = "repair",
) -> DataFrame:
    """Examples from ``instruction`` and ``output`` text; other columns are kept.

    ``encode`` turns a text column into token ids (code points by default). Works on streams as on tables: one
    projection per row.
    """
    encode = encode or partial(codepoints, special=special)
    checked = require_values(df, ["instruction", "output"], on_null)
    coded = checked.withColumns(
        {
            "_prompt": encode(prompt_text(F.col("instruction"), template)),
            "_output": encode(F.lower("output")),
        }
    )
    built = mask_examples(coded, "_prompt", "_output", max_len, special, on_masked)
    return built.drop("_prompt", "_output", "instruction", "output")
