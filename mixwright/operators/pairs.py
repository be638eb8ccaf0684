"""Question/answer pairs from a table of conversation turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mixwright.operators.ordering import MIN_BUCKET_ROWS, lay_out
from mixwright.schema import BUCKET


def pairs_from_turns(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    asks: str = "user",
    answers: str = "assistant",
    min_rows: int = MIN_BUCKET_ROWS,
) -> DataFrame:
    """Each ``asks`` turn directly followed by an ``answers`` turn of its conversation.

    Turns are range-bucketed by (conversation, turn), so one very long conversation is
    spread over many buckets. The row that starts a bucket is also shown to the bucket
    before it, which is all that looking one row ahead needs. Buckets of small tables have
    at least ``min_rows`` rows.
    """
    keys = [conversation, turn]
    layout = lay_out(df, keys, min_rows=min_rows)
    own = layout.bucket()
    rows = df.select(*keys, role, text).withColumn("_own", own)
    if layout.buckets > 1:
        bounds = layout.bounds_literal()
        starts_bucket = F.get(bounds, F.col("_own") - 1) == layout.key
        both = F.array(F.col("_own"), F.col("_own") - 1)
        seen_by = F.when(starts_bucket, both).otherwise(F.array(F.col("_own")))
        rows = rows.withColumn(BUCKET, F.explode(seen_by))
    else:
        rows = rows.withColumn(BUCKET, F.col("_own"))
    moved = rows.repartitionById(layout.buckets, F.col(BUCKET))
    ahead = Window.partitionBy(BUCKET, conversation).orderBy(turn)
    following = moved.withColumns(
        {
            "_role": F.lead(role).over(ahead),
            "_text": F.lead(text).over(ahead),
            "_turn": F.lead(turn).over(ahead),
        }
    )
    message = F.lit(f"({conversation}, {turn}) must be unique")
    unique = F.when(F.col("_turn") == F.col(turn), F.raise_error(message)).otherwise(F.lit(True))
    is_pair = (F.col(role) == asks) & (F.col("_role") == answers) & (F.col("_own") == F.col(BUCKET))
    return following.filter(unique & is_pair).select(
        *keys, F.col(text).alias("instruction"), F.col("_text").alias("output")
    )
