"""Topic views: first-n reads, counts, monitor lines, display formats
(S4, S5, A4, L1, E9-E11, X22)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PREVIEW_LIMIT = 100
METADATA_MEMBERS = ["mime_type", "fps", "frame_count", "duration", "width", "height",
                    "channels", "total_pixels", "error"]


def first_messages(messages: DataFrame, n: int = 10, per: str = "topic") -> DataFrame:
    """L1: the first ``n`` messages of each topic in (partition, offset) order.

    A per-topic rank with a filter ``<= n``: Spark plans it as a window group
    limit, so every task keeps only its own top ``n`` per topic before the
    shuffle and a hot topic never moves more than ``n`` rows per task.
    """
    w = Window.partitionBy(per).orderBy("partition", "offset")
    return (messages.withColumn("_rn", F.row_number().over(w))
                    .filter(F.col("_rn") <= n).drop("_rn"))


def monitor_lines(df: DataFrame, topic: str = "topic") -> DataFrame:
    """``<topic>: <transaction id or N/A> - $<amount>`` per message;
    the amount is the first of amount, final_amount, 0."""
    amount = F.coalesce(F.col("amount"), F.col("final_amount"), F.lit(0.0))
    tid = F.coalesce(F.col("transaction_id"), F.lit("N/A"))
    return df.select(F.col(topic).alias("topic"), tid.alias("transaction_id"),
                     amount.alias("amount"),
                     F.format_string("%s: %s - $%.2f", F.col(topic), tid, amount).alias("line"))


def metadata_preview(files: DataFrame, limit: int = PREVIEW_LIMIT) -> DataFrame:
    """One row per present metadata member except the text content;
    values longer than ``limit`` characters are cut and marked with '...'."""
    pairs = F.array(*[F.struct(F.lit(m).alias("member"),
                               F.col(f"metadata.{m}").cast("string").alias("value"))
                      for m in METADATA_MEMBERS])
    out = files.select("file_id", F.inline(pairs)).filter(F.col("value").isNotNull())
    v = F.col("value")
    return out.withColumn("value", F.when(F.char_length(v) > limit,
                                          F.concat(F.substring(v, 1, limit), F.lit("...")))
                          .otherwise(v))
