"""Transaction stream operators: F1, F4, E1, J1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.functions.columns import discount_multiplier, money

RECORD_COLS = ["transaction_id", "user_id", "product", "category", "amount",
               "quantity", "payment_method", "timestamp", "location"]


def high_value(df: DataFrame, threshold: float = 100.0) -> DataFrame:
    """amount > threshold (NaN is never high value)."""
    a = F.col("amount")
    return df.filter((a > F.lit(threshold)) & ~F.isnan(a))


def very_high_value(df: DataFrame, threshold: float = 500.0) -> DataFrame:
    return high_value(df, threshold)


def enrich(df: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Category discount: original_amount, discount_applied, final_amount.

    Money is computed in DECIMAL(12,2) and rounded half-up to cents, then
    returned as DOUBLE.  ``processing_timestamp`` is ``current_timestamp()``
    unless ``as_of`` is given.
    """
    mult = discount_multiplier("category")
    final = F.round(money("amount") * mult, 2)
    ts = (F.current_timestamp() if as_of is None
          else (F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of))
    return (df.withColumn("original_amount", F.col("amount"))
              .withColumn("discount_applied", mult.cast("double"))
              .withColumn("final_amount", final.cast("double"))
              .withColumn("processing_timestamp", ts))


def to_json_value(df: DataFrame, columns: list[str] | None = None,
                  key: str | None = None) -> DataFrame:
    """``key, value`` where value is the JSON object of ``columns``.

    Nulls are written as JSON null, as a dict dump would; a NULL record
    becomes ``{}``.
    """
    cols = columns or [c for c in df.columns if not c.startswith("_")]
    value = F.coalesce(F.to_json(F.struct(*[F.col(c) for c in cols]),
                                 {"ignoreNullFields": "false"}), F.lit("{}"))
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(k.alias("key"), value.alias("value"))
