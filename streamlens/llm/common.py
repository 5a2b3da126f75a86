"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage
    with files every executor can see, so lost executors cost no recomputation
    and non-deterministic columns are fixed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def own_exchange(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with its (long or string) keys as expressions of equal value.

    An aggregate's result is partitioned by its keys already, so a join on them
    takes it as it is; but AQE splits a hot key of the other side only between
    two exchanges of the join's own.  The expression hides the partitioning:
    one more exchange of the small side buys a join that skew cannot stop.
    """
    same = {k: F.concat(k, F.lit("")) if df.schema[k].dataType.simpleString() == "string"
            else F.col(k).bitwiseXOR(F.lit(0).cast("long")) for k in keys}
    return df.withColumns(same)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns that clash with an operator's output columns
    (compared case-insensitively, as Spark resolves names)."""
    clash = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in clash])


def set_aside(df: DataFrame, *helpers: str) -> tuple[DataFrame, Callable[[str], str], Callable[[DataFrame], DataFrame]]:
    """Input columns named like an operator's helper columns get unused names.

    Returns the frame, the present name of an input column, and what gives a
    result its names back.  Without a clash nothing changes.
    """
    taken = {c.lower() for c in df.columns} | {h.lower() for h in helpers}
    names: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in {h.lower() for h in helpers}:
            n = 0
            while f"aside_{n}" in taken:
                n += 1
            names[c] = f"aside_{n}"
            taken.add(names[c])
    present = {c.lower(): n for c, n in names.items()}

    def back(out: DataFrame) -> DataFrame:
        if not names:
            return out
        old = {n: c for c, n in names.items()}
        return out.select(*[F.col(f"`{c}`").alias(old.get(c, c)) for c in out.columns])

    if names:
        df = df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])
    return df, lambda c: present.get(c.lower(), c), back
