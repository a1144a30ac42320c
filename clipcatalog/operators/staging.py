"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """``df`` with extra columns that later filters cannot make Spark repeat.

    A filter is pushed through a projection by copying the projected expressions
    into it; for text cleaning that runs the work twice and can outgrow the code
    generator.  A generator with exactly one row per input row stops the copy and
    moves no data.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in columns]
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    out = df.select(*kept, F.explode(F.array(packed)).alias("_computed"))
    return out.select(*kept, *[F.col(f"_computed.{n}").alias(n) for n in columns])
