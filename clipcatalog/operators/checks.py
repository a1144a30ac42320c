"""Data checks: each gives its violating rows; the report counts them all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog.functions.columns import as_col


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count (NULLs are ignored)."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
    )


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(~F.col(column).isin(values))


def score_in_range(df: DataFrame, column: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def conditional_minimum(df: DataFrame, condition: Column | None, column: str, minimum: float) -> DataFrame:
    """Rows under a condition whose value is below a minimum; NULL counts as 0."""
    low = F.coalesce(as_col(column), F.lit(0)) < minimum
    return df.filter(low if condition is None else condition & low)


def conditional_minimums(df: DataFrame, rules: list[tuple[str, Column | None, str, float]], name: str = "rule") -> DataFrame:
    """One row per row and broken rule, from one pass; rules as in ``conditional_minimum``."""
    broken = []
    for rule, condition, column, minimum in rules:
        low = F.coalesce(as_col(column), F.lit(0)) < minimum
        broken.append(F.when(low if condition is None else condition & low, F.lit(rule)))
    return df.withColumn(name, F.explode(F.array_compact(F.array(*broken))))


def check_report(row_checks: list[tuple[str, DataFrame, Column]],
                 unique_checks: list[tuple[str, DataFrame, str, Column | None]] = ()) -> DataFrame:
    """Name, violations and verdict of every check, in one pass per frame.

    ``row_checks`` are predicates of violating rows.  ``unique_checks`` name a column
    (one per frame) that must not repeat, among all rows or those of a condition; their
    frame is counted per value first, predicates included.
    """
    frames: dict[int, tuple[DataFrame, list, list]] = {}
    for name, df, predicate in row_checks:
        frames.setdefault(id(df), (df, [], []))[1].append((name, predicate))
    for name, df, column, among in unique_checks:
        frames.setdefault(id(df), (df, [], []))[2].append((name, column, among))
    parts = []
    for df, checks, keys in frames.values():
        counts = [F.count_if(p).alias(f"_c{i}") for i, (_, p) in enumerate(checks)]
        columns = {c for _, c, _ in keys}
        if len(columns) > 1:
            raise ValueError("one column per frame may be checked for repeats")
        if keys:
            column = columns.pop()
            per_value = df.groupBy(column).agg(*counts, *[
                (F.count(F.lit(1)) if among is None else F.count_if(among)).alias(f"_u{i}")
                for i, (_, _, among) in enumerate(keys)
            ])
            counted = per_value.agg(
                *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(checks))],
                *[F.count_if(F.col(column).isNotNull() & (F.col(f"_u{i}") > 1)).alias(f"_u{i}") for i in range(len(keys))],
            )
        else:
            counted = df.agg(*counts)
        named = [(n, f"_c{i}") for i, (n, _) in enumerate(checks)] + [(n, f"_u{i}") for i, (n, *_) in enumerate(keys)]
        rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(c).alias("violations")) for n, c in named])
        parts.append(counted.select(F.inline(rows)))
    report = reduce(lambda a, b: a.unionAll(b), parts)
    return report.withColumn("result", F.when(F.col("violations") == 0, "pass").otherwise("fail"))
