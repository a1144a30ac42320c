"""Positions without a one-task sort.

A plain ``row_number()`` over a key sorts the whole key in one task, which a key
holding a third of the table cannot afford.  Here a row's position is the sum
of two parts: its rank inside a small slice of the key, and the number of rows
in the earlier slices.  A slice is a value prefix of the sort order, so it is
the same on every run and on every executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sort_key(c: Column, descending: bool) -> Column:
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def rank_in_slices(df: DataFrame, keys: list[str], slices: list[tuple[Column, bool]],
                   order: list[Column], name: str = "rank", maxima: dict[str, str] | None = None, total: str | None = None) -> DataFrame:
    """Position (1-based) of each row within its key.

    ``slices`` are ``(column, descending)`` pairs that lead the order: sorting by
    them and then by ``order`` is the wanted order.  The rows of one (key, slice)
    pair share a task; the counts per pair are a far smaller table.  ``maxima``
    (new name -> column) adds the greatest value of a column within the key, which
    comes from the same small table, as does ``total``, the number of rows of the key.

    The pair is one text column that is never NULL, so the ranking and the join
    to the counts use the same partitioning and the ranked rows are shuffled once; the
    input is evaluated twice, for the ranks and for the counts.
    """
    maxima = maxima or {}
    cut = [f"_slice{i}" for i in range(len(slices))]
    tagged = df.withColumns({n: c for n, (c, _) in zip(cut, slices)}).withColumn(
        "_pair", F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in [*keys, *cut]])
    )
    local = tagged.withColumn("_local", F.row_number().over(Window.partitionBy("_pair").orderBy(*order)))

    sizes = tagged.groupBy("_pair", *keys, *cut).agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(f"_m_{n}") for n, c in maxima.items()]
    )
    key = Window.partitionBy(*keys)
    earlier = key.orderBy(
        *[sort_key(F.col(n), d) for n, (_, d) in zip(cut, slices)], F.col("_pair")
    ).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_pair", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        *[F.max(f"_m_{n}").over(key).alias(n) for n in maxima],
        *([F.sum("_n").over(key).alias(total)] if total else []),
    )
    return (
        local.join(offsets, "_pair")
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_local", "_offset", "_pair", *cut)
    )


def assign_ids_and_defaults(new: DataFrame, max_id: int | Column, now: Column, stable_key: list[str],
                            id_column: str = "raw_id", defaults: dict[str, Column] | None = None,
                            time_column: str = "ingested_at", digits: int = 3) -> DataFrame:
    """Increasing ids for new rows, plus column defaults and the ingest time.

    Ids follow the MD5 order of the stable key, so a re-run gives the same ids.
    The first ``digits`` hex digits cut the rows into 16**digits slices; the only
    one-task step is a running sum over that many counts.
    """
    base = max_id if isinstance(max_id, Column) else F.lit(max_id)
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in stable_key]))
    hashed = new.drop(id_column).withColumn("_digest", digest).withColumn("_all", F.lit(0))
    ranked = rank_in_slices(
        hashed, ["_all"], [(F.substring("_digest", 1, digits), False)],
        [F.col("_digest"), *[F.col(k).asc_nulls_last() for k in stable_key]], "_position",
    )
    out = ranked.withColumn(id_column, (base + F.col("_position")).cast("bigint")).drop("_digest", "_all", "_position")
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), value) if name in out.columns else value)
    return out.withColumn(time_column, now)
