"""Shared pieces: tables in the shared folder, linked groups, batches of texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipcatalog.sources.session import work_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(doc_id, by: int):
    """crc32 of the id as text, modulo ``by``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(by))


def settled(df: DataFrame, label: str) -> DataFrame:
    """Write a frame into the shared folder and read it back.

    Cuts the lineage and survives the loss of executors.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice have about ``limit`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.array([len(x) if x is not None else 0 for x in column.cast(pa.large_binary()).to_pylist()])
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)


def record_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal ``keys`` from sorted batches; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield last, pa.Table.from_batches(held)


def components(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Smallest node each linked node of ``links(a, b)`` can reach: ``node, component``.

    The smallest node of a group has no row of its own.

    Large-star and small-star rounds by turns: every round hangs the neighbours of a
    node on the smallest of them, so the number of rounds grows with the logarithm of the
    longest chain.  Each round is written to the shared folder; only a row count and a
    checksum reach the driver.  Minima are combined before each shuffle, and the joins
    are plain ones that adaptive execution can split, so a hub does not fill one task.
    """
    edges = settled(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).distinct()
        )
        edges = settled(small, "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"linked groups did not settle in {max_rounds} rounds")
    # settled: every node but the root hangs on the root
    return edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.col("m").alias("component"))
