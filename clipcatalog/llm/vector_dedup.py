"""Near-duplicate vectors: spherical k-means cells, blocked cosines inside them.

Vectors are compared only under equal, non-null labels.  Equal vectors are one class with
a count.  Centroids per label are fitted on a bounded sample (``sample_rows`` over all
labels); every vector is assigned.  Cells overlap so that no link is lost: two unit vectors
of cosine ``c`` lie ``sqrt(2 - 2c)`` apart, so the cell of their midpoint is one from which
both are at most half of that behind their own best cell; each vector joins all such cells.
A link is counted in the smallest cell that both vectors are in.

Cells of any size are cut into blocks of about ``block`` vectors, and blocks are multiplied
two by two.  A pair of blocks returns link counts and a spanning forest, never pairs.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing;
so do rows with a null label.  Vectors of different dimension are never compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcatalog.llm.common import components, record_batch, settled

VALID = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("digest", pa.binary()),
                   ("vector", pa.binary())])


def usable(vectors: DataFrame) -> DataFrame:
    """Label, dimension, digest and doubles of the vectors that can have links; nulls for the others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in VALID}
            for key, label, values in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = None
                if label is not None and values and None not in values:
                    vector = np.array(values, np.float64)
                    norm = np.sqrt((vector**2).sum())
                    if np.isfinite(vector).all() and norm > 0:
                        own = vector + 0.0  # no negative zeros, so equal vectors have equal bytes
                row = (key, None, None, None, None) if own is None else (
                    key, label, len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest(), own.tobytes())
                for name, value in zip(out, row):
                    out[name].append(value)
            yield record_batch(VALID, **out)

    return vectors.mapInArrow(run, "vec_id long, label string, dim int, digest binary, vector binary")


def unit(column) -> np.ndarray:
    rows = np.stack([np.frombuffer(x, np.float64) for x in column])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(5)
    centres = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        for c in range(k):
            total = rows[own == c].sum(axis=0)
            size = np.sqrt(total @ total)
            if size > 1e-9:
                centres[c] = total / size
    return np.unique(centres, axis=0)


def fit_cells(classes: DataFrame, sample_rows: int, cell_rows: int, most_cells: int) -> dict[tuple[str, int], np.ndarray]:
    """Centroids for labels with more than ``cell_rows`` vectors, from ``sample_rows`` vectors at most."""
    total = classes.count()
    share = min(1.0, 0.9 * sample_rows / max(total, 1))
    chosen = classes.where(F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < int(share * (1 << 30)))
    frame = chosen.select("label", "dim", "vector").limit(sample_rows).toPandas()
    cells = {}
    for (label, dim), own in frame.groupby(["label", "dim"]):
        k = min(most_cells, int(len(own) / share / cell_rows), len(own) // 8)
        if k > 1:
            cells[label, dim] = spherical_kmeans(unit(own["vector"]), k)
    return cells


def assigned(classes: DataFrame, cells: dict, cosine: float) -> DataFrame:
    half = np.sqrt(2 - 2 * cosine) / 2 + 1e-9

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = pd.Series([[0]] * len(frame), index=frame.index, dtype=object)
            for key, own in frame.groupby(["label", "dim"]):
                if key not in cells:
                    continue
                centres = cells[key]
                apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
                near = unit(own["vector"]) @ centres.T
                best = near.argmax(axis=1)
                inside = near.max(axis=1, keepdims=True) - near <= half * apart[best] + 1e-9
                found[own.index] = [np.flatnonzero(x).tolist() for x in inside]
            yield frame.assign(cells=found)

    return classes.mapInPandas(run, "label string, dim int, digest binary, rep long, n long, vector binary, cells array<int>")


def block_links(key, frame: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Link counts and a spanning forest of one pair of blocks of one cell."""
    _, _, cell, lo, hi = key
    rows, own = unit(frame["vector"]), frame["own"].to_numpy()
    rep, n = frame["rep"].to_numpy(), frame["n"].to_numpy()
    first, second = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
    linked = rows[first] @ rows[second].T >= cosine
    if lo == hi:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return pd.DataFrame({"rep": [], "links": [], "a": []}).astype("int64")
    names = {c: i for i, c in enumerate(sorted({c for x in frame["cells"] for c in x if c < cell}))}
    counted = linked
    if names:  # links of pairs that share a smaller cell are counted there
        lower = np.zeros((len(frame), len(names)), np.float32)
        for i, x in enumerate(frame["cells"]):
            lower[i, [names[c] for c in x if c in names]] = 1
        counted = linked & (lower[first] @ lower[second].T < 0.5)
    links = np.zeros(len(frame), np.int64)
    links[first] += counted @ n[second]
    if lo != hi:
        links[second] += counted.T @ n[first]

    root = np.full(len(frame), -1)
    for i in first:
        if root[i] >= 0 or not linked[np.searchsorted(first, i)].any():
            continue
        reach, frontier = np.zeros(len(frame), bool), np.array([i])
        reach[i] = True
        while len(frontier):
            seen = np.zeros(len(frame), bool)
            if len(at := np.flatnonzero(np.isin(first, frontier))):
                seen[second[linked[at].any(axis=0)]] = True
            if len(at := np.flatnonzero(np.isin(second, frontier))):
                seen[first[linked[:, at].any(axis=1)]] = True
            frontier = np.flatnonzero(seen & ~reach)
            reach |= seen
        members = np.flatnonzero(reach)
        root[members] = members[rep[members].argmin()]
    at = np.flatnonzero(root >= 0)
    return pd.DataFrame({"rep": rep[at], "links": links[at], "a": rep[root[at]]})


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 cosine: float = 0.98, sample_rows: int = 20_000, cell_rows: int = 1000, most_cells: int = 1024,
                 block: int = 384) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                          F.col(embedding).cast("array<double>").alias("embedding"))
    made = settled(usable(rows), "vectors")
    classes = settled(
        made.where("digest is not null and vec_id is not null").groupBy("label", "dim", "digest")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vector").alias("vector")), "classes")
    cells = fit_cells(classes, sample_rows, cell_rows, most_cells)
    placed = settled(assigned(classes.select("label", "dim", "digest", "rep", "n", "vector"), cells, cosine), "cells")
    members = placed.withColumn("cell", F.explode("cells"))
    sizes = members.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = (
        members.join(sizes, ["label", "dim", "cell"])
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
        .select("label", "dim", "cell", "lo", "hi", "own", "rep", "n", "vector", "cells")
    )
    found = settled(
        dealt.groupBy("label", "dim", "cell", "lo", "hi")
        .applyInPandas(lambda key, frame: block_links(key, frame, cosine), "rep long, links long, a long"), "links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.where("rep <> a").select("a", F.col("rep").alias("b")))
    named = (
        classes.select("label", "dim", "digest", "rep", "n").join(counts, "rep", "left")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select("label", "dim", "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component"))
    )
    return (
        made.drop("vector").join(named, ["label", "dim", "digest"], "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("vec_id").isNull()))
    )
