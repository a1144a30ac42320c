"""Best-fit packing planned on the histogram of lengths.

1. Documents become token pieces of at most ``capacity`` ids (one pass over the texts,
   written to the shared folder without the ids).
2. The counts per length, at most ``capacity`` rows, go to the driver, which runs
   best-fit decreasing over *counts*: all sequences with the same fill are one entry.
   Work and plan depend on ``capacity`` alone, not on the number of documents.
3. A plan row says: ranks ``first .. first+n-1`` of this length take place ``offset`` in
   sequences ``sequence .. sequence+n-1``.  Pieces find their row by their rank.

The rank of a piece within its length is its place within a (length, slice) plus the
count of the earlier slices, so a length that a third of all pieces share is spread too.

Null and empty texts are one end id.  Repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipcatalog.llm.common import record_batch, settled, slices
from clipcatalog.llm.tokens import END, VOCABULARY, cut, encoder

CAPACITY = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY, end: int = END, with_ids: bool = False,
) -> DataFrame:
    """One row per piece; ``with_ids`` adds the ids as little-endian 32-bit binary."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids
    schema = pa.schema(fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).document
        for batch in slices(batches, "text"):
            out: dict[str, list] = {name: [] for name, _ in fields}
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(body, end)
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start : start + length].tobytes()
                    for name, value in zip(out, (key, k, start, length, zlib.crc32(own), own)):
                        out[name].append(value)
            yield record_batch(schema, **out)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES + ", ids binary" * with_ids)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows ``length, first rank, n, first sequence, offset``.

    ``open_[r]`` lists runs (first sequence, n) of sequences with r places left.
    """
    open_: dict[int, list[tuple[int, int]]] = {}
    rows, sequences = [], 0
    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = min((r for r, runs in open_.items() if r >= length and runs), default=capacity)
            first, n = open_[room].pop() if open_.get(room) else (sequences, left)
            fits = min(room // length, left)  # a sequence takes as many of this length as it holds
            take = min(n, max(1, left // fits))
            for k in range(fits):
                rows.append((length, rank + k * take, take, first, capacity - room + k * length))
            if first == sequences:
                sequences += take
            elif take < n:
                open_[room].append((first + take, n - take))
            open_.setdefault(room - fits * length, []).append((first, take))
            rank, left = rank + fits * take, left - fits * take
    return rows


def ranked(pieces: DataFrame, rows_per_slice: int = 20_000, least_slices: int = 32) -> DataFrame:
    """Add ``rank``: the place from 0 among all pieces of the same length."""
    n = max(least_slices, pieces.count() // rows_per_slice)
    cut_ = pieces.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n)))
    counts = cut_.groupBy("length", "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_slice").orderBy("doc_id", "piece", "ids_crc32")
    return (
        cut_.withColumn("_own", F.row_number().over(own) - 1).join(shifts, ["length", "_slice"])
        .withColumn("rank", F.col("_before") + F.col("_own")).drop("_slice", "_before", "_own")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece of ``token_pieces`` a ``sequence_id`` and an ``offset``.

    ``pieces`` must be settled: it is read once for the histogram and once for the ranks.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    by_length: dict[int, np.ndarray] = {}
    for row in plan(counts, capacity):
        by_length.setdefault(row[0], []).append(row[1:])
    by_length = {k: np.array(sorted(v), dtype=np.int64) for k, v in by_length.items()}
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset", "rank")]

    def place(frames: Iterable) -> Iterator:
        for frame in frames:
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            ranks, lengths = frame["rank"].to_numpy(), frame["length"].to_numpy()
            for length in np.unique(lengths):
                at, slots = np.flatnonzero(lengths == length), by_length[int(length)]
                slot = slots[np.searchsorted(slots[:, 0], ranks[at], side="right") - 1]
                sequence[at], offset[at] = slot[:, 2] + ranks[at] - slot[:, 0], slot[:, 3]
            yield frame[columns].assign(sequence_id=sequence, offset=offset)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in columns)
    return ranked(pieces).mapInPandas(place, kinds + ", sequence_id long, offset long")


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, **options) -> DataFrame:
    return pack(settled(token_pieces(docs, capacity=capacity, **options), "pieces"), capacity)
