"""Packed token-id matrices by best-fit decreasing with a segment tree over capacities.

Every input partition is packed by itself, in blocks of at most ``block_tokens`` ids, so
memory is bounded and nothing is shuffled: token ids are the largest thing here and stay
where they are made.  A lost task packs its partition again with the same result.  A block
leaves about one unfilled sequence behind, i.e. ``capacity / block_tokens`` of the output.

Within a block the pieces are taken from long to short; a segment tree over the free
places ``0 .. capacity`` finds the smallest open sequence that still holds the piece.

Null and empty texts are one end id.  Over-long documents are cut into pieces that give
the document back when put together in order of ``starts``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcatalog.llm.common import record_batch, slices
from clipcatalog.llm.tokens import END, VOCABULARY, cut, encoder

CAPACITY = 1024
SCHEMA = pa.schema([
    ("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary()), ("positions", pa.binary()),
    ("cu_seqlens", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
])
DDL = ("sequence_id long, n_tokens int, ids binary, positions binary, cu_seqlens array<int>, "
       "doc_ids array<long>, starts array<long>")


class CapacityTree:
    """Segment tree over free places; a leaf counts the open sequences with that many left."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, free: int, by: int) -> None:
        node = free + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def at_least(self, need: int) -> int | None:
        """Smallest free number ``>= need`` of an open sequence."""
        node, count = need + self.size, self.count
        if count[node]:
            return need
        while node > 1:  # up to the first right neighbour that holds one, then down its left edge
            if not node & 1 and count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if count[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the numbers of the pieces of each sequence, in order of placing."""
    tree, open_, sequences = CapacityTree(capacity), {}, []
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        free = tree.at_least(lengths[k])
        if free is None:
            home, free = len(sequences), capacity
            sequences.append([])
        else:
            home = open_[free].pop()
            tree.add(free, -1)
        sequences[home].append(k)
        if left := free - lengths[k]:
            open_.setdefault(left, []).append(home)
            tree.add(left, 1)
    return sequences


def packed_sequences(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    block_tokens: int = 4_000_000, vocabulary: str = VOCABULARY, end: int = END, pad: int = 0,
) -> DataFrame:
    """One row per sequence: a matrix row of ``capacity`` ids, padded, and what it is made of.

    ``ids`` and ``positions`` are little-endian 32-bit binaries of ``capacity`` entries,
    ``cu_seqlens`` starts at 0 and ends at ``n_tokens``; ``positions`` start again at 0
    with every piece (padding counts on from 0).
    """

    def block_rows(pieces: list, base: int) -> pa.RecordBatch:
        out: dict[str, list] = {f.name: [] for f in SCHEMA}
        for k, members in enumerate(best_fit([len(p[2]) for p in pieces], capacity)):
            parts = [pieces[m] for m in members]
            bounds = np.cumsum([0] + [len(p[2]) for p in parts])
            row = np.full(capacity, pad, "<u4")
            row[: bounds[-1]] = np.concatenate([p[2] for p in parts])
            runs = np.diff([*bounds, capacity])
            places = np.arange(capacity, dtype="<u4") - np.repeat([*bounds], runs).astype("<u4")
            for name, value in zip(out, (base + k, bounds[-1], row.tobytes(), places.tobytes(), bounds,
                                         [p[0] for p in parts], [p[1] for p in parts])):
                out[name].append(value)
        return record_batch(SCHEMA, **out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, held, size, base = encoder(vocabulary).document, [], 0, TaskContext.get().partitionId() << 36
        for batch in slices(batches, "text"):
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(body, end)
                held += [(key, start, ids[start : start + n]) for start, n in cut(len(ids), capacity)]
                size += len(ids)
                if size >= block_tokens:
                    made = block_rows(held, base)
                    held, size, base = [], 0, base + made.num_rows
                    yield made
        if held:
            yield block_rows(held, base)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, DDL)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the matrix rows and their bounds as Parquet; ``ids`` of all rows put together is the matrix."""
    packed.write.parquet(path)


def digest(packed: DataFrame) -> DataFrame:
    """The sequences with checksums in place of the two binaries."""
    return packed.select(
        "sequence_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"),
        "cu_seqlens", "doc_ids", "starts",
    )
