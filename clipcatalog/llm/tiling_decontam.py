"""Benchmark decontamination by greedy string tiling.

A document is compared with a benchmark item when they share a run of ``width`` words
(a seed, found by its Karp-Rabin hash in one pass over the document).  Shared seeds on one
diagonal make maximal matches.  Tiling takes the longest match whose words are unmarked on
both sides, marks it, and goes on with what is left of the others, down to ``width`` words.
The share of item words under tiles is the coverage: it does not depend on the order of the
passages, and every document word serves once.  Items shorter than ``width`` words must
occur whole.

The benchmark is a stated query set.  It is taken in blocks of at most ``block_words`` words
(or one item), each a bounded broadcast; every block makes one pass over all documents
without a shuffle.  Null and empty texts and items share nothing.  Repeated documents and
items give repeated rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcatalog.llm.common import record_batch, slices
from clipcatalog.llm.minmax_dedup import word_hashes

WIDTH, COVERAGE = 5, 0.5
TILES = pa.list_(pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("words", pa.int32())]))
SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()), ("covered_words", pa.int64()),
                    ("coverage", pa.float64()), ("tiles", TILES)])
DDL = ("doc_id long, item_id long, item_words long, covered_words long, coverage double, "
       "tiles array<struct<item_start:int,doc_start:int,words:int>>")


def matches(item_at: np.ndarray, doc_at: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Maximal matches (words, item start, doc start) from equal seeds."""
    order = np.lexsort((item_at, doc_at - item_at))
    i, j = item_at[order], doc_at[order]
    new = np.concatenate([[True], (np.diff(j - i) != 0) | (np.diff(i) != 1)])
    first = np.flatnonzero(new)
    runs = np.diff([*first, len(i)])
    return [(int(n) + width - 1, int(i[f]), int(j[f])) for f, n in zip(first, runs)]


def tiling(found: list[tuple[int, int, int]], item_words: int, width: int) -> list[tuple[int, int, int]]:
    """Tiles (item start, doc start, words), longest first; ties by item, then by document position."""
    heap = [(-n, i, j) for n, i, j in found]
    heapq.heapify(heap)
    item_used, doc_used, tiles = np.zeros(item_words, bool), {}, []
    while heap:
        n, i, j = heapq.heappop(heap)
        free = [not item_used[i + k] and (j + k) not in doc_used for k in range(-n)]
        if all(free):
            item_used[i : i - n] = True
            doc_used.update(dict.fromkeys(range(j, j - n)))
            tiles.append((i, j, -n))
            continue
        at = 0  # what is still free goes back as shorter matches
        while at < -n:
            if not free[at]:
                at += 1
                continue
            end = at
            while end < -n and free[end]:
                end += 1
            if end - at >= width:
                heapq.heappush(heap, (at - end, i + at, j + at))
            at = end
    return tiles


class Items:
    """The seeds of a block of items, by width: 5 words, or the whole item when it is shorter."""

    def __init__(self, rows: list[tuple[int, str]], width: int):
        self.ids, self.words, self.widths = [k for k, _ in rows], [], []
        by_width: dict[int, list] = {}
        for n, (_, text) in enumerate(rows):
            count = len((text or "").encode("utf-8", "surrogatepass").split())
            own = min(width, count)
            self.words.append(count)
            self.widths.append(own)
            if count:
                seeds = word_hashes(text, own)
                by_width.setdefault(own, []).append((seeds, np.full(len(seeds), n), np.arange(len(seeds))))
        self.seeds = {}
        for own, parts in by_width.items():
            seed, item, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(seed, kind="stable")
            self.seeds[own] = (seed[order], item[order], at[order])

    def compare(self, text: str, coverage: float) -> Iterator[tuple[int, int, list]]:
        """(item number, covered words, tiles) of the items covered enough."""
        for width, (seed, item, at) in self.seeds.items():
            own = word_hashes(text, width, whole_if_short=False)
            lo, hi = np.searchsorted(seed, own, "left"), np.searchsorted(seed, own, "right")
            hit = np.flatnonzero(hi > lo)
            if not len(hit):
                continue
            n = (hi - lo)[hit]
            doc_at = np.repeat(hit, n)
            entry = np.repeat(lo[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            items, item_at = item[entry], at[entry]
            for k in np.unique(items):
                own_rows = items == k
                touched = np.unique(np.unique(item_at[own_rows])[:, None] + np.arange(width))
                if len(touched) < coverage * self.words[k]:
                    continue  # tiles cover no more than the seeds do
                tiles = tiling(matches(item_at[own_rows], doc_at[own_rows], width), self.words[k], width)
                covered = sum(t[2] for t in tiles)
                if covered >= coverage * self.words[k]:
                    yield k, covered, tiles


def blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[int, str]]]:
    held, size = [], 0
    for key, text in items.toLocalIterator():
        words = len((text or "").split())
        if held and size + words > block_words:
            yield held
            held, size = [], 0
        held.append((key, text))
        size += words
    yield held


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", width: int = WIDTH, coverage: float = COVERAGE,
                 block_words: int = 2_000_000) -> DataFrame:
    """One row per document and item of which at least ``coverage`` lies under tiles."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    wanted = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    context = docs.sparkSession.sparkContext

    def one(block: list[tuple[int, str]]) -> DataFrame:
        shared = context.broadcast(Items(block, width))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in slices(batches, "text"):
                out: dict[str, list] = {f.name: [] for f in SCHEMA}
                for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for k, covered, tiles in own.compare(body, coverage) if body else ():
                        found = [{"item_start": i, "doc_start": j, "words": n} for i, j, n in sorted(tiles)]
                        for name, value in zip(out, (key, own.ids[k], own.words[k], covered, covered / own.words[k], found)):
                            out[name].append(value)
                yield record_batch(SCHEMA, **out)

        return rows.mapInArrow(run, DDL)

    return reduce(DataFrame.union, map(one, blocks(wanted, block_words)))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "item_id", "item_words", "covered_words", "coverage",
                        F.size("tiles").cast("long").alias("n_tiles"))
