"""Near-duplicate groups by min-max hashing of five-word shingles.

Each permutation of the shingle hashes gives two signature values, its minimum and its
maximum, so 60 permutations make 120 values.  Five minima (or five maxima) of different
permutations form a band: 24 bands.  A pair at the threshold of 0.85 shares none of them
with probability 8e-7.  A lower threshold needs more bands: at 0.80, 36 of them (180 values)
miss a pair with probability 6e-7.

1. One pass over the texts: set size, set digest, bands.  Documents with equal sets become
   one class, named by the smallest id; only class names go on.
2. Band buckets: every member is compared with the smallest class of its bucket.  A group
   of copies therefore costs one comparison per member, not one per pair.
3. Links found so far give groups.  Buckets that still hold members of several groups are
   compared in blocks of signatures; pairs of different groups whose estimate is not
   clearly below the threshold are checked as well.  Nothing is capped: a bucket of any
   size is cut into more blocks.  The estimate may lose a pair with probability 1e-6.
   Such pairs travel packed, and sets once per cell of pairs.
4. Every link is confirmed on the full shingle sets, which stream past the set of the
   class they are compared with; a hot class is spread over several tasks.

Words are runs of other bytes than blank and \\t-\\r, A-Z in lower case.  Fewer than
``width`` words are one shingle, no words none: such documents link with nothing.  Rows
with a null id stand for themselves; repeated rows of one id are one document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcatalog.llm.common import components, groups, record_batch, settled, slices

WIDTH, PERCENT, BANDS, ROWS = 5, 85, 24, 5
BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=4)
def _tables(permutations: int = BANDS * ROWS // 2) -> tuple[np.ndarray, ...]:
    rng = np.random.default_rng(20_240_501)
    codes = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    factor = rng.integers(0, 1 << 31, permutations, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 1 << 32, permutations, dtype=np.uint32)
    return codes, factor, shift


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers["up"]) < n:
        size = 1 << max(16, n.bit_length())
        inverse = pow(BASE, -1, 1 << 64)
        for name, base in (("up", BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(text: str | None, width: int = WIDTH, whole_if_short: bool = True) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` words, in order."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words or (len(words) < width and not whole_if_short):
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b" ".join(words), np.uint8)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_tables()[0][data] * up[:-1], out=sums[1:])
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
    k = min(width, len(words))
    first, last = starts[: len(starts) - k + 1], ends[k - 1 :]
    return mixed((sums[last] - sums[first]) * down[first])


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    return np.unique(word_hashes(text, width))


def signature(hashes: np.ndarray, n_bands: int = BANDS) -> np.ndarray:
    """Minima of all permutations, then their maxima."""
    _, factor, shift = _tables(n_bands * ROWS // 2)
    low, high = np.full(len(factor), 0xFFFFFFFF, np.uint32), np.zeros(len(factor), np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 4096):
        values = short[None, at : at + 4096] * factor[:, None] + shift[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.concatenate([low, high])


def bands(values: np.ndarray) -> np.ndarray:
    rows = values.reshape(-1, ROWS).astype(np.uint64)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        key = mixed(key ^ rows[:, k])
    return key.view(np.int64)


FEATURES = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                      ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])
FEATURES_DDL = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"


def shingled(docs: DataFrame, width: int = WIDTH, n_bands: int = BANDS) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: dict[str, list] = {f.name: [] for f in FEATURES}
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = shingle_set(body, width)
                values = signature(own, n_bands) if len(own) else None
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None
                for name, value in zip(out, (key, len(own), digest, None if values is None else bands(values),
                                             None if values is None else values.tobytes())):
                    out[name].append(value)
            yield record_batch(FEATURES, **out)

    return docs.mapInArrow(run, FEATURES_DDL)


def confirmed(docs: DataFrame, pairs: DataFrame, percent: int = PERCENT, width: int = WIDTH,
              per_task: int = 1000) -> DataFrame:
    """Those of ``pairs(a, b)`` with ``100 * intersection >= percent * union``, on full sets.

    The texts of the documents in ``pairs`` move once; their sets move once for each ``a``
    they are compared with, and stream past the set of ``a``.
    """
    sizes = pairs.groupBy("a").agg(F.count("*").alias("n"))
    spread = F.ceil(F.col("n") / per_task).cast("int")
    members = pairs.join(sizes, "a").select(
        F.col("b").alias("doc_id"), "a", F.pmod(F.xxhash64("b"), spread).cast("int").alias("part"), F.lit(1).alias("role")
    )
    heads = sizes.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(F.lit(0), spread - 1)).alias("part"),
                         F.lit(0).alias("role"))
    sets = pa.schema([("a", pa.int64()), ("part", pa.int32()), ("role", pa.int32()), ("b", pa.int64()), ("own", pa.binary())])

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, b""
        for batch in slices(batches, "text", 1_000_000):
            rows = batch.to_pydict()
            made = []
            for key, body in zip(rows["doc_id"], rows["text"]):
                if key != last:
                    last, own = key, shingle_set(body, width).tobytes()
                made.append(own)
            yield record_batch(sets, a=rows["a"], part=rows["part"], role=rows["role"], b=rows["doc_id"], own=made)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None
        for batch in batches:
            rows, a, b = batch.to_pydict(), [], []
            for key, role, other, body in zip(rows["a"], rows["role"], rows["b"], rows["own"]):
                values = np.frombuffer(body, np.uint64)
                if role == 0:
                    head, own = key, values
                    continue
                assert head == key
                if linked(own, values, percent):
                    a.append(key)
                    b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    targets = members.union(heads)
    return (
        docs.hint("merge").join(targets, "doc_id").select("doc_id", "a", "part", "role", "text").mapInArrow(build, "a long, part int, role int, b long, own binary")
        .repartition("a", "part").sortWithinPartitions("a", "part", "role").mapInArrow(compare, LINKS_DDL)
    )


CELLS = pa.schema([("bucket", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("role", pa.int32()),
                   ("doc_id", pa.int64()), ("body", pa.binary())])
CELLS_DDL = "bucket long, lo int, hi int, role int, doc_id long, body binary"
CELL = ["bucket", "lo", "hi"]


@lru_cache(maxsize=16)
def least_equal(percent: int, values: int, miss: float = 1e-6) -> int:
    """Equal values that a pair at ``percent`` has at least, but with probability ``miss``."""
    p, below = percent / 100, 0.0
    for equal in range(values + 1):
        below += math.comb(values, equal) * p**equal * (1 - p) ** (values - equal)
        if below > miss:
            return equal
    return values


def leftover_pairs(members: DataFrame, percent: int = PERCENT, block: int = 256) -> DataFrame:
    """Likely pairs of different groups in one bucket; ``members(bucket, rep, component, n_shingles, signature)``.

    A bucket of m members is cut into blocks and the blocks are compared two by two.  A pair
    is found in the first band it shares, once.  A pair of blocks gives one row with its pairs
    (role 1) and a row for each document in them (role 0), so rows grow with members, not pairs.
    """
    sizes = members.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks")).cast("int")
    dealt = (
        members.join(sizes, "bucket").withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other", "blocks")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, lo, hi), rows in groups(batches, CELL):
            values = np.stack([np.frombuffer(x, np.uint32) for x in rows["signature"].to_pylist()])
            rep, group, n, own = (rows[c].to_numpy() for c in ("rep", "component", "n_shingles", "own"))
            band = int(np.flatnonzero(bands(values[0]) == bucket)[0])
            first, second, found = np.flatnonzero(own == lo), np.flatnonzero(own == hi), []
            for i in first:
                at = second[(group[second] != group[i]) & (100 * np.minimum(n[second], n[i]) >= percent * np.maximum(n[second], n[i]))]
                if lo == hi:
                    at = at[rep[at] > rep[i]]
                same = values[at] == values[i]
                at = at[(same.sum(axis=1) >= least_equal(percent, values.shape[1])) & ~same[:, : band * ROWS].reshape(len(at), band, ROWS).all(axis=2).any(axis=1)]
                found += [(i, k) for k in at]
            if not found:
                continue
            pairs = rep[np.array(found)]
            docs = np.unique(pairs).tolist()
            size = len(docs) + 1
            yield record_batch(CELLS, bucket=[bucket] * size, lo=[lo] * size, hi=[hi] * size, role=[0] * (size - 1) + [1],
                               doc_id=[*docs, None], body=[None] * (size - 1) + [pairs.tobytes()])

    return dealt.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(run, CELLS_DDL)


def linked(own: np.ndarray, other: np.ndarray, percent: int) -> bool:
    most, least = max(len(own), len(other)), min(len(own), len(other))
    if 100 * least < percent * most:
        return False
    both = len(np.intersect1d(own, other, assume_unique=True))
    return 100 * both >= percent * (len(own) + len(other) - both)


LINKS_DDL = "a long, b long"


def confirmed_cells(docs: DataFrame, cells: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Links among the packed pairs of ``leftover_pairs``: a document's set moves once per cell, not per pair."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            rows = batch.to_pydict()
            last, own, made = None, b"", []
            for key, text in zip(rows["doc_id"], rows["text"]):
                if key != last:
                    last, own = key, shingle_set(text, width).tobytes()
                made.append(own)
            yield record_batch(CELLS, **{c: rows[c] for c in CELL}, role=[0] * len(made), doc_id=rows["doc_id"], body=made)

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, CELL):
            own, a, b = {}, [], []
            for role, key, body in zip(*(rows[c].to_pylist() for c in ("role", "doc_id", "body"))):
                if role == 0:
                    own[key] = np.frombuffer(body, np.uint64)
                    continue
                for x, y in np.frombuffer(body, np.int64).reshape(-1, 2).tolist():
                    if linked(own[x], own[y], percent):
                        a.append(min(x, y))
                        b.append(max(x, y))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    wanted = cells.where("role = 0").select("doc_id", *CELL)
    sets = docs.hint("merge").join(wanted, "doc_id").select("doc_id", *CELL, "text").mapInArrow(build, CELLS_DDL)
    return (
        sets.union(cells.where("role = 1")).repartition(*CELL).sortWithinPartitions(*CELL, "role")
        .mapInArrow(check, LINKS_DDL)
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT,
                    width: int = WIDTH, n_bands: int = BANDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row; an even number of bands."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    features = settled(shingled(rows, width, n_bands), "shingles")
    classes = settled(
        features.where("n_shingles > 0 and doc_id is not null").groupBy("digest")
        .agg(F.min_by(F.struct("doc_id", "n_shingles", "bands", "signature"), "doc_id").alias("s")).select("digest", "s.*"),
        "classes",
    ).withColumnRenamed("doc_id", "rep")
    members = classes.select("rep", F.explode("bands").alias("bucket"))
    # tables of keys, here and below: both sides of their joins are then plain shuffles, which adaptive
    # execution splits where one bucket holds a large share of the rows
    first = settled(members.groupBy("bucket").agg(F.min("rep").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"), "first")
    shared = settled(members.join(first, "bucket"), "buckets")
    pairs = settled(shared.where("rep <> a").select("a", F.col("rep").alias("b")).distinct(), "pairs")
    texts = rows.where("doc_id is not null")
    links = settled(confirmed(texts, pairs, percent, width), "confirmed")

    groups_ = settled(components(links), "groups")
    labelled = shared.join(groups_.withColumnRenamed("node", "rep"), "rep", "left").select(
        "bucket", "rep", F.coalesce("component", "rep").alias("component"))
    mixed_buckets = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    rest = labelled.join(settled(mixed_buckets.select("bucket"), "mixed"), "bucket")
    described = rest.join(classes.select("rep", "n_shingles", "signature"), "rep")
    cells = settled(leftover_pairs(described, percent), "cells")
    more = settled(confirmed_cells(texts, cells, percent, width), "confirmed")
    groups_ = settled(components(links.union(more)), "groups")

    named = classes.select("digest", "rep").join(groups_.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component"))
    return features.select("doc_id", "n_shingles", "digest").join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull()))
