"""Exact removal of repeated byte strings by externally sorted, induced suffixes.

A byte goes when a string of ``length`` bytes that covers it also starts somewhere else, in
the same document or another.  Sorting every suffix is out of reach at this size, and not
needed: only suffixes that share ``length`` bytes with another matter.

1. Sampled suffixes.  Each window of ``length`` bytes is owned by its smallest 128-byte gram
   (leftmost of equals), which depends on the bytes of the window alone.  Windows with the
   same owner follow each other, so a document becomes about one row per 137 bytes: the gram
   at ``x`` owns the windows ``lo .. hi``.  Equal windows have equal owners at equal distance.
2. Rows whose gram occurs once are done.  Rows whose whole stretch ``lo .. hi+length`` occurs
   again are done too: all their windows repeat.  Edges of repeats are left.
3. Induction.  The suffixes at the grams of these rows are sorted by Spark's external,
   spilling sort (by gram, then by the bytes that follow); common-prefix lengths of
   neighbours come off the sorted stream.  The suffixes in front of a gram, ``d`` bytes back,
   are then ordered by induction: two of them share ``length`` bytes when the ``d`` bytes
   before the gram agree and the sorted suffixes share ``length - d``.
4. Grams with more than ``hot_rows`` such rows are not gathered in one task; their windows
   are counted by 64-bit hash, combined before the shuffle; others are compared byte by byte.
5. One pass over the texts cuts the covered bytes out.

Passages of over 50 words are often shorter than 400 bytes and stay then.  ``n_shared_words``
counts the words inside passages of ``words`` words that another row holds too, whatever blanks
lie between them: the same sampling over word hashes (windows of ``words`` words, grams of
eight), with whole stretches and then the windows of the rows that are left compared by hash.

Equal texts are one text with a count: all their windows repeat.  Null texts are empty.
Repeated rows are equal texts like any other.  Nothing is capped or sampled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcatalog.llm.common import record_batch, settled, slices
from clipcatalog.llm.minmax_dedup import _tables, mixed, powers

LENGTH, GRAM = 400, 128
WORDS, WORD_GRAM = 51, 8
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
SEGMENT = 1 << 22
PLACE = np.uint64((1 << 24) - 1)


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of bytes, or of 64-bit codes of words."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data if data.dtype == np.uint64 else _tables()[0][data]) * up[:-1], out=sums[1:])
    return sums, down


def string_hash(sums: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((sums[end] - sums[start]) * down[start] ^ mixed((end - start).astype(np.uint64)))


def owners(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``x, lo, hi`` of the grams that own windows, and the hashes of gram and stretch."""
    sums, down = prefix_sums(data)
    at = np.arange(len(data) - gram + 1)
    hashes = mixed((sums[gram:] - sums[:-gram]) * down[: len(at)])
    keys = (hashes & ~PLACE) | at.astype(np.uint64)
    w = length - gram + 1  # smallest of each w neighbours, from running minima of blocks of w
    padded = np.full(-(-len(keys) // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(keys)] = keys
    shaped = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(shaped, axis=1).ravel()
    behind = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keys) - w + 1
    owner = (np.minimum(behind[:n], ahead[w - 1 : w - 1 + n]) & PLACE).astype(np.int64)
    lo = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
    hi = np.concatenate([lo[1:] - 1, [n - 1]])
    x = owner[lo]
    return x, lo, hi, hashes[x], string_hash(sums, down, lo, hi + length)


ROWS = pa.schema([(c, pa.int64()) for c in ("g", "e", "did", "x", "lo", "hi")])
ROWS_DDL = "g long, e long, did long, x long, lo long, hi long"


def sampled(texts: DataFrame, length: int, gram: int, segment: int = SEGMENT) -> DataFrame:
    """One row per owning gram of ``texts(did, text)`` and segment of a text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            parts = []
            for did, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = np.frombuffer((body or "").encode("utf-8", "surrogatepass"), np.uint8)
                for base in range(0, max(0, len(data) - length + 1), segment):
                    x, lo, hi, g, e = owners(data[base : base + segment + length - 1], length, gram)
                    parts.append((g.view(np.int64), e.view(np.int64), np.full(len(x), did), x + base, lo + base, hi + base))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=ROWS)

    return texts.mapInArrow(run, ROWS_DDL)


def word_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of the words."""
    gap = np.concatenate([[True], BLANK[data], [True]])
    return np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])


def word_codes(text: str, segment: int) -> np.ndarray:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends = word_edges(data)
    parts = [np.zeros(0, np.uint64)]
    cuts = np.unique(np.searchsorted(starts, np.arange(0, len(data) + segment, segment)))
    for a, b in zip(cuts, cuts[1:]):
        first = starts[a]
        sums, down = prefix_sums(data[first : ends[b - 1]])
        parts.append(string_hash(sums, down, starts[a:b] - first, ends[a:b] - first))
    return np.concatenate(parts)


WORD_ROWS = pa.schema([("g", pa.int64()), ("e", pa.int64()), ("did", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
WORD_ROWS_DDL = "g long, e long, did long, lo int, hi int"


def sampled_words(texts: DataFrame, words: int, gram: int, segment: int) -> DataFrame:
    """As ``sampled``, counted in words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            parts = []
            for did, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = word_codes(body, segment)
                for base in range(0, max(0, len(codes) - words + 1), segment):
                    _, lo, hi, g, e = owners(codes[base : base + segment + words - 1], words, gram)
                    parts.append((g.view(np.int64), e.view(np.int64), np.full(len(lo), did), lo + base, hi + base))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), type=f.type) for c, f in zip(zip(*parts), WORD_ROWS)], schema=WORD_ROWS)

    return texts.mapInArrow(run, WORD_ROWS_DDL)


def elsewhere(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that two texts hold."""
    return rows.groupBy(*keys).agg(F.min("did").alias("a"), F.max("did").alias("b")).where("a <> b").select(*keys)


def shared_passages(texts: DataFrame, words: int, gram: int, segment: int) -> DataFrame:
    """``did, lo, hi``: first words of the passages of ``words`` words that another text holds too."""
    texts = texts.where(F.octet_length("text") >= 2 * words - 1)
    samples = settled(sampled_words(texts, words, gram, segment), "word_samples")
    shared = settled(samples.join(settled(elsewhere(samples, ["g"]), "word_grams"), "g").distinct(), "word_shared")
    whole = settled(elsewhere(shared, ["g", "e"]).withColumn("again", F.lit(True)), "word_whole")
    marked = settled(shared.join(whole, ["g", "e"], "left"), "word_marked")
    open_ = marked.where("again is null")
    open_grams = settled(open_.select("g").distinct(), "word_open")
    place = F.struct("did", "lo", "hi")
    witnesses = (  # rows of two texts stand for all that hold a stretch: one of them is another text than that of an open window
        marked.where("again").join(open_grams, "g").groupBy("g", "e").agg(F.array(F.min(place), F.max(place)).alias("s"))
        .select(F.inline("s"))
    )
    places = open_.select("did", "lo", "hi").union(witnesses).groupBy("did").agg(F.collect_set(F.struct("lo", "hi")).alias("places"))

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.int64()), ("did", pa.int64()), ("lo", pa.int32())])
        for batch in slices(batches, "text", 1_000_000):
            parts = []
            for did, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                sums, down = prefix_sums(word_codes(text, segment))
                at = np.concatenate([np.arange(p["lo"], p["hi"] + 1) for p in found])
                parts.append((string_hash(sums, down, at, at + words).view(np.int64), np.full(len(at), did), at))
            h, did, lo = map(np.concatenate, zip(*parts))
            yield record_batch(schema, h=h, did=did, lo=lo)

    exploded = settled(texts.join(places, "did").select("did", "text", "places").mapInArrow(windows, "h long, did long, lo int"), "word_windows")
    again = exploded.join(settled(elsewhere(exploded, ["h"]), "word_again"), "h").select("did", "lo", F.col("lo").alias("hi"))
    return marked.where("again").select("did", "lo", "hi").union(again.distinct())


def repeated(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """The keys that occur at two different places, ``(did, place)``."""
    both = rows.groupBy(*keys).agg(*(f(c).alias(f"{n}_{c}") for c in ("did", place) for n, f in (("a", F.min), ("b", F.max))))
    return both.where(f"a_did <> b_did or a_{place} <> b_{place}").select(*keys)


def shared_prefix(rows: list[bytes], group: np.ndarray, width: int) -> np.ndarray:
    """Bytes that each row shares with the one before; -1 at the start of a group."""
    sizes = np.array([len(r) for r in rows])
    matrix = np.zeros((len(rows), width + 1), np.uint8)
    for i, r in enumerate(rows):
        matrix[i, : len(r)] = np.frombuffer(r, np.uint8)
    differ = matrix[1:] != matrix[:-1]
    differ[:, width] = True
    out = np.full(len(rows), -1)
    out[1:] = np.minimum(differ.argmax(axis=1), np.minimum(sizes[1:], sizes[:-1]))
    out[1:][group[1:] != group[:-1]] = -1
    return out


def induced(frame: dict[str, list], length: int) -> list[tuple[int, int, int]]:
    """(did, first, last) window starts that occur twice; rows come sorted by ``g, ahead``."""
    n = len(frame["g"])
    group = np.unique(np.array(frame["g"]), return_inverse=True)[1]
    x, lo, hi = (np.array(frame[c]) for c in ("x", "lo", "hi"))
    after = shared_prefix(frame["ahead"], group, length)
    back = [b[::-1] for b in frame["before"]]
    order = np.array(sorted(range(n), key=lambda i: (group[i], back[i])))
    before = shared_prefix([back[i] for i in order], group[order], max(map(len, back), default=0))
    hit = np.zeros((n, int((x - lo).max()) + 1), bool)
    for d in range(hit.shape[1]):
        rows = np.flatnonzero((x - d >= lo) & (x - d <= hi))
        if len(rows) < 2:
            continue
        right = np.cumsum(after < length - d)
        left = np.zeros(n, np.int64)
        left[order] = np.cumsum(before < d)
        _, at, count = np.unique(right[rows] * (n + 1) + left[rows], return_inverse=True, return_counts=True)
        hit[rows[count[at] > 1], d] = True
    return runs(frame["did"], x, hit)


def runs(did: list[int], x: np.ndarray, hit: np.ndarray) -> list[tuple[int, int, int]]:
    """Marked ``(row, d)`` as stretches of starts ``x - d``."""
    out = []
    for i in np.flatnonzero(hit.any(axis=1)):
        d = np.flatnonzero(hit[i])
        cuts = np.flatnonzero(np.diff(d) > 1)
        for a, b in zip([0, *(cuts + 1)], [*cuts, len(d) - 1]):
            out.append((did[i], int(x[i] - d[b]), int(x[i] - d[a])))
    return out


STRETCHES = pa.schema([("did", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])
STRETCHES_DDL = "did long, lo long, hi long"


def with_contexts(edges: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """Add the bytes of a row's stretch, cut at its gram: ``before`` and ``ahead``."""
    schema = pa.schema([(c, pa.int64()) for c in ("g", "did", "x", "lo", "hi")] + [("before", pa.binary()), ("ahead", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            out: dict[str, list] = {f.name: [] for f in schema}
            for row in batch.to_pylist():
                data = row["text"].encode("utf-8", "surrogatepass")
                for place in row["places"]:
                    x, lo, hi = place["x"], place["lo"], place["hi"]
                    for name, value in zip(out, (place["g"], row["did"], x, lo, hi, data[lo:x], data[x : hi + length])):
                        out[name].append(value)
            yield record_batch(schema, **out)

    places = edges.groupBy("did").agg(F.collect_list(F.struct("g", "x", "lo", "hi")).alias("places"))  # as many as a text has
    return texts.join(places, "did").select("did", "text", "places").mapInArrow(
        run, "g long, did long, x long, lo long, hi long, before binary, ahead binary").dropDuplicates(["did", "x", "lo"])  # a cut text gives two rows at one gram


def edge_stretches(contexts: DataFrame, length: int, hot_rows: int) -> DataFrame:
    sizes = contexts.groupBy("g").agg(F.count("*").alias("rows")).where("rows > 1")
    sized = contexts.join(sizes, "g")

    def sorted_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: dict[str, list]) -> pa.RecordBatch:
            found = induced(rows, length)
            return record_batch(STRETCHES, did=[r[0] for r in found], lo=[r[1] for r in found], hi=[r[2] for r in found])

        held: dict[str, list] = {}
        for batch in batches:
            new = batch.to_pydict()
            held = {k: held.get(k, []) + v for k, v in new.items()}
            g = held["g"]
            if len(g) < 8192:
                continue
            end = len(g)
            while end and g[end - 1] == g[-1]:  # the last group may go on
                end -= 1
            if end:
                yield made({k: v[:end] for k, v in held.items()})
                held = {k: v[end:] for k, v in held.items()}
        if held.get("g"):
            yield made(held)

    usual = (
        sized.where(F.col("rows") <= hot_rows).select("g", "did", "x", "lo", "hi", "before", "ahead")
        .repartition("g").sortWithinPartitions("g", "ahead").mapInArrow(sorted_groups, STRETCHES_DDL)
    )
    hot = sized.where(F.col("rows") > hot_rows).select("g", "did", "lo", "before", "ahead")

    def windows(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for g, did, lo, before, ahead in frame.itertuples(index=False):
                data = np.frombuffer(before + ahead, np.uint8)
                sums, down = prefix_sums(data)
                p = np.arange(len(data) - length + 1)
                h = string_hash(sums, down, p, p + length).view(np.int64)
                yield pd.DataFrame({"g": g, "h": h, "did": did, "lo": lo + p})

    exploded = hot.mapInPandas(windows, "g long, h long, did long, lo long")
    again = exploded.join(repeated(exploded, ["g", "h"], "lo"), ["g", "h"])
    return usual.union(again.select("did", "lo", F.col("lo").alias("hi")))


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                    ("kept_sha256", pa.string()), ("n_shared_words", pa.int64()), ("kept", pa.binary())])
RESULT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared_words long"


def covered(lo: np.ndarray, hi: np.ndarray, length: int) -> int:
    """Places inside windows of ``length`` that start at ``lo .. hi``."""
    if not len(lo):
        return 0
    order = np.argsort(lo)
    first, end = lo[order], np.maximum.accumulate(hi[order] + length)
    return int(end[-1] - first[0] - np.maximum(first[1:] - end[:-1], 0).sum())


def cut_out(texts: DataFrame, stretches: DataFrame, passages: DataFrame, length: int, words: int, with_kept: bool) -> DataFrame:
    names = [f for f in RESULT if with_kept or f.name != "kept"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: dict[str, list] = {f.name: [] for f in RESULT}
            passages = batch.column("passages")
            at, lo, hi = passages.offsets.to_numpy(), passages.values.field("lo").to_numpy(), passages.values.field("hi").to_numpy()
            for k, row in enumerate(batch.select(["doc_id", "text", "found", "copies"]).to_pylist()):
                data = (row["text"] or "").encode("utf-8", "surrogatepass")
                if row["copies"] > 1 and len(data) >= length:
                    spans = [[0, len(data)]]
                else:
                    spans = []
                    for first, last in sorted((s["lo"], s["hi"]) for s in row["found"] or ()):
                        if spans and first <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], last + length)
                        else:
                            spans.append([first, last + length])
                n_shared = covered(lo[at[k] : at[k + 1]], hi[at[k] : at[k + 1]], words)
                if row["copies"] > 1:
                    n_words = len(word_edges(np.frombuffer(data, np.uint8))[0])
                    n_shared = n_words if n_words >= words else 0
                edges = [0, *(x for s in spans for x in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                for name, value in zip(out, (row["doc_id"], len(data), len(data) - len(kept), len(spans),
                                             hashlib.sha256(kept).hexdigest(), n_shared, kept)):
                    out[name].append(value)
            yield record_batch(pa.schema(names), **out)

    copies = texts.groupBy("did", F.octet_length("text").alias("size")).agg(F.count("*").alias("copies")).where("copies > 1")
    found = (
        stretches.groupBy("did").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))  # as many as a text has
        .join(passages.groupBy("did").agg(F.collect_list(F.struct("lo", "hi")).alias("passages")), "did", "full")
        .join(copies.groupBy("did").agg(F.max("copies").alias("copies")), "did", "full")
    )
    return texts.join(found, "did", "left").select(
        "doc_id", "text", "found", "passages", F.coalesce("copies", F.lit(1)).alias("copies")
    ).mapInArrow(run, RESULT_DDL + ", kept binary" * with_kept)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   hot_rows: int = 2000, with_kept: bool = False, segment: int = SEGMENT, words: int = WORDS,
                   word_gram: int = WORD_GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared_words`` for every row; ``with_kept`` adds the kept bytes."""
    body = F.col(text).cast("string")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("did"))
    texts = rows.select("did", "text")
    samples = settled(sampled(texts.where(F.octet_length("text") >= length), length, gram, segment), "samples")
    # key lists are tables of their own: both sides of their joins are then plain shuffles, which
    # adaptive execution splits where one gram holds a large share of the rows
    shared = settled(samples.join(settled(repeated(samples, ["g"], "x"), "grams"), "g").distinct(), "shared")
    whole = settled(repeated(shared, ["g", "e"], "lo").withColumn("again", F.lit(True)), "whole")
    marked = settled(shared.join(whole, ["g", "e"], "left"), "marked")
    open_ = marked.where("again is null")
    open_grams = settled(open_.select("g").distinct(), "open")
    witnesses = (  # an open window may repeat inside a stretch that is done: one row of each stands for all
        marked.where("again").join(open_grams, "g").groupBy("g", "e")
        .agg(F.min(F.struct("did", "x", "lo", "hi")).alias("s")).select("g", "s.*")
    )
    edges = settled(with_contexts(open_.select("g", "did", "x", "lo", "hi").union(witnesses), texts, length), "edges")
    stretches = settled(marked.where("again").select("did", "lo", "hi").union(edge_stretches(edges, length, hot_rows)), "stretches")
    passages = settled(shared_passages(texts, words, word_gram, segment), "passages")
    return cut_out(rows, stretches, passages, length, words, with_kept)
