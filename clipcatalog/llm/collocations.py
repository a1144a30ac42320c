"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, then exact counts.

Texts fall, A-Z in lower case, into pieces at ``. , ; : ! ?`` and line ends, and pieces into
words at blanks and tabs.  Phrases are runs of one to four words within a piece, per language
(null: ``und``).

1. Summaries.  Each task hashes the phrases of its texts and counts them in chunks.  The
   chunk's counts are cut by hash into parts, packed, and sent to the part, ahead of them the
   chunk's share of the part's mass.  A part adds up its mass, then streams the chunks through
   one Misra-Gries summary with more than mass / ``least`` counters: whenever there are more,
   the first one beyond the capacity is taken off all of them.  The sum taken off stays below
   ``least``, so every phrase that occurs ``least`` times survives.  Survivors whose
   counter cannot reach ``least`` with that sum are dropped.
2. Exact counts.  The survivors mark bits in a map of fixed size, each part its own stretch of
   it.  A second pass counts the phrases that meet a set bit, by their words, and what is
   frequent stays.  False hits of the map or the hash only cost time.
3. Scores.  A phrase is cut behind each of its words; its score is the lowest of
   ``2000000 * a / (l + r)``.  Phrases that mostly occur inside one longer frequent phrase go.

Parts hold about 8 MB of text until there are 32,768 of them; from then on capacities grow.
The map has a bit per 8 bytes of text, at most 16 MB.  Nothing is sampled or capped; only
the map reaches the driver.  Rows count each for itself, repeated ones and null ids too; null
and empty texts have no words.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipcatalog.llm.common import settled, slices
from clipcatalog.llm.minmax_dedup import mixed
from clipcatalog.llm.suffix_dedup import prefix_sums, string_hash

LEAST, LONGEST, TOP, INSIDE = 30, 4, 2000, 80
SLICE = 1_000_000  # bytes of text that are hashed at once
WORD_BYTE, BLANK, BREAK = 0, 1, 2
KINDS = np.zeros(256, np.uint8)
KINDS[list(b" \t")] = BLANK
KINDS[list(b".,;:!?\n\v\f\r")] = BREAK


@dataclass(frozen=True)
class Layout:
    """Bits of a hash that are kept, that name its part, and that name its place in the map."""

    kept: int
    part: int
    place: int

    @staticmethod
    def of(text_bytes: int) -> Layout:
        size = max(1, text_bytes).bit_length()
        part = min(15, max(0, size - 23))
        return Layout(min(64, max(40, size + 12)), part, min(27, max(16, size - 3)))


class Phrases:
    """Hashes of all phrases of a batch of texts."""

    def __init__(self, texts: list[str | None], langs: list[str]):
        bodies = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
        self.data = b"\n".join(bodies)
        data = np.frombuffer(self.data, np.uint8)
        kind = KINDS[data]
        inside = np.concatenate([[False], kind == WORD_BYTE, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        piece = np.cumsum(kind == BREAK, dtype=np.int32)[self.starts]
        doc = np.searchsorted(np.cumsum([len(b) + 1 for b in bodies]), self.starts, side="right")
        names = sorted(set(langs))
        seeds = np.array([int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in names], np.uint64)
        number = {n: k for k, n in enumerate(names)}
        self.names, self.lang = names, np.array([number[x] for x in langs], np.int64)[doc]
        self.own: list[np.ndarray] = []  # per size: hashes of the phrases
        self.first: list[np.ndarray] = []  # and the number of their first word
        if len(self.starts):
            word = string_hash(*prefix_sums(data), self.starts, self.ends)
            hashes, at = mixed(word ^ seeds[self.lang]), np.arange(len(word))
            for size in range(1, LONGEST + 1):
                if size > 1:
                    at = at[at + size - 1 < len(word)]
                    more = piece[at] == piece[at + size - 1]
                    at = at[more]
                    hashes = mixed(full[at] * np.uint64(0x9E3779B97F4A7C15) + word[at + size - 1])
                full = np.zeros(len(word), np.uint64)
                full[at] = hashes
                self.own.append(hashes)
                self.first.append(at)

    def phrase(self, first: int, size: int) -> str:
        body = self.data[self.starts[first] : self.ends[first + size - 1]]
        return " ".join(w.decode("utf-8", "replace") for w in body.replace(b"\t", b" ").split(b" ") if w)


def packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising values as gaps, and their counts, in byte planes."""
    import zstandard

    gaps = np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    planes = np.concatenate([gaps, counts.astype("<u8").view(np.uint8).reshape(-1, 8).T])
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).reshape(16, -1)
    gaps, counts = (np.ascontiguousarray(p.T).view("<u8").ravel() for p in (planes[:8], planes[8:]))
    return np.cumsum(gaps, dtype=np.uint64), counts.astype(np.int64)


def summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, rising, with their counts added up."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


class Summary:
    """A Misra-Gries summary with ``capacity`` counters; ``lost`` is what has been taken off each."""

    def __init__(self, capacity: int, most_pending: int = 1 << 20):
        self.capacity, self.most_pending, self.lost = capacity, most_pending, 0
        self.values, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        self.pending.append((values, counts))
        self.waiting += len(values)
        if self.waiting > self.most_pending:
            self.merge()

    def merge(self) -> None:
        values, counts = (np.concatenate(c) for c in zip((self.values, self.counts), *self.pending))
        self.pending, self.waiting = [], 0
        self.values, self.counts = summed(values, counts)
        if len(self.values) > self.capacity:
            off = int(np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1])
            stay = self.counts > off
            self.values, self.counts, self.lost = self.values[stay], self.counts[stay] - off, self.lost + off

    def survivors(self, least: int) -> np.ndarray:
        self.merge()
        return self.values[self.counts + self.lost >= least]


CHUNKS = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("mass", pa.int64()), ("body", pa.binary())])
CHUNKS_DDL = "part long, kind int, mass long, body binary"


def chunk_counts(rows: DataFrame, layout: Layout, chunk: int = 2_000_000) -> DataFrame:
    """Phrase counts of chunks of text, cut by hash: a row of mass (kind 0) and one of counts (kind 1) per part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def made() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held) >> np.uint64(64 - layout.kept), return_counts=True)
            held.clear()
            part = (values >> np.uint64(layout.kept - layout.part)).astype(np.int64)
            cuts = np.concatenate([np.flatnonzero(np.diff(part, prepend=-1)), [len(part)]])
            own = [(int(part[a]), int(counts[a:b].sum()), packed(values[a:b], counts[a:b])) for a, b in zip(cuts, cuts[1:])]
            number, mass, bodies = zip(*own)
            return pa.RecordBatch.from_arrays([
                pa.array(number * 2, pa.int64()), pa.array([0] * len(own) + [1] * len(own), pa.int32()),
                pa.array(mass * 2, pa.int64()), pa.array([None] * len(own) + list(bodies), pa.binary())], schema=CHUNKS)

        for batch in slices(batches, "text", SLICE):
            held += Phrases(batch.column(0).to_pylist(), batch.column(1).to_pylist()).own
            if sum(map(len, held)) >= chunk:
                yield made()
        if sum(map(len, held)):
            yield made()

    return rows.mapInArrow(run, CHUNKS_DDL)


def surviving(chunks: DataFrame, layout: Layout, least: int) -> DataFrame:
    """``part, bits``: each part's stretch of the map of survivors."""
    schema = pa.schema([("part", pa.int64()), ("bits", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, own = None, 0, None

        def closed() -> pa.RecordBatch:
            places = (own.survivors(least) >> np.uint64(layout.kept - layout.place)).astype(np.int64)
            width = 1 << (layout.place - layout.part)
            marks = np.zeros(width, bool)
            marks[places - part * width] = True
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([np.packbits(marks, bitorder="little").tobytes()])], schema=schema)

        for batch in batches:
            for number, kind, size, body in zip(*(c.to_pylist() for c in batch.columns)):
                if number != part:
                    if own is not None:
                        yield closed()
                    part, mass, own = number, 0, None
                if kind == 0:
                    mass += size
                    continue
                if own is None:
                    own = Summary(mass // least + 1)
                own.add(*unpacked(body))
        if own is not None:
            yield closed()

    return chunks.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(run, "part long, bits binary")


MARKED = pa.schema([("lang", pa.string()), ("part", pa.int64()), ("body", pa.binary()), ("counts", pa.binary())])
COUNTS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def marked_counts(rows: DataFrame, bits, layout: Layout, most_held: int = 200_000) -> DataFrame:
    """Counts of the phrases with a set bit, and of all words (the empty phrase), packed by language and part of the hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        marks = np.frombuffer(bits.value, np.uint8)
        held: dict[tuple[str, int], Counter] = {}

        def made() -> pa.RecordBatch:
            squeeze = zstandard.ZstdCompressor(level=1).compress
            keys, own = list(held), list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int64()),
                pa.array([squeeze("\n".join(c).encode()) for c in own], pa.binary()),  # a phrase has no line end
                pa.array([squeeze(np.array(list(c.values()), "<i8").tobytes()) for c in own], pa.binary())], schema=MARKED)

        for batch in slices(batches, "text", SLICE):
            own = Phrases(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for name, n in zip(own.names, np.bincount(own.lang, minlength=len(own.names)).tolist()):
                if n:
                    held.setdefault((name, 0), Counter())[""] += n
            for size, (hashes, first) in enumerate(zip(own.own, own.first), 1):
                place = hashes >> np.uint64(64 - layout.place)
                hit = np.flatnonzero(marks[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                found, at, counts = np.unique(hashes[hit], return_index=True, return_counts=True)
                parts = (found >> np.uint64(63 - layout.part) >> np.uint64(1)).tolist()
                for word, part, n in zip(first[hit[at]].tolist(), parts, counts.tolist()):
                    held.setdefault((own.names[own.lang[word]], part), Counter())[own.phrase(word, size)] += n
            if sum(map(len, held.values())) >= most_held:
                yield made()
        if held:
            yield made()

    return rows.mapInArrow(run, "lang string, part long, body binary, counts binary")


def exact_counts(marked: DataFrame, least: int) -> DataFrame:
    """``lang, size, phrase, f`` of what occurs ``least`` times; one language's part of the hash at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        loose, key, total = zstandard.ZstdDecompressor().decompress, None, Counter()

        def made() -> pa.RecordBatch:
            kept = [(p, n) for p, n in total.items() if n >= least or not p]
            return pa.RecordBatch.from_arrays([
                pa.array([key[0]] * len(kept), pa.string()), pa.array([p.count(" ") + 1 if p else 0 for p, _ in kept], pa.int32()),
                pa.array([p for p, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], schema=COUNTS)

        for batch in batches:
            for lang, part, body, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if (lang, part) != key:
                    if key is not None:
                        yield made()
                    key, total = (lang, part), Counter()
                for phrase, n in zip(loose(body).decode().split("\n"), np.frombuffer(loose(counts), "<i8").tolist()):
                    total[phrase] += n
        if key is not None:
            yield made()

    return marked.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(
        run, "lang string, size int, phrase string, f long")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """``lang, size, phrase, f`` of all phrases of one to four words that occur ``least`` times, and all words as size 0."""
    rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    layout = Layout.of(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    width = (1 << layout.place) >> layout.part >> 3
    bits = bytearray(1 << layout.place >> 3)
    for part, own in settled(surviving(chunk_counts(rows, layout), layout, least), "marks").collect():  # 16 MB at most
        bits[part * width : (part + 1) * width] = own
    shared = docs.sparkSession.sparkContext.broadcast(bytes(bits))
    return exact_counts(marked_counts(rows, shared, layout), least)


def part_of(first, last):
    return F.array_join(F.slice(F.split("phrase", " "), first, last - first + 1), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
                 inside: int = INSIDE) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language."""
    counts = settled(frequent_phrases(docs, text, lang, least), "counts")
    phrases = counts.where("size > 1").withColumnRenamed("f", "a")
    known = counts.where("size > 0").select("lang", F.col("phrase").alias("own"), "f")
    k, size = F.col("k"), F.col("size")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", "a", "k", part_of(F.lit(1), k).alias("left"), part_of(k + 1, size).alias("right"))
    cuts = cuts.join(known.select("lang", F.col("own").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("own").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    whole = F.call_function("div", F.lit(2_000_000).cast("decimal(10,0)") * wide["a"], wide["l"] + wide["r"])
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(whole.alias("score"), "k", "l", "r")).alias("cut"))

    first, last = F.col("first"), F.col("last")
    longer = (
        phrases.where(size > 2).withColumn("first", F.explode(F.sequence(F.lit(1), size - 1)))
        .withColumn("last", F.explode(F.sequence(first + 1, size))).where(last - first + 1 < size)
        .select("lang", part_of(first, last).alias("phrase"), F.col("a").alias("over"))
        .groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    )
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(
        F.col("over").isNull() | (100 * F.col("over") < inside * F.col("a")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r").withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


ORACLE = """
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS body
  FROM documents
), worded AS (
  SELECT lang, words FROM (SELECT lang, regexp_extract_all(body, '[^\\x20\\x09]+') AS words FROM piece) WHERE len(words) > 0
), total AS (SELECT lang, sum(len(words))::BIGINT AS n FROM worded GROUP BY lang),
gram AS (
  SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: array_to_string(words[i:i + size - 1], ' '))) AS phrase
  FROM worded, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(words) >= size
), counts AS (SELECT lang, size, phrase, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 30),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS w FROM counts WHERE size > 1) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
), lowest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, array_to_string(w[first:last], ' ') AS phrase, max(f) AS over_f
  FROM (SELECT *, unnest(range(first + 1, size + 1)) AS last
        FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS first FROM counts WHERE size > 2))
  WHERE last - first + 1 < size GROUP BY ALL
), ranked AS (
  SELECT lowest.*, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank
  FROM lowest LEFT JOIN longer ON longer.lang = lowest.lang AND longer.phrase = lowest.phrase
  WHERE over_f IS NULL OR 100 * over_f < 80 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
