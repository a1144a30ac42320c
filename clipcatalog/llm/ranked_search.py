"""Ranked lexical search: a block-max index in shards, searched by Block-Max MaxScore.

Terms are runs of ASCII letters, digits and any other than ASCII signs, only A-Z in lower
case.  With N documents that hold a term, L terms in all, n terms in a document, df
documents that hold a term and tf its occurrences in one, a document's score is the sum over
the terms of the query, repeats included, of

    w * ((1000000000 * tf) div (1000 * tf + 12 * m)),  w = floor(1000 * ln((2N + 2) / (2df + 1))),
    m = 100 - 25 + ((25 * n * N) div L)

1. ``build_index``: every task packs its documents into shards of about ``shard_bytes`` of
   text, documents in ascending order of id.  A shard holds one row per term: postings in
   blocks of 64, packed bytewise, with the last document and the competitive (tf, n) pairs
   of each block.  As the score grows with tf and falls with n, these pairs give the exact
   block maximum under the statistics of any later corpus.  Nothing is shuffled.
2. ``search``: df, N and L come from the index; index rows meet the query terms in a join,
   and one task at a time searches a shard for a bounded block of queries.
3. Within a shard, lists are ordered by their largest contribution.  Those whose bounds sum
   to no more than the k-th best score so far are not essential: a document found in none
   but them cannot enter.  Documents of the essential lists are scored in windows; then each
   non-essential list, largest first, rejects those that its block maximum and the bounds of
   the lists below cannot lift over the k-th score, and only blocks of the others are unpacked.
4. The heaps of all shards are merged by rank.

The result is exact: no list, block or shard is skipped but by these bounds.  Null and empty
texts hold no term.  Rows with a null id are searched and come after others of equal score.
Repeated rows are documents of their own.  Equal queries (id and text) are one query.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipcatalog.llm.common import groups, settled

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
BLOCK = 64
HEAD = np.dtype([("last", "<u4"), ("at", "<u4"), ("pair", "<u4"), ("doc_width", "u1"), ("tf_width", "u1")])

INDEX = pa.schema([
    ("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("cf", pa.int64()),
    ("heads", pa.binary()), ("pairs", pa.binary()), ("body", pa.binary()),
])
INDEX_DDL = "shard long, term string, df long, cf long, heads binary, pairs binary, body binary"
#: the row of a shard's documents: ids in ``heads``, null marks in ``pairs``, numbers of terms in ``body``
DOCUMENTS = ""


def terms(text: str | None) -> list[bytes]:
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def _binaries(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Cut one byte array at ``starts`` (the last one is its end)."""
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype("<i4").tobytes()), pa.py_buffer(data.tobytes())])


def _widths(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    most = np.maximum.reduceat(values, firsts)
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


class ShardWriter:
    """Collects documents and packs them into the rows of one shard."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        found = terms(text)
        if found:
            number = self.vocabulary
            self.ids.append(doc_id)
            self.tokens.append(np.array([number.setdefault(t, len(number)) for t in found], np.int64))
            self.size += len(text)

    def pack(self, shard: int) -> pa.RecordBatch:
        missing = np.array([i is None for i in self.ids])
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        order = np.lexsort((ids, missing))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lengths = np.array([len(t) for t in self.tokens], np.int64)
        names = sorted(self.vocabulary)
        rank = np.empty(len(names), np.int64)
        rank[[self.vocabulary[t] for t in names]] = np.arange(len(names))

        keys, tf = np.unique(
            rank[np.concatenate(self.tokens)] * len(order) + np.repeat(place, lengths), return_counts=True)
        term, doc = np.divmod(keys, len(order))
        lengths = lengths[order]
        n = lengths[doc]
        lists = np.flatnonzero(np.diff(term, prepend=-1))
        df = np.diff(lists, append=len(term))
        within = np.arange(len(term)) - np.repeat(lists, df)
        firsts = np.flatnonzero(within % BLOCK == 0)  # of the blocks
        block = np.cumsum(within % BLOCK == 0) - 1
        counts = np.diff(firsts, append=len(term))

        # gaps run on from block to block of a list; the first one counts from -1
        gap = np.diff(doc, prepend=0)
        gap[lists] = doc[lists] + 1
        wide, tf_wide = _widths(gap, firsts), _widths(tf, firsts)
        at = np.concatenate([[0], np.cumsum(counts * (wide + tf_wide))])
        body = np.zeros(at[-1], np.uint8)
        nth = np.arange(len(term)) - firsts[block]
        for values, width, base in ((gap, wide, at[:-1]), (tf, tf_wide, at[:-1] + counts * wide)):
            start = base[block] + nth * width[block]
            for k in range(4):
                rows = np.flatnonzero(width[block] > k)
                if len(rows):
                    body[start[rows] + k] = values[rows] >> (8 * k) & 255

        # competitive pairs: by falling tf, those with fewer terms than any before them
        by = np.lexsort((n, -tf, block))
        low = n[by] - block[by] * np.int64(1 << 40)
        keep = np.ones(len(by), bool)
        keep[1:] = low[1:] < np.minimum.accumulate(low)[:-1]
        by = by[keep]
        pair = np.concatenate([[0], np.cumsum(np.bincount(block[by], minlength=len(firsts)))])
        pairs = np.stack([tf[by], n[by]], axis=1).astype("<u4")

        of_list = np.concatenate([block[lists], [len(firsts)]])
        first = np.repeat(of_list[:-1], np.diff(of_list))  # first block of a block's list
        heads = np.zeros(len(firsts), HEAD)
        heads["last"], heads["at"], heads["pair"] = doc[firsts + counts - 1], at[:-1] - at[first], pair[:-1] - pair[first]
        heads["doc_width"], heads["tf_width"] = wide, tf_wide

        size = len(names) + 1
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(size, shard)),
            pa.array([DOCUMENTS, *(t.decode("utf-8", "replace") for t in names)]),
            pa.array(np.concatenate([[len(order)], df])),
            pa.array(np.concatenate([[lengths.sum()], np.add.reduceat(tf, lists)])),
            pa.concat_arrays([pa.array([ids[order].tobytes()], pa.binary()),
                              _binaries(heads.view(np.uint8), of_list * HEAD.itemsize)]),
            pa.concat_arrays([pa.array([missing[order].tobytes()], pa.binary()),
                              _binaries(pairs.view(np.uint8).ravel(), pair[of_list] * 8)]),
            pa.concat_arrays([pa.array([lengths.tobytes()], pa.binary()), _binaries(body, at[of_list])]),
        ], schema=INDEX)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = 16_000_000) -> DataFrame:
    """The index rows of all documents; write them with ``settled`` or as a table to search them again."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, done = ShardWriter(), 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal own, done
            batch = own.pack((TaskContext.get().partitionId() << 32) + done)
            own, done = ShardWriter(), done + 1
            for at in range(0, batch.num_rows, 8192):
                yield batch.slice(at, 8192)

        for batch in batches:
            for key, body in zip(batch.column(0), batch.column(1)):
                own.add(key.as_py(), body.as_py())
                if own.size >= shard_bytes:
                    yield from packed()
        if own.size:
            yield from packed()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, INDEX_DDL)


@dataclass
class Corpus:
    """N and L of the scores."""

    documents: int
    terms: int

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 75 + 25 * n * self.documents // self.terms
        return 1_000_000_000 * tf // (1000 * tf + 12 * m)


@dataclass
class PostingList:
    heads: np.ndarray
    body: bytes
    df: int
    weight: int
    maxima: np.ndarray  # largest impact of each block
    unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    @staticmethod
    def read(heads: bytes, pairs: bytes, body: bytes, df: int, weight: int, corpus: Corpus) -> PostingList:
        blocks = np.frombuffer(heads, HEAD)
        tf, n = np.frombuffer(pairs, "<u4").reshape(-1, 2).astype(np.int64).T
        maxima = np.maximum.reduceat(corpus.impact(tf, n), blocks["pair"].astype(np.int64))
        return PostingList(blocks, body, df, weight, maxima)

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and term frequencies of one block; unpacked once per shard and block of queries."""
        if b not in self.unpacked:
            head = self.heads[b]
            count = min(BLOCK, self.df - b * BLOCK)
            middle = int(head["at"]) + count * int(head["doc_width"])
            gaps = np.frombuffer(self.body, f"<u{head['doc_width']}", count, int(head["at"]))
            tf = np.frombuffer(self.body, f"<u{head['tf_width']}", count, middle)
            base = int(self.heads["last"][b - 1]) if b else -1
            self.unpacked[b] = base + np.cumsum(gaps, dtype=np.int64), tf.astype(np.int64)
        return self.unpacked[b]

    def between(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Postings of the documents ``lo .. hi-1``."""
        a, b = np.searchsorted(self.heads["last"], [lo, hi - 1])
        own = [self.block(k) for k in range(a, min(b + 1, len(self.heads)))]
        if not own:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, tf = (np.concatenate(c) for c in zip(*own))
        inside = slice(*np.searchsorted(docs, [lo, hi]))
        return docs[inside], tf[inside]


def best(lists: list[tuple[PostingList, int]], lengths: np.ndarray, corpus: Corpus, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the ``k`` best documents of a shard; ``lists`` come with their factor.

    Documents are visited in ascending order, so a later one needs more than the k-th score.
    """
    lists = sorted(lists, key=lambda x: int(x[0].maxima.max()) * x[1])
    bounds = np.cumsum([0, *(int(own.maxima.max()) * factor for own, factor in lists)])
    docs, scores, least, lo, width = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0, 4 * BLOCK
    while lo < len(lengths):
        split = int(np.searchsorted(bounds, least, side="right")) - 1  # the lists before it are not essential
        if split == len(lists):
            break
        hi = min(lo + width, len(lengths))
        total = np.zeros(hi - lo, np.int64)
        for own, factor in lists[split:]:
            at, tf = own.between(lo, hi)
            total[at - lo] += factor * corpus.impact(tf, lengths[at])
        found = np.flatnonzero(total)
        found = found[total[found] + bounds[split] > least]
        for t in range(split - 1, -1, -1):
            if not len(found):
                break
            own, factor = lists[t]
            where = np.searchsorted(own.heads["last"], found + lo)
            inside = where < len(own.heads)
            most = np.zeros(len(found), np.int64)
            most[inside] = own.maxima[where[inside]]
            hopeful = total[found] + factor * most + bounds[t] > least
            found, where, inside = found[hopeful], where[hopeful], inside[hopeful]
            for b in np.unique(where[inside]):
                at, tf = own.block(int(b))
                some = found[where == b] + lo
                spot = np.minimum(np.searchsorted(at, some), len(at) - 1)
                hit = at[spot] == some
                total[some[hit] - lo] += factor * corpus.impact(tf[spot[hit]], lengths[some[hit]])
        found = found[total[found] > least]
        if len(found):
            docs, scores = np.concatenate([docs, found + lo]), np.concatenate([scores, total[found]])
            top = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[top], scores[top]
            least = int(scores[-1]) if len(scores) == k else 0
        lo, width = hi, min(2 * width, 32 * BLOCK)
    return docs, scores


QUERY_TERMS = pa.schema([("query", pa.int64()), ("term", pa.string()), ("times", pa.int64())])
HITS = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
HITS_DDL = "query long, doc_id long, score long"
CELL = ["shard", "part"]


def query_terms(queries: DataFrame) -> DataFrame:
    """``query, term, times`` of ``queries(query, text)``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(key, t.decode("utf-8", "replace"), times) for key, text in zip(*(c.to_pylist() for c in batch.columns))
                    for t, times in Counter(terms(text)).items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema=QUERY_TERMS)

    return queries.mapInArrow(run, "query long, term string, times long")


def search(index: DataFrame, queries: DataFrame, item_id: str = "item_id", text: str = "text", k: int = 20,
           part_terms: int = 200_000) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents above 0 of each query.

    Queries are dealt into parts of about ``part_terms`` terms; a task holds one shard and one part.
    """
    items = settled(queries.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text")).distinct()
                    .withColumn("query", F.xxhash64(F.col("item_id").cast("string"), "text")), "items")
    documents, all_terms = index.where(F.col("term") == DOCUMENTS).agg(F.sum("df"), F.sum("cf")).first()
    corpus = Corpus(documents or 0, all_terms or 0)
    asked = settled(query_terms(items.select("query", "text")), "asked")
    parts = max(1, -(-asked.count() // part_terms))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query", F.lit(3)), F.lit(parts)))
    named = index.where(F.col("term") != DOCUMENTS)
    wanted = asked.select("term").distinct()
    spread = named.select("term", "df").join(wanted, "term").groupBy("term").agg(F.sum("df").alias("all_df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * corpus.documents + 2) / (2 * F.col("all_df") + 1).cast("double"))).cast("long")
    weights = settled(
        asked.select("part", "term").distinct().join(spread.select("term", weight.alias("weight")), "term"), "weights")
    lists = named.join(weights, "term").select(*CELL, "term", "df", "weight", "heads", "pairs", "body")
    # a cell is a shard's work for a part of the queries; its bytes do not show it, so tasks follow the number of cells
    met = settled(named.select("shard", "term").join(weights, "term").select(*CELL).distinct(), "met")
    places = index.where(F.col("term") == DOCUMENTS).join(met, "shard").select(
        *CELL, "term", "df", F.lit(0).cast("long").alias("weight"), "heads", "pairs", "body")
    packed = asked.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("query", "term", "times"))).alias("rows"))  # part_terms
    asks = met.join(packed.select("part", F.to_json("rows").cast("binary").alias("body")), "part").select(
        *CELL, F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("df"), F.lit(0).cast("long").alias("weight"),
        F.lit(None).cast("binary").alias("heads"), F.lit(None).cast("binary").alias("pairs"), "body")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        asked_for: tuple[bytes, dict] = (b"", {})
        for _, rows in groups(batches, CELL):
            lists, ids, missing, lengths = {}, None, None, None
            for row in rows.to_pylist():
                if row["term"] is None:
                    if row["body"] != asked_for[0]:
                        by_query: dict[int, list] = {}
                        for r in json.loads(row["body"]):
                            by_query.setdefault(r["query"], []).append((r["term"], r["times"]))
                        asked_for = row["body"], by_query
                elif row["term"] == DOCUMENTS:
                    ids, missing = np.frombuffer(row["heads"], np.int64), np.frombuffer(row["pairs"], bool)
                    lengths = np.frombuffer(row["body"], np.int64)
                else:
                    lists[row["term"]] = PostingList.read(
                        row["heads"], row["pairs"], row["body"], row["df"], row["weight"], corpus)
            out: dict[str, list] = {f.name: [] for f in HITS}
            for query, wanted_terms in asked_for[1].items():
                own = [(lists[t], times * lists[t].weight) for t, times in wanted_terms if t in lists]
                docs, scores = best(own, lengths, corpus, k)
                out["query"] += [query] * len(docs)
                out["doc_id"] += [None if missing[d] else int(ids[d]) for d in docs]
                out["score"] += scores.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in HITS], schema=HITS)

    hits = (
        lists.union(places).union(asks)
        .repartition(min(10_000, met.count() // 2 + 1), *CELL).sortWithinPartitions(*CELL, "term").mapInArrow(run, HITS_DDL)
    )
    ranked = hits.withColumn("rank", F.row_number().over(
        Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= k)
    return ranked.join(items.select("item_id", "query"), "query").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 20, shard_bytes: int = 16_000_000) -> DataFrame:
    """Index ``docs(doc_id, text)`` and search it for each of ``items(item_id, text)``."""
    return search(settled(build_index(docs, shard_bytes=shard_bytes), "index"), items, k=k)


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), lengths AS (SELECT row_no, doc_id, words, len(words) AS n FROM d WHERE len(words) > 0),
corpus AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM lengths),
posting AS (
  SELECT row_no, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_no, doc_id, n, unnest(words) AS term FROM lengths) GROUP BY ALL
),
weight AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM posting, corpus GROUP BY term, big_n
),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
  ) GROUP BY ALL
),
scored AS (
  SELECT item_id, row_no, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN posting USING (term), corpus GROUP BY ALL
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, row_no)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
