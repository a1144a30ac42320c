"""Toxicity from the nearest labelled examples under exact TF-IDF cosine.

Fitting, on at most ``per_label`` labelled documents of each label in hash order (a stated
bound; so rare labels are all there):

* Terms are the words of the examples, all of them.
* Document frequencies of these terms are counted over *all* documents.  A term weighs
  (1 + ln tf) * idf * relevance; the relevance is the root of the likelihood ratio of the term and
  the label, so terms that say nothing of it count little, but none is left out.
* The examples form a block-max index: blocks of ``block`` examples with similar vectors,
  and for each term the blocks that hold it with its largest weight there.  A query adds
  up these bounds per block and opens only blocks that can hold one of its k best examples, so
  the k nearest are exact.  Terms that an eighth of the examples hold are rows of weights.
* The squared cosines of the k nearest vote, each label weighted by how many labelled documents
  an example stands for.  A monotone fit of the votes of the examples among each other
  (each left out in turn) turns a vote into a probability.

Scoring is one pass over the documents with this bounded model.  A text without any known
term, as null and empty ones, has no neighbour and scores the rate of such examples.
Equal texts count once in fitting.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipcatalog.llm.common import record_batch, remainder, settled, slices

WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> Counter:
    return Counter(WORD.findall(text.lower())) if text else Counter()


def term_counts(number: dict[str, int], text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the known terms of a text, rising, and how often they occur."""
    bag = words(text)
    at = np.array([number.get(w, -1) for w in bag], np.int64)
    order = np.argsort(at, kind="stable")[np.count_nonzero(at < 0) :]
    return at[order], np.fromiter(bag.values(), np.int64, len(bag))[order]


def vector(at: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and unit weights; empty when nothing weighs."""
    weight = (1 + np.log(counts)) * weights[at]
    norm = float(np.sqrt(weight @ weight))
    return (at, weight / norm) if norm > 0 else (at[:0], weight[:0])


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places ``start .. start + length - 1``, one span after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


class BlockMaxIndex:
    """Blocks of examples; common terms as rows of weights, the others as postings with their block maxima."""

    def __init__(self, ids: list[int], labels: list[int], vectors: list, terms: int, block: int = 32):
        order = sorted(range(len(ids)), key=lambda i: (labels[i], int(vectors[i][0][vectors[i][1].argmax()]), ids[i]))
        self.ids, self.labels = np.array([ids[i] for i in order]), np.array([labels[i] for i in order], float)
        self.size, self.blocks = block, -(-len(order) // block)
        place = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        term, weight = (np.concatenate([vectors[i][c] for i in order]) for c in (0, 1))
        common = np.flatnonzero(8 * np.bincount(term, minlength=terms) >= len(order))  # at most 8 times the terms of an example
        self.row = np.full(terms, -1)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), self.blocks * block))
        held = self.row[term] >= 0
        self.rows[self.row[term[held]], place[held]] = weight[held]
        place, term, weight = place[~held], term[~held], weight[~held]
        by = np.lexsort((place, term))  # postings by term and, within it, by block
        self.place, self.weight = place[by].astype(np.int32), weight[by]
        key = term[by] * self.blocks + self.place // block
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.first, self.length = first, np.diff(first, append=len(key))
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else self.weight
        self.block = (key[first] % self.blocks).astype(np.int32)
        self.of_term = np.searchsorted(key[first] // self.blocks, np.arange(terms + 1))

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int, leave: int | None = None) -> list[tuple[float, int]]:
        """The ``k`` highest (cosine, place) above 0, best first; ``leave`` is a place to leave out."""
        return next(self.nearest_of([(at, weight)], k, [leave]))

    def nearest_of(self, queries: list, k: int, leave: list | None = None, together: int = 32) -> Iterator[list[tuple[float, int]]]:
        """``nearest`` of many queries; the common terms of ``together`` of them are multiplied at once."""
        for start in range(0, len(queries), together):
            chunk = queries[start : start + together]
            common = np.zeros((len(chunk), len(self.rows)))
            for i, (at, weight) in enumerate(chunk):
                rows = self.row[at]
                common[i, rows[rows >= 0]] = weight[rows >= 0]
            for i, ((at, weight), partial) in enumerate(zip(chunk, common @ self.rows)):
                rare = self.row[at] < 0
                yield self._finished(partial, at[rare], weight[rare], k, leave[start + i] if leave else None)

    def _finished(self, partial: np.ndarray, at: np.ndarray, weight: np.ndarray, k: int, leave: int | None) -> list[tuple[float, int]]:
        """Add the postings of the blocks that can hold one of the ``k`` best to the partial cosines.

        The k-th partial cosine is a lower limit; a block's best partial one and its maxima of the other terms are its upper limit.
        """
        if leave is not None:
            partial[leave] = -np.inf
        least = max(0.0, np.partition(partial, -k)[-k]) - 1e-12 if len(partial) >= k else 0.0
        lengths = self.of_term[at + 1] - self.of_term[at]
        pairs, own = spans(self.of_term[at], lengths), np.repeat(weight, lengths)  # (term, block) and the query's weight
        block = self.block[pairs]
        bound = partial.reshape(self.blocks, -1).max(axis=1) + np.bincount(block, own * self.most[pairs], self.blocks)
        opened = bound > least
        wanted = np.flatnonzero(opened[block])
        held = self.length[pairs[wanted]]
        postings = spans(self.first[pairs[wanted]], held)
        cosine = partial + np.bincount(self.place[postings], np.repeat(own[wanted], held) * self.weight[postings], len(partial))
        places = np.flatnonzero(np.repeat(opened, self.size) & (cosine > max(least, 0.0)))
        top = places[np.lexsort((places, -cosine[places]))[:k]]
        return list(zip(cosine[top].tolist(), top.tolist()))


def monotone(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing steps (votes, smoothed rates) by pooling neighbours that are out of order."""
    pools: list[list[float]] = []  # first vote, positives, rows
    for v, y, w in sorted(zip(votes.tolist(), labels.tolist(), (np.ones(len(votes)) if weights is None else weights).tolist())):
        if pools and pools[-1][0] == v:
            pools[-1][1] += y * w
            pools[-1][2] += w
        else:
            pools.append([v, y * w, w])
    merged: list[list[float]] = []
    for pool in pools:
        merged.append(pool)
        while len(merged) > 1 and merged[-2][1] * merged[-1][2] >= merged[-1][1] * merged[-2][2]:
            _, y, n = merged.pop()
            merged[-1][1] += y
            merged[-1][2] += n
    return np.array([p[0] for p in merged]), np.array([(p[1] + 0.5) / (p[2] + 1) for p in merged])


@dataclass
class Model:
    names: list[str]
    weights: np.ndarray
    index: BlockMaxIndex | None
    stands_for: tuple[float, float]  # labelled documents per example, of label 0 and 1
    steps: tuple[np.ndarray, np.ndarray]
    without: float
    k: int

    def vote(self, near: list[tuple[float, int]]) -> float | None:
        if not near:
            return None
        cosine, label = np.array([c for c, _ in near]), self.index.labels[[p for _, p in near]]
        share = cosine * cosine * np.where(label > 0, self.stands_for[1], self.stands_for[0])
        return round(float((share * label).sum() / share.sum()), 9)

    def score(self, vote: float | None) -> float:
        if vote is None or not len(self.steps[0]):
            return self.without
        return float(self.steps[1][max(0, np.searchsorted(self.steps[0], vote, side="right") - 1)])


def example_sample(docs: DataFrame, labels: DataFrame, per_label: int) -> tuple[DataFrame, tuple[float, float]]:
    """``doc_id, text, toxic`` of at most ``per_label`` labelled documents of a label, equal texts once; labelled ones per example."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    nth = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = known.withColumn("nth", nth).where(F.col("nth") <= per_label).drop("nth")
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    texts = docs.where("text is not null").join(F.broadcast(chosen), "doc_id")  # 2 * per_label rows of two numbers
    sample = texts.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    return sample, tuple(max(1.0, totals.get(y, 0) / per_label) for y in (0, 1))


def relevance(in_toxic: np.ndarray, in_other: np.ndarray, toxic: int, other: int) -> np.ndarray:
    """Root of the likelihood ratio of "holds the term" and the label, and a little for every term."""
    n, seen = toxic + other, in_toxic + in_other

    def part(both: np.ndarray, row: np.ndarray, column: int) -> np.ndarray:
        share = np.divide(both * n, row * column, out=np.ones(len(both)), where=both > 0)
        return both * np.log(share)

    ratio = (part(in_toxic, seen, toxic) + part(in_other, seen, other)
             + part(toxic - in_toxic, n - seen, toxic) + part(other - in_other, n - seen, other))
    return 0.1 + np.sqrt(np.maximum(0.0, 2 * ratio))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 2000, k: int = 15, block: int = 32) -> Model:
    """``docs(doc_id, text)`` give the corpus counts, ``labels(doc_id, toxic)`` the examples."""
    spark = docs.sparkSession
    sample, stands_for = example_sample(docs, labels, per_label)
    sample = settled(sample.select("text", "doc_id", F.col("toxic").cast("int").alias("toxic")), "examples")

    def term_rows(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, list[int]] = {}
        for frame in frames:
            for text, toxic in zip(frame["text"], frame["toxic"]):
                for term in words(text):
                    total.setdefault(term, [0, 0])[toxic] += 1
        yield pd.DataFrame([(t, a, b) for t, (b, a) in total.items()], columns=["term", "a", "b"])

    counted = sample.select("text", "toxic").mapInPandas(term_rows, "term string, a long, b long")
    terms = counted.groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow().sort_by("term")  # those of the sample
    names = terms["term"].to_pylist()
    shared = spark.sparkContext.broadcast(names)

    def frequencies(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = {t: i for i, t in enumerate(shared.value)}
        total, rows = np.zeros(len(number), np.int64), 0
        for frame in frames:
            for text in frame["text"]:
                rows += 1
                total[[number[w] for w in set(WORD.findall((text or "").lower())) if w in number]] += 1
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"term": np.append(seen, -1), "n": np.append(total[seen], rows)})

    df = np.zeros(len(names) + 1)
    every = docs.select("text").mapInPandas(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df[every["term"].to_numpy()] = every["n"].to_numpy()  # one row per term of the sample; -1 is the number of documents
    idf = np.log((df[-1] + 1) / (df[:-1] + 1))

    def example_vectors(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = {t: i for i, t in enumerate(shared.value)}
        for frame in frames:
            own = [term_counts(number, text) for text in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "toxic": frame["toxic"],
                                "at": [at.tobytes() for at, _ in own], "n": [n.tobytes() for _, n in own]})

    examples = sample.mapInPandas(example_vectors, "doc_id long, toxic int, at binary, n binary").orderBy("doc_id").collect()
    n1 = sum(r.toxic for r in examples)
    n0 = len(examples) - n1
    weights = idf * relevance(terms["a"].to_numpy().astype(float), terms["b"].to_numpy().astype(float), n1, n0)
    ids, marks, vectors, bare = [], [], [], [0.0, 0.0]
    for row in examples:
        own = vector(np.frombuffer(row["at"], np.int64), np.frombuffer(row["n"], np.int64), weights)
        if len(own[0]):
            ids.append(row.doc_id)
            marks.append(row.toxic)
            vectors.append(own)
        else:
            bare = [bare[0] + row.toxic * stands_for[1], bare[1] + stands_for[row.toxic]]
    model = Model(names, weights, BlockMaxIndex(ids, marks, vectors, len(names), block) if ids else None,
                  stands_for, (np.zeros(0), np.zeros(0)), 0.0, k)
    votes, known = [], []
    place = {i: p for p, i in enumerate(model.index.ids.tolist())} if ids else {}
    near = model.index.nearest_of(vectors, k, [place[i] for i in ids]) if ids else []
    for found, y in zip(near, marks):
        vote = model.vote(found)
        if vote is None:
            bare = [bare[0] + y * stands_for[1], bare[1] + stands_for[y]]
        else:
            votes.append(vote)
            known.append(y)
    known_ = np.array(known, float)
    model.steps = monotone(np.array(votes), known_, np.where(known_ > 0, stands_for[1], stands_for[0]))
    all_toxic, everything = n1 * stands_for[1], n1 * stands_for[1] + n0 * stands_for[0]
    prior = (all_toxic + 0.5) / (everything + 1) if examples else 0.0
    model.without = (bare[0] + prior) / (bare[1] + 1)
    return model


EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("evidence", EVIDENCE)])


class Scorer:
    """Scores texts with a model; equal term counts are scored once."""

    def __init__(self, model: Model, most_cached: int = 20_000):
        self.model, self.seen, self.most_cached = model, {}, most_cached
        self.number = {t: i for i, t in enumerate(model.names)}

    def __call__(self, texts: list[str | None]) -> list[tuple[float, list[tuple[float, int]]]]:
        own, keys, new = self.model, [], {}
        if len(self.seen) > self.most_cached:
            self.seen.clear()
        for text in texts:
            at, counts = term_counts(self.number, text)
            keys.append(hashlib.blake2b(at.tobytes() + counts.tobytes(), digest_size=16).digest())
            if keys[-1] not in self.seen and keys[-1] not in new:
                new[keys[-1]] = vector(at, counts, own.weights)
        found = own.index.nearest_of(list(new.values()), own.k) if own.index else ([] for _ in new)
        for key, near in zip(new, found):
            self.seen[key] = own.score(own.vote(near)), near
        return [self.seen[key] for key in keys]


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", shown: int = 3) -> DataFrame:
    """``doc_id, score, evidence`` (the ``shown`` nearest examples) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, index = Scorer(shared.value), shared.value.index
        for batch in slices(batches, "text"):
            made = own(batch.column(1).to_pylist())
            yield record_batch(
                SCHEMA, doc_id=batch.column(0).to_pylist(), score=[m[0] for m in made],
                evidence=[[{"doc_id": int(index.ids[p]), "cosine": c, "toxic": int(index.labels[p])} for c, p in m[1][:shown]]
                          for m in made])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,toxic:int>>")


def scorer(spark: SparkSession, model: Model):
    """The score as a column function of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Scorer(shared.value)
        for texts in batches:
            made = own([body if isinstance(body, str) else None for body in texts])
            yield pd.Series([m[0] for m in made], index=texts.index, dtype="float64")

    return toxicity


def fitted(docs: DataFrame, labels: DataFrame, **options) -> Model:
    """Fit on the labels whose id has a remainder other than 0 (crc32 modulo 5); counts from all documents."""
    return fit(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
               labels.where(remainder("doc_id", 5) != 0).select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")), **options)


def held_out_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fitted(docs, labels)).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
