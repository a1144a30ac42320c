"""Document quality by hierarchical empirical Bayes.

1. A document's own evidence: seven numbers of its text (word variety, letters, capitals,
   symbols, word length, words that repeat the one before, repeated lines), each put in one
   of a fixed number of bins.  The log-likelihood ratio of a bin comes from grouped counts
   over all labelled documents; the ratios add up, tempered because the numbers hang together.
2. Sites: the quality of a host (and of a path of it) is estimated from all its documents,
   a label where there is one, else the probability from step 1.  The posterior of a path is
   shrunk toward its host, a host toward the global rate; how strongly follows from the
   spread between sites (method of moments), so sparse sites stay near the prior.
3. Score: the logit of the path posterior plus the document's evidence; kept from 0.5 on.

Everything is grouped aggregation with partial sums; at most the bins of the seven numbers
reach the driver.  Null texts are empty, null hosts and paths are sites of their own.
Repeated rows count as often as they occur; of several labels of one id the lowest holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog.llm.common import record_batch, remainder, settled, slices

BINS = 24
TEMPER = 0.5
FEATURES = ("variety", "letters", "capitals", "symbols", "word_length", "stutter", "repeated_lines")


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Per code point: 0 blank, 1 letter, 2 capital letter, 3 digit, 4 other."""
    table = np.full(0x110000, 4, np.uint8)
    for code in range(0x30000):
        char = chr(code)
        table[code] = 0 if char.isspace() else 2 if char.isupper() else 1 if char.isalpha() else 3 if char.isdigit() else 4
    return table


def bin_numbers(text: str | None) -> list[int]:
    words = text.split() if text else []
    if not words:
        return [0] * len(FEATURES)
    n = np.bincount(kinds()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")], minlength=5)
    solid = max(1, len(text) - int(n[0]))
    small = text.lower().split()
    lines = [x for x in text.split("\n") if x.strip()]
    share = (
        len(set(small)) / len(small), (n[1] + n[2]) / solid, min(1, 4 * n[2] / solid), min(1, 4 * n[4] / solid),
        min(1, solid / len(words) / 12), sum(a == b for a, b in zip(small, small[1:])) / len(small),
        1 - len(set(lines)) / len(lines),
    )
    return [1 + min(BINS - 1, int(x * BINS)) for x in share]


def described(docs: DataFrame, doc_id: str, text: str, host: Column, path: Column) -> DataFrame:
    """``doc_id, host, path, bins``: all that is kept of a document."""
    schema = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("bins", pa.list_(pa.int32()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = batch.to_pydict()
            yield record_batch(schema, doc_id=rows["doc_id"], host=rows["host"], path=rows["path"],
                               bins=[bin_numbers(x) for x in rows["text"]])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), host.cast("string").alias("host"),
                       path.cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, host string, path string, bins array<int>")


def ratios(labelled: DataFrame) -> tuple[list[list[float]], float]:
    """Log-likelihood ratio per number and bin, and the global rate; from ``bins, quality``."""
    counts = labelled.select("quality", F.posexplode("bins").alias("number", "bin")).groupBy("number", "bin").agg(
        F.sum("quality").alias("good"), F.count("*").alias("n")).collect()
    good, bad = np.zeros((len(FEATURES), BINS + 1)), np.zeros((len(FEATURES), BINS + 1))
    for r in counts:
        good[r.number, r.bin], bad[r.number, r.bin] = r.good, r.n - r.good
    ratio = np.log((good + 0.5) / (good.sum(1, keepdims=True) + 0.5 * BINS)) - np.log((bad + 0.5) / (bad.sum(1, keepdims=True) + 0.5 * BINS))
    seen = good + bad > 0
    ratio[~seen] = 0.0  # a bin without a labelled document says nothing
    return (TEMPER * ratio).tolist(), float((good[0].sum() + 1) / (good[0].sum() + bad[0].sum() + 2))


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def shrunk(sites: DataFrame, keys: list[str], prior: Column, name: str) -> DataFrame:
    """Posterior rate ``name`` of sites with ``good`` of ``n``; one row per site in, one out.

    With n_i rows and rate r_i around priors p_i: the strength of the prior is
    ``p(1-p) / v - 1``, where v is the spread between sites beyond what n_i explains.
    """
    spread = sites.withColumn("p", prior).agg(
        F.sum(F.col("n") * (F.col("good") / F.col("n") - F.col("p")) ** 2).alias("between"),
        F.sum(F.col("p") * (1 - F.col("p"))).alias("within"), F.sum("n").alias("rows"), F.count("*").alias("sites"),
        F.sum(F.col("n") * F.col("p") * (1 - F.col("p"))).alias("weighted"),
    ).first()
    strength = 100.0
    if spread.rows and spread.rows > spread.sites:
        v = max(0.0, (spread.between - spread.within) / (spread.rows - spread.sites))
        mean = spread.weighted / spread.rows
        strength = min(1e4, max(1.0, mean / v - 1)) if v > 0 else 1e4
    return sites.select(*keys, ((F.col("good") + strength * prior) / (F.col("n") + strength)).alias(name))


def quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``doc_id, evidence, host_rate, path_rate, score, kept`` for every row of ``docs``."""
    made = settled(described(docs, doc_id, text, host, path), "described")
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    table, rate = ratios(made.join(marks, "doc_id").select("bins", "quality"))
    at = F.array(*[F.array(*[F.lit(x) for x in row]) for row in table])
    evidence = F.aggregate(F.zip_with(at, "bins", lambda row, b: F.get(row, b)), F.lit(0.0), lambda x, y: x + y)
    own = made.select("doc_id", "host", "path", evidence.alias("evidence"))
    base = math.log(rate / (1 - rate))
    alone = 1 / (1 + F.exp(-(F.col("evidence") + base)))
    known = own.join(marks, "doc_id", "left").withColumn("good", F.coalesce(F.col("quality").cast("double"), alone))
    paths = settled(known.groupBy("host", "path").agg(F.sum("good").alias("good"), F.count("*").alias("n")), "sites")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    host_rates = settled(shrunk(hosts, ["host"], F.lit(rate), "host_rate"), "hosts")
    same = lambda left, right, keys: [left[k].eqNullSafe(right[k]) for k in keys]
    placed = paths.join(host_rates, same(paths, host_rates, ["host"]), "left").select(paths["*"], "host_rate")
    site_rates = settled(shrunk(placed, ["host", "path", "host_rate"], F.col("host_rate"), "path_rate"), "paths")
    return (
        own.join(site_rates, same(own, site_rates, ["host", "path"]), "left")
        .select("doc_id", "evidence", "host_rate", "path_rate",
                (1 / (1 + F.exp(-(logit(F.col("path_rate")) + F.col("evidence"))))).alias("score"))
        .withColumn("kept", F.col("score") >= 0.5)
    )


def document_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Hosts are sources, paths their languages; labels of ids with remainder 0 (crc32 modulo 5) are held out."""
    learned = labels.where(remainder("doc_id", 5) != 0)
    return quality(docs, learned, F.col("source"), F.col("lang")).withColumn("held_out", remainder("doc_id", 5) == 0)
