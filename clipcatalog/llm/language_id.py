"""Language identification by cross-parsing entropy.

A suffix automaton per language holds labelled text of that language.  A text is parsed
into the longest phrases that occur in it; the fewer phrases, the closer the text.  The
entropy of a language is ``phrases * log2(size of its text) / characters``, and the lowest
wins (ties: the first name).  Phrases end at word ends at the latest, so the parse of a
text is the sum over its words, and a worker parses each distinct word once.

Texts are lower-cased; words are runs of letters with one blank before and after.  The
labelled text is a bounded sample: per language whole documents, in hash order, up to
``sample_chars`` letters (one document at least, from the ``sample_docs`` first ones).
Null texts and texts without a letter are ``und`` with score 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipcatalog.llm.common import record_batch, remainder, slices

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class SuffixAutomaton:
    """All substrings of a text; a state is the dict of its moves."""

    def __init__(self, text: str):
        moves, link, length = [{}], [-1], [0]
        last = 0
        for char in text:
            new = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and char not in moves[p]:
                moves[p][char] = new
                p = link[p]
            if p != -1:
                q = moves[p][char]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    twin = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and moves[p].get(char) == q:
                        moves[p][char] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        for own in moves:  # moves hold states, not numbers
            for char, to in own.items():
                own[char] = moves[to]
        self.start = moves[0]

    def phrases(self, text: str) -> int:
        """Greedy parse into longest known phrases; an unknown character is a phrase of its own."""
        start, state, count = self.start, self.start, 0
        for char in text:
            to = state.get(char)
            if to is None:
                if state is not start:
                    count += 1
                    to = start.get(char)
                if to is None:
                    count, to = count + 1, start
            state = to
        return count + (state is not start)


class Parser:
    def __init__(self, samples: tuple[tuple[str, str], ...], most_cached: int = 400_000):
        self.languages = [name for name, _ in samples]
        self.automata = [SuffixAutomaton(text) for _, text in samples]
        self.weight = [math.log2(max(2, len(text))) for _, text in samples]
        self.known: dict[str, tuple[int, ...]] = {}
        self.most_cached = most_cached

    def entropies(self, found: list[str]) -> list[float]:
        total, size, known = [0] * len(self.languages), 0, self.known
        if len(known) > self.most_cached:
            known.clear()
        for word, n in Counter(found).items():
            counts = known.get(word)
            if counts is None:
                unit = f" {word} "
                counts = known[word] = tuple(a.phrases(unit) for a in self.automata)
            size += n * (len(word) + 2)
            for k, c in enumerate(counts):
                total[k] += n * c
        return [t * w / size for t, w in zip(total, self.weight)]

    def predict(self, text: str | None) -> tuple[str, float]:
        found = words(text)  # number signs such as a half count as word characters, but not as letters
        if not self.languages or not any(c.isalpha() for word in found for c in word):
            return UNKNOWN, 0.0
        bits = self.entropies(found)
        best = min(range(len(bits)), key=lambda k: (bits[k], self.languages[k]))
        return self.languages[best], 1 / sum(2 ** (4 * (bits[best] - b)) for b in bits)


@lru_cache(maxsize=2)
def parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(samples)


def learn(labelled: DataFrame, sample_chars: int = 40_000, sample_docs: int = 64, usual_chars: int = 5_000) -> tuple:
    """Sample text per language from ``labelled(doc_id, text, lang)``; shorter documents first."""
    rows = labelled.where("lang is not null and text is not null and trim(text) <> ''")
    order = Window.partitionBy("lang").orderBy(F.length("text") > usual_chars, F.xxhash64("doc_id", "text"))
    chosen = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample_docs)
    texts: dict[str, str] = {}
    for row in chosen.orderBy("lang", "_n").select("lang", "text").toLocalIterator():
        own = texts.get(row.lang, "")
        body = " " + " ".join(words(row.text)) + " "
        if not own or len(own) + len(body) <= sample_chars:
            texts[row.lang] = own + body
    return tuple(sorted(texts.items()))


def languages(docs: DataFrame, samples: tuple, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = parser(samples).predict
        for batch in slices(batches, "text"):
            made = [predict(body) for body in batch.column(1).to_pylist()]
            yield record_batch(schema, doc_id=batch.column(0).to_pylist(), lang_pred=[m[0] for m in made], score=[m[1] for m in made])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out_languages(docs: DataFrame) -> DataFrame:
    """Learn from ids of remainder 0 and 2, predict all; ``held_out`` marks remainder 1."""
    samples = learn(docs.where(remainder("doc_id", 3) != 1).select("doc_id", "text", "lang"))
    return languages(docs, samples).withColumn("held_out", remainder("doc_id", 3) == 1).select(
        "doc_id", "held_out", "lang_pred", "score")
