"""The pipeline against plain Python on the smallest tables."""

import math
import random

import corpus_pipeline
from clipcatalog.llm import minmax_dedup, secrets, toxic_neighbours
from clipcatalog.llm.common import settled, table

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(settled(stage(spark, frames[-1], FOLDER), name))
    assert all(f.columns == columns for f in frames[:-1])
    rows = [{r.doc_id: r for r in f.collect()} for f in frames[:-1]]

    scores = {r.doc_id: r.score for r in toxic_neighbours.score(docs, toxic_neighbours.fitted(docs, table(spark, FOLDER, "labels"))).collect()}
    assert set(rows[1]) == {i for i, s in scores.items() if s < 0.5}

    sets = {i: shingles(r.text) for i, r in rows[1].items()}
    up = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= corpus_pipeline.NEAR_PERCENT * len(sets[a] | sets[b]):
                low, high = sorted((up[a], up[b]))
                up = {i: low if r == high else r for i, r in up.items()}
    assert set(rows[2]) == {i for i, r in up.items() if i == r}

    items = [r.text.encode().lower().split() for r in table(spark, FOLDER, "benchmark").collect()]
    for i in set(rows[2]) - set(rows[3]):
        assert any(set(map(tuple, zip(*(w[k:] for k in range(5))))) & shingles(rows[2][i].text) for w in items)
    for i in rows[3]:  # no clean document lost, no whole item left
        assert not any(b" ".join(w) in b" ".join(rows[3][i].text.encode().lower().split()) for w in items)

    assert set(rows[4]) == set(rows[3])
    for i, r in rows[4].items():
        assert r.text == secrets.masked(rows[3][i].text) and r.n_chars == len(r.text) and r.source == rows[3][i].source
    pieces = frames[-1].collect()
    assert {p.doc_id for p in pieces} == set(rows[4])
    fill = {}
    for p in pieces:
        fill[p.sequence_id] = fill.get(p.sequence_id, 0) + p.length
    assert max(fill.values()) <= 1024


def through(spark, rows):
    """All stages over rows with extra columns whose names the operators use themselves."""
    docs = spark.createDataFrame([(*r, "k", 1, 2.5) for r in rows], "doc_id long, text string, kept string, n_shingles int, bins double")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert docs.columns == columns
        docs = settled(stage(spark, docs, FOLDER), name)
    return docs.collect()


def test_odd_rows(spark):
    rows = [(None, "x"), (1, None), (2, ""), (3, "y z"), (4, "y z"), (4, "y z"), (5, "word " * 30_000), (6, " " * 1_000_000)]
    pieces = through(spark, rows)
    assert {p.doc_id for p in pieces} == {None, 1, 2, 3, 5, 6}
    assert sum(p.length for p in pieces if p.doc_id == 6) == 1_000_001
    assert through(spark, []) == []


def test_near_duplicate_stage_links_at_80(spark):
    """A 200-word text with four scattered edited words (176 of 216 shingles) goes; brute force at 80."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(200)]
        for edits in ((), (30, 80, 120, 170), (20, 60, 100, 140, 180), (50, 90, 150)):
            texts.append(" ".join(word() if k in edits else w for k, w in enumerate(base)))
    sets = [shingles(t) for t in texts]
    assert len(sets[0] & sets[1]) == 176 and len(sets[0] | sets[1]) == 216
    up = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            if 100 * len(sets[a] & sets[b]) >= corpus_pipeline.NEAR_PERCENT * len(sets[a] | sets[b]):
                low, high = sorted((up[a], up[b]))
                up = [low if r == high else r for r in up]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in enumerate(up) if i == r}


def test_estimate_bound():
    """The fewest equal values of a linked pair leave out at most one in a million, at any threshold."""
    for percent, values in ((85, 120), (80, 120), (80, 180)):
        least, p = minmax_dedup.least_equal(percent, values), percent / 100
        tail = lambda n: sum(math.comb(values, k) * p**k * (1 - p) ** (values - k) for k in range(n))
        assert tail(least) <= 1e-6 < tail(least + 1)
