"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np

from clipcatalog.llm import ranked_search
from clipcatalog.llm.common import settled

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute(docs, items, k=20):
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    big_n, big_l = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in held:
            n, score = sum(c.values()), 0
            m = 100 - 25 + (25 * n * big_n) // big_l
            for t in words(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(scored[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, extra="", **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3, "doc_id")
    if extra:
        frame = frame.selectExpr("*", extra)
    asked = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in ranked_search.ranked_documents(frame, asked, **options).collect()), key=str)


def test_against_brute_force_over_many_shards(spark):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)] + ["Ünï", "日本"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60)))) for i in range(900)]
    docs += [(1000 + k, docs[k % 7][1]) for k in range(150)]  # ties
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 25)))) for k in range(25)]
    want = brute(docs, items)
    assert found(spark, docs, items, shard_bytes=20_000) == want
    assert found(spark, docs, items) == want


def test_several_parts_of_queries(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9)))) for i in range(300)]
    items = [(k, " ".join(rng.choices("abcdefghij", k=4))) for k in range(30)]
    index = settled(ranked_search.build_index(spark.createDataFrame(docs, "doc_id long, text string"), shard_bytes=500), "index")
    hits = ranked_search.search(index, spark.createDataFrame(items, "item_id long, text string"), k=3, part_terms=10)
    assert sorted((tuple(r) for r in hits.collect()), key=str) == brute(docs, items, 3)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "... !"), (4, "A b A"), (4, "A b A"), (None, "a B"), (5, "x " * 70_000 + "b"), (6, "\x7fé[b]")]
    items = [(1, "a b"), (1, "a b"), (1, "X x"), (2, None), (3, ""), (4, "unseen"), (None, "É b é")]
    want = brute(docs, items)
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, extra="doc_id + 1 as score") == want
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def test_common_terms_leave_blocks_packed():
    """Block maxima and list bounds spare most blocks of frequent terms."""
    writer, rng = ranked_search.ShardWriter(), random.Random(5)
    for i in range(6000):
        writer.add(i, "the of and " * rng.randint(1, 3) + f"rare{i % 400} " + "fill " * rng.randint(1, 50))
    rows = writer.pack(0).to_pylist()
    corpus = ranked_search.Corpus(rows[0]["df"], rows[0]["cf"])
    lists = {r["term"]: ranked_search.PostingList.read(
        r["heads"], r["pairs"], r["body"], r["df"], math.floor(1000 * math.log((2 * 6000 + 2) / (2 * r["df"] + 1))), corpus) for r in rows[1:]}
    own = [(lists[t], lists[t].weight) for t in ("the", "of", "rare7", "rare8")]
    docs, _ = ranked_search.best(own, np.frombuffer(rows[0]["body"], np.int64), corpus, 20)
    assert len(docs) == 20
    assert len(lists["the"].unpacked) < len(lists["the"].heads) / 2
