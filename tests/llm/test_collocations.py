"""Phrase collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np

from clipcatalog.llm import collocations as co

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for size in (1, 2, 3, 4):
                f.update((lang, tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    frequent = {k: v for k, v in f.items() if v >= least}
    over = Counter()
    for (lang, p), v in frequent.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                over[lang, p[i : i + size]] = max(over[lang, p[i : i + size]], v)
    out = {}
    for (lang, p), a in frequent.items():
        if len(p) < 2 or 100 * over[lang, p] >= 80 * a:
            continue
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -score) for lang, own in out.items()
                  for r, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1))


def found(spark, rows, **options):
    frame = spark.createDataFrame([(t, x, 1) for t, x in rows], "text string, lang string, rank int").repartition(3)
    return sorted(tuple(r) for r in co.collocations(frame, **options).collect())


def corpus(seed, docs=1500):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["Ñandú", "日本", "a b", "X"]
    sayings = ["in other words", "as soon as possible", "new york city hall", "Ñandú new york", "w1 w1 w1 w1"]
    rows = []
    for _ in range(docs):
        out = []
        for _ in range(rng.randint(0, 60)):
            out.append(rng.choice(sayings) if rng.random() < 0.3 else rng.choice(vocabulary))
            out.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "; "]))
        rows.append(("".join(out), rng.choice(["en", "en", "es", None, "und"])))
    return rows


def test_against_brute_force(spark):
    rows = corpus(1) + [(None, "en"), ("", None), (" .,\t", "de"), ("w1 " * 50_000, "es")] + [("new york city hall", "fr")] * 100
    want = brute(rows)
    assert len(want) > 20
    assert found(spark, rows) == want
    assert found(spark, rows, least=5, top=7) == brute(rows, 5, 7)


def test_no_rows(spark):
    assert found(spark, []) == [] and found(spark, [("a b", "en")]) == []


def test_every_frequent_phrase_survives_small_summaries():
    """Summaries with the least capacity, merged from many chunks, lose no value that is frequent."""
    rng, least = np.random.default_rng(2), 30
    values = np.concatenate([rng.integers(0, 1 << 40, 60_000), np.repeat(rng.integers(0, 1 << 40, 300), 30), np.repeat(77, 20_000)])
    rng.shuffle(values)
    values = values.astype(np.uint64)
    own = co.Summary(len(values) // least + 1, most_pending=2_000)
    for chunk in np.array_split(values, 40):
        own.add(*co.unpacked(co.packed(*np.unique(chunk, return_counts=True))))
    kept = own.survivors(least)
    assert own.lost and own.lost < least and len(own.values) <= own.capacity
    real, counts = np.unique(values, return_counts=True)
    assert set(real[counts >= least].tolist()) <= set(kept.tolist())
    assert len(kept) < len(real) / 2


def test_layout_follows_the_size():
    sizes = [co.Layout.of(10**k) for k in range(0, 20)]
    assert all(a.part <= b.part and a.kept <= b.kept and a.place <= b.place for a, b in zip(sizes, sizes[1:]))
    assert all(s.part <= 15 and s.place <= 27 and s.part + 3 <= s.place <= s.kept <= 64 for s in sizes)


def test_exact_scores_beyond_64_bits(spark):
    """The score's product passes 64 bits for large counts."""
    big = 9_000_000_000_000
    counts = spark.createDataFrame([(big, big, big + 1)], "a long, l long, r long").selectExpr(
        "cast(2000000 as decimal(10,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as s")
    assert counts.first().s == 2_000_000 * big // (2 * big + 1)
