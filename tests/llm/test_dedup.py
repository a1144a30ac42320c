"""Groups of documents, vectors and byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from clipcatalog.llm import common, minmax_dedup, suffix_dedup, vector_dedup


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near_copies():
    """A base with copies at many distances, chains of copies, short, empty and very long texts."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    texts = [" ".join(base)] * 3 + [" ".join(base).upper()]
    for k in range(150):
        own = list(base)
        for _ in range(k % 12):
            own[rng.randrange(len(own))] = word()
        texts.append(" ".join(own))
    chain = [word() for _ in range(150)]
    for k in range(12):
        texts.append(" ".join(chain))
        chain[rng.randrange(150)] = word()
        chain[rng.randrange(150)] = word()
    texts += ["", None, "   \t\n", "one two", "One  two", "one two three", " ".join(word() for _ in range(20_000))]
    texts += ["café x y z w v", "ÀB c d e f", "àB c d e f", "x " * 400, "x " * 300]
    return texts


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(60)]
    found = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots({n for link in links for n in link}, links)
    assert found == {n: r for n, r in want.items() if n != r}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark):
    texts = near_copies()
    docs = spark.createDataFrame([(i + 5, t, 1, "k") for i, t in enumerate(texts)], "doc_id long, text string, n_shingles int, kept string")
    got = {r.doc_id: r for r in minmax_dedup.near_duplicates(docs).collect()}
    sets = {i + 5: shingles(t) for i, t in enumerate(texts)}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = roots(ids, links)
    for i in ids:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), want[i], want[i] == i)


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f")]
    got = minmax_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.component_id, r.kept) for r in got.collect() if r.doc_id is not None) == [(1, False), (1, True), (1, True)]
    assert got.count() == 4
    assert minmax_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_blocks_of_a_bucket(spark):
    """Small blocks find the same pairs as large ones, each once."""
    texts = near_copies()[:100]
    rows = []
    for i, t in enumerate(texts):
        own = minmax_dedup.shingle_set(t)
        values = minmax_dedup.signature(own)
        rows += [(int(b), i, i, len(own), values.tobytes()) for b in minmax_dedup.bands(values)]
    members = spark.createDataFrame(rows, "bucket long, rep long, component long, n_shingles long, signature binary")

    def pairs(block):
        found = minmax_dedup.leftover_pairs(members, block=block).where("role = 1").collect()
        out = [tuple(sorted(p)) for r in found for p in np.frombuffer(r.body, np.int64).reshape(-1, 2).tolist()]
        assert len(out) == len(set(out))
        return set(out)

    assert pairs(7) == pairs(1000) != set()


def brute_vectors(rows, cosine):
    keep = {}
    for i, v, label in rows:
        if v is not None and label is not None and None not in v:
            v = np.array(v, float)
            if len(v) and np.isfinite(v).all() and (v != 0).any():
                keep[i] = (v / np.linalg.norm(v), label)
    ids = sorted(keep)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :]
             if keep[a][1] == keep[b][1] and len(keep[a][0]) == len(keep[b][0]) and keep[a][0] @ keep[b][0] >= cosine]
    counts = Counter(n for link in links for n in link)
    return {i: (counts[i], r) for i, r in roots([r[0] for r in rows], links).items()}


@pytest.mark.parametrize("options", [{}, {"cell_rows": 40, "block": 16}])
def test_near_vectors(spark, options):
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1, None):
        centres = rng.normal(size=(12, 8))
        for k in range(260):
            rows.append((n, [float(x) for x in np.float32(centres[k % 12] + rng.normal(size=8) * 0.12)], label))
            n += 1
    for v in ([1.0] + [0.0] * 7,) * 40 + ([2.0] + [0.0] * 7, None, [], [0.0] * 8, [float("nan")] * 8, [None] * 8, [float("inf")] * 8, [1.0, 0.0],
                                          [1e-30] + [0.0] * 7):
        rows.append((n, v, 1))
        n += 1
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, rep int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_vectors(frame, **options).collect()}
    assert got == brute_vectors(rows, 0.98)
    assert vector_dedup.near_vectors(frame.limit(0)).count() == 0


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        mark = np.zeros(len(d) + 1, int)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                mark[k : k + length] = 1
        kept = bytes(b for b, m in zip(d, mark) if not m)
        out.append((len(d), int(mark.sum()), int((np.diff([0, *mark]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [2000, 2])
def test_repeats(spark, hot):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    shared, other = text(300), text(90)
    texts = [text(50) + shared + text(70), shared[40:] + text(10), text(30) + shared[:150] + text(30), other + text(20) + other,
             other, shared, shared, None, "", "a" * 500, "ab" * 100, text(40) + other[:60] + shared[200:] + text(9), text(3000) + other]
    texts += [text(rng.randrange(60)) + shared[60 : 60 + rng.randrange(200)] + text(rng.randrange(60)) for _ in range(25)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, "x", 0)], "doc_id long, text string, did int")
    got = suffix_dedup.remove_repeats(docs, length=64, gram=20, hot_rows=hot)
    by = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()}
    assert [by[i] for i in range(len(texts))] == brute_repeats(texts, 64)
    assert len(by) == len(texts) + 1
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_segments(monkeypatch, spark):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 100)
    data = np.random.default_rng(2).integers(97, 100, 900).astype(np.uint8)
    whole = suffix_dedup.owners(data, 64, 20)
    assert (whole[1][1:] == whole[2][:-1] + 1).all() and whole[2][-1] == 900 - 64
    for x, lo, hi in zip(*whole[:3]):
        assert hi <= x <= lo + 44


@pytest.mark.parametrize("hot", [2000, 2])
def test_repeats_across_segments(spark, hot):
    """Two occurrences each, that start, end or lie at the cuts of a long text."""
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    texts = []
    for k in range(20):
        shared = text(64 + 3 * k)
        texts += [text(90 + 7 * k) + shared + text(150), text(13 * k) + shared + text(rng.randrange(300))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, length=64, gram=20, hot_rows=hot, segment=100)
    by = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()}
    assert [by[i] for i in range(len(texts))] == brute_repeats(texts, 64)


def brute_shared_words(texts: list[str | None], words: int) -> list[int]:
    split = [(t or "").encode().split() for t in texts]
    held = Counter(w for s in split for w in {tuple(s[p : p + words]) for p in range(len(s) - words + 1)})
    out = []
    for s in split:
        covered = set()
        for p in range(len(s) - words + 1):
            if held[tuple(s[p : p + words])] > 1:
                covered |= set(range(p, p + words))
        out.append(len(covered))
    return out


@pytest.mark.parametrize("segment", [1 << 22, 40])
def test_shared_words(spark, segment):
    """Against brute force: passages of six words of other rows, with cuts, copies, repeats within a text and odd blanks."""
    rng = random.Random(14)
    text = lambda n: "".join(rng.choice(["ab", "b", "c", "ñé", "dd", "\u3000", "x"]) + rng.choice([" ", "\n", "  "]) for _ in range(n))
    texts = [None, "", "  ", "a b c d e", "own " * 30, text(90), text(3), "w" * 300]
    texts += [texts[5], texts[6], texts[3], texts[0]]
    for k in range(25):
        shared = text(4 + k)
        texts += [text(9 + 2 * k) + shared + text(20), text(k) + shared.replace("\n", " ") + text(rng.randrange(30)), text(2) + shared + shared]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.n_shared_words for r in suffix_dedup.remove_repeats(docs, words=6, word_gram=2, segment=segment).collect()}
    want = brute_shared_words(texts, 6)
    assert 0 < sum(map(bool, want)) < len(texts)
    assert [got[i] for i in range(len(texts))] == want


def test_passages_of_over_50_words(spark):
    """Passages shorter than 400 bytes are told although the bytes stay; repeats within one text are not."""
    rng = random.Random(15)
    text = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    planted, clean = [], []
    for k in range(10):
        passage = text(51 + k)
        planted += [f"{text(30 + k)} {passage} {text(200)}", f"{passage} {text(k)}"]
        short, inner = text(50), text(60)
        clean += [f"{text(40)} {short} {text(100)}", f"{text(90)} {short}", f"{inner} {text(9)} {inner}"]
    docs = spark.createDataFrame(list(enumerate(planted + clean)), "doc_id long, text string")
    rows = sorted(suffix_dedup.remove_repeats(docs).collect())
    assert [r.n_shared_words for r in rows] == [51 + k // 2 for k in range(20)] + [0] * 30
    assert not any(r.n_removed for r in rows)
