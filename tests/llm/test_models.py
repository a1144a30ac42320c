"""Language, toxicity, quality and decontamination on small fixtures."""

import math
import random

import numpy as np
import pytest

from clipcatalog.llm import language_id, quality_bayes, tiling_decontam, toxic_neighbours
from pyspark.sql import functions as F

rng = random.Random(11)


def prose(syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n))


TONGUES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "er"], "cc": ["eau", "ç", "ion", "les"]}


def test_suffix_automaton():
    text = "abracadabra"
    automaton = language_id.SuffixAutomaton(text)

    def phrases(body):
        count, at = 0, 0
        while at < len(body):
            end = at
            while end < len(body) and body[at : end + 1] in text:
                end += 1
            at, count = max(end, at + 1), count + 1
        return count

    for _ in range(300):
        body = "".join(rng.choice("abcdrx") for _ in range(rng.randrange(12)))
        assert automaton.phrases(body) == phrases(body)


def test_languages(spark):
    rows = [(i, prose(TONGUES[k], 60), k, "s") for i, k in enumerate(list(TONGUES) * 40)]
    rows += [(200, None, "aa", "s"), (201, "", "aa", "s"), (202, "123 !!", None, "s"), (203, "ka " * 50_000, None, "s"), (None, "x", None, "s"), (204, "½ ² ①", None, "s")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, source string, score double")
    got = {r.doc_id: r for r in language_id.held_out_languages(docs).collect()}
    held = [r for r in rows[:120] if got[r[0]].held_out]
    assert len(held) > 20 and all(got[r[0]].lang_pred == r[2] for r in held)
    assert [got[i].lang_pred for i in (200, 201, 202, 203, 204)] == ["und", "und", "und", "aa", "und"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language_id.held_out_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.held_out_languages(docs.limit(0)).count() == 0


def test_block_max_is_exact():
    gen = np.random.default_rng(1)
    vectors = []
    for _ in range(300):
        at = np.sort(gen.choice(40, gen.integers(1, 8), replace=False))
        w = gen.random(len(at))
        vectors.append((at, w / np.linalg.norm(w)))
    dense = np.zeros((300, 40))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    index = toxic_neighbours.BlockMaxIndex(list(range(300)), [i % 2 for i in range(300)], vectors, 40, block=16)
    for i in range(60):
        near = index.nearest(*vectors[i], 10)
        want = np.sort(dense @ dense[i])[::-1][:10]
        assert np.allclose([c for c, _ in near], want[want > 0])
        for c, place in near:
            assert abs(dense[index.ids[place]] @ dense[i] - c) < 1e-9
    assert index.nearest(np.zeros(0, int), np.zeros(0), 5) == []


def dense_scores(docs, labels, k=15):
    """Scores with plain loops: idf, relevance, cosine with every example, votes and calibration together."""
    known = {}
    for i, y in labels:
        if i is not None and y is not None:
            known[i] = max(y, known.get(i, 0))
    examples = {}
    for i, t in docs:
        if t is not None and i in known:
            old = examples.get(t)
            examples[t] = (min(i, old[0]), max(known[i], old[1])) if old else (i, known[i])
    examples = sorted((i, y, t) for t, (i, y) in examples.items())
    n1 = sum(y for _, y, _ in examples)
    n = len(examples)
    bags = [toxic_neighbours.words(t) for _, _, t in examples]
    every = [toxic_neighbours.words(t) for _, t in docs]
    weight = {}
    for term in {w for b in bags for w in b}:
        a = sum(y for b, (_, y, _) in zip(bags, examples) if term in b)
        m = sum(term in b for b in bags)
        ratio = 0.0
        for both, row, column in ((a, m, n1), (m - a, m, n - n1), (n1 - a, n - m, n1), (n - n1 - m + a, n - m, n - n1)):
            ratio += both * math.log(both * n / (row * column)) if both else 0.0
        idf = math.log((len(docs) + 1) / (sum(term in b for b in every) + 1))
        weight[term] = idf * (0.1 + math.sqrt(max(0.0, 2 * ratio)))

    def unit(bag):
        v = {w: (1 + math.log(c)) * weight[w] for w, c in bag.items() if w in weight}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if norm else {}

    units = [unit(b) for b in bags]

    def vote(v, leave=None):
        near = sorted(((sum(x * u.get(w, 0.0) for w, x in v.items()), i) for i, u in enumerate(units) if i != leave), reverse=True)[:k]
        near = [(c, i) for c, i in near if c > 0]
        share = sum(c * c for c, _ in near)
        return sum(c * c * examples[i][1] for c, i in near) / share if share else None

    own = [vote(u, i) for i, u in enumerate(units)]
    steps = toxic_neighbours.monotone(np.array([v for v in own if v is not None]), np.array([e[1] for e, v in zip(examples, own) if v is not None], float))
    bare = [e[1] for e, v in zip(examples, own) if v is None]
    without = (sum(bare) + (n1 + 0.5) / (n + 1)) / (len(bare) + 1)
    out = []
    for bag in every:
        v = vote(unit(bag))
        out.append(without if v is None else float(steps[1][max(0, np.searchsorted(steps[0], v + 1e-9, side="right") - 1)]))
    return out


def test_scores_against_dense_brute_force(spark):
    own = random.Random(21)
    pool = [f"wort{a}" for a in "abcdefghijklmnopqrstuvwxyz"] + ["common", "words"]
    docs = [(i, " ".join(own.choices(pool, k=own.randint(1, 12))) + (" vilest" if i % 5 == 0 else "")) for i in range(120)]
    docs += [(200, None), (201, "unknown only"), (202, docs[3][1])]
    labels = [(i, int(i % 5 == 0)) for i in range(100)] + [(202, 0), (None, 1), (7, None)]
    model = toxic_neighbours.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxic_neighbours.score(spark.createDataFrame(docs, "doc_id long, text string"), model).collect()}
    want = dense_scores(docs, labels)
    close = [abs(got[i] - s) < 1e-6 for (i, _), s in zip(docs, want)]
    assert sum(close) >= len(close) - 2  # votes that tie at the k-th cosine may fall either way


def test_rare_toxic_word_is_evidence(spark):
    """A word that only four labelled examples hold still finds them."""
    own = random.Random(22)
    text = lambda: " ".join("".join(own.choice("abcdefgh") for _ in range(3)) for _ in range(40))
    rows = [(i, text() + (" zonkwort" if i < 4 else " grubbix" if i % 9 == 0 else ""), int(i < 4 or i % 9 == 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxic_neighbours.fit(docs, labels)
    new = spark.createDataFrame([(1, "zonkwort zonkwort"), (2, text() + " zonkwort zonkwort"), (3, text())], "doc_id long, text string")
    got = {r.doc_id: r for r in toxic_neighbours.score(new, model, shown=4).collect()}
    assert got[1].score >= 0.5 and {e.doc_id for e in got[1].evidence} == {0, 1, 2, 3} and all(e.toxic == 1 for e in got[1].evidence)
    assert got[2].score >= 0.5 and got[3].score < 0.5


def test_monotone():
    steps, rates = toxic_neighbours.monotone(np.array([0, 0, 0.2, 0.5, 0.7, 1, 1]), np.array([0, 0, 1, 0, 1, 1, 1.0]))
    assert (np.diff(steps) > 0).all() and (np.diff(rates) >= 0).all() and rates[0] < 0.5 < rates[-1]


def test_toxicity(spark):
    def text(bad):
        words = prose(["ka", "lo", "mi", "tu", "re", "so"], 40).split()
        if bad:
            words[rng.randrange(40)] = rng.choice(["grubbix", "grubbol", "zonkle"])
        return " ".join(words)

    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    extra = [(900, None, 1), (901, "", 0), (902, "grubbix " * 30_000, 1), (902, "grubbix", 1)]
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows + extra], "doc_id long, text string, predicted int")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(3, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    got = toxic_neighbours.held_out_scores(docs, labels).collect()
    by = {r.doc_id: r for r in got}
    held = [(i, y) for i, _, y in rows if by[i].held_out]
    assert np.mean([by[i].predicted == y for i, y in held]) > 0.97
    assert by[902].predicted == 1 and by[901].predicted == by[900].predicted == 0 and len(got) == docs.count()
    assert all(0 <= r.score <= 1 for r in got)
    model = toxic_neighbours.fitted(docs, labels)
    assert toxic_neighbours.score(docs, model).where("doc_id = 902").first().evidence[0].toxic == 1
    nothing = toxic_neighbours.held_out_scores(docs, labels.limit(0)).collect()
    assert {r.predicted for r in nothing} == {0}
    assert toxic_neighbours.held_out_scores(docs.limit(0), labels).count() == 0


def test_quality(spark):
    good = lambda: prose(["ka", "lo", "mi", "tu", "re"], 60).capitalize() + "."
    junk = lambda: "###!! " * 40 + "BUY " * 30
    rows = [(i, junk() if i % 3 == 0 else good(), f"h{i % 7}" if i % 5 else "hot", "p") for i in range(300)]
    rows += [(900, None, None, None), (901, "", "h1", None), (902, good() * 3000, "new", "p"), (902, good(), "new", "p")]
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, source string, lang string, kept boolean")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(200)] + [(5, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_bayes.document_quality(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(r.kept == (r.doc_id % 3 != 0) for r in got if r.doc_id < 300)
    assert all(0 < r.path_rate < 1 and 0 <= r.score <= 1 for r in got)
    assert len(quality_bayes.document_quality(docs, labels.limit(0)).collect()) == len(rows)
    assert quality_bayes.document_quality(docs.limit(0), labels).count() == 0


def test_sparse_sites_shrink(spark):
    sites = spark.createDataFrame([("big", 90.0, 100), ("other", 20.0, 100), ("one", 1.0, 1)], "host string, good double, n long")
    got = {r.host: r.rate for r in quality_bayes.shrunk(sites, ["host"], F.lit(0.5), "rate").collect()}
    assert got["big"] > 0.85 and got["other"] < 0.25 and 0.5 < got["one"] < 0.95


def brute_tiling(item, doc, width):
    used_i, used_d, covered = set(), set(), 0
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                       and i + n not in used_i and j + n not in used_d):
                    n += 1
                if n >= width and (best is None or n > best[0]):
                    best = (n, i, j)
        if best is None:
            return covered
        n, i, j = best
        used_i.update(range(i, i + n))
        used_d.update(range(j, j + n))
        covered += n


def test_tiling_brute_force():
    for _ in range(150):
        item = [rng.choice("abc") for _ in range(rng.randrange(1, 25))]
        doc = [rng.choice("abc") for _ in range(rng.randrange(1, 40))]
        if rng.random() < 0.7:
            cut = rng.randrange(len(item))
            doc[len(doc) // 2 : len(doc) // 2] = item[cut:] + item[:cut]
        items = tiling_decontam.Items([(1, " ".join(item))], 5)
        found = list(items.compare(" ".join(doc), 0.01))
        assert (found[0][1] if found else 0) == brute_tiling(item, doc, min(5, len(item)))


@pytest.mark.parametrize("block_words", [2_000_000, 30])
def test_contaminated(spark, block_words):
    items = {1: prose(["ka", "lo", "mi"], 40), 2: prose(["tu", "re", "so"], 30), 3: "three short words", 4: None, 5: ""}
    words = items[1].split()
    reordered = " ".join(words[20:] + ["zz"] * 9 + words[:20])
    docs = [(1, prose(["x", "y"], 50) + " " + items[1].upper() + " z"), (2, reordered), (3, " ".join(words[:8]) + " q"), (4, None), (5, ""),
            (6, "a three  short\nwords b"), (7, (prose(["x", "y"], 20_000) + " " + items[2])), (8, prose(["x", "y"], 60)), (1, "none")]
    got = tiling_decontam.contaminated(
        spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int"),
        spark.createDataFrame([(k, v, 1) for k, v in items.items()], "item_id long, text string, doc_id int"), block_words=block_words)
    rows = {(r.doc_id, r.item_id): r for r in got.collect()}
    assert set(rows) == {(1, 1), (2, 1), (6, 3), (7, 2)}
    assert rows[2, 1].coverage == 1 and len(rows[2, 1].tiles) == 2
    empty = spark.createDataFrame([], "item_id long, text string")
    assert tiling_decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), empty).count() == 0
