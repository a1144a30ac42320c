"""Fingerprints against plain Python (the same 64-bit hash from another library)."""

import base64
import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from clipcatalog.llm import fingerprints as fp
from clipcatalog.llm.common import table

BLANKS = "[^\x20\x09-\x0d]+"


def shingles(text, width=5):
    words, out = re.findall(BLANKS, (text or "").lower()), set()
    for i in range(len(words)):
        h = 42
        for w in words[max(0, i - width + 1) : i + 1]:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h % 2**64)
        out.add(h - 2**64 if h >= 2**63 else h)
    return out


def sketch(text, k):
    return sorted(shingles(text))[:k]


def printed(values):
    return base64.b64encode(b"".join((v % 2**64).to_bytes(8, "big") for v in values)).decode()


def likeness(a, b, k):
    both = sorted(set(a) | set(b))[:k]
    return len(set(both) & set(a) & set(b)) / len(both) if both else 1.0


def brute(docs, k):
    by_id = {}
    for i, t in docs:
        by_id.setdefault(i, []).append(t or "")
    first = {i: min(ts, key=lambda t: (lambda h: h - 2**64 if h >= 2**63 else h)(xxhash.xxh64_intdigest(t.encode(), seed=42)))
             for i, ts in by_id.items()}
    order = sorted((i for i in by_id if i is not None), reverse=True) + ([None] if None in by_id else [])
    follows = {i: order[(n + 1) % len(order)] for n, i in enumerate(order)}
    out = []
    for i, t in docs:
        t = t or ""
        other = first[follows[i]]
        third = len(t) // 3
        edited = t[: len(t) - third] + other[:third]
        a, b, c = (sketch(x, k) for x in (t, edited, other))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), printed(a), printed(b), likeness(a, b, k), likeness(a, c, k)))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def found(frame, **options):
    return sorted((tuple(r) for r in fp.edited_fingerprints(frame, **options).select(*COLUMNS).collect()), key=str)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == brute(rows, fp.K)
    wide = found(docs.repartition(7))
    assert wide == brute(rows, fp.K)
    near = [(r[5], r[6]) for r in wide]
    assert sum(a > b for a, b in near) > 0.95 * len(near)


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = [(9, "Añb c\td \n e f g"), (7, None), (5, ""), (5, "second text of five"), (3, " \t"), (2, "日本 語 x" * 40), (-4, "one"),
            (None, "no id here at all, none"), (None, None), (1, " ".join(rng.choice("abcdefgh") * 3 for _ in range(60_000))),
            (-(2**63), "least id"), (2**63 - 1, "most id"), (4, "Same Text"), (6, "same text")]
    for k in (4, 128):
        assert found(spark.createDataFrame(rows, "doc_id long, text string"), k=k) == brute(rows, k)
    clash = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, sketch int, missing int")
    assert found(clash) == brute(rows, fp.K)
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []
    alone = [(1, "abcdef ghijkl")]
    assert found(spark.createDataFrame(alone, "doc_id long, text string")) == brute(alone, fp.K)
    twice = [(3, "a b c"), (3, "a b c"), (2, "d e f g h i j")]
    assert found(spark.createDataFrame(twice, "doc_id long, text string")) == brute(twice, fp.K)


def test_merge_estimates_and_round_trip(spark):
    rng = random.Random(1)
    pool = [f"w{k}" for k in range(4000)]
    a = " ".join(rng.choices(pool, k=6000))
    b = a[: len(a) // 2] + " " + " ".join(rng.choices(pool, k=6000))
    rows = spark.createDataFrame([("a", a), ("b", b), ("e", "")], "name string, text string")
    own = fp.sketched(rows).withColumn("print", fp.fingerprint(F.col("sketch")))
    back = own.withColumn("again", fp.from_fingerprint("print"))
    assert back.where("again <> sketch").count() == 0
    whole = fp.merged_sketches(own.withColumn("part", F.lit(1)), ["part"]).first().sketch
    assert whole == sorted(shingles(a) | shingles(b))[:fp.K]
    sets = shingles(a), shingles(b)
    pair = own.where("name = 'a'").select(F.col("sketch").alias("x")).join(own.where("name = 'b'").select(F.col("sketch").alias("y")))
    got = pair.select(fp.resemblance(F.col("x"), F.col("y")), fp.containment(F.col("x"), F.col("y")),
                      fp.distinct_shingles(F.col("x")), fp.merged(F.col("x"), F.col("y"))).first()
    both = len(sets[0] & sets[1])
    assert abs(got[0] - both / len(sets[0] | sets[1])) < 0.15
    assert abs(got[1] - both / len(sets[0])) < 0.25
    assert abs(got[2] / len(sets[0]) - 1) < 0.3
    assert got[3] == whole


def test_native_plan(spark):
    plan = fp.edited_fingerprints(table(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "MapPartitions"))
