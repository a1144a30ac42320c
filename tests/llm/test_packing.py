"""Both packings against round trips and the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from clipcatalog.llm import packing_plan, token_output, tokens

TEXTS = [None, "", "a", "hello world " * 900, "hello world " * 900, " \n\n  tabs\tand  spaces 　  x", "é中文🙂 <|endoftext|> it's 12345",
         "word " * 30_000, "x" * 5_000, "‍́ mixed \r\n line's end  "]


def frame(spark, n=40):
    rows = [(i, TEXTS[i % len(TEXTS)], "s", 1) for i in range(n)] + [(None, "no id", "s", 1), (3, "twice", "s", 1), (3, "twice", "s", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int")


OWN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def reference(text):
    return [*OWN.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids():
    for text in TEXTS:
        assert tokens.encoder().document(text).tolist() == reference(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_random(text):
    assert tokens.encoder().document(text).tolist() == reference(text)


@pytest.mark.parametrize("text", [" ", "\n", "^", "\u00a0", "ab", "7", " \n"])
def test_ids_of_very_long_runs(text):
    """A million equal signs neither end the worker nor change the ids."""
    body = "a" + text * (1_000_000 // len(text)) + " b"
    want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(body, add_special_tokens=False).ids
    assert tokens.encoder().encode(body) == want
    for size in (tokens.LONG_BLANKS - 1, tokens.LONG_BLANKS, tokens.LONG_BLANKS + 1):
        body = "a" + text * (size // len(text)) + "b"
        assert tokens.encoder().encode(body) == tokens.encoder()._full.encode(body, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan(counts):
    used, seen = {}, {}
    for length, rank, n, first, offset in packing_plan.plan(counts, 64):
        seen.setdefault(length, []).extend(range(rank, rank + n))
        for s in range(first, first + n):
            used.setdefault(s, []).append((offset, length))
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in counts.items()}
    for spots in used.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 64
    lengths = [k for k, n in counts.items() for _ in range(n)]
    assert len(used) == len(token_output.best_fit(lengths, 64))  # planning on counts packs as tightly


def check_pieces(pieces, docs, capacity):
    want = {}
    for key, text, *_ in docs:
        want.setdefault(key, []).append(reference(text))
    assert sum(p["length"] for p in pieces) == sum(len(i) for v in want.values() for i in v)
    for p in pieces:
        assert any(zlib.crc32(np.array(i[p["start"]: p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"] for i in want[p["doc_id"]])
    home = {}
    for p in pieces:
        home.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for spots in home.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(home)


def test_planned(spark):
    docs = frame(spark)
    pieces = [r.asDict() for r in packing_plan.packed_documents(docs).collect()]
    n = check_pieces(pieces, docs.collect(), 1024)
    assert n <= sum(p["length"] for p in pieces) / 1024 * 1.05 + 1
    cut = [p for p in pieces if p["doc_id"] == 7]
    assert [p["length"] for p in sorted(cut, key=lambda p: p["piece"])][1:] == [1024] * (len(cut) - 1)
    assert packing_plan.packed_documents(docs.limit(0)).count() == 0


def test_matrix(spark):
    docs = frame(spark)
    want = sorted((r.doc_id if r.doc_id is not None else -1, reference(r.text)) for r in docs.collect())
    rows = token_output.packed_sequences(docs, block_tokens=20_000).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    parts = []
    for r in rows:
        ids, places = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(places) == 1024 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        for a, b, key, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.starts):
            assert places[a:b].tolist() == list(range(b - a))
            parts.append((key if key is not None else -1, start, ids[a:b].tolist()))
        assert not ids[r.n_tokens:].any()
    got = sum(len(p[2]) for p in parts)
    assert got == sum(len(i) for _, i in want)
    for key, ids in want:
        if key not in (3, -1):
            assert [x for _, _, p in sorted(q for q in parts if q[0] == key) for x in p] == ids
    assert token_output.digest(token_output.packed_sequences(docs.limit(0))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_best_fit(lengths):
    """The tree finds what a plain search over all sequences finds."""
    free, want = [], []
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        best = min((f for f in free if f >= lengths[k]), default=None)
        if best is None:
            free.append(32 - lengths[k])
        else:
            free[free.index(best)] -= lengths[k]
    got = token_output.best_fit(lengths, 32)
    assert sorted(x for s in got for x in s) == list(range(len(lengths)))
    assert sorted(32 - sum(lengths[x] for x in s) for s in got) == sorted(free)
