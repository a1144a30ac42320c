"""Token ids of whole texts with a public byte-level vocabulary."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k"
END = 2
#: the rank form recurses once per blank of a run and fails on some hundred thousand
LONG_BLANKS = 10_000
_LONG_BLANKS = re.compile(r"\s{%d}" % LONG_BLANKS)


class Encoder:
    """Ids of a vocabulary that comes both as ``.json`` and as ``.tiktoken`` ranks.

    The rank form gives the same ids several times faster.  Texts that hold the string of
    a special token go to the ``.json`` form, which reads it as that token, and so do texts
    with a very long run of blanks.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._ranks = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._full = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self._special = [t.content for t in self._full.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> list[int]:
        if any(s in text for s in self._special) or (len(text) >= LONG_BLANKS and _LONG_BLANKS.search(text)):
            return self._full.encode(text, add_special_tokens=False).ids
        return self._ranks.encode_ordinary(text)

    def document(self, text: str | None, end: int = END) -> np.ndarray:
        """Ids of a document and its end id; null is an empty text."""
        ids = self.encode(text) if text else []
        ids.append(end)
        return np.array(ids, dtype="<u4")


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The encoder of this process; it is built once per Python worker."""
    return Encoder(vocabulary)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be shorter than ``capacity``."""
    first = length % capacity or capacity
    starts = [0, *range(first, length, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length])]
