"""The helpers that run in Python, as Arrow batches.

They are sent to executors by value, so workers do not need this package.
"""

from __future__ import annotations

import html
import json
import re
import sys
import unicodedata

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcatalog import vocab
from clipcatalog.functions import columns

CAPTION_KEYS = tuple(vocab.CAPTION_JSON_KEYS)
ID_KEYS = tuple(vocab.CAPTION_ID_KEYS)
ESCAPED = re.compile(r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}")


def decode_escape(match: re.Match) -> str:
    units = [int(u, 16) for u in match.group(0).split("\\u")[1:]]
    raw = b"".join(u.to_bytes(2, "big") for u in units)
    return raw.decode("utf-16-be", errors="replace")


SLICE = 256  # texts that are Python objects at one time


def by_slices(make, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """An Arrow batch a few values at a time, so that a worker holds the batch, its result and little else."""
    if not len(columns[0]):
        return pa.array([], kind)
    return pa.concat_arrays([
        pa.array([make(*row) for row in zip(*(c.slice(at, SLICE).to_pylist() for c in columns))], kind)
        for at in range(0, len(columns[0]), SLICE)])


def texts_by_slices(change, values: pa.Array) -> pa.Array:
    return by_slices(lambda v: None if v is None else change(v), pa.string(), values)


def unescaped(text: str) -> str:
    return ESCAPED.sub(decode_escape, html.unescape(text))


@F.arrow_udf(T.StringType())
def nfkc_batch(values: pa.Array) -> pa.Array:
    return texts_by_slices(lambda v: unicodedata.normalize("NFKC", v), values)


@F.arrow_udf(T.StringType())
def unescape_batch(values: pa.Array) -> pa.Array:
    return texts_by_slices(unescaped, values)


@F.arrow_udf(T.StringType())
def html_batch(values: pa.Array) -> pa.Array:
    return texts_by_slices(html.unescape, values)


# --- features of a text, from one read of it ------------------------------------

VOCABULARIES = {"recipe": vocab.RECIPE_WORDS, "ingredient": vocab.INGREDIENT_WORDS, "verb": vocab.COOKING_VERBS, "signal": vocab.RECIPE_SIGNALS}


def term_matcher(vocabularies: dict[str, list[str]]) -> tuple[re.Pattern, dict[str, int]]:
    """One pattern for all terms, and per term the bits of the vocabularies it satisfies.

    A match consumes a first character and looks ahead for the longest term that begins
    there; the terms that begin there as well are its prefixes, so their bits are its own.
    Every position is looked at, so overlapping terms are all seen.
    """
    terms = sorted({t for own in vocabularies.values() for t in own})
    bits = {t: sum(1 << k for k, own in enumerate(vocabularies.values()) if any(t.startswith(o) for o in own)) for t in terms}

    def branch(tails: list[str]) -> str:
        heads: dict[str, list[str]] = {}
        for tail in tails:
            if tail:
                heads.setdefault(tail[0], []).append(tail[1:])
        parts = "|".join(re.escape(h) + branch(own) for h, own in heads.items())
        return f"(?:{parts})?" if parts and "" in tails else f"(?:{parts})" if parts else ""

    heads = dict.fromkeys(t[0] for t in terms)
    pattern = "|".join(f"{re.escape(h)}(?=({branch([t[1:] for t in terms if t[0] == h])}))" for h in heads)
    return re.compile(pattern), bits


TERMS, TERM_BITS = term_matcher(VOCABULARIES)
ALL_BITS = (1 << len(VOCABULARIES)) - 1
DIGITS = re.compile(r"\d+")
AMOUNT = re.compile(
    rf"\b(?:\d+(?:[.,]\d+)?\s?(?:{vocab.QUANTITY_UNITS})\b|\d+\s?/\s?\d+\b|\d{{2,3}}\s?(?:{vocab.TEMPERATURE_UNITS})\b)")
NOT_ASCII = re.compile(r"[^\x00-\x7f]+")
NO_LETTER = bytes(b for b in range(256) if not (b < 128 and chr(b).isalpha()))
NO_DIGIT = bytes(b for b in range(256) if not (b < 128 and chr(b).isdecimal()))


_native: list = []


def native_terms():
    """The same terms as an Aho-Corasick automaton, where the workers have one; made once per task."""
    if not _native:
        try:
            import ahocorasick
        except ModuleNotFoundError:
            _native.append(None)
        else:
            own = ahocorasick.Automaton()
            for term, bits in TERM_BITS.items():
                own.add_word(term, bits)
            own.make_automaton()
            _native.append(own)
    return _native[0]


def term_bits(low: str, native=None) -> int:
    found = 0
    hits = (bits for _, bits in native.iter(low)) if native else (
        TERM_BITS[low[m.start() : m.end(m.lastindex)]] for m in TERMS.finditer(low))
    for bits in hits:
        found |= bits
        if found == ALL_BITS:
            break
    return found


def letters_and_digits(text: str) -> tuple[int, bool]:
    """Number of letters, and whether there is any digit."""
    body = text.encode("utf-8", "surrogatepass")
    count, digit = len(body.translate(None, NO_LETTER)), len(body.translate(None, NO_DIGIT)) > 0
    if len(body) > len(text):
        rest = "".join(NOT_ASCII.findall(text))
        count += sum(map(str.isalpha, rest))
        digit = digit or any(map(str.isdecimal, rest))
    return count, digit


def has_amount(low: str) -> bool:
    return any(AMOUNT.match(low, run.start()) for run in DIGITS.finditer(low))


FEATURES = T.StructType([
    T.StructField("letters", T.DoubleType()), T.StructField("amount", T.BooleanType()),
    *[T.StructField(name, T.BooleanType()) for name in VOCABULARIES],
])


FEATURES_ARROW = pa.struct([("letters", pa.float64()), ("amount", pa.bool_()), *[(name, pa.bool_()) for name in VOCABULARIES]])


def features(text: str | None, native=None) -> dict:
    text = text or ""
    low = text.lower()
    bits = term_bits(low, native)
    letters, digit = letters_and_digits(text)
    return {"letters": letters / len(text) if text else 0.0, "amount": digit and has_amount(low),
            **{name: bool(bits >> k & 1) for k, name in enumerate(VOCABULARIES)}}


@F.arrow_udf(FEATURES)
def features_batch(values: pa.Array) -> pa.Array:
    native = native_terms()
    return by_slices(lambda v: features(v, native), FEATURES_ARROW, values)


# --- evidence text and its features in one helper: a plan needs one worker where it would need three ---

WHITE_SPACE = columns.WHITESPACE
BLANKS, EMPTY_LINES = re.compile(r"[ \t]{2,}|\t"), re.compile(r"\n{3,}")
EVIDENCE = T.StructType([T.StructField("text", T.StringType()), *FEATURES.fields])
EVIDENCE_ARROW = pa.struct([("text", pa.string()), *FEATURES_ARROW])


def collapsed(text: str) -> str:
    return EMPTY_LINES.sub("\n\n", BLANKS.sub(" ", text)).strip(WHITE_SPACE)


def caption_text(text: str) -> str:
    return collapsed(unescaped(text).replace("\\n", "\n").replace("\\/", "/"))


def evidence_row(text: str, native=None) -> dict:
    clean = collapsed(unicodedata.normalize("NFKC", text).replace("\r", "\n"))
    return {"text": clean, **features(clean, native)}


@F.arrow_udf(EVIDENCE)
def evidence_batch(values: pa.Array) -> pa.Array:
    native = native_terms()
    return by_slices(lambda v: evidence_row(v or "", native), EVIDENCE_ARROW, values)


@F.arrow_udf(EVIDENCE)
def caption_evidence_batch(values: pa.Array) -> pa.Array:
    native = native_terms()
    return by_slices(lambda v: evidence_row(caption_text(v or ""), native), EVIDENCE_ARROW, values)


# --- page text -------------------------------------------------------------------

BLOCK_TAG = re.compile(r"<(?:(/)(?:p|li|h1|h2|h3)|(?:p|li|h1|h2|h3)(?:\s[^>]*)?)>", re.I | re.A)
ANY_TAG = re.compile(r"<[^>]+>")
DROPPED = {tag: (re.compile(f"<{tag}", re.I | re.A), re.compile(f"</{tag}>", re.I | re.A)) for tag in ("script", "style", "noscript", "svg")}


def without_elements(body: str, tag: str) -> str:
    """Each element of a kind, from its tag to the next end tag, as a blank; one without an end stays."""
    opens, closes = DROPPED[tag]
    out, at = [], 0
    while start := opens.search(body, at):
        inner = body.find(">", start.end())
        end = closes.search(body, inner + 1) if inner >= 0 else None
        if end is None:
            break
        out += [body[at : start.start()], " "]
        at = end.end()
    return "".join(out) + body[at:] if at else body


def block_texts(page: str) -> list[str]:
    """Text of each stretch between block tags that lies inside a block; one walk over the tags."""
    body = page.replace("\x01", "")
    for tag in DROPPED:
        body = without_elements(body, tag)
    depth, at, out = 0, 0, []

    def stretch(piece: str) -> None:
        last = piece.rfind(">") + 1  # signs behind the last tag end can be no tag
        text = (ANY_TAG.sub(" ", piece[:last]) + piece[last:]).strip(WHITE_SPACE)
        if text:
            out.append(text)

    for tag in BLOCK_TAG.finditer(body, 0, body.rfind(">") + 1):
        if depth:
            stretch(body[at : tag.start()])
        depth, at = max(0, depth - 1 if tag[1] else depth + 1), tag.end()
    if depth:
        stretch(body[at:])
    return out


@F.arrow_udf(T.StringType())
def page_batch(pages: pa.Array) -> pa.Array:
    return texts_by_slices(lambda page: unescaped("\n".join(block_texts(page))), pages)


def walk(node, wanted: str, out: list[str]) -> None:
    """Collect caption-like texts of a JSON document at any depth."""
    pending = [node]
    while pending:
        here = pending.pop()
        if isinstance(here, str):
            out.append(here)
        elif isinstance(here, list):
            pending.extend(v for v in reversed(here) if isinstance(v, (dict, list)))
        elif isinstance(here, dict):
            own = next((str(here[k]) for k in ID_KEYS if here.get(k)), "")
            ours = not own or not wanted or own == wanted
            found = []
            for key, value in here.items():
                if isinstance(value, (dict, list)):
                    found.append(value)
                elif isinstance(value, str) and key.lower() in CAPTION_KEYS and (ours or len(value) >= 80):
                    found.append(value)
            pending.extend(reversed(found))


@F.arrow_udf(T.ArrayType(T.StringType()))
def walk_batch(bodies: pa.Array, ids: pa.Array) -> pa.Array:
    def texts(body: str | None, wanted: str | None) -> list[str]:
        out: list[str] = []
        if body is not None:
            walk(json.loads(body), wanted or "", out)
        return out

    return by_slices(texts, pa.list_(pa.string()), bodies, ids)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
