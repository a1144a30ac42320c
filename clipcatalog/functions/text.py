"""Caption and evidence text: cleaning, vocabulary tests and scores.

Everything stays in JVM expressions except two Unicode helpers (compatibility
normalisation and HTML entity decoding) and the features of a text.  The helpers run as
Arrow batches, a few texts at a time, and see NULL for every row that provably needs no
change.  Where cleaning and features of a text are both wanted, one helper does both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.batch_helpers import (
    caption_evidence_batch, evidence_batch, features_batch, html_batch, nfkc_batch, unescape_batch,
)
from clipcatalog.functions.columns import as_col, empty_to_null, literal_array, lookup, strip

# Characters that compatibility normalisation provably leaves alone in any
# context: no mapping, no combining mark, no composing second half.
NFKC_STABLE = (
    r"\x00-\x7F\u00A1-\u00A7\u00A9\u00AB-\u00AE\u00B0\u00B1\u00B6\u00B7\u00BB\u00BF"
    r"\u00C0-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u017E\u0180-\u01C3"
    r"\u0620-\u064A\u0660-\u066F\u0391-\u03A1\u03B1-\u03C9\u0410-\u044F"
    r"\u2010\u2012-\u2016\u2018-\u2023\u2039\u203A\u20AC\u4E00-\u9FA5"
)


NFKC_UNUSUAL = r"[^\x00-\x7F\u00C0-\u0131]"
# one class leads, so other signs fail at once
ENTITY_OR_ESCAPE = r"[&\\](?:(?<=&)[#A-Za-z]|(?<=\\)u[0-9a-fA-F]{4})"


def _only_where(needs_work: Column, text: Column, helper) -> Column:
    """Apply a Python helper to the rows that need it, hiding all others."""
    return F.coalesce(helper(F.when(needs_work, text)), text)


def _collapse(text: Column) -> Column:
    # single blanks are left alone: they are most of a text and need no change; one class leads, so other signs fail at once
    text = F.regexp_replace(text, r"[ \t](?:[ \t]+|(?<=\t))", " ")
    return strip(F.regexp_replace(text, "\n{3,}", "\n\n"))


def nfkc(c) -> Column:
    # the first test is the fast one: plain and accented Latin text stops there
    text = as_col(c)
    unusual = text.rlike(NFKC_UNUSUAL)
    return _only_where(unusual & text.rlike(f"[^{NFKC_STABLE}]"), text, nfkc_batch)


def normalize_evidence_text(c) -> Column:
    text = nfkc(F.coalesce(as_col(c), F.lit("")))
    return _collapse(F.replace(text, F.lit("\r"), F.lit("\n")))


def decode_entities(c) -> Column:
    """HTML entities and ``\\uXXXX`` escapes to characters."""
    text = as_col(c)
    return _only_where(text.rlike(ENTITY_OR_ESCAPE), text, unescape_batch)


def decode_html(c) -> Column:
    """HTML entities to characters; ``\\uXXXX`` stays for a JSON parser."""
    text = as_col(c)
    return _only_where(text.rlike(r"&[#A-Za-z]"), text, html_batch)


def cleaned_caption(text: Column) -> Column:
    """Written-out line ends and slashes, and blanks, of a text whose entities are decoded."""
    text = F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\/"), F.lit("/"))
    return _collapse(text)


def normalize_caption(c) -> Column:
    return cleaned_caption(decode_entities(F.coalesce(as_col(c), F.lit(""))))


def normalize_captions(array) -> Column:
    """``normalize_caption`` on each element, with one pass through the helper.

    The elements travel as one text joined by U+001F, a control character that
    neither HTML nor the decoder can produce.
    """
    joined = F.array_join(F.transform(as_col(array), lambda x: F.translate(x, "\x1f", " ")), "\x1f")
    parts = F.split(decode_entities(joined), "\x1f")

    def clean(x):
        x = F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\/"), F.lit("/"))
        return _collapse(x)

    return F.when(F.size(as_col(array)) > 0, F.transform(parts, clean)).otherwise(
        F.array().cast("array<string>")
    )


def alpha_ratio(c) -> Column:
    """Share of letters; 0 for an empty text."""
    text = as_col(c)
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return F.when(F.length(text) > 0, letters / F.length(text)).otherwise(F.lit(0.0))


def minimal_terms(terms: list[str]) -> list[str]:
    """Drop terms that contain another term: they cannot change a substring test."""
    unique = list(dict.fromkeys(terms))
    return [t for t in unique if not any(o != t and o in t for o in unique)]


def term_pattern(terms: list[str]) -> str:
    """One regular expression for a vocabulary, with shared prefixes factored out."""
    def branch(words: list[str]) -> str:
        if "" in words:
            return ""
        heads: dict[str, list[str]] = {}
        for word in words:
            heads.setdefault(word[0], []).append(word[1:])
        parts = [_escape(head) + branch(tails) for head, tails in heads.items()]
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    words = minimal_terms(terms)
    # a cheap look at the first character rules out most positions of a text
    heads = "".join(_escape(h) for h in dict.fromkeys(w[0] for w in words))
    return f"(?=[{heads}])" + branch(words)


def _escape(char: str) -> str:
    return char if char.isalnum() or char == " " else "\\" + char


def contains_any(c, terms: list[str]) -> Column:
    """True when any term occurs as a substring (not as a word)."""
    return as_col(c).rlike(term_pattern(terms))


# An amount with a unit, a fraction, or a temperature.  The look-ahead lets the
# search skip every position that is not a digit.
QUANTITY_PATTERN = (
    r"(?U)(?=\d)\b(?:"
    rf"\d+(?:[.,]\d+)?\s?(?:{vocab.QUANTITY_UNITS})\b"
    r"|\d+\s?/\s?\d+\b"
    rf"|\d{{2,3}}\s?(?:{vocab.TEMPERATURE_UNITS})\b)"
)


def has_quantity(c) -> Column:
    return F.lower(as_col(c)).rlike(QUANTITY_PATTERN)


def content_hashtags(c) -> Column:
    """Hashtags of a text: lower-cased, ``#`` removed, distinct, in order."""
    found = F.regexp_extract_all(F.lower(as_col(c)), F.lit(r"(?U)#([\w\u0600-\u06FF]+)"), F.lit(1))
    return F.array_distinct(found)


def clean_hashtags(array) -> Column:
    """Caller-supplied hashtags: stripped, lower-cased, leading ``#`` removed."""
    given = F.filter(as_col(array), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.transform(given, lambda x: F.ltrim(F.lower(strip(x)), F.lit("#")))


def text_features(c) -> Column:
    """``letters`` (share), ``amount`` and one flag per vocabulary (``recipe, ingredient, verb, signal``) as a struct.

    They come from one read of the text, in an Arrow batch.  Calls on the same column in one
    projection are one call.
    """
    return features_batch(as_col(c))


def evidence_with_features(c, caption: bool = False) -> Column:
    """``text`` as ``normalize_evidence_text`` gives it (of ``normalize_caption`` with ``caption``), and its ``text_features``.

    One call of one helper: every helper in a plan has a worker of its own for each task.
    """
    return (caption_evidence_batch if caption else evidence_batch)(as_col(c))


def evidence_score(c, hashtags=None, creator=None, normalized: bool = False, found: Column | None = None) -> Column:
    """How useful a text is as recipe evidence, in [0, 1] with 4 decimals.

    ``found``: the features of the normalised text, where they are known.
    """
    text = as_col(c) if normalized else normalize_evidence_text(c)
    found = text_features(text) if found is None else found

    def points(condition, value):
        return F.when(condition, F.lit(value)).otherwise(F.lit(0.0))

    score = (
        F.when(F.length(text) >= 120, F.lit(0.15)).when(F.length(text) >= 60, F.lit(0.08)).otherwise(F.lit(0.0))
        + points(found["recipe"], 0.20)
        + points(found["ingredient"], 0.15)
        + points(found["amount"], 0.20)
        + points(found["verb"], 0.15)
    )
    if hashtags is not None:
        score = score + points(
            F.coalesce(F.arrays_overlap(clean_hashtags(hashtags), literal_array(vocab.RECIPE_HASHTAGS)), F.lit(False)),
            0.10,
        )
    if creator is not None:
        name = F.ltrim(F.lower(strip(F.coalesce(as_col(creator), F.lit("")))), F.lit("@"))
        score = score + points(name.isin(vocab.KNOWN_CREATORS), 0.05)
    score = F.when(found["letters"] < 0.35, score * F.lit(0.45)).otherwise(score)
    return F.round(F.greatest(F.lit(0.0), F.least(score, F.lit(1.0))), 4)


def evidence_class(score) -> Column:
    s = as_col(score)
    chain = None
    for edge, name in vocab.EVIDENCE_CLASS_EDGES:
        chain = F.when(s >= edge, name) if chain is None else chain.when(s >= edge, name)
    return chain.otherwise("rejected")


def usable_ocr(c, normalized: bool = False, score=None, found: Column | None = None) -> Column:
    text = as_col(c) if normalized else normalize_evidence_text(c)
    found = text_features(text) if found is None else found
    points = evidence_score(text, normalized=True, found=found) if score is None else as_col(score)
    return (F.length(text) >= 40) & (found["letters"] >= 0.45) & (points >= 0.30)


def infer_language(c, rules=None, default: str = "en") -> Column:
    """First language with a marker in the text, in rule order."""
    text = F.lower(F.coalesce(as_col(c), F.lit("")))
    chain = None
    for language, markers in rules or vocab.CAPTION_LANGUAGE_MARKERS:
        hit = contains_any(text, [m.lower() for m in markers])
        chain = F.when(hit, language) if chain is None else chain.when(hit, language)
    return chain.otherwise(default)


def joined_evidence(*cols) -> Column:
    return F.concat_ws(" ", *[F.coalesce(as_col(c), F.lit("")) for c in cols])


def has_arabic(*cols) -> Column:
    text = joined_evidence(*cols)
    return text.rlike(r"[\u0600-\u06FF]") | (infer_language(text) == "ar")


def script_profile(*cols) -> Column:
    """Ordered text-recognition language profiles for an item's evidence."""
    latin, arabic = F.lit("en,fr,es,it,pt"), F.lit("ar,en")
    return F.when(has_arabic(*cols), F.array(arabic, latin)).otherwise(F.array(latin))


def recipe_signal(c) -> Column:
    """A signal word anywhere, or a hashtag that is in the signal list."""
    text = F.coalesce(as_col(c), F.lit(""))
    tagged = F.contains(text, F.lit("#")) & F.arrays_overlap(content_hashtags(text), literal_array(vocab.SIGNAL_HASHTAGS))
    return text_features(text)["signal"] | tagged


def comment_signal(c) -> Column:
    return contains_any(F.lower(F.coalesce(as_col(c), F.lit(""))), vocab.COMMENT_SIGNALS)


def extract_urls(c) -> Column:
    """External links of a text: trailing punctuation cut, distinct, in order."""
    found = F.regexp_extract_all(F.coalesce(as_col(c), F.lit("")), F.lit(r"https?://[^\s)>\]]+"), F.lit(0))
    cut = F.transform(found, lambda u: F.rtrim(u, F.lit(".,;:!?")))
    return F.array_distinct(F.filter(cut, lambda u: ~F.contains(F.lower(u), F.lit("tiktok.com"))))


def has_external_link(*cols) -> Column:
    return F.size(extract_urls(joined_evidence(*cols))) > 0


def evidence_text_compose(*cols, separator: str = "\n\n", strict_null: bool = False) -> Column:
    """Non-empty parts joined by a blank line; NULL when nothing is left.

    ``strict_null=True`` gives NULL as soon as one part is missing.
    """
    parts = [empty_to_null(c) for c in cols]
    joined = F.concat(*[x for p in parts for x in (F.lit(separator), p)][1:]) if strict_null else F.concat_ws(
        separator, *parts
    )
    return empty_to_null(joined)


def looks_like_caption(candidate, existing) -> Column:
    """A candidate worth replacing ``existing``: long enough, new, no boilerplate."""
    cand, have = as_col(candidate), F.coalesce(as_col(existing), F.lit(""))
    return (
        (F.coalesce(cand, F.lit("")) != "")
        & ~contains_any(F.lower(cand), vocab.CAPTION_BOILERPLATE)
        & ~((have != "") & (cand == have))
        & (F.length(cand) >= F.greatest(F.lit(40), F.length(have) + 15))
    )


def _is_label(line: Column) -> Column:
    label = strip(F.btrim(F.lower(line), F.lit(":")))
    return label.isin(vocab.SECTION_LABELS)


def recipe_lines(c) -> Column:
    """Lines of a recipe text without mark-up, bullets, labels and blanks."""

    def clean(line):
        marked = strip(F.regexp_replace(line, r"^#{1,6}\s*", ""))
        marked = strip(F.regexp_replace(marked, r"^\*\*(.*?)\*\*:?\s*$", "$1"))
        marked = strip(F.regexp_replace(marked, r"^\*\*(.*?)\*\*", "$1"))
        marked = strip(F.regexp_replace(marked, r"^[-*]\s+", ""))
        # every mark begins the line
        return F.when(F.substring(line, 1, 1).isin("#", "*", "-"), marked).otherwise(line)

    text = F.coalesce(as_col(c), F.lit(""))
    # nearly all texts have plain line ends only, which split without a search by pattern
    lines = F.when(text.rlike(r"[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")).otherwise(
        F.split(text, "\n"))
    lines = F.filter(F.transform(lines, strip), lambda x: x != "")
    return F.filter(F.transform(lines, clean), lambda x: ~_is_label(x))


def clean_recipe_text(c) -> Column:
    return strip(F.array_join(recipe_lines(c), "\n"))


def recipe_intro(c, title) -> Column:
    """First recipe line that is neither the title nor a label; '' if none."""
    name = F.lower(strip(F.coalesce(as_col(title), F.lit(""))))
    lines = F.filter(
        F.transform(F.split(clean_recipe_text(c), "\n"), strip),
        lambda x: ~((name != "") & (F.lower(x) == name)) & ~_is_label(x),
    )
    return F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit(""))


def preview(c, chars: int = vocab.PREVIEW_CHARS, leeway: int = 5) -> Column:
    """Cut a text to ``chars`` including the dots; slightly longer texts stay."""
    text = as_col(c)
    cut = F.concat(F.substring(text, 1, chars - 3), F.lit("..."))
    return F.when(F.length(text) > chars + leeway, cut).otherwise(text)


def base_confidence(method, signal) -> Column:
    """Starting confidence of an attempt from its method and recipe signal."""
    with_signal = lookup(method, {m: v[0] for m, v in vocab.BASE_CONFIDENCE.items()})
    without = lookup(method, {m: v[1] for m, v in vocab.BASE_CONFIDENCE.items()})
    return F.when(as_col(signal), with_signal).otherwise(without)
