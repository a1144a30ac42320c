"""SQL fragments for the checking statements, written for DuckDB.

They state each rule a second time and on their own, from the same fixed values.
"""

from __future__ import annotations

from clipcatalog import vocab

WS = r"E' \t\n\r'"
EDGE_L, EDGE_R = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def collapse(x: str) -> str:
    blanks = rf"regexp_replace({x}, '[ \t]+', ' ', 'g')"
    return strip(rf"regexp_replace({blanks}, '\n{{3,}}', E'\n\n', 'g')")


def decode(x: str) -> str:
    """The entities that occur in the given pages."""
    out = f"replace(replace(replace({x}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·')"
    return f"regexp_replace({out}, '&amp;?', '&', 'g')"


def evidence_text(x: str) -> str:
    return collapse(f"replace(coalesce({x}, ''), chr(13), chr(10))")


def caption(x: str) -> str:
    text = decode(f"coalesce({x}, '')")
    return collapse(rf"replace(replace({text}, '\n', chr(10)), '\/', '/')")


def any_of(x: str, terms) -> str:
    return "(" + " OR ".join(f"contains({x}, {quoted(t)})" for t in dict.fromkeys(terms)) + ")"


def quantity(x: str) -> str:
    patterns = [
        rf"{EDGE_L}\p{{Nd}}+([.,]\p{{Nd}}+)?\s?({vocab.QUANTITY_UNITS}){EDGE_R}",
        rf"{EDGE_L}\p{{Nd}}+\s?/\s?\p{{Nd}}+{EDGE_R}",
        rf"{EDGE_L}\p{{Nd}}{{2,3}}\s?({vocab.TEMPERATURE_UNITS}){EDGE_R}",
    ]
    return "(" + " OR ".join(f"regexp_matches({x}, {quoted(p)})" for p in patterns) + ")"


def letters(x: str) -> str:
    return rf"(CASE WHEN length({x}) > 0 THEN length(regexp_replace({x}, '[^\p{{L}}]', '', 'g')) / length({x}) ELSE 0.0 END)"


def score(x: str, creator: str | None = None, hashtag_hit: str | None = None) -> str:
    """Evidence score of an already normalised text column."""
    low = f"lower({x})"

    def points(cond, value):
        return f"CASE WHEN {cond} THEN {value}::DOUBLE ELSE 0.0::DOUBLE END"

    terms = [
        f"CASE WHEN length({x}) >= 120 THEN 0.15::DOUBLE WHEN length({x}) >= 60 THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END",
        points(any_of(low, vocab.RECIPE_WORDS), "0.20"),
        points(any_of(low, vocab.INGREDIENT_WORDS), "0.15"),
        points(quantity(low), "0.20"),
        points(any_of(low, vocab.COOKING_VERBS), "0.15"),
    ]
    if hashtag_hit:
        terms.append(points(hashtag_hit, "0.10"))
    if creator:
        name = strip(f"coalesce({creator}, '')")
        terms.append(points(f"ltrim(lower({name}), '@') IN {in_list(vocab.KNOWN_CREATORS)}", "0.05"))
    total = "(" + " + ".join(terms) + ")"
    factor = f"CASE WHEN {letters(x)} < 0.35 THEN 0.45::DOUBLE ELSE 1.0::DOUBLE END"
    return f"round(greatest(0.0::DOUBLE, least({total} * ({factor}), 1.0::DOUBLE)), 4)"


def klass(s: str) -> str:
    return f"CASE WHEN {s} >= 0.70 THEN 'high' WHEN {s} >= 0.45 THEN 'medium' WHEN {s} >= 0.20 THEN 'low' ELSE 'rejected' END"


def ocr_ok(x: str) -> str:
    return f"(length({x}) >= 40 AND {letters(x)} >= 0.45 AND {score(x)} >= 0.30)"


def language(x: str, rules=None, default="en") -> str:
    low = f"lower(coalesce({x}, ''))"
    whens = " ".join(f"WHEN {any_of(low, m)} THEN '{code}'" for code, m in rules or vocab.CAPTION_LANGUAGE_MARKERS)
    return f"CASE {whens} ELSE '{default}' END"


def hashtags(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '#([\p{{L}}\p{{N}}_]+)', 1)"


def signal(x: str) -> str:
    low = f"lower(coalesce({x}, ''))"
    tags = "[" + ", ".join(quoted(t) for t in vocab.SIGNAL_HASHTAGS) + "]"
    return f"({any_of(low, vocab.RECIPE_SIGNALS)} OR list_has_any({hashtags(low)}, {tags}))"


def comment_signal(x: str) -> str:
    return any_of(f"lower(coalesce({x}, ''))", vocab.COMMENT_SIGNALS)


def urls(x: str) -> str:
    found = rf"regexp_extract_all(coalesce({x}, ''), 'https?://[^\s)>\]]+')"
    cut = f"list_transform({found}, lambda u: rtrim(u, '.,;:!?'))"
    return f"list_filter({cut}, lambda u: NOT contains(lower(u), 'tiktok.com'))"


def distinct_in_order(values: str) -> str:
    return f"list_filter({values}, lambda v, i: list_position({values}, v) = i)"


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')")


def clamp(x: str) -> str:
    return f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce({x}, 0.0::DOUBLE)))"


def staging_language(x: str, other: str = "'unknown'") -> str:
    whens = " ".join(f"WHEN lower({x}) = '{k}' THEN '{v}'" for k, v in vocab.STAGING_LANGUAGE_ALIASES.items())
    return f"CASE {whens} WHEN lower({x}) IN {in_list(vocab.LANGUAGE_CODES)} THEN lower({x}) ELSE {other} END"


def path_id(url: str) -> str:
    return f"nullif(regexp_extract({url}, '/video/([0-9]+)', 1), '')"


def content_key(content_id: str, url: str) -> str:
    return f"coalesce(nullif(trim({content_id}), ''), {path_id(url)}, nullif(trim({url}), ''))"


def video_id(url: str) -> str:
    return rf"coalesce({path_id(url)}, nullif(regexp_extract({url}, '/([0-9]+)(\?|$)', 1), ''))"
