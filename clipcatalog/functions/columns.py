"""Key, default and type-coercion columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcatalog import vocab

# Characters that count as white space at the ends of a text.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim every kind of white space (SQL ``trim`` only removes blanks)."""
    return F.btrim(as_col(c), F.lit(WHITESPACE))


def blank_to_null(c) -> Column:
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def empty_to_null(c) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def default_blank(c, default, keep: bool = False) -> Column:
    """Trimmed text, or ``default`` when NULL or blank.

    ``keep=True`` is the display form: the text is tested trimmed but returned
    as it is.
    """
    c = as_col(c).cast("string")
    if keep:
        return F.when(strip(c) != "", c).otherwise(F.lit(default))
    return F.coalesce(blank_to_null(c), F.lit(default))


def is_true(c) -> Column:
    return F.coalesce(as_col(c), F.lit(False))


def clamp01(c) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(as_col(c).cast("double"), F.lit(0.0))))


def text_literal(value: str) -> str:
    """A text as a Spark SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_array(values) -> Column:
    return F.expr("array(" + ", ".join(text_literal(v) for v in dict.fromkeys(values)) + ")")


def lookup(c, mapping: dict, default: Column | None = None) -> Column:
    """Map a text through a small dictionary; unknown keys give ``default``."""
    pairs = ", ".join(
        f"{text_literal(k)}, {text_literal(v) if isinstance(v, str) else repr(v) + 'D'}" for k, v in mapping.items()
    )
    found = F.try_element_at(F.expr(f"map({pairs})"), as_col(c))
    return found if default is None else F.coalesce(found, default)


def normalize_language_code(
    c,
    aliases: dict[str, str] | None = None,
    allowed: list[str] | None = None,
    other: str | None = "unknown",
    trim: bool = False,
) -> Column:
    """Language name or alias to ISO code; anything else becomes ``other``."""
    aliases = vocab.STAGING_LANGUAGE_ALIASES if aliases is None else aliases
    allowed = vocab.LANGUAGE_CODES if allowed is None else allowed
    table = {**aliases, **{code: code for code in allowed}}
    text = F.lower(as_col(c))
    if trim:
        text = strip(text)
    return lookup(text, table, None if other is None else F.lit(other))


def is_json(c) -> Column:
    """The whole text is exactly one JSON value.

    Spark's parser stops after the first value and ignores what follows.  A text
    that is valid both as a list element and as an object member has nothing left
    over: a stray bracket would break one form, a stray brace the other.
    """
    text = as_col(c)
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.coalesce(listed.isNotNull() & named.isNotNull(), F.lit(False))


def json_kind(c) -> Column:
    """Type name of a JSON text (``OBJECT...``, ``ARRAY...``, ``STRING``, ...); NULL if not JSON."""
    text = as_col(c)
    return F.when(is_json(text), F.schema_of_variant(F.try_parse_json(text)))


def content_key(content_id, url) -> Column:
    """Business key of a landing row: id, else id in the URL, else the URL."""
    return F.coalesce(blank_to_null(content_id), path_id(url), blank_to_null(url))


def scoring_key(url, raw_id) -> Column:
    """Business key of a scored row: id in the URL, else the URL, else the row id."""
    return F.coalesce(
        empty_to_null(F.regexp_extract(as_col(url), "video/([0-9]+)", 1)),
        empty_to_null(url),
        as_col(raw_id).cast("string"),
    )


def path_id(url) -> Column:
    return empty_to_null(F.regexp_extract(as_col(url), "/video/([0-9]+)", 1))


def video_id_from_url(url) -> Column:
    """Id after ``/video/``, else a numeric last path part, else NULL."""
    url = as_col(url)
    return F.coalesce(
        empty_to_null(F.regexp_extract(url, r"/video/(\d+)", 1)),
        empty_to_null(F.regexp_extract(url, r"/(\d+)(?:\?|$)", 1)),
    )


def seed_content_id(url) -> Column:
    """Id after ``/video/``, else the last non-empty path part."""
    url = as_col(url)
    last = F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)
    return F.coalesce(empty_to_null(F.regexp_extract(url, r"/video/(\d+)", 1)), last)


def creator_from_url(url) -> Column:
    found = F.regexp_extract(as_col(url), r"tiktok\.com/@([^/]+)/", 1)
    return F.coalesce(empty_to_null(found), F.lit("unknown_creator"))


def record_hash(*cols, trimmed: bool = False) -> Column:
    """SHA-256 over pipe-joined fields, NULL counted as empty."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]
    if trimmed:
        parts = [strip(p) for p in parts]
    return F.sha2(F.concat_ws("|", *parts), 256)


def batch_hash(platform, key, description, title, url) -> Column:
    return record_hash(F.coalesce(as_col(platform), F.lit("tiktok")), key, description, title, url)


def event_hash(content_id, url) -> Column:
    return record_hash(content_id, url, trimmed=True)


def legacy_event_hash(title, description, url) -> Column:
    return record_hash(title, description, url, trimmed=True)


def attempt_hash(raw_id, method, text) -> Column:
    return F.sha2(
        F.concat_ws("|", as_col(raw_id).cast("string"), as_col(method), strip(F.coalesce(as_col(text), F.lit("")))), 256
    )


def build_payload(fields: dict[str, Column | str]) -> Column:
    """JSON object of named fields; NULL members are kept."""
    return F.to_json(
        F.struct(*[as_col(c).alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"}
    )


def display_title(final, original) -> Column:
    title = F.coalesce(empty_to_null(final), as_col(original))
    return F.trim(F.regexp_replace(title, r"\s+", " "))


def title_case(c) -> Column:
    return F.initcap(as_col(c))


def try_boolean(c) -> Column:
    """Text to boolean with the warehouse spellings; anything else is NULL."""
    text = F.lower(F.trim(as_col(c).cast("string")))
    return F.when(text.isin(vocab.WAREHOUSE_TRUE), True).when(text.isin(vocab.WAREHOUSE_FALSE), False)


def safe_numeric_and_time(df: DataFrame, numbers: dict[str, float | None] | None = None,
                          times: list[str] | None = None, fills: dict[str, str] | None = None) -> DataFrame:
    """Coerce columns to number or timestamp, bad values to NULL, then fill.

    ``numbers`` maps a column to its fill value (None keeps NULL); ``fills``
    maps text columns to a fill value.
    """
    out = {}
    for name, fill in (numbers or {}).items():
        value = F.col(name).cast("string").try_cast("double")
        out[name] = value if fill is None else F.coalesce(value, F.lit(float(fill)))
    for name in times or []:
        out[name] = F.col(name).cast("string").try_cast("timestamp_ntz")
    for name, fill in (fills or {}).items():
        out[name] = F.coalesce(F.col(name), F.lit(fill))
    return df.withColumns(out)


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def language_label(c) -> Column:
    """Language code to display name; an unknown short code is upper-cased."""
    code = strip(F.coalesce(as_col(c), F.lit("")))
    return F.coalesce(
        lookup(F.lower(code), vocab.LANGUAGE_LABELS),
        F.when(F.length(code) <= 3, F.upper(code)).otherwise(code),
    )
