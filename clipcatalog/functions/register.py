"""Make the column functions callable from SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from clipcatalog import vocab
from clipcatalog.functions import batch_helpers
from clipcatalog.functions import text as _text
from clipcatalog.functions.columns import text_literal

# SQL functions whose body is one native expression over their argument.
SQL_FUNCTIONS = {
    "clip_strip_ws": ("c STRING", "STRING", r"regexp_replace(c, '(?U)^\\s+|\\s+$', '')"),
    "clip_alpha_ratio": (
        "c STRING", "DOUBLE",
        r"CASE WHEN length(c) > 0 THEN length(regexp_replace(c, '[^\\p{L}]', '')) / length(c) ELSE 0D END",
    ),
    "clip_evidence_class": (
        "s DOUBLE", "STRING",
        "CASE WHEN s >= 0.70D THEN 'high' WHEN s >= 0.45D THEN 'medium' WHEN s >= 0.20D THEN 'low' ELSE 'rejected' END",
    ),
    "clip_quality_grade": (
        "s DOUBLE", "STRING",
        "CASE WHEN s >= 0.80D THEN 'A' WHEN s >= 0.60D THEN 'B' WHEN s >= 0.40D THEN 'C' ELSE 'D' END",
    ),
    "clip_clamp01": ("x DOUBLE", "DOUBLE", "greatest(0D, least(1D, coalesce(x, 0D)))"),
    "clip_video_id": (
        "u STRING", "STRING",
        r"coalesce(nullif(regexp_extract(u, '/video/(\\d+)', 1), ''), nullif(regexp_extract(u, '/(\\d+)(?:\\?|$)', 1), ''))",
    ),
    "clip_content_key": (
        "content_id STRING, u STRING", "STRING",
        "coalesce(nullif(trim(content_id), ''), nullif(regexp_extract(u, '/video/([0-9]+)', 1), ''), nullif(trim(u), ''))",
    ),
    "clip_has_quantity": (
        "c STRING", "BOOLEAN",
        "lower(c) rlike '{}'".format(_text.QUANTITY_PATTERN.replace("\\", "\\\\")),
    ),
    "clip_hashtags": (
        "c STRING", "ARRAY<STRING>", r"array_distinct(regexp_extract_all(lower(c), '(?U)#([\\w\\u0600-\\u06FF]+)', 1))",
    ),
    "clip_split_list": ("c STRING", "ARRAY<STRING>", r"split(c, '[,;|\\n]')"),
    "clip_coerce_bool": (
        "c STRING", "BOOLEAN",
        "CASE WHEN lower({0}) IN ({1}) THEN true WHEN lower({0}) IN ({2}) THEN false END".format(
            r"regexp_replace(c, '(?U)^\\s+|\\s+$', '')", *(", ".join(f"'{v}'" for v in own) for own in (vocab.ANSWER_TRUE, vocab.ANSWER_FALSE))),
    ),
}


def _matches(pattern: str) -> str:
    return "c rlike " + text_literal(pattern)


# Functions with a Python helper, and the rows that the helper has to see.
UNICODE_FUNCTIONS = [
    ("clip_nfkc", batch_helpers.nfkc_batch, f"{_matches(_text.NFKC_UNUSUAL)} AND {_matches(f'[^{_text.NFKC_STABLE}]')}"),
    ("clip_unescape", batch_helpers.unescape_batch, _matches(_text.ENTITY_OR_ESCAPE)),
]


def register_functions(spark: SparkSession) -> list[str]:
    """Register every SQL-callable function; returns their names.

    Native ones become SQL functions, inlined by the optimiser; the two Unicode
    helpers run as Arrow functions below them.
    """
    for name, (args, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}")
    # as in their column forms, rows that provably need no change stay out of Python
    for name, helper, needs in UNICODE_FUNCTIONS:
        spark.udf.register(f"{name}_batch", helper)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(c STRING) RETURNS STRING RETURN coalesce({name}_batch(CASE WHEN {needs} THEN c END), c)")
    return sorted([*SQL_FUNCTIONS, "clip_nfkc", "clip_unescape"])
