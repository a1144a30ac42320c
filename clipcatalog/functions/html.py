"""Text, captions and embedded JSON out of fetched HTML pages."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipcatalog.functions.batch_helpers import page_batch, walk_batch
from clipcatalog.functions.columns import as_col, empty_to_null, is_json, strip
from clipcatalog.functions.text import cleaned_caption, decode_html, normalize_caption, normalize_captions

# --- fixed values: the four attribute orders of a description tag -------------
META_PATTERNS = [
    r"""(?is)<meta[^>]+property=["']og:description["'][^>]+content=["'](.*?)["']""",
    r"""(?is)<meta[^>]+name=["']description["'][^>]+content=["'](.*?)["']""",
    r"""(?is)<meta[^>]+content=["'](.*?)["'][^>]+property=["']og:description["']""",
    r"""(?is)<meta[^>]+content=["'](.*?)["'][^>]+name=["']description["']""",
]


def drop_blocks(c, *tags: str) -> Column:
    """Remove whole elements, one tag at a time so the ends always match."""
    text = as_col(c)
    for tag in tags:
        text = F.regexp_replace(text, rf"(?is)<{tag}[^>]*>.*?</{tag}>", " ")
    return text


def page_text(c) -> Column:
    """Text inside headings, paragraphs and list items, one line per stretch between their tags.

    Blocks nest: the rest of an outer block after an inner one is kept, as a line of
    its own.  A block without an end tag reaches to the end of what encloses it.
    The tags are walked once, in an Arrow batch, in time that grows with the page.
    """
    return cleaned_caption(page_batch(F.coalesce(as_col(c), F.lit(""))))


def meta_descriptions(c) -> Column:
    found = [F.regexp_extract_all(as_col(c), F.lit(p), F.lit(1)) for p in META_PATTERNS]
    return normalize_captions(F.concat(*found))


def json_script(c, script_id: str) -> Column:
    """JSON body of a script element, NULL when absent or malformed."""
    pattern = rf"""(?is)<script[^>]+id=["']{re.escape(script_id)}["'][^>]*>(.*?)</script>"""
    raw = empty_to_null(F.regexp_extract(as_col(c), pattern, 1))
    body = empty_to_null(strip(decode_html(raw)))
    return F.when(is_json(body), body)


def strip_tags(c) -> Column:
    text = drop_blocks(F.coalesce(as_col(c), F.lit("")), "script", "style")
    return normalize_caption(F.regexp_replace(text, "<[^>]+>", " "))


def json_caption_walk(body, item_id) -> Column:
    """Caption-like values at any depth of a JSON document.

    A value counts when its object carries no id, the wanted id, or when the
    value has 80 characters or more.  Depth is unbounded, so this is the one
    structural helper that runs in Python, as Arrow batches over valid JSON.
    """
    return normalize_captions(walk_batch(as_col(body), F.coalesce(as_col(item_id).cast("string"), F.lit(""))))
