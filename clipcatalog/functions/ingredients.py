"""Display lists: ingredients and steps of a recipe, merged and formatted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions.columns import as_col, empty_to_null, is_json, json_kind, strip

NO_TEXTS = "array<string>"


def _empty() -> Column:
    return F.array().cast(NO_TEXTS)


def _texts(json: Column) -> Column:
    """Elements of a JSON array as texts; objects stay JSON."""
    return F.from_json(json, NO_TEXTS)


def _split_text(text: Column) -> Column:
    """A plain list text: one item per line, or comma separated."""
    by_line = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" -\t")))
    by_comma = F.transform(F.split(text, ","), strip)
    items = F.when(F.contains(text, F.lit("\n")), by_line).otherwise(by_comma)
    blank = (text == "") | F.lower(text).isin(vocab.BLANK_LIST_TEXTS)
    return F.when(blank, _empty()).otherwise(F.filter(items, lambda x: x != ""))


def _set_member(json: Column, name: str) -> Column:
    """A member as text when it is set: no null, false, zero, empty text, list or object.  A text such as ``"[]"`` or ``"0"`` is set."""
    value = F.get_json_object(json, f"$.{name}")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), f"$.{name}", "variant"))
    zero = F.coalesce(value.try_cast("double") == 0, F.lit(False))
    return F.when(F.when(kind == "STRING", value != "").otherwise(~value.isin("[]", "{}", "false") & ~zero), value)


def _unwrapped(text: Column) -> Column:
    """The innermost value: through objects with a list member and through JSON in quotes, at any depth.

    Each step takes off one layer until nothing changes; a text has no more layers than braces and quotes.
    """
    state = "struct<text:string,done:boolean>"
    most = F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit(""))) + F.length(text) - F.length(
        F.replace(text, F.lit('\\"'), F.lit("_"))) + 1
    wrapped = text.startswith("{") | text.startswith('"')
    steps = F.when(wrapped, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))

    def step(seen, _):
        own = seen["text"]
        inner = strip(F.when(own.startswith("{") & is_json(own), F.coalesce(*[
            _set_member(own, name) for name in ("ingredients", "items", "values")
        ])).when(own.startswith('"') & is_json(own), F.try_variant_get(F.try_parse_json(own), "$", "string")))
        return F.when(seen["done"], seen).otherwise(
            F.struct(F.coalesce(inner, own).alias("text"), inner.isNull().alias("done")).cast(state))

    start = F.struct(text.alias("text"), F.lit(False).alias("done")).cast(state)
    return F.aggregate(steps, start, step, lambda seen: seen["text"])


def coerce_list_field(c) -> Column:
    """JSON array, object, quoted text, lines or commas to a list of texts.

    An object gives the list under ``ingredients``, ``items`` or ``values`` when one of them is
    set, however deep objects and quoted JSON are nested, else itself as the only item.
    """
    text = _unwrapped(strip(F.coalesce(as_col(c), F.lit(""))))
    staged = F.transform(F.array(text), lambda own: F.struct(own.alias("text"), F.coalesce(json_kind(own), F.lit("TEXT")).alias("kind")))

    def listed(own):
        text, kind = own["text"], own["kind"]
        return (
            F.when(kind == "TEXT", _split_text(text)).when(kind == "VOID", _empty())
            .when(kind.startswith("ARRAY"), _texts(text)).otherwise(F.array(text))
        )

    return F.get(F.transform(staged, listed), 0)


def _member(json: Column, *names: str) -> Column:
    """First truthy member of a JSON object as text."""
    values = [F.get_json_object(json, f"$.{n}") for n in names]
    return F.coalesce(*[F.when(~v.isin("", "0", "0.0", "false", "[]", "{}"), v) for v in values])


def format_ingredient(item) -> Column:
    """A text, or an object with name, quantity, unit and notes, for display."""
    text = strip(F.coalesce(as_col(item), F.lit("None")))
    name = F.coalesce(_member(text, "name", "ingredient", "text"), F.lit("ingredient"))
    quantity = _member(text, "quantity")
    unit = F.when(quantity.isNotNull(), _member(text, "unit"))
    notes = _member(text, "notes", "preparation", "comment")
    shown = F.concat(
        F.concat_ws(" ", quantity, unit, name),
        F.coalesce(F.concat(F.lit(" ("), notes, F.lit(")")), F.lit("")),
    )
    is_object = text.startswith("{") & is_json(text)
    return F.when(is_object, shown).otherwise(F.btrim(text, F.lit("[]{}'\" ")))


def ingredient_key(c) -> Column:
    """What an ingredient is, without amounts, units and filler words."""
    lower = F.lower(as_col(c))
    text = F.regexp_replace(lower, r"\([^)]*\)", "")
    text = F.regexp_replace(text, r"(?U)\b\d+([.,]\d+)?\b", "")
    text = F.regexp_replace(text, rf"(?U)\b(?:{vocab.INGREDIENT_NOISE_WORDS})\b", " ")
    text = strip(F.regexp_replace(text, r"[^a-zà-ÿ0-9]+", " "))
    return F.coalesce(empty_to_null(text), strip(lower))


def merge_similar_ingredients(items, fallback=None) -> Column:
    """Ordered list without weaker repeats.

    An item without an amount gives way to one that has an amount and whose
    key equals, contains, or is contained in its own.  ``fallback`` is used
    when ``items`` is empty.
    """
    source = as_col(items)
    if fallback is not None:
        source = F.when(F.size(source) > 0, source).otherwise(as_col(fallback))
    shown = F.transform(source, lambda x: strip(F.btrim(strip(format_ingredient(x)), F.lit(","))))
    kept = F.filter(
        shown,
        lambda x: ~x.isin("", "[", "]", "{", "}") & ~F.lower(x).isin(vocab.INGREDIENT_PLACEHOLDERS),
    )
    entries = F.transform(
        kept,
        lambda x: F.struct(x.alias("text"), ingredient_key(x).alias("key"), x.rlike(r"(?U)\d").alias("amount")),
    )

    def same(a, b):
        return F.contains(a, b) | F.contains(b, a)

    def add(state, item):
        weaker = F.exists(state, lambda o: o["amount"] & ~item["amount"] & same(o["key"], item["key"]))
        rest = F.filter(state, lambda o: ~(item["amount"] & ~o["amount"] & same(o["key"], item["key"])))
        repeated = F.exists(rest, lambda o: o["key"] == item["key"])
        grown = F.when(repeated, rest).otherwise(F.concat(rest, F.array(item)))
        return F.when(weaker, state).otherwise(grown)

    start = F.filter(entries, lambda _: F.lit(False))
    return F.transform(F.aggregate(entries, start, add), lambda e: e["text"])


def ingredient_preview(array, n: int = 4) -> Column:
    return F.slice(as_col(array), 1, n)


def format_steps(array) -> Column:
    """Steps as texts; an object gives its instruction, text, step or first value."""

    def one(step):
        text = F.coalesce(step, F.lit("None"))
        values = F.from_json(text, "map<string,string>")
        named = F.coalesce(
            _member(text, "instruction", "text", "step"),
            F.try_element_at(F.map_values(values), F.lit(1)),
            F.lit(""),
        )
        return F.when(text.startswith("{") & is_json(text), named).otherwise(text)

    return F.transform(as_col(array), one)
