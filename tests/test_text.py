import re
import time
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions import batch_helpers
from clipcatalog.functions import html as H
from clipcatalog.functions import text as X
from clipcatalog.functions.columns import strip


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression.alias("r")).first()["r"]


def many(spark, texts, expression):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", expression.alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


def test_stable_characters_are_stable():
    stable = re.compile(f"[{X.NFKC_STABLE}]")
    for code in range(0x10000):
        char = chr(code)
        if not 0xD800 <= code < 0xE000 and stable.match(char):
            assert unicodedata.normalize("NFKC", char) == char and unicodedata.combining(char) == 0, hex(code)
            # a combining mark after it must be outside the class, so such a text is normalised
    for code in range(0x300, 0x370):
        assert not stable.match(chr(code))


TEXTS = ["", None, "  plain  ", "ﬁne ½ cup", "été", "Ⅳ\tx \t y", "a\r\rb\n\n\n\nc", "１２ g", "日本 ｶﾞ", " x　"]


def test_normalize_evidence_text(spark):
    got = many(spark, TEXTS, X.normalize_evidence_text("t"))

    def expected(t):
        t = unicodedata.normalize("NFKC", t or "").replace("\r", "\n")
        return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", t)).strip()

    assert got == [expected(t) for t in TEXTS]


def test_normalize_caption(spark):
    texts = [
        "Tom &amp; Jerry&#39;s &frac12; &apos;x&apos;", r"café 🍝 a\/b\nnext", "salt & pepper", "&ampx; &nosuch;",
        r"broken \ud83c end", None, "a \t  b",
    ]
    assert many(spark, texts, X.normalize_caption("t")) == [
        "Tom & Jerry's ½ 'x'", "café 🍝 a/b\nnext", "salt & pepper", "&x; &nosuch;", "broken � end", "", "a b",
    ]


def test_captions_of_an_array_keep_their_borders(spark):
    df = spark.createDataFrame([(["&lt;b&gt;", "x\x1fy &amp;", ""],), ([],)], "a array<string>")
    assert [r[0] for r in df.select(X.normalize_captions("a")).collect()] == [["<b>", "x y &", ""], []]


def test_quantities_in_other_scripts(spark):
    texts = ["٣ g", "200g sugar", "x200gy", "1 / 2", "350°f", "35 c", "5 c", "12,5 ml", "10 minutes", "3 eggs"]
    assert many(spark, texts, X.has_quantity("t")) == [True, True, False, True, True, True, False, True, True, False]


def test_letter_share(spark):
    assert many(spark, ["", "ab12", "éßع1", "!!!"], F.round(X.alpha_ratio("t"), 4)) == [0.0, 0.5, 0.75, 0.0]


def test_score_parts(spark):
    long = "Recipe: mix 2 cups flour. " + "word " * 30
    got = many(spark, [long, "Recipe", "1234567890 !!! recipe", ""], X.evidence_score("t"))
    assert got == [pytest.approx(0.85), 0.2, pytest.approx(0.09), 0.0]
    hints = spark.createDataFrame([("x", ["#EasyRecipe", None], "@FitWaffle")], "t string, h array<string>, c string")
    assert hints.select(X.evidence_score("t", "h", "c")).first()[0] == pytest.approx(0.15)


def test_score_classes(spark):
    df = spark.createDataFrame([(0.7,), (0.45,), (0.2,), (0.1999,)], "s double")
    assert [r[0] for r in df.select(X.evidence_class("s")).collect()] == ["high", "medium", "low", "rejected"]


def test_language_order_and_scripts(spark):
    assert many(spark, ["Recette de pasta", "pollo y pasta", "nothing", "وصفة"], X.infer_language("t")) == ["fr", "es", "en", "ar"]
    assert one(spark, "مرحبا", X.script_profile("t")) == ["ar,en", "en,fr,es,it,pt"]


def test_signal_by_hashtag_only(spark):
    assert many(spark, ["#foodtok yum", "#foodtokk yum", "foodtok", "Lunch!"], X.recipe_signal("t")) == [True, False, False, True]


def test_links(spark):
    text = "see https://a.example/x, and (http://b.example/y). https://www.TikTok.com/@a https://a.example/x!"
    assert one(spark, text, X.extract_urls("t")) == ["https://a.example/x", "http://b.example/y"]


def test_recipe_text_lines(spark):
    text = "## My Cake\n**Ingredients:**\n- 2 eggs\n* **Mix** well\r\n\n STEPS:\nBake"
    assert one(spark, text, X.clean_recipe_text("t")) == "My Cake\n2 eggs\n**Mix** well\nBake"
    assert one(spark, text, X.recipe_intro("t", F.lit("my cake"))) == "2 eggs"
    assert one(spark, "Method:\n", X.recipe_intro("t", F.lit(None).cast("string"))) == ""


def test_preview_leeway(spark):
    assert [len(r) for r in many(spark, ["x" * 130, "x" * 135, "x" * 136], X.preview("t"))] == [130, 135, 130]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdefghimnoprstuvxyz ", max_size=60))
def test_vocabulary_pattern_is_a_substring_test(text):
    for terms in (vocab.COOKING_VERBS, vocab.INGREDIENT_WORDS, vocab.RECIPE_SIGNALS, ["a.b", "a+", "(x)"]):
        assert bool(re.search(X.term_pattern(terms), text)) == any(t in text for t in terms)


def test_pattern_escapes(spark):
    assert many(spark, ["a.b", "axb", "a+", "(x)"], X.contains_any("t", ["a.b", "a+", "(x)"])) == [True, False, True, True]


def test_page_text_and_tags(spark):
    html = '<p>One<br>two</p><script>var t="</p><p>no</p>";</script><pre>skip</pre><ul><li class="x">Th&amp;ree</li></ul><H2> Four </H2>'
    assert one(spark, html, H.page_text("t")) == "One two\nTh&ree\nFour"
    assert one(spark, html, H.strip_tags("t")) == "One two skip Th&ree Four"


def test_text_after_a_nested_block_is_kept(spark):
    html = ["<ul><li><p>a</p> rest of item</li></ul>out", "</p>x<p>y</p>z<li>1<li>2</li></li>w", "no block", None]
    assert many(spark, html, H.page_text("t")) == ["a\nrest of item", "y\n1\n2", "", ""]


def test_page_of_very_many_blocks(spark):
    """Time grows with the page: blocks, deep nesting, tags and elements without an end."""
    pages = ["<p>word</p>" * 100_000, "<li>" * 50_000 + "x" + "</li>" * 50_000, "<p " * 100_000 + "text", "<script>" * 100_000 + "<p>a</p>",
             "a<" * 100_000 + "<p>b<c</p>"]
    started = time.time()
    got = many(spark, pages, H.page_text("t"))
    assert got[0].count("word") == got[0].count("\n") + 1 == 100_000 and got[1] == "x" and got[2] == "" and got[3] == "a"
    assert time.time() - started < 60


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([
    *(t for own in batch_helpers.VOCABULARIES.values() for t in own[:8]), " ", "2 cups", "1/2", "350 f", "x", "é", "٣ kg", "½", "A", "kg", "5"]),
    max_size=12).map("".join))
def test_features_of_a_text(text):
    """The pattern, the automaton and plain substring tests agree; letters and amounts are those of the single functions."""
    low = text.lower()
    want = sum(1 << k for k, own in enumerate(batch_helpers.VOCABULARIES.values()) if any(t in low for t in own))
    assert batch_helpers.term_bits(low) == want
    native = batch_helpers.native_terms()
    assert native is None or batch_helpers.term_bits(low, native) == want
    letters, digit = batch_helpers.letters_and_digits(text)
    assert letters == sum(c.isalpha() for c in text) and digit == any(c.isdecimal() for c in text)


def test_features_equal_the_single_functions(spark):
    texts = ["Mix 2 cups flour", "", "no", "Bake at 350 F. 1/2 tsp", "x2 kg", "2kg", "12 g.", "日本 3 g", None, "%%% 1 ###", "#easyrecipe dinner"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", "t", X.text_features("t").alias("f"), X.has_quantity("t").alias("q"), X.alpha_ratio("t").alias("a"),
                      X.contains_any(F.lower("t"), vocab.RECIPE_WORDS).alias("w")).collect()
    for r in got:
        if r["t"] is not None:
            assert (r["f"]["amount"], r["f"]["letters"], r["f"]["recipe"]) == (r["q"], r["a"], r["w"]), r["t"]
    score = X.evidence_score("t", normalized=True)
    used = rows.select(score.alias("s"), X.evidence_class(score).alias("c"), X.usable_ocr("t", normalized=True).alias("o"))
    plan = used._jdf.queryExecution().executedPlan().toString()
    assert plan.count("features_batch(") == plan.count("ArrowEvalPython") == 1


def test_json_in_pages(spark):
    html = '<SCRIPT type="x" id=\'S.1\'>{&quot;desc&quot;: 1}</SCRIPT>'
    assert one(spark, html, H.json_script("t", "S.1")) == '{"desc": 1}'
    assert one(spark, html, H.json_script("t", "Sx1")) is None
    body = '{"id":"7","desc":"other id","x":[{"Title":"a &amp; b"},{"id":"9","caption":"mine","deep":{"description":"' + "z" * 80 + '"}}],"title":5}'
    walked = spark.createDataFrame([(body, "9"), (None, "9")], "b string, i string").select(H.json_caption_walk("b", "i")).collect()
    assert walked[0][0] == ["a & b", "mine", "z" * 80]
    assert walked[1][0] == []


def test_strip_is_unicode_aware(spark):
    assert one(spark, "   x \x0b", strip("t")) == "x"


def test_json_script_keeps_escapes(spark):
    """Only HTML entities are decoded; the JSON parser reads its own escapes."""
    from clipcatalog.functions import html

    body = '{"id":"7","desc":"say \\u0022hi\\u0022 &amp; two\\u000Alines \\u002F","x":{"y":[{"title":"deep"}]}}'
    page = spark.createDataFrame([(f'<script id="S" type="application/json">{body}</script>',)], "html string")
    script = html.json_script("html", "S")
    assert page.select(F.get_json_object(script, "$.desc")).first()[0] == 'say "hi" & two\nlines /'
    assert page.select(html.json_caption_walk(script, F.lit("7"))).first()[0] == ['say "hi" & two\nlines /', "deep"]


def test_evidence_with_features_is_the_columns_in_one_helper(spark):
    texts = [*TEXTS, "Tom &amp; Jerry&#39;s &frac12; cup", r"café a\/b\nnext", "a \t  b\r\n\r\n\r\nﬁne", "&ampx; \\ud83c", "x\u001c", "200 g sugar, mix"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 60)], "i int, t string").repartition(1)
    for caption, clean in ((True, X.normalize_evidence_text(X.normalize_caption("t"))), (False, X.normalize_evidence_text("t"))):
        one = rows.select("i", X.evidence_with_features("t", caption).alias("f")).select("i", "f.*")
        two = rows.select("i", clean.alias("text")).select("i", "text", X.text_features("text").alias("f")).select("i", "text", "f.*")
        assert sorted(one.collect()) == sorted(two.collect()) and one.columns == two.columns


def test_helpers_hold_a_few_texts_at_a_time():
    import pyarrow as pa

    held = []
    values = pa.array([str(i) if i % 3 else None for i in range(1000)])
    got = batch_helpers.by_slices(lambda v: held.append(v) or v, pa.string(), values)
    assert got == values and held == values.to_pylist() and batch_helpers.SLICE < 1000
    assert batch_helpers.texts_by_slices(str, values.slice(0, 0)) == pa.array([], pa.string())


def test_attempts_have_one_helper_per_step(spark):
    from clipcatalog.operators import recovery as E

    rows = spark.createDataFrame([(1, "ocr", "attempted_success", 0.5, None, "Recipe: 2 cups flour and butter, mix and bake it well.", "c")],
                                 "raw_id long, method string, status string, confidence double, error string, text string, creator_username string")
    result = E.attempt_result(rows)
    for frame, helpers in ((result, 1), (E.evidence_from_attempts(result), 2), (E.queue_status(result), 2)):
        assert frame.count() == 1
        assert frame._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == helpers


def test_sql_helpers_see_only_rows_that_need_them(spark):
    from clipcatalog.functions.register import register_functions

    assert {"clip_nfkc", "clip_unescape"} <= set(register_functions(spark))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, "Tom &amp; J\\u00e9", "a'b\\c & d"])], "i int, c string")
    rows.createOrReplaceTempView("texts_for_functions")
    got = spark.sql("SELECT i, clip_nfkc(c) AS n, clip_unescape(c) AS u FROM texts_for_functions")
    want = rows.select("i", X.nfkc("c").alias("n"), X.decode_entities("c").alias("u"))
    assert sorted(got.collect()) == sorted(want.collect())
    helpers = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "ArrowEvalPython" in line]
    assert len(helpers) == 1 and helpers[0].count("CASE WHEN") == 2
