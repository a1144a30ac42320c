import json
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.functions import columns as C
from clipcatalog.functions import ingredients as I
from clipcatalog.functions import structured as V
from clipcatalog.operators import items
from clipcatalog.operators.answers import normalize_answers


def many(spark, texts, expression):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", expression.alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


def answers(spark, *responses):
    df = spark.createDataFrame(list(enumerate(responses)), "raw_id int, response string")
    return [r.asDict() for r in normalize_answers(df).orderBy("raw_id").collect()]


def test_lenient_parse(spark):
    got = many(spark, ['{"a":1}', 'x {"a":1} y', "}{", "[1]", None, '{"a":1} and {"b":2}'], V.parse_json_lenient("t"))
    assert got == ['{"a":1}', '{"a":1}', None, "[1]", None, None]


def test_whole_text_is_json(spark):
    texts = ['{"a":1}', "[1,2]", "null", '"x"', "1", "1,2", '1,"k":2', '{"a":1}]x[', "1}x{", '{"a":1} {"b":2}', "", None, "{", '[1]]']
    assert many(spark, texts, C.is_json("t")) == [True] * 5 + [False] * 9
    kinds = many(spark, ['{"a":1}', "[]", '"x"', "x", "null"], C.json_kind("t"))
    assert [k and k.split("<")[0] for k in kinds] == ["OBJECT", "ARRAY", "STRING", None, "VOID"]


def test_booleans_and_scores(spark):
    texts = ["YES", " végétarien ", "Not Vegetarian", "0", "n/a", "", None, "maybe"]
    assert many(spark, texts, V.coerce_bool("t")) == [True, True, False, False, None, None, None, None]
    assert many(spark, ["0.5", "7", "-1", "x", None, "nan"], V.coerce_score("t")) == [0.5, 1.0, 0.0, 0.0, 0.0, 1.0]
    assert many(spark, ["on", " OFF ", "t", "2", None], C.try_boolean("t")) == [True, False, True, None, None]


def test_absent_member_differs_from_null(spark):
    null_lang, absent_lang = answers(spark, '{"lang":null,"recipe_language":"fr"}', '{"recipe_language":"fr"}')
    assert null_lang["lang"] == "unknown" and absent_lang["lang"] == "fr"


def test_answer_shapes(spark):
    rows = answers(spark, '[{"lang":"fr"}]', "[]", '[{"a":1},{"b":2}]', '"text"', "[1]", None, "{}")
    assert [r["error"] is None for r in rows] == [True, False, False, False, False, False, True]
    assert rows[6]["is_recipe"] is False and rows[6]["recipe_status"] == "food_content"


def test_answer_cross_field_defaults(spark):
    full, text = answers(
        spark,
        '{"ingredients":["A","b","b"],"caption_completeness_score":0.9,"recipe_title":"T","recipe_text":" x ","is_veg":1}',
        '{"is_recipe":false,"final_recipe_title":"T","final_recipe_text":"x","final_recipe_confidence":0.9,"is_veg":"unclear"}',
    )
    assert full["ingredients"] == ["a", "b"] and full["has_ingredient_list"] and full["has_instructions"]
    assert full["recipe_status"] == "full_recipe" and full["final_recipe_text"] == "x" and full["is_veg"] is True
    assert full["final_recipe_confidence"] == 0.9
    filled = json.loads(full["final_recipe_json"])
    assert filled["title"] == "T" and filled["ingredients"] == ["a", "b"] and filled["steps"] == []
    assert (text["final_recipe_title"], text["final_recipe_text"], text["final_recipe_confidence"]) == ("", "", 0.0)
    assert text["is_veg"] is None


def test_recipe_json_keeps_other_members(spark):
    df = spark.createDataFrame([('{"x":{"y":[1]},"steps":["s"]}', ""), ("oops", "T")], "j string, t string")
    filled = V.fill_recipe_json("j", "t", F.array(F.lit("i")), F.array().cast("array<string>"))
    a, b = [json.loads(r[0]) for r in df.select(filled).collect()]
    assert a["x"] == {"y": [1]} and a["steps"] == ["s"] and a["title"] == "Untitled recipe" and a["ingredients"] == ["i"]
    assert b == {"title": "T", "ingredients": ["i"], "steps": [], "notes": [], "missing_info": []}


def test_list_field_shapes(spark):
    texts = ['["a",{"name":"b"},null]', '{"items":["x"]}', '{"name":"solo"}', "- one\n- two\n\n", "a, b,,", '"q, r"', "None",
             "null", None, "7", '{"ingredients":[],"values":"u,v"}']
    assert many(spark, texts, I.coerce_list_field("t")) == [
        ["a", '{"name":"b"}', None], ["x"], ['{"name":"solo"}'], ["one", "two"], ["a", "b"], ["q", "r"], [], [], [], ["7"],
        ["u", "v"]]


def test_list_field_members_that_are_texts(spark):
    texts = [r'{"x":1,"ingredients":"{\"x\":1,\"items\":\"[]\"}"}', '{"items":"[]"}', '{"items":"0"}', '{"items":"false"}', '{"items":"{}"}',
             '{"x":1,"items":[]}', '{"items":"","values":["v"]}', '{"items":0.00,"values":["v"]}', '{"items":false}', '{"items":null}', '{"items":{}}']
    assert many(spark, texts, I.coerce_list_field("t")) == [
        [], [], ["0"], ["false"], ["{}"], ['{"x":1,"items":[]}'], ["v"], ["v"], ['{"items":false}'], ['{"items":null}'], ['{"items":{}}']]


def test_ingredient_display(spark):
    texts = ['{"name":"rice","quantity":200,"unit":"g","notes":"washed"}', '{"ingredient":"oil","quantity":0,"unit":"l"}',
             '{"text":"salt","preparation":"fine"}', "['egg']", "{}", " plain "]
    assert many(spark, texts, I.format_ingredient("t")) == [
        "200 g rice (washed)", "oil", "salt (fine)", "egg", "ingredient", "plain"]


def brute_key(value):
    text = re.sub(r"\([^)]*\)", "", value.lower())
    text = re.sub(r"\b\d+([.,]\d+)?\b", "", text)
    text = re.sub(rf"\b(?:{vocab.INGREDIENT_NOISE_WORDS})\b", " ", text)
    text = re.sub(r"[^a-zà-ÿ0-9]+", " ", text).strip()
    return text or value.lower().strip()


def brute_merge(values):
    def weaker(v, others):
        return not re.search(r"\d", v) and any(
            re.search(r"\d", o) and (brute_key(o) in brute_key(v) or brute_key(v) in brute_key(o)) for o in others)

    out = []
    for v in values:
        if weaker(v, out):
            continue
        out = [o for o in out if not weaker(o, [v])]
        if brute_key(v) not in {brute_key(o) for o in out}:
            out.append(v)
    return out


WORDS = ["egg", "2 eggs", "eggs", "flour", "200 g flour", "brown sugar", "sugar", "1 cup sugar", "Salt", "salt", "3", "rice (2 cups)"]


@settings(max_examples=40, deadline=None)
@given(lists=st.lists(st.lists(st.sampled_from(WORDS), max_size=7), min_size=8, max_size=8))
def test_merge_against_brute_force(spark, lists):
    df = spark.createDataFrame(list(enumerate(lists)), "i int, a array<string>")
    got = {r["i"]: r["m"] for r in df.select("i", I.merge_similar_ingredients("a").alias("m")).collect()}
    assert got == {i: brute_merge(values) for i, values in enumerate(lists)}


def test_keys(spark):
    df = spark.createDataFrame(
        [(" 7 ", "u/video/8"), ("", "u/video/8"), (None, " u "), (None, " ")], "c string, u string")
    assert [r[0] for r in df.select(C.content_key("c", "u")).collect()] == ["7", "8", "u", None]
    urls = ["https://x/@a/video/12?x=1", "https://x/p/34?z", "https://x/p/56", "https://x/p/ab/", None]
    assert many(spark, urls, C.video_id_from_url("t")) == ["12", "34", "56", None, None]
    assert many(spark, urls[:4], C.seed_content_id("t")) == ["12", "34?z", "56", "ab"]


def test_language_codes(spark):
    texts = ["English", "FRANCAIS", "français", "de", None, " en"]
    assert many(spark, texts, C.normalize_language_code("t")) == ["en", "fr", "unknown", "unknown", "unknown", "unknown"]
    assert many(spark, texts, C.normalize_language_code("t", vocab.ANSWER_LANGUAGE_ALIASES, trim=True)) == [
        "en", "fr", "fr", "unknown", "unknown", "en"]
    assert many(spark, ["fr", "xx", "Klingon", None], C.language_label("t")) == ["French", "XX", "Klingon", ""]


def test_raw_items(spark):
    rows = ['{"id":5,"desc":"Easy recipe","createTime":"1700000000","author":{"uniqueId":"","nickname":"n"}}',
            '{"id":"6","desc":"cats"}', '{"desc":"recipe"}', "nonsense", '{"id":"7","desc":"lunch","createTime":"soon"}']
    df = spark.createDataFrame(list(enumerate(rows)), "k int, item string")
    good = {r["CONTENT_ID"]: r for r in items.item_from_raw_json(df, keep=["k"]).collect()}
    bad = items.reject_rows(df, source_value="x", keep=["k"]).collect()
    assert set(good) == {"5", "7"} and {r["k"] for r in bad} == {1, 2, 3}
    assert good["5"]["VERIFICATION_SOURCE_URL"].endswith("/@n/video/5?published_at=2023-11-14T22:13:20+00:00")
    assert good["7"]["VERIFICATION_SOURCE_URL"].endswith("/@unknown_creator/video/7")


def test_edges_of_quality(spark):
    df = spark.createDataFrame([(True, True, True, 1.0, 1.0, 1.0, 3, 2, 9), (None, True, True, 1.0, 1.0, 1.0, 3, 2, 0)],
                               "r boolean, a boolean, b boolean, c double, f double, e double, i int, s int, m int")
    score = V.quality_score("r", "a", "b", "c", "f", "e", "i", "s", "m")
    got = df.select(score.alias("s"), V.quality_grade(score).alias("g")).collect()
    assert [(r["s"], r["g"]) for r in got] == [(0.85, "A"), (0.0, "D")]
    edges = spark.createDataFrame([(0.8,), (0.6,), (0.4,), (0.39,)], "s double")
    assert [r[0] for r in edges.select(V.quality_grade("s")).collect()] == ["A", "B", "C", "D"]
