import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clipcatalog import vocab
from clipcatalog.operators import joins as J
from clipcatalog.operators import ordinals, ranking, recovery, rollups, serving
from clipcatalog.operators import upsert as U
from clipcatalog.operators.checks import check_report

T0 = datetime(2024, 3, 1)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def evidence(spark, n, hot_share=0.5, seed=3):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = 1 if rnd.random() < hot_share else rnd.choice([None, 2, 3])
        data.append((i, key, f"text {i}", rnd.randint(0, 9), rnd.choice([0.1, 0.2, 0.5, 0.9]),
                     T0 + timedelta(minutes=rnd.randint(0, 600))))
    return spark.createDataFrame(
        data, "evidence_id long, raw_id long, evidence_text string, evidence_length long, "
              "evidence_quality_score double, created_at timestamp_ntz")


def test_rank_in_slices_equals_a_window(spark):
    df = evidence(spark, 400)
    order = [F.col("evidence_quality_score").desc(), F.col("created_at").desc(), F.col("evidence_id").desc()]
    sliced = ordinals.rank_in_slices(
        df, ["raw_id"], [(F.col("evidence_quality_score"), True), (F.date_trunc("hour", "created_at"), True)],
        [F.col("created_at").desc(), F.col("evidence_id").desc()], "r", {"top": "evidence_quality_score"})
    plain = df.withColumn("r", F.row_number().over(Window.partitionBy("raw_id").orderBy(*order)).cast("long"))
    assert rows(sliced.select("evidence_id", "r")) == rows(plain.select("evidence_id", "r"))
    best = {r["raw_id"]: r["m"] for r in df.groupBy("raw_id").agg(F.max("evidence_quality_score").alias("m")).collect()}
    assert all(r["top"] == best[r["raw_id"]] for r in sliced.collect())


def test_hot_item_keeps_every_text(spark):
    df = evidence(spark, 600, 0.8)
    parts = rollups.evidence_concat(df, part_rows=50)
    want = df.filter("evidence_length > 0 AND evidence_quality_score >= 0.2")
    got = parts.select("raw_id", F.explode(F.split("recovery_text", "\n\n")).alias("t"))
    assert rows(got.select("t")) == rows(want.select("evidence_text"))
    assert parts.filter("raw_id = 1").count() == -(-want.filter("raw_id = 1").count() // 50)
    assert parts.agg(F.max(F.size(F.split("recovery_text", "\n\n")))).first()[0] <= 50


def test_pieces_are_cut_exactly(spark):
    data = [(1, i, f"piece-{i % 3000}") for i in range(6000)] + [(2, 0, "  "), (3, 5, "b"), (3, 4, "a"), (3, 6, "a")]
    df = spark.createDataFrame(data, "k long, o long, t string")
    got = {r["k"]: r["text"] for r in rollups.distinct_lines_concat(df, "k", "o", "t").collect()}
    assert got[1] == "\n".join(f"piece-{i}" for i in range(3000))[:10_000]
    assert got[3] == "a\nb" and 2 not in got
    ones = spark.createDataFrame([(1, i, "x") for i in range(7000)], "k long, o long, t string")
    joined = rollups.segments_concat(ones, "k", "o", "t").first()["transcript"]
    assert joined == " ".join("x" for _ in range(7000))[:10_000]


def test_ids_are_dense_and_stable(spark):
    df = spark.createDataFrame([(f"u{i}",) for i in range(500)], "url string")
    now = F.lit("2024-01-01").cast("timestamp_ntz")

    def run(parts):
        return rows(ordinals.assign_ids_and_defaults(df.repartition(parts), 40, now, ["url"], "raw_id").select("raw_id", "url"))

    once = run(3)
    assert once == run(7)
    assert sorted(r[0] for r in once) == list(range(41, 541))


def brute_waterfall(best, has_link, scores):
    ran = []
    for m in vocab.METHOD_ORDER:
        if best >= 0.70 or m not in scores:
            continue
        wanted = {"web_caption": True, "audio_transcript": best < 0.70, "ocr": best < 0.55,
                  "external_url": has_link, "comments": best < 0.55}[m]
        if wanted:
            ran.append(m)
            best = max(best, scores[m])
    return ran, best


def test_waterfall_against_brute_force(spark):
    rnd = random.Random(5)
    items, attempts, want = [], [], {}
    for i in range(150):
        best, link = rnd.choice([None, 0.0, 0.4, 0.6, 0.7]), rnd.random() < 0.5
        scores = {m: rnd.choice([0.0, 0.5, 0.56, 0.69, 0.7, 0.9]) for m in vocab.METHOD_ORDER if rnd.random() < 0.7}
        items.append((i, best, link))
        attempts += [(i, m, s) for m, s in scores.items()]
        want[i] = brute_waterfall(best or 0.0, link, scores)
    out = recovery.adaptive_waterfall(
        spark.createDataFrame(attempts, "raw_id long, method string, score double"),
        spark.createDataFrame(items, "raw_id long, best_score double, has_link boolean"))
    assert {r["raw_id"]: (r["methods_run"], r["best_score"]) for r in out.collect()} == want


def test_merge_rules(spark):
    target = spark.createDataFrame([("a", "long text", "x", 1), ("b", "t", "", 2), (None, "n", "n", 9)],
                                   "k string, txt string, own string, v long")
    source = spark.createDataFrame([("a", "short", "y", 5), ("b", "longer", "z", 1), ("c", "new", None, 7), (None, "m", "m", 1)],
                                   "k string, txt string, own string, v long")
    rules = {"txt": U.longer_text, "own": U.keep_if_set, "v": U.newest}
    merged = U.merge(target, source, ["k"], rules, {"own": F.lit("default")})
    assert rows(merged) == rows(spark.createDataFrame(
        [("a", "long text", "x", 5), ("b", "longer", "z", 2), ("c", "new", "default", 7), (None, "n", "n", 9), (None, "m", "m", 1)],
        "k string, txt string, own string, v long"))


def test_merge_with_computed_key_is_idempotent(spark):
    target = spark.createDataFrame([(1, None, "7", None, "t", "d", "https://x/video/7")],
                                   "raw_id long, platform string, content_id string, creator_username string, title string, description string, url string")
    source = spark.createDataFrame([(2, "tiktok", None, "c", "title", "d", "https://y/video/7"), (3, "tiktok", "8", "c", "t", "d", "u")],
                                   target.schema)
    once = U.upsert_longest_text(target, source)
    assert rows(once) == rows(U.upsert_longest_text(once, source))
    assert {(r["raw_id"], r["title"], r["creator_username"], r["url"]) for r in once.collect()} == {
        (1, "title", "c", "https://x/video/7"), (3, "t", "c", "u")}


def test_update_clears_errors(spark):
    target = spark.createDataFrame([(1, "new", "old", T0), (2, "new", "old", T0), (3, "new", "old", T0)],
                                   "id long, status string, last_error string, updated_at timestamp_ntz")
    changes = spark.createDataFrame([(1, "failed", "why"), (2, "extracted_success", "why")], "id long, status string, last_error string")
    out = U.update_where(target, changes, "id", F.lit("2025-01-01").cast("timestamp_ntz"))
    assert [(r["id"], r["status"], r["last_error"], r["updated_at"].year) for r in out.orderBy("id").collect()] == [
        (1, "failed", "why", 2025), (2, "extracted_success", None, 2025), (3, "new", "old", 2024)]


def test_recent_runs(spark):
    df = spark.createDataFrame([
        ("completed", "2024-01-10T06:00:00Z"), ("completed", "2024-01-09T06:00:00Z"), ("completed", "2024-01-10T06:00:00"),
        ("completed", "2024-01-10T08:00:00+02:00"), ("failed", "2024-01-10T06:00:00Z"), ("completed", "bad"), ("completed", None),
    ], "s string, c string")
    now = F.lit("2024-01-10T12:00:00+00:00").cast("timestamp")
    assert [r[0] for r in df.select(recovery.creator_recent("s", "c", now, 20)).collect()] == [
        True, False, True, True, False, False, False]


def test_method_plan(spark):
    df = spark.createDataFrame([("see https://a.example",), ("nothing",), (None,)], "t string")
    assert [r[0] for r in df.select(recovery.method_plan("t", skip_ocr=True)).collect()] == [
        ["web_caption", "audio_transcript", "external_url"], ["web_caption", "audio_transcript"],
        ["web_caption", "audio_transcript"]]


def test_candidate_modes(spark):
    source = spark.createDataFrame([(i, "d" if i != 5 else " ") for i in range(1, 7)], "raw_id long, description string")
    done = spark.createDataFrame([(1, T0), (2, T0), (3, None)], "raw_id long, processed_at timestamp_ntz")
    ev = spark.createDataFrame([(1, T0, 0.5), (2, T0 - timedelta(1), 0.5), (3, T0, 0.5), (4, T0, 0.5)],
                               "raw_id long, latest_evidence_at timestamp_ntz, evidence_quality_score double")

    def ids(mode):
        return sorted(r["raw_id"] for r in J.incremental_candidates(source, done, ev, mode).collect())

    assert ids("new") == [4, 6] and ids("recovered") == [1, 3, 4] and ids("all") == [1, 2, 3, 4, 6]
    with pytest.raises(ValueError):
        ids("other")


def test_forced_retry_skips_nothing(spark):
    plan = spark.createDataFrame([(1, "ocr"), (1, "comments")], "raw_id long, method string")
    log = spark.createDataFrame([(1, "ocr", "attempted_failed", T0), (1, "comments", "usable_recipe_text", T0)],
                                "raw_id long, method string, status string, created_at timestamp_ntz")
    now = F.lit("2024-03-01 05:00:00").cast("timestamp_ntz")
    tie = [F.col("status")]
    assert rows(recovery.skip_recent(plan, log, now, 24, tie)) == [(1, "comments")]
    assert recovery.skip_recent(plan, log, now, 2, tie).count() == 2
    assert recovery.skip_recent(plan, log, now, 24, tie, force=True).count() == 2


def test_list_limits_and_empty_facets(spark):
    df = spark.createDataFrame([(1, "a", 0.5, True), (2, None, None, None)], "raw_id long, c string, p double, v boolean")
    for limit in (0, 501):
        with pytest.raises(ValueError):
            serving.list_query(df, limit=limit)
    with pytest.raises(ValueError):
        serving.sorted_page(df, "newest", 10)

    def facet(**kw):
        return serving.facet_filter(df, confidence="p", flag="v", **kw).count()

    assert facet(in_lists={"c": []}) == 2 and facet(in_lists={"c": ["a"]}) == 1
    assert facet(in_lists={"c": []}, empty_selects_nothing=True) == 0
    assert facet(dietary="vegetarian") == 1 and facet(dietary="non_vegetarian") == 1


def test_buckets_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.51,), (0.9,), (1.0,), (None,), (1.2,)], "p double")
    assert dict(serving.confidence_buckets(df, "p").collect()) == {
        "0-0.50": 3, "0.50-0.75": 1, "0.75-0.90": 1, "0.90-1.00": 1, "unknown": 1}


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "cuisine_style string, main_ingredient string, recipe_quality_score double, "
                                      "is_vegetarian boolean, processing_confidence double")
    assert serving.search_metrics(empty).first()[:] == (0, 0, 0, 0.0)
    assert serving.kpi_row(empty, empty).first()[:] == (0, 0, 0.0, 0.0, 0, 0)
    assert [r["unknown_rate"] for r in serving.field_completeness(empty, ["cuisine_style"]).collect()] == [0.0]


def test_failed_prompts_do_not_fail_the_job(spark):
    def answer(prompts):
        return [str(10 // len(p)) for p in prompts]

    df = spark.createDataFrame([(1, "ab"), (2, ""), (3, "abcde")], "id long, p string").coalesce(1)
    got = {r["id"]: (r["response"], r["status"]) for r in serving.enrich_with(df, answer, "id", "p").collect()}
    assert got == {1: ("5", "ok"), 2: (None, "failed"), 3: ("2", "ok")}


def test_an_error_per_prompt_is_not_asked_again(spark):
    def answer(prompts):
        if len(prompts) < 3:
            raise AssertionError("asked again")
        return [ValueError("bad") if p == "" else p.upper() for p in prompts]

    df = spark.createDataFrame([(1, "ab"), (2, ""), (3, "c")], "id long, p string").coalesce(1)
    got = {r["id"]: (r["response"], r["status"], r["error"]) for r in serving.enrich_with(df, answer, "id", "p").collect()}
    assert got == {1: ("AB", "ok", None), 2: (None, "failed", "ValueError: bad"), 3: ("C", "ok", None)}


def test_report(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 2.0), (None, None)], "id long, s double")
    report = check_report([("range", df, F.col("s") > 1), ("null", df, F.col("id").isNull())],
                          [("unique", df, "id", None), ("some", df, "id", F.col("s") < 0)])
    assert rows(report) == [
        ("null", 1, "fail"), ("range", 1, "fail"), ("some", 0, "pass"), ("unique", 1, "fail")]


def test_best_row_prefers_full_recipes(spark):
    df = spark.createDataFrame(
        [(1, "k", 0.5, "food_content"), (2, "k", 0.5, "full_recipe"), (3, "k", 0.5, "partial_recipe"), (4, "k", None, "full_recipe")],
        "raw_id long, content_key string, recipe_quality_score double, recipe_status string"
    ).selectExpr("*", "0.1D AS final_recipe_confidence", "0.1D AS caption_completeness_score", "0.1D AS processing_confidence",
                 "current_timestamp() AS processed_at")
    assert ranking.best_row_per_key(df).first()["raw_id"] == 2


def test_pieces_are_all_counted(spark):
    """Pieces behind the cut are left out of the text, not out of the count."""
    lines = spark.range(7000).select(F.lit(1).alias("item"), F.col("id").alias("ordinal"),
                                     F.concat(F.lit("line "), F.col("id").cast("string")).alias("text"))
    row = rollups.distinct_lines_concat(lines, "item", "ordinal", "text").first()
    assert row["pieces"] == 7000 and len(row["text"]) == vocab.PIECES_CHARS
    assert rollups.segments_concat(lines, "item", "ordinal", "text").first()["pieces"] == 7000


def test_creator_scores_replace_known_creators_and_add_new_ones(spark):
    schema = "creator_username string, videos_scanned long, status string, updated_at timestamp_ntz"
    old = spark.createDataFrame([("a", 1, "active", T0), ("b", 2, "active", T0)], schema)
    new = spark.createDataFrame([("b", 5, "high_yield"), ("c", 7, "active")], "creator_username string, videos_scanned long, status string")
    now = F.lit("2024-03-02 00:00:00").cast("timestamp_ntz")
    got = U.upsert_creator_scores(old, new, now).orderBy("creator_username").collect()
    assert [(r[0], r[1], r[2], r[3] == T0) for r in got] == [
        ("a", 1, "active", True), ("b", 5, "high_yield", False), ("c", 7, "active", False)]
