import json
import tempfile

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcatalog import schemas
from clipcatalog.operators import upsert as U
from clipcatalog.plans import medallion, views
from clipcatalog.sources import files as S
from clipcatalog.sources.keyed_table import KeyedTable
from clipcatalog.sources.terms import load_terms
from clipcatalog.streaming import events as EV
from clipcatalog.streaming import sinks as SK

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def put(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def table_rows(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_positional_csv(spark, folder):
    put(folder, "a.csv", '﻿A,B,C\n x ,"say ""hi"", ok",NULL\n1,"two\nlines",3\n')
    put(folder, "b.csv", "A\nonly\n\n")
    put(folder, "c.csv", "A,B,C\n1,2,3,4\nnull,,z\n")
    put(folder, "skip.txt", "A\nno\n")
    got = S.read_positional_csv(spark, folder, ["a", "b", "c"])
    assert sorted([tuple(r) for r in got.collect()], key=repr) == sorted([
        ("x", 'say "hi", ok', None, "a.csv"), ("1", "two\nlines", "3", "a.csv"), ("only", None, None, "b.csv"),
        (None, None, "z", "c.csv")], key=repr)
    bad = S.read_positional_csv(spark, folder, ["a", "b", "c"], quarantine=True).collect()
    assert [(r["bad_row"], r["SOURCE_FILE"]) for r in bad] == [("1,2,3,4", "c.csv")]


def test_csv_without_line_ends_in_fields_is_read_by_several_tasks(spark, folder):
    put(folder, "a.csv", "A,B\n" + "".join(f'{i},"t, ""{i}"" é"\n' for i in range(40_000)) + "1,2,3,4\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        got = S.read_positional_csv(spark, folder, ["a", "b"], multi_line=False)
        named = S.read_named_csv(spark, [f"{folder}/a.csv"], ["a"], ["A", "B"], multi_line=False)
        assert got.rdd.getNumPartitions() > 4 and named.rdd.getNumPartitions() > 4
        assert S.read_positional_csv(spark, folder, ["a", "b"]).rdd.getNumPartitions() == 1
        whole = S.read_positional_csv(spark, folder, ["a", "b"])
        assert got.count() == 40_000 and got.exceptAll(whole).count() == 0
        assert S.read_positional_csv(spark, folder, ["a", "b"], quarantine=True, multi_line=False).count() == 1
        assert named.filter("A <> '1' OR B <> '2'").select("A", "B").exceptAll(whole.select("a", "b")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_named_csv_and_missing_columns(spark, folder):
    put(folder, "a.csv", "﻿title,URL\nt,u\nx,\n")
    got = S.read_named_csv(spark, [f"{folder}/a.csv"], ["TITLE", "url"], ["URL", "TITLE", "EXTRA"], url="URL")
    assert [tuple(r) for r in got.collect()] == [("u", "t", "")]
    with pytest.raises(ValueError, match="missing required columns: \\['DESCRIPTION'\\]"):
        S.read_named_csv(spark, [f"{folder}/a.csv"], ["TITLE", "DESCRIPTION"], ["TITLE"])


def test_named_csv_with_two_header_orders_in_one_folder(spark, folder):
    put(folder, "a b.csv", "title,url\nT1,U1\n\"two\nlines\",U3\n")
    put(folder, "b.csv", "URL,Title\nU2,T2\n")
    put(folder, "c.csv", "")
    got = S.read_named_csv(spark, [folder], ["title", "url"], ["title", "url"])
    assert sorted(tuple(r) for r in got.collect()) == [("T1", "U1"), ("T2", "U2"), ("two\nlines", "U3")]


def test_inputs_must_exist(spark, folder):
    put(folder, "x.csv", "a\n")
    assert [r["name"] for r in S.list_inputs(spark, folder, "*.csv").collect()] == ["x.csv"]
    with pytest.raises(FileNotFoundError):
        S.list_inputs(spark, folder, "*.json")


def test_optional_table(spark, folder):
    assert S.read_optional(spark, f"{folder}/none", SCHEMA).columns == ["k", "v"]
    put(folder, "bad.parquet", "not parquet")
    with pytest.raises(Exception) as error:
        S.read_optional(spark, f"{folder}/bad.parquet", SCHEMA).count()
    assert not isinstance(error.value, AnalysisException) or "PATH_NOT_FOUND" not in str(error.value)


def test_terms(spark, folder):
    put(folder, "lines.txt", "# note\n one \n\ntwo\n #x\n")
    put(folder, "list.json", '[" a ", "", "b"]')
    put(folder, "named.json", '{"creators": ["c1", "c2"], "creators_by_language": {"en": ["x"]}}')
    put(folder, "grouped.json", '{"creators_by_language":\n {"en": ["x", "y"], "fr": ["y", "z"]}}')

    def terms(name, kind="json"):
        return [r["term"] for r in load_terms(spark, f"{folder}/{name}", kind=kind).collect()]

    assert terms("lines.txt", "lines") == ["one", "two"]
    assert terms("list.json") == ["a", "b"] and terms("named.json") == ["c1", "c2"]
    assert sorted(terms("grouped.json")) == ["x", "y", "z"]
    assert [r[0] for r in load_terms(spark, None, ["d"]).collect()] == ["d"]


def test_keyed_table(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", SCHEMA, ["k"], buckets=4)
    assert table_rows(table) == []
    first = spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA)
    assert table.upsert(first, batch=0)
    assert not table.upsert(spark.createDataFrame([("a", 99)], SCHEMA), batch=0)
    table.upsert(spark.createDataFrame([("b", 5), ("c", 3)], SCHEMA), {"v": U.newest}, batch=1)
    table.upsert(spark.createDataFrame([("b", 5), ("c", 3)], SCHEMA), {"v": U.newest})
    assert table_rows(table) == [("a", 1), ("b", 5), ("c", 3)] and table.last_batch() == 1
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([("d", 1), ("d", 2)], SCHEMA))
    old_reader = table.read()
    broken = spark.createDataFrame([("a", 7)], SCHEMA).withColumn("v", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception):
        table.upsert(broken)
    assert table_rows(table) == [("a", 1), ("b", 5), ("c", 3)]
    table.upsert(spark.createDataFrame([("a", 8)], SCHEMA))
    assert sorted(tuple(r) for r in old_reader.collect()) == [("a", 1), ("b", 5), ("c", 3)]
    assert table_rows(table)[0] == ("a", 8)


def test_stream_equals_batch_after_a_restart(spark, folder):
    import os

    os.makedirs(f"{folder}/in")
    put(f"{folder}/in", "1.json", '{"content_id":"1","url":"u","title":"first"}\n{"content_id":"2","url":"u"}\nnope\n{"url":"x"}\n')
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("record_hash", "content_id", "title", "source_file")])
    table = KeyedTable(spark, f"{folder}/t", schema, ["record_hash"], buckets=2)

    def drain():
        valid, _ = EV.normalize_event(EV.read_events(spark, {"path": f"{folder}/in"}))
        SK.stream_upsert(valid.select(*schema.names), table, f"{folder}/cp", ["record_hash"], [F.col("title").desc()])

    drain()
    put(f"{folder}/in", "2.json", '{"video_id":"1","url_tiktok":"u","title":"second","platform":" ","creator_username":"c"}\n')
    drain()
    drain()
    assert [(r["content_id"], r["title"], r["source_file"]) for r in table.read().orderBy("content_id").collect()] == [
        ("1", "second", "kafka_tiktok_c"), ("2", "", "kafka_tiktok_unknown_creator")]


def test_events_round_trip(spark, folder):
    item = spark.createDataFrame([("tiktok", "c", "9", "t", "d", "u", True)],
                                 "platform string, creator_username string, content_id string, title string, "
                                 "description string, url string, description_is_partial boolean")
    EV.write_events(EV.build_event(item, F.lit("2024-01-01T00:00:00+00:00"), "catalog_monitor"), {"path": f"{folder}/e"})
    valid, bad = EV.normalize_event(EV.parse_events(spark.read.text(f"{folder}/e")))
    row = valid.first()
    assert (row["content_id"], row["url"], row["description_is_partial"]) == ("9", "u", True) and bad.count() == 0


def test_first_seen_with_watermark(spark, folder):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:02:00")],
                                 "k string, ts string")
    rows.write.json(f"{folder}/in")
    stream = spark.readStream.schema("k string, ts timestamp").json(f"{folder}/in")
    out = SK.stream_first_seen(stream, ["k"], ("ts", "1 hour"))
    SK.bounded_drain(out, lambda batch, _: batch.write.mode("append").parquet(f"{folder}/out"), f"{folder}/cp")
    assert sorted(r["k"] for r in spark.read.parquet(f"{folder}/out").collect()) == ["a", "b"]


def test_first_seen_forgets_old_keys(spark, folder):
    """A month in daily files: state stays at some days, repeats are left out, late rows are counted and left out."""
    days = spark.range(30 * 200).selectExpr(
        "cast(id div 200 as int) as d", "concat('k', id % 100) as k").selectExpr(
        "k", "d", "timestamp'2024-01-01 12:00:00' + make_dt_interval(d, cast(substr(k, 2) as int) % 10) as ts")
    EV.replay_events(days, f"{folder}/in", "ts", 30, ["k", "ts"])
    EV.write_events(days.filter("d < 5"), {"path": f"{folder}/in"}, ["k", "ts"])
    stream = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 2).json(f"{folder}/in")
    first = SK.stream_first_seen(stream.withColumn("day", F.to_date("ts")), ["k", "day"], ("ts", "2 days"))
    progress = SK.bounded_drain(first, lambda batch, _: batch.write.mode("append").parquet(f"{folder}/out"), f"{folder}/cp")
    got = spark.read.parquet(f"{folder}/out")
    assert got.count() == got.select("k", "day").distinct().count() == 30 * 100
    states = [p["stateOperators"][0] for p in progress if p["stateOperators"]]
    assert max(s["numRowsTotal"] for s in states) <= 10 * 100 and states[-1]["numRowsTotal"] <= 5 * 100
    assert sum(s["numRowsDroppedByWatermark"] for s in states) >= 5 * 100


def test_batch_run_end_to_end(spark):
    """Landing rows to the catalog, with answers that come from the prompts."""
    landing = spark.createDataFrame([
        (1, " ", None, "Chef", "Cake", "Recipe: 2 eggs, flour. Mix and bake.", "https://x/@chef/video/10", "true", "no", None, None, "a.csv"),
        (2, "tiktok", "10", None, "Cake again", "Recipe: 2 eggs, flour. Mix and bake well please.", "https://x/@chef/video/10", "no", "yes", None, None, "b.csv"),
        (3, "tiktok", "11", "other", "Cats", "cats playing", "https://x/@other/video/11", "no", "no", None, None, "b.csv"),
    ], "raw_id long, platform string, content_id string, creator_username string, title string, description string, url string, "
       "description_is_partial string, description_enriched string, evidence_text string, recovered_text string, source_file string")
    best = medallion.landing_rows(landing, keep_id=True)
    assert sorted(r["raw_id"] for r in best.collect()) == [2, 3]
    bronze = best.withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    silver_schema = "raw_id long, processed_at timestamp_ntz"
    ev = spark.createDataFrame(
        [(1, 2, "comments", "200 g sugar", 11, 0.5, True, "h")],
        "evidence_id long, raw_id long, source_type string, evidence_text string, evidence_length long, "
        "evidence_quality_score double, is_recipe_signal boolean, record_hash string",
    ).withColumn("created_at", F.lit("2024-01-02").cast("timestamp_ntz"))
    requests = medallion.enrichment_requests(bronze, spark.createDataFrame([], silver_schema), ev)
    assert requests.filter("raw_id = 2 AND evidence_text LIKE '%200 g sugar'").count() == 1
    answers = requests.select("raw_id", F.when(
        F.contains("prompt", F.lit("Recipe")),
        '{"lang":"en","ingredients":["egg","flour","sugar"],"caption_completeness_score":0.9,"recipe_title":"Cake",'
        '"recipe_text":"Mix. Bake.","final_recipe_json":{"steps":["mix","bake"]},"cuisine":"french"}').otherwise("sorry").alias("response"))
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    typed, bad = medallion.typed_rows(requests, answers, "model-x", now)
    assert [r["raw_id"] for r in bad.collect()] == [3]
    gold = views.build_catalog(typed, ev, [F.col("record_hash")])
    api = views.api_catalog(gold).collect()
    assert [(r["id"], r["title"], r["language"], r["cuisine_style"], r["recipe_quality_grade"]) for r in api] == [
        (2, "Cake", "en", "French", "A")]
    recipes, evidence = views.stage_recipes(typed, [F.col("record_hash")]), views.stage_evidence(ev)
    report = views.catalog_checks(recipes, evidence, gold)
    assert {r["result"] for r in report.collect()} == {"pass"}

    old = spark.createDataFrame([], typed.schema)
    ask = lambda wanted: answers.join(wanted.select("raw_id").distinct(), "raw_id")
    first = medallion.run_batch(landing, old, ev, ask, "model-x", now)
    assert [(r["id"], r["recipe_quality_grade"]) for r in first["api"].collect()] == [(2, "A")]
    assert {r["result"] for r in first["checks"].collect()} == {"pass"}
    done = spark.createDataFrame(first["typed"].collect(), typed.schema)
    again = medallion.run_batch(landing, done, ev, ask, "model-x", now)
    assert again["requests"].filter("raw_id = 2").count() == 0
    assert again["api"].collect() == first["api"].collect()


def test_batch_run_asks_once(spark):
    """However many frames of a batch run are written, each request is made up and answered once."""
    landing = spark.range(1, 7).selectExpr(
        "id as raw_id", "'tiktok' as platform", "cast(id as string) as content_id", "'chef' as creator_username", "'Cake' as title",
        "concat('Mix ', id, ' eggs.') as description", "concat('https://x/@chef/video/', id) as url", "'no' as description_is_partial",
        "'no' as description_enriched", "cast(null as string) as evidence_text", "if(id = 3, 'Bake.', null) as recovered_text",
        "'a.csv' as source_file")
    ev = spark.range(1, 5).selectExpr(
        "id as evidence_id", "id % 2 + 1 as raw_id", "'comments' as source_type", "concat('text ', id) as evidence_text",
        "10L as evidence_length", "0.5D as evidence_quality_score", "true as is_recipe_signal", "'h' as record_hash",
        "timestamp_ntz'2024-01-02 00:00:00' as created_at")
    silver = spark.createDataFrame([], "raw_id long, processed_at timestamp_ntz")
    asked = spark.sparkContext.accumulator(0)

    def ask(requests):
        def answers(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    asked.add(1)
                    said = "sorry" if row["raw_id"] == 6 else json.dumps({"is_recipe": True, "final_recipe_title": row["prompt"][:5]})
                    yield pa.RecordBatch.from_pylist([{"raw_id": row["raw_id"], "part_no": row["part_no"], "response": said}])

        return requests.select("raw_id", "part_no", "prompt").mapInArrow(answers, "raw_id long, part_no long, response string")

    made = medallion.run_batch(landing, silver, ev, ask, "m", F.lit("2024-02-01").cast("timestamp_ntz"), part_rows=1)
    typed, bad = made["typed"].collect(), made["rejected"].collect()
    wanted = {(r["raw_id"], r["part_no"]): r for r in made["requests"].collect()}
    assert sorted(wanted) == [(1, 0), (1, 1), (2, 0), (2, 1), (3, 0), (4, 0), (5, 0), (6, 0)] and asked.value == len(wanted)
    assert wanted[1, 0]["evidence_text"] == "Mix 1 eggs.\n\ntext 4" and wanted[1, 0]["recovered_text"] == "text 4"
    assert wanted[3, 0]["evidence_text"] == "Mix 3 eggs.\n\nBake." and wanted[4, 0]["recovered_text"] == ""
    assert {r["raw_id"]: r["evidence_parts"] for r in typed} == {1: 2, 2: 2, 3: 1, 4: 1, 5: 1} and [r["raw_id"] for r in bad] == [6]


def test_typed_rows_merge_every_part(spark):
    """An item whose evidence fills several requests gets one row that holds what every part's answer says."""
    requests = spark.createDataFrame(
        [(i, p, "T", "u", "h", "o", "r", f"evidence {p}", 0.0) for i in (1, 2) for p in range(4)],
        "raw_id long, part_no int, title string, url string, record_hash string, original_description string, "
        "recovered_text string, evidence_text string, evidence_quality_score double")
    parts = [
        '{"lang":"unknown","ingredients":["egg","flour"],"caption_completeness_score":0.1,"cuisine":"french","missing_info":["oven"],'
        '"is_recipe":true,"final_recipe_json":{"steps":["mix","mix",{"do":"rest"}],"notes":"cold"}}',
        '{"lang":"en","ingredients":["Flour","milk"],"caption_completeness_score":0.9,"recipe_title":"Cake","is_recipe":true,'
        '"has_instructions":false,"recipe_text":"Mix. Bake.","final_recipe_json":{"steps":["bake","mix"]},"missing_info":["time","oven"]}',
        "sorry",
        '{"lang":"en","ingredients":["salt"],"caption_completeness_score":0.8,"recipe_title":"Pie","is_recipe":false,'
        '"has_instructions":true,"final_recipe_json":{"steps":["serve",{"do":"rest"}]}}',
    ]
    answers = spark.createDataFrame(
        [(1, p, r) for p, r in enumerate(parts)] + [(2, 0, parts[1])], "raw_id long, part_no int, response string")
    typed, bad = medallion.typed_rows(requests, answers.repartition(3), "m", F.lit("2024-02-01").cast("timestamp_ntz"))
    rows = {r["raw_id"]: r.asDict() for r in typed.collect()}
    assert [(r["raw_id"], r["part_no"]) for r in bad.collect()] == [(1, 2)] and set(rows) == {1, 2}
    one, two = rows[1], rows[2]
    assert json.loads(one["ingredients"]) == ["egg", "flour", "milk", "salt"] and json.loads(one["missing_recipe_info"]) == ["oven", "time"]
    made = json.loads(one["final_recipe_json"])
    assert made["steps"] == ["mix", "mix", {"do": "rest"}, "bake", "serve"] and made["notes"] == ["cold"] and made["title"] == "Cake"
    assert (one["evidence_text"], one["evidence_parts"], one["recipe_language"], one["cuisine_style"]) == ("evidence 1", 3, "en", "french")
    assert one["has_instructions"] and one["caption_completeness_score"] == 0.9 and one["final_recipe_title"] == "Cake"
    assert json.loads(two["ingredients"]) == ["flour", "milk"] and json.loads(two["final_recipe_json"])["steps"] == ["bake", "mix"]
    assert (two["evidence_parts"], two["cuisine_style"], two["has_instructions"]) == (1, "unknown", False)


def test_layouts():
    assert len(schemas.VERIFIED_COLUMNS) == 13 and len(schemas.DISCOVERY_COLUMNS) == 19
    assert len(schemas.API_COLUMNS) == 16 and len(schemas.DASHBOARD_COLUMNS) == 41 and len(schemas.DEBUG_COLUMNS) == 34


def test_keyed_table_keeps_its_number_of_buckets(spark, folder):
    KeyedTable(spark, f"{folder}/t", SCHEMA, ["k"], buckets=4).upsert(spark.createDataFrame([("a", 1)], SCHEMA))
    with pytest.raises(ValueError):
        KeyedTable(spark, f"{folder}/t", SCHEMA, ["k"], buckets=8).read()


def test_keyed_table_shares_a_bucket_between_tasks(spark, folder):
    rows = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.col("id").alias("v"))
    table = KeyedTable(spark, f"{folder}/t", SCHEMA, ["k"], buckets=2)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        table.upsert(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(table.read().inputFiles()) > 2
    few = table.read_beside(rows.filter("v = 7"))
    assert 0 < few.count() < 200_000 and few.filter("v = 7").count() == 1
    assert table.read().count() == 200_000


def test_upsert_passes_no_batch_through_the_driver(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", SCHEMA, ["k"], buckets=2)
    table.upsert(spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")))
    spark.createDataFrame([("7", 70), ("x", 1), (None, 2)], SCHEMA).write.parquet(f"{folder}/new")
    got = table.merged([0, 1], spark.read.parquet(f"{folder}/new"), {"v": U.newest})
    assert got.count() == 102 and got.filter("k = '7'").first()["v"] == 70
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_merge_of_a_small_source_broadcasts_and_equals_the_full_join(spark, folder):
    spark.range(1000).select(
        F.when(F.col("id") % 50 > 0, F.col("id").cast("string")).alias("k"), F.col("id").alias("v")
    ).write.parquet(f"{folder}/old")
    spark.createDataFrame([("7", 70), ("x", 1), (None, 2), ("8", None)], SCHEMA).write.parquet(f"{folder}/new")
    old, new = spark.read.parquet(f"{folder}/old"), spark.read.parquet(f"{folder}/new")
    got = U.merge_small(old, new, ["k"], {"v": U.newest})
    want = U.merge(old, new, ["k"], {"v": U.newest})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 1002
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
