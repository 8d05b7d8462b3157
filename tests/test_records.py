import json

import pytest
from pyspark.sql import functions as F

from marquee.functions.values import as_float, as_int, as_text, passage, truthy
from marquee.operators.dedup import dedup_first, limit_first, top_n
from marquee.operators.merge import gather_all, merge_entities, pending
from marquee.operators.records import INDEX_FIELDS, is_api_error, normalize
from marquee.operators.report import build_counters, run_report
from marquee.plans.build import prepare


def decoded(spark, bodies, source="s.json"):
    rows = [(source, i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "source_path string, n bigint, body string")
    pos = F.struct(F.col("n").alias("major"), F.lit(0).cast("bigint").alias("minor"))
    return df.select("source_path", pos.alias("pos"), "body", F.try_parse_json("body").alias("record"))


def norm(spark, bodies):
    return [r.asDict() for r in normalize(decoded(spark, bodies)).orderBy("pos").collect()]


def test_coercion(spark):
    values = [None, "", " 7 ", "7.5", 3.7, True, False, "abc", "1_000", "1e3", "nan", 99999999999999999999, [], {}, [1], "false", 0, " x "]
    rec = F.col("record")
    rows = decoded(spark, [{"v": v} for v in values] + [{}]).orderBy("pos").select(
        as_int(rec, "$.v").alias("i"), as_float(rec, "$.v").alias("f"), as_text(rec, "$.v").alias("t"), truthy(rec, "$.v").alias("b"),
    ).collect()
    assert [r.i for r in rows] == [None, None, 7, None, 3, 1, 0, None, 1000, None, None, None, None, None, None, None, 0, None, None]
    floats = [r.f for r in rows]
    assert floats[:10] == [None, None, 7.0, 7.5, 3.7, 1.0, 0.0, None, None, 1000.0] and floats[10] != floats[10]
    assert [r.t for r in rows][:9] == ["", "", "7", "7.5", "3.7", "True", "False", "abc", "1_000"] and rows[17].t == "x"
    assert [r.b for r in rows] == [False, False, True, True, True, True, False, True, True, True, True, True, False, False, True, True, False, True, False]


@pytest.mark.parametrize(
    "record, kept",
    [
        ({"title": "  ", "id": 1, "genres": []}, False),
        ({"title": "a", "id": None, "imdb_id": "tt1", "cast": None}, True),
        ({"title": "a", "id": None, "imdb_id": "", "cast": None}, False),
        ({"title": "a", "id": 1}, False),
        ({"title": "a", "id": 0, "runtime": 1}, True),
        ([1, 2], False),
        ("text", False),
    ],
)
def test_record_shape(spark, record, kept):
    assert len(norm(spark, [json.dumps(record)])) == int(kept)


def test_normalised_document(spark):
    movie = {
        "id": "7", "title": " A ", "release_date": "19x9-01-01", "genres": [{"id": 1, "name": "X"}, 5, {"id": "2", "name": " "}, {"id": 3, "name": "X"}],
        "cast": [{"name": "" if i < 5 else f"n{i}", "character": "c"} for i in range(25)], "crew": "none",
        "reviews": [{"author": "r", "content": "y" * 2500}], "adult": "false", "budget": 0, "overview": "", "origin_country": ["US", "US"],
    }
    doc = norm(spark, [movie])[0]
    assert doc["doc_id"] == "7" and doc["movie_id"] == 7 and doc["title"] == "A"
    assert doc["release_year"] is None and doc["release_date"] == "19x9-01-01"
    assert doc["genres"] == ["X"] and doc["genre_ids"] == [1, 2, 3]
    assert doc["cast_names"] == [f"n{i}" for i in range(5, 20)] and doc["cast_characters"] == ["c"]
    assert doc["crew_names"] == [] and doc["review_count"] == 1 and len(doc["reviews_text"][0]) == 2000
    assert doc["adult"] is True and doc["budget"] == 0 and doc["overview"] is None and doc["origin_country"] == ["US", "US"]
    assert doc["all_text"].startswith("A X n5 ") and set(INDEX_FIELDS) <= set(doc)


def test_short_date_and_fallback_key(spark):
    short, broken = norm(spark, [{"id": 1, "title": "a", "release_date": "199"}, {"id": "7.5", "title": "b", "runtime": 1}])
    assert short["release_date"] is None and short["release_year"] is None
    assert broken["doc_id"].startswith("sha1_") and broken["movie_id"] is None


def test_first_record_wins_and_counters_add_up(spark):
    movie = {"title": "a", "genres": []}
    records = decoded(spark, [{**movie, "id": "7"}, {**movie, "id": 7, "title": "b"}, {"id": 1}, "{bad", {**movie, "id": 8}])
    docs = prepare(records)
    assert {r.doc_id: r.title for r in docs.collect()} == {"7": "a", "8": "a"}
    counts = build_counters(records, docs).first().asDict()
    assert counts == {
        "files_seen": 1, "docs_seen": 4, "docs_skipped_non_movie": 1, "parse_errors": 1, "docs_prepared": 2, "docs_skipped_duplicate": 1,
    }
    limited = build_counters(records, prepare(records, max_docs=1), limited=True).first()
    assert (limited.docs_seen, limited.docs_prepared, limited.docs_skipped_duplicate) == (1, 1, 0)
    report = run_report(build_counters(records, docs), {"max_docs": 0}, "src", "idx", "standard", errors=records.select("body")).first()
    assert report.stats.docs_seen == 4 and len(report.error_samples) == 5


def test_repeats_are_found_without_shuffling_documents(spark):
    """Records that share key and place too are told apart by where they are stored."""
    movie = {"title": "a", "genres": []}
    records = decoded(spark, [{**movie, "id": 7}, {**movie, "id": 8}, {**movie, "id": 7, "title": "b"}])
    docs = prepare(records.union(records).union(records))
    assert sorted((r.doc_id, r.title) for r in docs.collect()) == [("7", "a"), ("8", "a")]
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    slim = prepare(records, combined=False)
    assert set(docs.columns) - set(slim.columns) == {"all_text"} and slim.count() == 2


def test_what_orders_children_is_gathered_once(spark):
    rows = spark.createDataFrame([(1, 2, "b", "x"), (1, 1, "c", "y"), (1, 1, "a", None), (2, None, "d", "z"), (None, 1, "e", "w")], "k int, o int, t string, u string")
    made = gather_all(rows, "k", ["o", "t"], ["t", "u"], "all")
    got = {r.k: [(x.t, x.u) for x in r["all"]] for r in made.collect()}
    assert got == {1: [("a", None), ("c", "y"), ("b", "x")], 2: [("d", "z")], None: [("e", "w")]}
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(struct(o0, o#" in plan and plan.count(", t#") <= 3 and "item" not in plan


def test_top_n_beyond_the_planner_limit(spark):
    rows = spark.range(20_000).select((F.col("id") % 3 > 0).cast("int").alias("g"), F.xxhash64("id").alias("v"), "id")
    got = top_n(rows, ["g"], [F.desc("v"), F.col("id")], 5000).select("g", "id", "rank").toPandas()
    whole = rows.toPandas().sort_values(["g", "v", "id"], ascending=[True, False, True])
    want = whole.groupby("g").head(5000)
    assert len(got) == 10_000 and set(zip(got.g, got.id)) == set(zip(want.g, want.id))


def test_large_limit_equals_top_n(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("v"), "id").repartition(7)
    want = {r.id for r in rows.orderBy("v", "id").limit(1234).collect()}
    got = limit_first(rows, 1234, ["v", "id"])
    assert {r.id for r in got.collect()} == want and got.columns == ["v", "id"]
    assert limit_first(rows, 0, ["v"]).count() == limit_first(rows, 9000, ["v"]).count() == 5000
    tied = rows.withColumn("v", F.lit(1))
    kept = {r.id for r in limit_first(tied, 50, ["v"]).collect()}
    assert len(kept) == 50 and kept == {r.id for r in limit_first(tied.repartition(3), 50, ["v"]).collect()}


def test_dedup_is_idempotent(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    once = dedup_first(rows, ["k"], ["id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, dedup_first(once, ["k"], ["id"]).collect())) == [(k, k) for k in range(7)]


def test_merge_and_resume(spark):
    details = spark.createDataFrame([(1, "a"), (2, "b")], "movie_id bigint, title string")
    person = "struct<id:bigint,name:string,character:string,order:int>"
    credits = spark.createDataFrame(
        [(1, [(i, f"n{i}", "c", i) for i in range(30)], [(1, "x", "Director", "D"), (2, "y", "Grip", "G")])],
        f"movie_id bigint, `cast` array<{person}>, crew array<struct<id:bigint,name:string,job:string,department:string>>",
    )
    reviews = spark.createDataFrame(
        [(1, [("r", "au", ("user", 8.0), "text", "now")] * 12)],
        "movie_id bigint, results array<struct<id:string,author:string,author_details:struct<username:string,rating:double>,content:string,created_at:string>>",
    )
    rows = {r.movie_id: r for r in merge_entities(details, credits, reviews).collect()}
    assert len(rows[1]["cast"]) == 20 and [c.job for c in rows[1].crew] == ["Director"] and rows[1].review_count == 10
    assert rows[1].reviews[0].author_username == "user" and rows[2]["cast"] == [] and rows[2].review_count == 0
    assert [r.movie_id for r in pending(details.select("movie_id"), credits).collect()] == [2]


def test_api_error_and_passage(spark):
    rows = decoded(spark, [{"status_code": 34, "success": False}, {"status_code": 1}, {"success": False}])
    assert [r[0] for r in rows.orderBy("pos").select(is_api_error(F.col("record"))).collect()] == [True, False, False]
    name = lambda *n: F.array(*[F.struct(F.lit(x).alias("name"), F.lit("Director").alias("job")) for x in n])
    text = spark.range(1).select(passage(F.lit("T"), F.lit(None).cast("string"), F.lit("tag"), name("G"), name(*"abcdefg"), name("D"))).first()[0]
    assert text == "Title: T T T\n    Overview: \n    Tagline: tag\n    Genres: G\n    Cast: a b c d e\n    Director: D"
