import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.functions.values import count_band
from marquee.operators.dense import dense_search, embed, knn, mean_pool
from marquee.operators.discover import discover, page_plan, slice_plan
from marquee.operators.facets import facet_counts, facet_with_source, index_status, translate_codes
from marquee.operators.postings import build_index
from marquee.operators.records import find_by_id, normalize
from marquee.operators.search import answer, compare_rankings, dense_hits, scoped_queries, search, sparse_hits, validate_requests
from marquee.operators.sparse import best_per_query, query_clauses, score_documents, sparse_search
from marquee.plans.dense_queries import hashed_words

TEXTS = [
    "funny space adventure with a robot", "space station drama", "romantic drama set in Paris", "scary horror movie",
    "a movie about dreams within dreams", "everything everywhere", "space space space", "the and of",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(f"{i:02d}", t.split()[0], t, ["US"] if i % 2 else ["FR", "US"]) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id string, title string, all_text string, origin_country array<string>")


@pytest.fixture(scope="module")
def index(docs):
    return build_index(docs, ["title", "all_text"], "english_stem", shards=4)


def asked(spark, *rows):
    return spark.createDataFrame(list(rows), "query_id int, query string, top_k int, country string")


BOOSTS = {"title": 3.0, "all_text": 1.0}


def ids(hits, query_id=1):
    return [r.doc_id for r in hits.where(F.col("query_id") == query_id).orderBy("rank").collect()]


def test_misspelt_query_finds_its_document(spark, docs, index):
    hits = sparse_search(asked(spark, (1, "Everthing Everywhere", 3, None)), index, docs, BOOSTS)
    assert ids(hits)[0] == "05"
    assert ids(sparse_search(asked(spark, (1, "Everthing", 3, None)), index, docs, BOOSTS, fuzzy=None)) == []


def test_filter_limits_and_empty_queries(spark, docs, index):
    queries = asked(spark, (1, "space", 10, "FR"), (2, "space", 1, None), (3, "*", 5, None), (4, "the", 5, None))
    hits = sparse_search(queries, index, docs, BOOSTS)
    assert set(ids(hits)) == {"00", "06"} and len(ids(hits, 2)) == 1 and ids(hits, 3) == ids(hits, 4) == []


def test_shuffled_join_equals_broadcast(spark, docs, index, monkeypatch):
    queries = asked(spark, (1, "space drama dreams", 10, None), (2, "a robot movie in paris", 10, None))
    clauses = query_clauses(queries, index, BOOSTS)
    rows = lambda: sorted(map(tuple, best_per_query(score_documents(clauses, index, BOOSTS), queries).collect()))
    small = rows()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr("marquee.operators.sparse.sent_if_few", lambda df: df)
    try:
        assert rows() == small != []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_scores_are_added_up_without_a_shuffle(spark, docs, index):
    queries = asked(spark, (1, "space drama dreams", 10, None))
    scored = score_documents(query_clauses(queries, index, BOOSTS), index, BOOSTS)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_spelling_keys_are_read_from_the_index(spark, docs, index):
    plan = index.spelling.where("size IN (4, 5)")._jdf.queryExecution().executedPlan().toString()
    assert "In(size, [4,5])" in plan and "Generate" not in plan


def test_country_needs_documents_and_empty_is_none(spark, docs, index):
    queries = asked(spark, (1, "space drama", 10, ""))
    with pytest.raises(ValueError):
        sparse_search(queries, index, fields=BOOSTS)
    free = sparse_search(queries.drop("country"), index, fields=BOOSTS)
    assert sorted(map(tuple, sparse_search(queries, index, docs, fields=BOOSTS).collect())) == sorted(map(tuple, free.collect())) != []


def test_uncapped_expansion_is_a_superset(spark, docs, index):
    queries = asked(spark, (1, "space drama", 10, None))
    few = query_clauses(queries, index, BOOSTS, max_expansions=1).count()
    assert few <= query_clauses(queries, index, BOOSTS, max_expansions=None).count()


def test_router_hits_and_comparison(spark, docs, index):
    encode = lambda df: embed(df, "query", hashed_words)
    vectors = embed(docs, "all_text", hashed_words).withColumns({"vec_id": F.col("doc_id").cast("int"), "movie_id": F.col("doc_id").cast("int")})
    queries = asked(spark, (1, "space station drama", 3, None), (2, "  ", 3, None), (3, "x", 0, None))
    valid, errors = validate_requests(queries)
    assert valid.count() == 1 and {r.error for r in errors.collect()} == {"Query cannot be empty.", "top_k must be at least 1."}
    sparse = search(queries, "sparse", index=index, documents=docs, fields=BOOSTS)
    dense = search(queries, "bert", vectors=vectors, encode=encode)
    assert ids(sparse)[0] == "01" and dense.orderBy("rank").first().movie_id == 1
    whole = answer(queries, "sparse", index=index, documents=docs, fields=BOOSTS)
    assert whole.hits.count() == sparse.count() and whole.errors.count() == 2 and whole.seconds > 0
    assert [(r.query_id, r.result_count) for r in whole.summary.collect()] == [(1, 3)]
    named = dense.select("query_id", "rank", F.format_string("%02d", "movie_id").alias("doc_id"), "score")
    both = {r.doc_id: r.rank_change for r in compare_rankings(sparse, named).collect()}
    assert both["01"] == 0
    with pytest.raises(ValueError):
        search(queries, "dense")


def test_hit_defaults(spark):
    bodies = spark.createDataFrame([('{"id": 3, "title": "t", "release_date": "1999-01-01", "cast": [], "overview": "%s"}' % ("o" * 400),)], "body string")
    docs = normalize(bodies.select(F.lit("s").alias("source_path"), F.lit(0).alias("pos"), F.try_parse_json("body").alias("record")))
    hits = spark.createDataFrame([(1, 1, "3", 0.5)], "query_id int, rank int, doc_id string, score double")
    row = sparse_hits(hits, docs).first()
    assert (row.release_year, row.rating, row.genres, row.cast, row.imdb_id, len(row.overview)) == ("1999", 0.0, [], [], "", 300)
    assert find_by_id(docs, 3).count() == 1 and find_by_id(docs, "4").count() == 0
    assert index_status(docs).first().has_facet is True and index_status(docs.drop("origin_country")).first().has_facet is False
    meta = spark.createDataFrame([(3, None, None, None, None, None, None, None)], "id int, imdb_id string, title string, overview string, genres array<string>, release_date string, vote_average double, origin_country array<string>")
    dense = dense_hits(hits.withColumn("movie_id", F.lit(3)), meta).first()
    assert (dense.title, dense.release_year, dense.countries) == ("Unknown", "", [])


def brute(queries, vectors, k, allowed=None, groups=None):
    out = set()
    for qi, q in enumerate(queries):
        d = ((vectors - q) ** 2).sum(1)
        order, seen = sorted(range(len(vectors)), key=lambda i: (d[i], i)), []
        for i in order:
            if allowed is not None and not allowed[qi][i]:
                continue
            if groups is not None and groups[i] in [groups[j] for j in seen]:
                continue
            seen.append(i)
            if len(seen) == k:
                break
        out |= {(qi, r + 1, i) for r, i in enumerate(seen)}
    return out


def test_knn_scan_and_blocks_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(size=(300, 8)) * 5).astype(np.float32)  # rounding makes ties
    q = np.vstack([v[:20], np.round(rng.normal(size=(20, 8)) * 50)]).astype(np.float32)
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id int, embedding array<float>").repartition(5)
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "query_id int, embedding array<float>")
    want = brute(q.astype(float), v.astype(float), 7)
    rows = lambda df: {(r.query_id, r.rank, r.vec_id) for r in df.collect()}
    assert rows(knn(queries, vectors, 7)) == want
    assert rows(knn(queries, vectors, 7, query_block=16, vector_block=64)) == want
    assert len(rows(knn(queries, vectors.limit(3), 7))) == 3 * 40


def test_prefilter_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(200, 6)).astype(np.float32)
    codes = [["A"] if i % 3 else ["A", "B"] for i in range(200)]
    vectors = spark.createDataFrame(
        [(i, x.tolist(), i // 4, codes[i]) for i, x in enumerate(v)], "vec_id int, embedding array<float>, movie_id int, origin_country array<string>"
    ).repartition(3)
    countries = [None, "B", "A", "Z"]
    queries = spark.createDataFrame([(i, v[i].tolist(), c) for i, c in enumerate(countries)], "query_id int, embedding array<float>, country string")
    allowed = [[c is None or c in codes[i] for i in range(200)] for c in countries]
    want = {(q, r, i // 4) for q, r, i in brute(v[:4].astype(float), v.astype(float), 5, allowed, [i // 4 for i in range(200)])}
    got = {(r.query_id, r.rank, r.movie_id) for r in dense_search(queries, vectors, 5, prefilter=True).collect()}
    assert got == want


def test_prefilter_in_tiles_equals_brute_force(spark, monkeypatch):
    """More queries than one broadcast takes, asked of the table that they come from."""
    monkeypatch.setattr("marquee.operators.dense.QUERY_BLOCK", 16)
    monkeypatch.setattr("marquee.operators.dense.TILE_BYTES", 8 * 5 * 40)
    rng = np.random.default_rng(6)
    v = np.round(rng.normal(size=(150, 5)) * 4).astype(np.float32)
    rows = spark.createDataFrame([(i, x.tolist(), i % 3) for i, x in enumerate(v)], "vec_id int, embedding array<float>, label int")
    asked = rows.select(F.col("vec_id").alias("query_id"), "embedding", F.when(F.col("label") != 0, F.col("label").cast("string")).alias("country"))
    stored = rows.select("vec_id", "embedding", F.expr("vec_id div 2").alias("movie_id"), F.array(F.col("label").cast("string")).alias("origin_country"))
    allowed = [[q % 3 == 0 or i % 3 == q % 3 for i in range(150)] for q in range(150)]
    want = {(q, r, i // 2) for q, r, i in brute(v.astype(float), v.astype(float), 6, allowed, [i // 2 for i in range(150)])}
    got = {(r.query_id, r.rank, r.movie_id) for r in dense_search(asked, stored, 6, prefilter=True).collect()}
    assert got == want


def test_knn_in_tiles_keeps_tasks_small(spark, monkeypatch):
    """Ties, repeated query ids and broken vectors; a candidate list is cut while vectors stream by."""
    from marquee.operators import dense

    monkeypatch.setattr(dense, "TILE_BYTES", 8 * 4 * 64)
    most = []
    settle = dense._Nearest.settle
    monkeypatch.setattr(dense._Nearest, "settle", lambda self: (most.append(self.waiting), settle(self))[1])
    rng = np.random.default_rng(8)
    v = np.round(rng.normal(size=(2000, 4)) * 3)
    near = dense._Nearest(v[:100], np.arange(100), 5, 128)
    for at in range(0, 2000, 250):
        table = pa.table({"vec_id": pa.array(range(at, at + 250)), "embedding": pa.array(v[at : at + 250].tolist())})
        near.meet(dense._Block(table))
    near.settle()
    assert {(int(q), int(i)) for f in near.found for q, i in zip(f["query"], f["vec_id"])} == {(q, i) for q, _, i in brute(v[:100], v, 5)}
    assert max(most) <= 100 * (5 + 128)
    rows = [(i, x.tolist()) for i, x in enumerate(v[:300])]
    vectors = spark.createDataFrame([*rows, (300, [float("nan")] * 4), (301, None), (None, [0.0] * 4)], "vec_id int, embedding array<double>")
    queries = spark.createDataFrame([*rows, (0, v[0].tolist()), (None, v[1].tolist())], "query_id int, embedding array<double>")
    got = {(r.query_id, r["rank"], r.vec_id) for r in knn(queries, vectors, 5, query_block=16, vector_block=32).collect() if r.query_id}
    assert got == {t for t in brute(v[:300], v[:300], 5) if t[0]}


def test_mean_pool_of_a_fully_masked_key(spark):
    rows = spark.createDataFrame([(1, [2.0, 4.0], 1), (1, [4.0, 0.0], 1), (1, [100.0, 1.0], 0), (2, [5.0, 5.0], 0)], "id int, embedding array<float>, mask int")
    got = {r.id: r.embedding for r in mean_pool(rows).collect()}
    assert got == {1: [3.0, 2.0], 2: [0.0, 0.0]}
    odd = spark.createDataFrame([("a", [2.0], 1.0), ("a", [4.0, 8.0], 1.0), (None, [1.0, None], 2.0), ("b", None, 1.0)], "key string, v array<double>, m double")
    got = {r["key"]: r.embedding for r in mean_pool(odd.repartition(3), "key", "v", "m").collect()}
    assert got == {"a": [3.0, 8.0], None: [1.0, 0.0]}
    assert mean_pool(odd.limit(0), "key", "v", "m").count() == 0


def test_facets_codes_and_bands(spark, docs):
    rows = spark.createDataFrame([(["US", "US", "GB"],), (["GB", ""],), ([],), (None,)], "origin_country array<string>")
    counts = lambda df: {r.country_code: r["count"] for r in df.collect()}
    assert counts(facet_counts(rows)) == {"GB": 2, "US": 1, "": 1}
    assert counts(facet_counts(rows, per="occurrence")) == {"US": 2, "GB": 2}
    assert {r.source for r in facet_with_source(None, docs).collect()} == {"dense"}
    shapes = spark.createDataFrame([("USA", None), ("-99", "XX"), ("-99", None), ("ZZZ", "")], "a3 string, iso_a2 string")
    assert sorted(r.a2 for r in translate_codes(shapes).collect()) == ["-99", "US", "XX", "ZZZ"]
    bands = spark.createDataFrame([(n,) for n in (0, 1, 10, 11, 101, 501, 1001, 2001, 5001, 10000, 10001)], "n int")
    assert [r[0] for r in bands.select(count_band(F.col("n"))).collect()] == [0, 1, 1, 2, 3, 4, 5, 6, 7, 7, 8]


def test_discovery(spark):
    rows = [(i, [28] if i % 2 else [99999], i % 40, float(i), 1980, "en" if i % 3 else "xx") for i in range(0, 60)]
    catalogue = spark.createDataFrame(rows, "id bigint, genre_ids array<int>, vote_count int, popularity double, release_year int, original_language string")
    found = {r.movie_id for r in discover(catalogue, "genre").collect()}
    assert found == {i for i in range(60) if i % 2}
    assert {r.movie_id for r in discover(catalogue, pages=1, page_size=2, strategy="year").collect()} == {58, 59}
    assert 0 not in {r.movie_id for r in discover(catalogue).collect()}
    assert slice_plan(spark).count() == (19 * 4 + 57 + 10) * 500
    assert page_plan(catalogue, "year").count() == 3
    with pytest.raises(ValueError):
        discover(catalogue, "colour")


def test_scoped_queries(spark):
    countries = spark.createDataFrame([("US",)], "country_code string")
    assert scoped_queries(countries, " ").first().query == "*"


def test_documents_are_not_shuffled_for_hits(spark):
    names = "doc_id movie_id title overview genres origin_country vote_average release_year release_date cast_names imdb_id poster_path".split()
    kinds = dict(genres="array<string>", origin_country="array<string>", cast_names="array<string>", vote_average="double", release_year="int", movie_id="bigint")
    rows = [tuple(str(i) if n == "doc_id" else None for n in names) for i in range(50)]
    docs = spark.createDataFrame(rows, ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names))
    hits = spark.createDataFrame([(1, 1, "3", 0.5), (1, 2, "44", 0.25)], "query_id int, rank int, doc_id string, score double")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = sparse_hits(hits, docs)
        assert "hashpartitioning" not in made._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["rank"], r.movie_id, r.title) for r in made.collect()) == [(1, "3", "Unknown"), (2, "44", "Unknown")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
