"""Segments against a catalogue built at once."""

import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marquee import session
from marquee.operators import postings
from marquee.operators.sparse import sparse_search
from marquee.sources import catalogue as store

DDL = "doc_id string, title string, body string, release_date string, crawled_at string"
FIELDS = ("title", "body")
WORDS = "space drama robot paris dream movie night river stone light running dogs".split()


def rows(keys, seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choices(WORDS, k=n))
    return [(f"k{i:04d}", text(3), text(rng.randint(0, 30)), None, None) for i in keys]


FIRST, SECOND, THIRD = rows(range(300), 1), rows(range(250, 400), 2), rows([5, 260, 399, 900], 3)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """The path of a catalogue of three runs, and of one that holds the same at once."""
    frame = lambda data: spark.createDataFrame(data, DDL)
    steps, whole = (str(tmp_path_factory.mktemp("catalogue") / n) for n in ("steps", "whole"))
    for data in (FIRST, SECOND, THIRD):
        store.write_documents(frame(data), steps, fields=FIELDS, shards=3)
    last = {r[0]: r for data in (FIRST, SECOND, THIRD) for r in data}
    store.write_documents(frame(list(last.values())), whole, fields=FIELDS, shards=3)
    return steps, whole


def content(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


def same(spark, a, b):
    one, two = (store.open_catalogue(spark, p) for p in (a, b))
    assert content(one.documents) == content(two.documents)
    for name in ("postings", "term_stats", "field_stats"):
        assert content(getattr(one.index, name)) == content(getattr(two.index, name)) != []
    asked = spark.createDataFrame([(1, "robot dreams", 10, None), (2, "runing dog by a rivr", 10, None)], "query_id int, query string, top_k int, country string")
    hits = [content(sparse_search(asked.drop("country"), c.index, fields={"title": 3.0, "body": 1.0})) for c in (one, two)]
    assert hits[0] == hits[1] and len(hits[0]) == 20


def test_runs_equal_one_build(spark, built):
    same(spark, *built)


def test_only_segments_that_lose_documents_have_markers(spark, built):
    made = store.open_catalogue(spark, built[0])
    assert [s.removes for s in made.segments] == [(), ("s000001",), ("s000001", "s000002")]
    assert made.version == 3 and store.versions(spark, built[0]) == [1, 2, 3]
    assert content(store.open_catalogue(spark, built[0], 1).documents) == sorted((r[2], None, r[0], None, r[1]) for r in FIRST)
    untouched = store.write_documents(spark.createDataFrame(rows([7000], 4), DDL), built[1])[0]
    assert untouched.segments[-1].removes == () and not os.path.exists(f"{built[1]}/segments/s000002/removed_term_stats")
    plan = untouched.index.postings._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    store.write_documents(spark.createDataFrame(rows([7000], 4), DDL), built[0])


def test_a_run_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    store.write_documents(spark.createDataFrame(FIRST, DDL), path, fields=FIELDS, shards=2)
    before = content(store.stored_documents(spark, path))

    def die(made):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, "_publish", die)
        with pytest.raises(OSError):
            store.write_documents(spark.createDataFrame(SECOND, DDL), path)
    assert content(store.stored_documents(spark, path)) == before
    made, _ = store.write_documents(spark.createDataFrame(SECOND, DDL), path)
    assert [s.name for s in made.segments] == ["s000001", "s000003"] and made.documents.count() == 400
    store.drop_old_versions(spark, path)
    assert sorted(os.listdir(f"{path}/segments")) == ["s000001", "s000003"] and store.versions(spark, path) == [2]
    assert made.documents.count() == 400


def test_reuse_warns_and_recreate_replaces(spark, tmp_path):
    path = str(tmp_path / "c")
    store.write_documents(spark.createDataFrame(FIRST, DDL), path, "standard", fields=FIELDS, shards=2)
    with pytest.warns(UserWarning, match="keeps its analyzer option 'standard'"):
        made, _ = store.write_documents(spark.createDataFrame(SECOND, DDL), path, "english_stem")
    assert made.option == "standard" and made.fields == FIELDS and made.shards == 2
    made, _ = store.write_documents(spark.createDataFrame(THIRD, DDL), path, "english_stem", recreate=True)
    assert made.option == store.stored_option(spark, path) == "english_stem" and made.documents.count() == 4
    with pytest.raises(ValueError):
        made.index  # noqa: B018


def test_merge(spark, built, tmp_path):
    merged = store.merge_segments(spark, built[0])
    assert len(merged.segments) == 1 and store.merge_segments(spark, built[0]).version == merged.version
    same(spark, *built)


def test_lookup_pushes_the_key(spark, built):
    found = store.open_catalogue(spark, built[1]).live("s000001").where(F.col("doc_id") == "k0005")
    assert "EqualTo(doc_id,k0005)" in found._jdf.queryExecution().executedPlan().toString() and found.count() == 1


def pieces(path, name, table):
    """Files of each bucket of a table, with their rows."""
    found = {}
    folder = f"{path}/segments/{name}/index/{table}"
    for file in sorted(f for f in os.listdir(folder) if f.endswith(".parquet")):
        found.setdefault(file.split("_")[-1].split(".")[0], []).append(pq.read_metadata(f"{folder}/{file}").num_rows)
    return found


def three_runs(spark, path):
    """A merged catalogue of three runs."""
    for data in (FIRST, SECOND, THIRD):
        store.write_documents(spark.createDataFrame(data, DDL), path, fields=FIELDS, shards=3)
    return store.merge_segments(spark, path).path


def test_a_merging_task_holds_one_bucket(spark, tmp_path):
    # Tasks that took the rows of file pieces would each write all buckets.
    found = pieces(three_runs(spark, str(tmp_path / "c")), "s000004", "postings")
    assert [len(f) for f in found.values()] == [1, 1, 1]


def test_more_tasks_write_a_large_bucket(spark, tmp_path, monkeypatch):
    whole = str(tmp_path / "whole")
    last = {r[0]: r for data in (FIRST, SECOND, THIRD) for r in data}
    store.write_documents(spark.createDataFrame(list(last.values()), DDL), whole, fields=FIELDS, shards=3)
    monkeypatch.setattr(postings, "MOST_ROWS_SORTED", 500)
    monkeypatch.setattr(postings, "MOST_TEXT_SORTED", 5000)
    # Keys are too many to be sent, so tasks hash them.
    monkeypatch.setattr(session.sent_or_hashed, "__defaults__", (10,))
    path = three_runs(spark, str(tmp_path / "d"))
    for name in ("s000001", "s000004"):
        found = pieces(path, name, "postings")
        assert len(found) == 3 and all(len(f) > 1 and max(f) < 800 for f in found.values()), (name, found)
    same(spark, path, whole)


def test_more_tasks_write_many_spelling_keys(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(WORDS)], "doc_id long, body string")
    one = postings.write_index(docs, ["body"], f"{tmp_path}/segments/s1/index", shards=2)
    monkeypatch.setattr(postings, "MOST_ROWS_SORTED", 20)
    two = postings.write_index(docs, ["body"], f"{tmp_path}/segments/s2/index", shards=2)
    found = [pieces(tmp_path, name, "spelling") for name in ("s1", "s2")]
    assert found[0].keys() == found[1].keys() and all(len(f) > len(found[0][b]) for b, f in found[1].items()), found
    for bucket, files in found[0].items():
        assert sum(files) == sum(found[1][bucket])
    assert content(one.spelling) == content(two.spelling) != []


def test_passes_write_the_same_catalogue(spark, tmp_path):
    once, path = str(tmp_path / "once"), str(tmp_path / "passes")
    docs = spark.createDataFrame(FIRST, DDL)
    store.write_documents(docs, once, fields=FIELDS, shards=3)
    stored = session.materialise(docs.withColumnRenamed("body", "other"), "docs")
    finish = lambda rows: rows.withColumnRenamed("other", "body")
    store.write_documents(stored, path, fields=FIELDS, shards=3, finish=finish, passes=2)
    same(spark, once, path)
    names = [f for f in os.listdir(f"{path}/segments/s000001/documents") if f.endswith(".parquet")]
    assert sorted(int(f.split("_")[-1].split(".")[0]) for f in names) == [0, 1, 2]


def test_neither_scores_nor_documents_are_shuffled_for_a_country(spark, tmp_path):
    path = str(tmp_path / "countries")
    codes = [["US"], ["GB", "US"], [], None]
    data = [(*r, codes[i % 4]) for i, r in enumerate(FIRST)]
    made, _ = store.write_documents(spark.createDataFrame(data, f"{DDL}, origin_country array<string>"), path, fields=FIELDS, shards=3)
    asked = spark.createDataFrame([(1, "robot dream", "US"), (2, "robot dream", None), (3, "river", "GB"), (4, "river", "XX")], "query_id int, query string, country string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = sparse_search(asked, made.index, made.documents, fields={"title": 3.0, "body": 1.0}, fuzzy=None, top_k=400)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        got = content(hits)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    # Only ranks are dealt, by query; the join with the requests is by query too.
    assert "hashpartitioning(doc_id" not in plan and "hashpartitioning(_doc" not in plan
    free = sparse_search(asked.drop("country"), made.index, fields={"title": 3.0, "body": 1.0}, fuzzy=None, top_k=400).collect()
    code, country = {r[0]: r[-1] or [] for r in data}, {1: "US", 2: None, 3: "GB", 4: "XX"}
    want = {(r.query_id, r.doc_id) for r in free if country[r.query_id] is None or country[r.query_id] in code[r.doc_id]}
    at = sorted(hits.columns)
    assert {(row[at.index("query_id")], row[at.index("doc_id")]) for row in got} == want and {q for q, _ in want} == {1, 2, 3}


def test_an_empty_run_keeps_its_columns(spark, tmp_path):
    made, _ = store.write_documents(spark.createDataFrame([], DDL), str(tmp_path / "none"), fields=FIELDS, shards=3)
    assert made.documents.columns == [c.split()[0] for c in DDL.split(", ")] and made.documents.count() == 0


def test_segments_of_plain_files_are_read(spark, tmp_path):
    """A manifest from before documents were bucketed names no columns."""
    path = str(tmp_path / "plain")
    made, _ = store.write_documents(spark.createDataFrame(FIRST, DDL), path, fields=FIELDS, shards=3)
    old = store.Catalogue(spark, path, 1, made.option, 3, made.fields, "string", (store.Segment("s000001"),))
    assert content(old.documents) == content(made.documents) and len(FIRST) == old.documents.count()
