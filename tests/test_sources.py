import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from marquee.plans.build import run
from marquee.schemas import LEDGER_DDL
from marquee.sources import catalogue as store
from marquee.sources import files, sinks
from marquee.streaming import ledger

MOVIE = {"title": "t", "genres": []}


@pytest.fixture()
def tree(tmp_path):
    root = tmp_path / "data" / "movies"
    for i in (1, 2, 1001):
        folder = root / str(i // 1000)
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.json").write_text(json.dumps({**MOVIE, "id": i}))
    (root / "bad.json").write_text("{")
    (root / "list.JSON").write_text(json.dumps([{**MOVIE, "id": 5}, 3, {**MOVIE, "id": 1}]))
    (root / "utf8.json").write_bytes(b'{"id": 9, "genres": [], "title": "\xff!"}')
    (root / "rows.jsonl").write_text('{"id": 20, "title": "l", "cast": []}\n\n  \n[1]\nbroken\n')
    (root / "notes.txt").write_text("no")
    litter = tmp_path / "data" / "__MACOSX"
    litter.mkdir()
    (litter / "x.json").write_text("{}")
    (root / "._x.json").write_text("{}")
    return tmp_path


def ids(records):
    rows = files.parsed(records).select(F.expr("try_variant_get(record, '$.id', 'bigint')").alias("id"))
    return sorted(r.id for r in rows.collect())


def test_tree(spark, tree):
    records = files.read_records(spark, str(tree))
    assert ids(records) == [1, 1, 2, 5, 9, 1001]
    assert files.parse_errors(records).count() == 1
    bad_text = files.parsed(records).where("source_path like '%utf8%'").selectExpr("try_variant_get(record, '$.title', 'string') t").first().t
    assert bad_text == "�!"


def test_tree_with_lines_and_subpath(spark, tree):
    records = files.read_records(spark, str(tree), include_jsonl=True)
    assert ids(records) == [1, 1, 2, 5, 9, 20, 1001] and files.parse_errors(records).count() == 2
    assert ids(files.read_records(spark, str(tree), subpath="movies/1")) == [1001]


def test_zip_equals_tree(spark, tree, tmp_path):
    path = tmp_path / "all.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(tree / "data"):
            for name in names:
                full = os.path.join(folder, name)
                archive.write(full, os.path.relpath(full, tree))
    records = files.read_records(spark, str(path), subpath="data/movies", include_jsonl=True)
    assert ids(records) == [1, 1, 2, 5, 9, 20, 1001] and files.parse_errors(records).count() == 2
    assert ids(files.read_records(spark, str(path))) == [1, 1, 2, 5, 9, 1001]


def test_damaged_member_is_one_error_and_long_lines_are_chunked(spark, tmp_path, monkeypatch):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for i in range(3):
            archive.writestr(f"{i}.json", json.dumps({**MOVIE, "id": i + 1, "overview": "x" * 500}))
        archive.writestr("rows.jsonl", "\n".join(json.dumps({**MOVIE, "id": 100 + i}) for i in range(200)))
    raw = bytearray(path.read_bytes())
    at = raw.find(b"1.json") + len("1.json") + 5
    raw[at : at + 20] = b"\0" * 20
    path.write_bytes(bytes(raw))
    records = files.read_records(spark, str(path), include_jsonl=True)
    assert ids(records) == [1, 3, *range(100, 300)] and files.parse_errors(records).count() == 1
    monkeypatch.setattr(files, "_FRAME_BYTES", 1000)
    chunked = files.read_archives(spark, str(path), include_jsonl=True).where("source_path like '%jsonl'")
    assert chunked.count() > 5
    lines = files.decode_json(files.split_lines(chunked))
    order = [r.id for r in lines.orderBy("pos").select(F.expr("try_variant_get(record, '$.id', 'bigint')").alias("id")).collect()]
    assert order == list(range(100, 300))


def test_single_files_and_bad_source(spark, tree):
    root = tree / "data" / "movies"
    assert ids(files.read_records(spark, str(root / "list.JSON"))) == [1, 5]
    assert ids(files.read_records(spark, str(root / "rows.jsonl"))) == []
    assert ids(files.read_records(spark, str(root / "rows.jsonl"), include_jsonl=True)) == [20]
    with pytest.raises(ValueError):
        files.read_records(spark, str(root / "notes.txt"))
    with pytest.raises(FileNotFoundError):
        files.read_records(spark, str(root / "none"))
    with pytest.raises(Exception):
        files.read_strict(spark, str(root)).collect()


@pytest.mark.parametrize(
    "name, sub, lines, kept",
    [
        ("__MACOSX/a.json", None, False, False), ("x/._a.json", None, False, False), ("data/movies/1/1.json", None, False, True),
        ("a.jsonl", None, False, False), ("a.jsonl", None, True, True), ("x\\data\\movies\\a.json", "data/movies", False, True),
        ("mydata/movies/a.json", "data/movies", False, False), ("data/movies/a.json", "/data/movies/", False, True), ("a.txt", None, True, False),
    ],
)
def test_source_names(spark, name, sub, lines, kept):
    assert spark.range(1).select(files.wanted_name(F.lit(name), sub, lines)).first()[0] is kept


def test_whole_build(spark, tree, tmp_path):
    report = run(spark, str(tree), str(tmp_path / "out"), include_jsonl=True, report_path=str(tmp_path / "report"), shards=2).first()
    assert report.final_count == 6 and report.stats.docs_prepared == 6 and report.stats.docs_skipped_duplicate == 1
    assert report.stats.parse_errors == 2 and files.read_report(spark, str(tmp_path / "report")).first().stats.docs_seen == 7
    assert report.stats.docs_indexed == 6 and report.stats.docs_failed == 0 and report.stats.started_at < report.stats.ended_at
    stored = store.stored_documents(spark, str(tmp_path / "out"))
    assert stored.count() == 6 and store.stored_option(spark, str(tmp_path / "out")) == "english_stem"
    # Another analyser is not taken up: the stored one stays, with a warning.
    with pytest.warns(UserWarning, match="english_stem"):
        again = run(spark, str(tree), str(tmp_path / "out"), option="standard", shards=2).first()
    assert again.analyzer_option == "english_stem" and again.final_count == 6
    dry = run(spark, str(tree), str(tmp_path / "none"), dry_run=True, max_docs=2).first()
    assert dry.stats.docs_prepared == dry.stats.docs_indexed == 2 and not os.path.exists(tmp_path / "none")


def test_rejects_raise_after_the_report(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({**MOVIE, "id": 1, "release_date": "not a date"}))
    with pytest.raises(RuntimeError):
        run(spark, str(tmp_path / "in"), str(tmp_path / "out"), report_path=str(tmp_path / "r"), shards=2)
    assert len(files.read_report(spark, str(tmp_path / "r")).first().error_samples) == 1


def test_store_overwrite_and_merge(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = lambda pairs: spark.createDataFrame(pairs, "id bigint, title string")
    sinks.write_movies(rows([(1, "a"), (2, "b"), (1500, "c"), (0, "zero"), (None, "none")]), path)
    sinks.write_movies(rows([(2, "B"), (3, "d")]), path)
    stored = spark.read.schema("id bigint, title string").json(path)
    assert sorted((r.id, r.title) for r in stored.collect()) == [(1, "a"), (2, "B"), (3, "d"), (1500, "c")]


def test_vectors_runs_and_rejects(spark, tmp_path):
    vectors = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert sinks.write_vectors(vectors, str(tmp_path / "v")) == 1
    assert files.read_vectors(spark, str(tmp_path / "v")).count() == 1
    from marquee.operators.report import runtime_sweep

    runs = runtime_sweep(spark, lambda n: {"prepared": n, "indexed": n}, [10, 20])
    sinks.write_runs(runs, str(tmp_path / "csv"), str(tmp_path / "json"), source="s")
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 2
    assert len(spark.read.json(str(tmp_path / "json")).first().runs) == 2


def test_stream_resumes_and_counts(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    ledger_rows = lambda pairs: spark.createDataFrame(pairs, LEDGER_DDL)
    sinks.append_ledger(ledger_rows([(1, 1, 1.0), (2, 1, 1.0), (1, 1, 1.0), (0, 1, 1.0)]), source)
    stream = lambda: ledger.stream_ids(spark, source, LEDGER_DDL)
    first = ledger.run_available(stream(), target, state)
    assert sum(n for _, n in ledger.progress_rows(first)) == 2
    sinks.append_ledger(ledger_rows([(2, 5, 5.0), (3, 1, 1.0)]), source)
    ledger.run_available(stream(), target, state)
    assert sorted(r.movie_id for r in spark.read.parquet(target).collect()) == [1, 2, 3]
    seen = []
    stored = lambda: spark.createDataFrame([(1,)], "movie_id bigint")
    ledger.run_pending(stream(), stored, lambda df: seen.extend(r.movie_id for r in df.collect()), str(tmp_path / "state2"))
    assert sorted(seen) == [2, 3]


def test_watermarked_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:01:00")], "movie_id bigint, t string")
    rows.selectExpr("movie_id", "timestamp(t) as t").write.parquet(str(tmp_path / "in"))
    stream = ledger.stream_ids(spark, str(tmp_path / "in"), "movie_id bigint, t timestamp", "parquet", watermark=("t", "10 minutes"))
    ledger.run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from marquee.session import shared_dir

    conf = SimpleNamespace(get=lambda key, default: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))


def test_dates_are_read_strictly(spark):
    from marquee.operators.records import write_rejects

    dates = ["2020-01-01", "2020-01-01T10:00:00Z", None, "2020-1-1", "T12:30", "2020-13-01", "2020"]
    rows = spark.createDataFrame([(i, d, None) for i, d in enumerate(dates)], "i int, release_date string, crawled_at string")
    assert [r.reject_reason is None for r in write_rejects(rows).orderBy("i").collect()] == [True] * 3 + [False] * 4


def test_names_read(spark):
    names = ["a.json", "__MACOSX/a.json", "x/__MACOSX/b.json", "x/._a.json", "data/movies/1/1.JSON", "data\\movies\\2.json", "a.jsonl", "my-data/movies.json", "z/data/movies"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    read = lambda *a: [r.n for r in rows.where(files.wanted_name(rows.n, *a)).collect()]
    assert read() == ["a.json", "data/movies/1/1.JSON", "data\\movies\\2.json", "my-data/movies.json"]
    assert read("data/movies/") == ["data/movies/1/1.JSON", "data\\movies\\2.json"]
    assert read(None, True) == [*read()[:3], "a.jsonl", "my-data/movies.json"]


def test_tree_is_listed_by_tasks(spark, tmp_path, monkeypatch):
    """Names as Spark's reader gives them, hidden ones skipped, and no folder listed by the driver."""
    tree = tmp_path / "a tree%"
    for name in ("x/1.json", "x/deep/er/2.JSON", "x/_3.json", "x/.4.json", "_no/5.json", "x/6.txt", "x/__MACOSX/7.json", "p=1/8.json"):
        (tree / name).parent.mkdir(parents=True, exist_ok=True)
        (tree / name).write_text('{"id":%s}' % name[-6])
    (tree / "empty").mkdir()
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[jJ][sS][oO][nN]").load(str(tree))
    want = {r.path for r in plain.select("path").collect()}
    assert len(want) == 3
    rows = files.read_tree(spark, str(tree))
    assert {r.source_path for r in rows.collect()} == {r.source_path for r in files.list_sources(spark, str(tree)).collect()} == want
    assert {r.body for r in rows.collect()} == {'{"id":1}', '{"id":2}', '{"id":8}'}
    assert not [f for f in rows.inputFiles() if f.lower().endswith(".json")]
    monkeypatch.setattr(files, "_arrow_root", lambda spark, path: None)
    assert {r.source_path for r in files.read_tree(spark, str(tree)).collect()} == want
    assert files.list_sources(spark, str(tree)).count() == 3


def parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parseJson(")


def test_records_of_the_tables_are_parsed_once(spark, monkeypatch):
    from marquee.operators.records import normalize
    from marquee.plans import views

    rows = spark.createDataFrame([(1, "a"), (2, " "), (3, "c")], "id long, title string").selectExpr("*", "'2001' AS release_date")
    monkeypatch.setattr(views, "movies", lambda spark, sf_dir: rows)
    made = normalize(files.parsed(views.records(spark, "")))
    assert parses(made) == 1 and sorted(r.doc_id for r in made.collect()) == ["1", "3"]


def test_ledger_lines_are_parsed_once(spark, tmp_path):
    lines = ['{"movie_id": 1, "vote_count": 2, "popularity": 0.5}', "", "broken", "[1]", '{"movie_id": 0}', '{"movie_id": 1, "vote_count": 9}']
    (tmp_path / "ids.jsonl").write_text("\n".join(lines))
    ids = files.read_ledger(spark, str(tmp_path / "ids.jsonl"))
    assert parses(ids) == 1 and [tuple(r) for r in ids.collect()] == [(1, 2, 0.5)]
