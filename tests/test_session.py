"""Scratch tables and their scopes."""

import os
import time

import pytest

from marquee.session import materialise, scratch_scope, shared_dir


def tables(spark):
    top = f"{shared_dir(spark).removeprefix('file://')}/marquee"
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_scope_deletes_what_is_not_kept(spark):
    before = tables(spark)
    with scratch_scope(spark) as scope:
        one, two = materialise(spark.range(5), "one"), materialise(spark.range(7), "two")
        result = scope.keep(two.join(two.selectExpr("id + 1 AS id"), "id"))
        assert len(tables(spark) - before) == 2 and one.count() == 5
    assert [t.split("-")[0] for t in tables(spark) - before] == ["two"]
    assert result.count() == 6


def test_scopes_nest(spark):
    before = tables(spark)
    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as inner:
            kept = inner.keep(materialise(spark.range(3), "in ner"))
            materialise(spark.range(3), "gone")
        assert kept.count() == 3 and len(tables(spark) - before) == 1
        last = outer.keep(materialise(kept, "last"))
        outer.drop(kept)
        assert len(tables(spark) - before) == 1
    assert last.count() == 3 and len(tables(spark) - before) == 1
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        materialise(spark.range(3), "lost")
        1 / 0
    assert len(tables(spark) - before) == 1


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle")}


def test_shuffles_of_stored_tables_go(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, kept = shuffle_files(spark), spark.conf.get(key)
    stored = materialise(spark.range(1000).repartition(3, "id"), "dealt")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and spark.conf.get(key) == kept
    assert stored.groupBy().count().first()[0] == 1000
