"""Session settings and shared-storage materialisation."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a slim table (keys and a few numbers) that may be sent to every task.
MOST_ROWS_SENT = 500_000

_SCOPE: contextvars.ContextVar[Scratch | None] = contextvars.ContextVar("scratch", default=None)


def get_session(app: str = "marquee", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; explicit ``conf`` entries win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Terms and keys asked for are pushed to the scan one by one up to this many.
        "spark.sql.parquet.pushdown.inFilterThreshold": "500",
        # Ranks up to this are cut in each task before rows are shuffled by group.
        "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder (``spark.checkpoint.dir``).

    Only a session in one process (tests, a laptop) that names none gets a local folder, once per session
    and removed at its end.  Executors elsewhere would write to disks that nobody else reads, so on a
    cluster a missing folder is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        configured = tempfile.mkdtemp(prefix="marquee-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


class Scratch:
    """The scratch tables written since a ``scratch_scope`` began."""

    def __init__(self, outer: Scratch | None) -> None:
        self.outer, self.paths = outer, []

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``; the tables that it still reads outlive this scope and fall to the one around it."""
        read = {_table_name(f) for f in df.inputFiles()}
        kept = [p for p in self.paths if _table_name(p) in read]
        self.paths = [p for p in self.paths if p not in kept]
        if self.outer is not None:
            self.outer.paths += kept
        return df

    def drop(self, df: DataFrame) -> None:
        """Delete the tables of this scope that ``df`` reads, now."""
        read = {_table_name(f) for f in df.inputFiles()}
        for path in [p for p in self.paths if _table_name(p) in read]:
            self.paths.remove(path)
            delete_path(df.sparkSession, path)


def _table_name(path: str) -> str:
    """What names a scratch table in the path of one of its files."""
    found = re.search(r"/marquee/([^/]+-[0-9a-f]{32})(/|$)", unquote(path))
    return found[1] if found else path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scratch]:
    """Deletes the scratch tables written inside, but for those that ``keep`` names.

    For a step whose result is written, or reads few of the tables made on its way.  Scopes nest; without
    any, tables stay until the shared folder is cleared.
    """
    scope = Scratch(_SCOPE.get())
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        for path in scope.paths:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a table of the shared folder, wherever that is kept."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/marquee/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written or collected inside go when that is done.

    For plans that nobody runs again.  Otherwise they stay until the driver collects its garbage, and the
    disk holds those of all steps at once.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None, **options: str) -> DataFrame:
    """Write ``df`` as a Parquet table in shared storage and read it back.

    Cuts lineage (a lost executor re-reads the table, not the whole history) and gives the planner
    real file sizes for its join choices.  Inside a ``scratch_scope`` the table goes when the scope ends.
    """
    path = scratch_path(df.sparkSession, name)
    if (scope := _SCOPE.get()) is not None:
        scope.paths.append(path)
    writer = df.write.mode("errorifexists").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with passing_shuffles(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent_if_few(rows: DataFrame, most: int = MOST_ROWS_SENT) -> DataFrame:
    """A stored slim table, marked to be sent to all tasks if it has at most ``most`` rows."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def sent_or_hashed(rows: DataFrame, most: int = MOST_ROWS_SENT) -> DataFrame:
    """A stored table of keys for a join: sent if it has few rows, else each task hashes its share, so the other side is not sorted."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows.hint("shuffle_hash")
