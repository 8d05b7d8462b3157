"""Secrets in texts: certain shapes, and weak parts that only count together.

Certain kinds (assigned secrets, access identifiers, long hexadecimal) are reported wherever they match.
Weak parts (a named account, a bare 40-character key, a short password, a host) are found as well, but
reported only when complementary parts stand in one scope: an interval join of identifiers, secrets and
endpoints over their places.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ROW, numbered
from marquee.llm.spans import Kind, locate, redact, tagged, written
from marquee.session import MOST_ROWS_SENT, materialise, scratch_scope

SCOPE_CHARS = 256

# The base kinds in their order.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_NAMED = r"""["']?\x20*[:=]\x20*["']?"""
_STEM = r"""["']?\x20*[:=]"""
BASE = [
    Kind("assign", ASSIGN, 2, probe=rf"(?i:password|passwd|secret|token|api_?key){_STEM}"),
    Kind("access", r"AKIA[A-Z0-9]+", needle="AKIA"),
    Kind("hex", r"[0-9a-f]{32,}", probe=r"[0-9a-f]{32}"),
]
# Weak parts with their role.  Each is a lead, never a finding by itself.
_ACCOUNT = r"(?i:access_?key_?id|client_?id|user_?name|user|login|account)"
_PHRASE = r"(?i:pwd|passphrase|password|passwd|pass|auth|credential|access_?key|private_?key|api_?key|secret|token)"
_HOST = r"(?i:hostname|host|server|endpoint|database|db)"
_SCHEME = r"(?i:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp|ftp|s3)"
WEAK = [
    (Kind("account", rf"{_ACCOUNT}{_NAMED}([A-Za-z0-9._@-]{{3,}})", 1, probe=_ACCOUNT + _STEM), "id"),
    (Kind("phrase", rf"""{_PHRASE}{_NAMED}([^\x20\x09-\x0D"',;]{{4,}})""", 1, probe=_PHRASE + _STEM), "secret"),
    (Kind("bare", r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])", probe=r"[A-Za-z0-9+/]{40}"), "secret"),
    (Kind("url", rf"""{_SCHEME}://[^\x20\x09-\x0D"'<>]{{3,}}""", needle="://"), "endpoint"),
    (Kind("host", rf"{_HOST}{_NAMED}([A-Za-z0-9.:/_-]{{3,}})", 1, probe=_HOST + _STEM), "endpoint"),
]
# Role of a base kind in a link.
BASE_ROLE = {"assign": "secret", "access": "id", "hex": "secret"}
ORDER = {"assign": 0, "access": 1, "hex": 2, "linked_id": 3, "linked_secret": 4, "linked_endpoint": 5}
SPAN = "struct<start:int,order:int,end:int,kind:string>"


def _filtered() -> dict[str, Column]:
    """Base spans that pass their kind's test."""
    return {
        "assign": F.filter("assign", lambda s: F.length(s["value"]) >= 8),
        "access": F.filter("access", lambda s: F.length(s["match"]) >= 16),
        "hex": F.col("hex"),
    }


def find(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """A stored table, one row per row of ``docs``: ``carry``, ``row``, ``base``, ``parts``.

    ``base`` are the certain spans in order of start, then kind; ``parts`` the weak ones with their role.
    ``row`` is unique, so rows that repeat (and keys that repeat or are null) stay apart.
    """
    carry = ["doc_id"] if carry is None else carry
    own = F.struct(*carry).alias("_carry")
    rows = docs.select(own, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    found = locate(rows, BASE + [k for k, _ in WEAK]).select(
        "_carry", *[c.alias(n) for n, c in _filtered().items()], *[k.name for k, _ in WEAK]
    )
    base = F.array_sort(F.concat(*[tagged(F.col(k.name), ORDER[k.name], k.name) for k in BASE]))

    def weak(name: str, role: str) -> Column:
        return F.transform(name, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(role).alias("role")))

    parts = F.concat(*[weak(k.name, role) for k, role in WEAK])
    return materialise(found.select(
        "_carry", F.monotonically_increasing_id().alias("row"), base.alias("base"), parts.alias("parts")
    ), "secrets")


def link(found: DataFrame, scope: int = SCOPE_CHARS) -> DataFrame:
    """``(row, linked)``: weak parts with their complements at most ``scope`` characters away, as spans.

    An identifier needs a secret; a secret needs an identifier; an endpoint needs both.  Certain spans are
    complements too.  The distance is that from the end of one part to the start of the other.  Parts are
    joined by row and scope-wide bin (each is in all bins that it touches and looks into those within its
    scope), so a long text is spread over bins and no list of parts is compared with itself.
    What is asked of a bin is whether it holds a role near enough; roles are joined, never pairs of parts
    kept.  A weak part that one certain span contains is dropped, it is reported already.
    """
    weak = found.where(F.size("parts") > 0).select("row", F.explode("parts").alias("p")).select("row", "p.*", F.lit(True).alias("weak"))
    role = F.element_at(F.create_map(*[F.lit(x) for kv in BASE_ROLE.items() for x in kv]), F.col("b.kind"))
    sure = found.where((F.size("parts") > 0) & (F.size("base") > 0)).select("row", F.explode("base").alias("b")).select(
        "row", "b.start", "b.end", role.alias("role"), F.lit(False).alias("weak")
    )
    parts = weak.union(sure)
    bins = lambda start, end: F.explode(F.sequence(F.floor(start / scope).cast("int"), F.floor(end / scope).cast("int"))).alias("bin")
    seen = parts.select(
        "row", bins(F.col("start") - scope, F.col("end") + scope),
        F.col("start").alias("o_start"), F.col("end").alias("o_end"), F.col("role").alias("o_role"), F.col("weak").alias("o_weak"),
    )
    asked = weak.select("row", "start", "end", "role", bins(F.col("start"), F.col("end")))
    near = F.greatest(F.col("o_start") - F.col("end"), F.col("start") - F.col("o_end")) <= scope
    over = (F.col("o_start") < F.col("end")) & (F.col("start") < F.col("o_end"))
    inside = (F.col("o_start") <= F.col("start")) & (F.col("end") <= F.col("o_end"))
    met = asked.join(seen, ["row", "bin"]).where(near).groupBy("row", "start", "end", "role").agg(
        F.bool_or((F.col("o_role") == "id") & ~over).alias("id"),
        F.bool_or((F.col("o_role") == "secret") & ~over).alias("secret"),
        F.bool_or(inside & ~F.col("o_weak")).alias("covered"),
    )
    told = F.when(F.col("role") == "id", F.col("secret")).when(F.col("role") == "secret", F.col("id")).otherwise(F.col("id") & F.col("secret"))
    kind = F.concat(F.lit("linked_"), F.col("role"))
    order = F.element_at(F.create_map(*[F.lit(x) for kv in ORDER.items() for x in kv]), kind)
    span = F.struct(F.col("start").alias("start"), order.alias("order"), F.col("end").alias("end"), kind.alias("kind"))
    return met.where(told & ~F.col("covered")).groupBy("row").agg(F.array_sort(F.collect_set(span)).alias("linked"))


def scan_rows(docs: DataFrame, text: str, carry: list[str], scope: int = SCOPE_CHARS) -> DataFrame:
    """``_carry`` (a struct, so that no name can clash), ``base`` and ``spans`` of every row.

    Rows without weak parts (nearly all) take no part in a shuffle.
    """
    found = find(docs, text, carry)
    lone = found.where(F.size("parts") == 0).select("_carry", "base", F.col("base").alias("spans"))
    rest = found.where(F.size("parts") > 0).join(link(found, scope), "row", "left")
    none = F.array().cast(f"array<{SPAN}>")
    both = rest.select("_carry", "base", F.array_sort(F.concat("base", F.coalesce("linked", none))).alias("spans"))
    return lone.union(both)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", scope: int = SCOPE_CHARS) -> DataFrame:
    """``doc_id``, ``base`` spans and ``spans`` (base and linked, in order) of every row of ``docs``.

    A null or empty text has none.  Repeated rows and repeated or null keys each keep their row; other
    columns are not read.
    """
    return scan_rows(docs, text, [key], scope).select(F.col("_carry").getField(key).alias("doc_id"), "base", "spans")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and written spans of scanned rows."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        "doc_id", *[count(k.name) for k in BASE],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, text: str = "text", scope: int = SCOPE_CHARS) -> DataFrame:
    """``docs`` with every reported span replaced by its kind; same columns, same rows.

    A null text stays null; an empty table stays empty; rows that repeat are redacted alike.  Only spans
    are stored, under the names of their rows; they go to the texts where those are read if they are few.
    """
    rows = numbered(docs)
    with scratch_scope(docs.sparkSession) as tables:
        found = scan_rows(rows, text, ROW, scope)
        spans = materialise(found.where(F.size("spans") > 0).select(*[F.col("_carry").getField(c).alias(c) for c in ROW], F.col("spans").alias("_spans")), "spans")
        tables.keep(spans)
    # A span counts as a row here: one document may hold most of them.
    few = spans.agg(F.coalesce(F.sum(F.size("_spans") + 1), F.lit(0))).first()[0] <= MOST_ROWS_SENT
    marked = rows.join(F.broadcast(spans) if few else spans, ROW, "left")
    clean = F.when(F.col("_spans").isNull(), F.col(text)).otherwise(redact(F.col(text), F.col("_spans")))
    return marked.select(*[clean.alias(c) if c == text else F.col(c) for c in docs.columns])
