"""Personal data in texts: certain shapes, and identifiers that stand where such shapes stand.

Certain kinds (mail addresses, IP addresses, card and phone numbers) are found by pattern and test.  They
seed a bootstrap: the words before them are lexical patterns, every pattern is scored by how many of the
identifiers it introduces are believed, identifiers by the patterns that introduce them, in rounds; a
pattern that ends with high confidence then also reports identifiers of no known shape after it.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.spans import Kind, gaps_before, locate, redact, running, written
from marquee.session import materialise

# The base kinds in their order.  Loops are possessive, and a mail address or an IP address
# starts where its run of characters does (or where the last match ended): the same matches, but neither
# the stack nor the time grows with the square of a long run.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = [
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", needle="@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", probe=r"[0-9]\.[0-9]"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", probe=r"[0-9](?:[\x20-]?[0-9]){13}"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", probe=r"\+[0-9]"),
]
# Identifier-like: one whole run of letters, digits and joining marks with four digits or more.  A run is
# entered at its start only and the loops are possessive; its value begins behind the marks in front.
_MARKS = "@._%+/-"
_JOINED = rf"[A-Za-z{_MARKS}]"
LIKE = Kind(
    "like", rf"(?<![A-Za-z0-9{_MARKS}])[{_MARKS}]*+(?=(?:{_JOINED}*+[0-9]){{4}})[A-Za-z0-9{_MARKS}]++",
    probe=rf"[0-9](?:{_JOINED}*+[0-9]){{3}}",
)
ORDER = {"email": 0, "ip": 1, "card": 2, "phone": 3, "context": 4}
# A pattern is trusted with this score and so many different believed identifiers.
TRUSTED = 0.6
SUPPORT = 3
BELIEVED = 0.6
SPAN = "struct<start:int,order:int,end:int,kind:string>"


def _luhn(digits: Column) -> Column:
    """Whether 14 to 19 digits pass the check: every second one from the right counts double, less nine above nine."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    total = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), worth), F.lit(0), lambda a, x: a + x)
    return F.when(n.between(14, 19), total % 10 == 0).otherwise(False)


def _octet(part: Column) -> Column:
    number = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return F.when(F.length(number) <= 3, number.cast("int") <= 255).otherwise(False)


def _filtered() -> dict[str, Column]:
    digits = lambda s, others: F.translate(s["match"], others, "")

    def bare(s: Column) -> Column:
        value = F.ltrim(s["match"], F.lit(_MARKS))
        return F.struct((s["end"] - F.length(value)).alias("start"), s["end"].alias("end"), value.alias("match"))

    return {
        "like": F.transform("like", bare),
        "email": F.col("email"),
        "ip": F.filter("ip", lambda s: F.forall(F.split(s["match"], r"\."), _octet)),
        "card": F.filter("card", lambda s: _luhn(digits(s, " -"))),
        "phone": F.filter("phone", lambda s: F.length(digits(s, "+ ().-")).between(10, 15)),
    }


def _short(word: Column) -> Column:
    """A word, or the hash of a long one: words are only compared, and one may stand before many identifiers."""
    return F.when(F.length(word) > 64, F.sha2(word, 256)).otherwise(word)


def _last_two(words: Column) -> Column:
    return F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), 2)


def _words(gap: Column) -> Column:
    """The last two words of a text, lower-cased, without digits.  A run of digits and signs is no word.

    Nearly always they are in its last 256 characters, behind the run that begins there; else all is read.
    """
    kept = lambda runs: F.filter(runs, lambda w: (w != "") & (~w.rlike("[0-9]") | w.rlike(r"\p{L}")))
    runs = lambda t: F.split(F.lower(t), r"[\x20\x09-\x0D]+", -1)
    near = runs(F.right(gap, F.lit(256)))
    behind = _last_two(kept(F.slice(near, F.lit(2), F.size(near))))
    two = F.when(F.size(behind) == 2, behind).otherwise(_last_two(kept(runs(gap))))
    return F.transform(two, lambda w: _short(F.translate(w, "0123456789", "")))


def patterns_before(text: Column, spans: Column) -> Column:
    """The last two words before each of the sorted ``spans``, across earlier ones; empty when there are not two."""
    words = F.transform(gaps_before(text, spans), _words)
    join = lambda a, b: _last_two(F.concat(a, b))
    before = running(words, "array<string>", F.array().cast("array<string>"), join)
    return F.transform(F.zip_with(before, words, join), lambda w: F.when(F.size(w) == 2, F.array_join(w, " ")).otherwise(F.lit("")))


def find(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """Stored, one row per row of ``docs``: ``_carry``, ``row``, ``base`` spans, ``seeds`` and ``leads``.

    Seeds are pattern and value of the base spans; leads are identifier-like runs outside them.
    """
    rows = docs.select(F.struct(*carry).alias("_carry"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    found = locate(rows, [*BASE, LIKE]).select("_carry", "_t", *[c.alias(n) for n, c in _filtered().items()])

    def mark(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(ORDER.get(kind, ORDER["context"])).alias("order"), s["end"].alias("end"),
            F.lit(kind).alias("kind"), _short(s["match"]).alias("value"),
        ))

    based = found.select("_carry", "_t", "like", F.concat(*[mark(k.name) for k in BASE]).alias("based"))
    free = F.filter(mark("like"), lambda s: ~F.exists("based", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    marked = based.select("_carry", "_t", F.array_sort(F.concat("based", free)).alias("marks"))
    told = marked.select("_carry", "marks", F.when(F.size("marks") > 0, patterns_before(F.col("_t"), F.col("marks"))).otherwise(F.array().cast("array<string>")).alias("told"))
    whole = told.select("_carry", F.zip_with("marks", "told", lambda m, p: F.struct(m.alias("m"), p.alias("pattern"))).alias("marks"))
    sure, lead = (F.filter("marks", lambda x: x["m"]["order"] < ORDER["context"]), F.filter("marks", lambda x: x["m"]["order"] == ORDER["context"]))
    return materialise(whole.select(
        "_carry", F.monotonically_increasing_id().alias("row"),
        F.transform(sure, lambda x: F.struct(*[x["m"][n].alias(n) for n in ("start", "order", "end", "kind")])).alias("base"),
        F.transform(sure, lambda x: F.struct(x["pattern"].alias("pattern"), x["m"]["value"].alias("value"))).alias("seeds"),
        F.transform(lead, lambda x: F.struct(
            x["m"]["start"].alias("start"), x["m"]["end"].alias("end"), x["pattern"].alias("pattern"), x["m"]["value"].alias("value")
        )).alias("leads"),
    ), "pii")


def trusted_patterns(found: DataFrame) -> DataFrame:
    """``(pattern, score)`` of the patterns that end with high confidence.

    Edges are distinct (pattern, value) pairs, so copies of a text count once.  A pattern's score is the
    belief in its values over their number plus one; a value's belief is one for a seed, else the chance
    that not all trusted patterns before it are wrong.  Each round is two sums over the stored edges.
    """
    seeds = found.select(F.explode("seeds").alias("e")).select("e.pattern", "e.value", F.lit(1).alias("seed"))
    leads = found.select(F.explode("leads").alias("e")).select("e.pattern", "e.value", F.lit(0).alias("seed"))
    edges = materialise(seeds.union(leads).where("pattern <> ''").groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "edges")
    known = edges.where("seed = 1").select("value").distinct().withColumn("belief", F.lit(1.0))
    belief, mark = known, None
    while True:
        scored = edges.join(belief, "value", "left").groupBy("pattern").agg(
            (F.sum(F.coalesce("belief", F.lit(0.0))) / (F.count("*") + 1)).alias("score"),
            F.sum((F.coalesce("belief", F.lit(0.0)) >= BELIEVED).cast("int")).alias("support"),
        )
        trusted = materialise(scored.where((F.col("score") >= TRUSTED) & (F.col("support") >= SUPPORT)).select("pattern", "score"), "patterns")
        before, mark = mark, tuple(trusted.agg(F.count("*"), F.bit_xor(F.xxhash64("pattern", F.round("score", 6)))).first())
        if before == mark:
            return trusted
        told = edges.where("seed = 0").join(trusted, "pattern").groupBy("value").agg(
            (1 - F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.999)))))).alias("belief")
        )
        belief = materialise(known.union(told.join(known, "value", "left_anti")), "beliefs")


def scan_rows(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``_carry`` (a struct, so that no name can clash), ``base`` and ``spans`` of every row.

    Only leads of trusted patterns are joined back; rows without any lead take no part in a shuffle.
    """
    found = find(docs, text, carry)
    leads = found.where(F.size("leads") > 0).select("row", F.explode("leads").alias("e")).select("row", "e.*").where("pattern <> ''")
    span = F.struct("start", F.lit(ORDER["context"]).alias("order"), "end", F.lit("context").alias("kind"))
    added = leads.join(trusted_patterns(found), "pattern", "left_semi").groupBy("row").agg(F.collect_set(span).alias("added"))
    lone = found.where(F.size("leads") == 0).select("_carry", "base", F.col("base").alias("spans"))
    none = F.array().cast(f"array<{SPAN}>")
    rest = found.where(F.size("leads") > 0).join(added, "row", "left").select(
        "_carry", "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans")
    )
    return lone.union(rest)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``base`` spans and ``spans`` (base and discovered, in order) of every row of ``docs``.

    A null or empty text has none.  Repeated rows and repeated or null keys each keep their row; other
    columns are not read.  An empty table gives none.
    """
    return scan_rows(docs, text, [key]).select(F.col("_carry").getField(key).alias("doc_id"), "base", "spans")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and written spans of scanned rows."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        "doc_id", *[count(k.name) for k in BASE],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every reported span replaced by its kind; same columns, same rows; a null text stays null."""
    own = F.col("_carry").getField
    rows = scan_rows(docs, text, docs.columns).select("_carry", "spans", own(text).alias("_t"))
    return rows.select(*[(redact(F.col("_t"), F.col("spans")) if c == text else own(c)).alias(c) for c in docs.columns])
