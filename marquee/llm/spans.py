"""Places of pattern matches inside texts, as Column expressions only.

Spark's regular-expression functions return matched texts but no offsets.  The texts between matches
(a split by the same pattern) give them: a match starts after all gaps and matches before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256


@dataclass(frozen=True)
class Kind:
    """A pattern, and the group given as value.

    ``probe`` (a simpler pattern) or ``needle`` (a plain text) must be in a text for it to be searched.
    """

    name: str
    pattern: str
    group: int = 0
    probe: str = ""
    needle: str = ""


def once(value: Column, use) -> Column:
    """``use`` of ``value``, made once however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, kind: str, zero: Column, join) -> Column:
    """All earlier elements joined, for each element of an array; ``kind`` is the element type, ``join`` associative.

    Lambdas have no scan and appending to an array copies it, so elements are first joined in blocks: the
    work is elements x block size, not elements squared.
    """
    last = lambda a: F.element_at(a, -1)

    def scanned(v: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.greatest(F.ceil(F.size(v) / F.lit(BLOCK)).cast("int") - 1, F.lit(0))),
            lambda b: F.aggregate(F.slice(v, b * BLOCK + 1, BLOCK), F.array(zero), lambda acc, x: F.concat(acc, F.array(join(last(acc), x)))),
        )
        # The whole of a block goes with its elements; blocks are then moved by what stands before them.
        return F.aggregate(
            blocks,
            F.struct(zero.alias("before"), F.array().cast(f"array<array<{kind}>>").alias("done")),
            lambda acc, b: F.struct(
                join(acc["before"], last(b)).alias("before"),
                F.concat(acc["done"], F.array(F.transform(F.slice(b, F.lit(1), F.size(b) - 1), lambda x: join(acc["before"], x)))).alias("done"),
            ),
            lambda acc: F.flatten(acc["done"]),
        )

    return once(values, lambda v: F.when(F.size(v) > 0, scanned(v)).otherwise(F.array().cast(f"array<{kind}>")))


def running_sums(values: Column) -> Column:
    """Sum of all earlier elements, for each element of an integer array."""
    return running(values, "bigint", F.lit(0).cast("long"), lambda a, x: a + x)


def gaps_before(text: Column, spans: Column) -> Column:
    """The text before each of the sorted ``spans``, back to where the spans before it end; empty inside one.

    The text is cut at every 256th span first, as in ``redact``.
    """
    upto = running(F.transform(spans, lambda s: s["end"]), "int", F.lit(0), F.greatest)
    places = F.zip_with(spans, upto, lambda s, u: F.struct(u.alias("from"), F.greatest(s["start"], u).alias("upto")))

    def cut(group: Column) -> Column:
        base = F.get(group, F.lit(0))["from"]
        part = F.substring(text, base + 1, F.element_at(group, -1)["upto"] - base)
        return once(part, lambda p: F.transform(group, lambda c: F.substring(p, c["from"] - base + 1, c["upto"] - c["from"])))

    def groups(c: Column) -> Column:
        last = F.greatest(F.ceil(F.size(c) / F.lit(BLOCK)).cast("int") - 1, F.lit(0))
        return F.flatten(F.transform(F.sequence(F.lit(0), last), lambda g: once(F.slice(c, g * BLOCK + 1, BLOCK), cut)))

    return F.when(F.size(spans) > 0, once(places, groups)).otherwise(F.array().cast("array<string>"))


def locate(rows: DataFrame, kinds: list[Kind], text: str = "_t") -> DataFrame:
    """``rows`` with a column per kind: its leftmost matches that do not overlap, in order.

    Each is ``array<struct<start, end, match, value>>``: code points, end exclusive, the match and the
    wanted group.  Texts without the probe are not searched.  ``text`` must not be null.  The columns are
    made in steps, so that lambdas only read arrays that exist.
    """
    keep = rows.columns
    t = F.col(text)
    made = {}
    for k in kinds:
        on, pattern = t.contains(k.needle) if k.needle else t.rlike(k.probe or k.pattern), F.lit(k.pattern)
        made[f"_{k.name}_m"] = F.when(on, F.regexp_extract_all(t, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
        if k.group:
            made[f"_{k.name}_v"] = F.when(on, F.regexp_extract_all(t, pattern, F.lit(k.group))).otherwise(F.array().cast("array<string>"))
        gaps = F.split(t, k.pattern, -1)
        made[f"_{k.name}_g"] = F.when(on, F.transform(gaps, lambda g: F.struct(F.length(g).alias("n"))))
    found = rows.select(*keep, *[c.alias(n) for n, c in made.items()])

    def taken(k: Kind) -> Column:
        return F.transform(f"_{k.name}_m", lambda m, i: F.get(f"_{k.name}_g", i)["n"] + F.length(m)).alias(f"_{k.name}_n")

    found = found.select("*", *[taken(k) for k in kinds])
    found = found.select("*", *[running_sums(F.col(f"_{k.name}_n")).alias(f"_{k.name}_s") for k in kinds])

    def span(k: Kind) -> Column:
        def one(m: Column, i: Column) -> Column:
            gap = F.get(f"_{k.name}_g", i)
            start = (F.get(f"_{k.name}_s", i) + gap["n"]).cast("int")
            return F.struct(
                start.alias("start"), (start + F.length(m)).alias("end"), m.alias("match"),
                (F.get(f"_{k.name}_v", i) if k.group else m).alias("value"),
            )

        return F.transform(f"_{k.name}_m", one).alias(k.name)

    return found.select(*keep, *[span(k) for k in kinds])


def tagged(spans: Column, order: int, kind: str) -> Column:
    """Spans as ``(start, order, end, kind)``, which sort by start and then by kind."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")
    ))


def written(spans: Column) -> Column:
    """Sorted spans as ``kind:start:end``, joined by commas; an empty text without spans."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by ``[KIND]``; overlapping spans become one, named by the first.

    ``spans`` are sorted.  The text is cut at every 256th span first, so that a piece is looked for in
    its cut and not from the start of a long text.
    """
    merged = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,upto:int,kind:string>>").alias("cuts")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(s["end"].alias("at"), F.concat(acc["cuts"], F.array(F.struct(
                acc["at"].alias("from"), s["start"].alias("upto"), s["kind"].alias("kind")
            ))).alias("cuts")),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["cuts"].alias("cuts"))),
    )

    def cut(group: Column) -> Column:
        base = F.get(group, F.lit(0))["from"]
        part = F.substring(text, base + 1, F.element_at(group, -1)["upto"] - base)
        piece = lambda c, p: F.concat(
            F.substring(p, c["from"] - base + 1, c["upto"] - c["from"]), F.lit("["), F.upper(c["kind"]), F.lit("]")
        )
        return F.get(F.transform(F.array(part), lambda p: F.array_join(F.transform(group, lambda c: piece(c, p)), "")), F.lit(0))

    def rebuilt(acc: Column) -> Column:
        last = F.greatest(F.ceil(F.size(acc["cuts"]) / F.lit(BLOCK)).cast("int") - 1, F.lit(0))
        groups = F.transform(F.sequence(F.lit(0), last), lambda g: F.slice(acc["cuts"], g * BLOCK + 1, BLOCK))
        return F.concat(F.array_join(F.transform(groups, cut), ""), F.substring(text, acc["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.get(F.transform(F.array(merged), rebuilt), F.lit(0))).otherwise(text)
