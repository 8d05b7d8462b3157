"""Personal data against a plain-Python reading of the same rules, and the bootstrap on planted contexts."""

import hashlib
import re

from pyspark.sql import functions as F

from marquee.llm import bootstrapped_pii as bp

TEXTS = [
    None, "", "no data here", "mail é𝄞 a.b+c@x-y.example.com_x@d.e.", "a@b.c@d.e", "@x.y a@b a@.c", "1.2.3.4 256.1.1.1 001.02.3.255 1.2.3.4.5.6.7.8",
    "0000000001.2.3.4", "card 4111 1111 1111 1111 and 4111-1111-1111-1112", "378282246310005 1234", "+1 (555) 123-4567. +12 +1--------2 +123456789012345678",
    "+1 555 123 45 6", "a" * 60_000, "1" * 60_000, "a." * 20_000 + "@b" + ".c" * 20_000, "5 " * 20_000, "x@y.z " * 3000, "4111111111111111" * 2,
]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    t, out = text or "", []
    for m in re.finditer(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+" if len(t) > 5000 else r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(?:\.[0-9]+){3}" if len(t) < 5000 else r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([ -]?[0-9])+", t):
        d = re.sub(r"\D", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][ ().0-9-]+[0-9]", t):
        if 10 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_base_spans_match_brute_force(spark):
    texts = TEXTS + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rows = bp.digest(bp.scan(frame(spark, texts))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (r["doc_id"], want[:200], r["spans"][:200])
        kinds = want.split(",") if want else []
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(w.startswith(k + ":") for w in kinds) for k in ("email", "ip", "card", "phone")]


def test_trusted_pattern_discovers_identifiers(spark):
    texts = [f"you can call me at +1 555 010 {1000 + i} today" for i in range(8)]
    texts += ["please call me at 555-010-7777 soon", "see version number 2024-11-0001 of it", "the value was 12345678 then"]
    texts += ["please call me at 555-010-7777 soon"]
    docs = frame(spark, texts).withColumn("row", F.lit(1)).withColumn("like", F.lit("x"))
    spans = {r["doc_id"]: r["spans"] for r in bp.digest(bp.scan(docs)).collect()}
    assert spans[8] == spans[11] == "context:18:30"
    assert spans[9] == spans[10] == ""
    texts_out = {r["doc_id"]: r["text"] for r in bp.redacted(docs).collect()}
    assert texts_out[8] == "please call me at [CONTEXT] soon" and texts_out[9] == texts[9]
    assert texts_out[0] == "you can call me at [PHONE] today"


def test_empty_table(spark):
    assert bp.digest(bp.scan(frame(spark, []))).count() == 0


def test_context_reaches_across_earlier_identifiers(spark):
    texts = [f"you can call me at +1 555 010 {1000 + i} or +1 555 011 {1000 + i} today" for i in range(8)]
    texts += ["call me at 555-010-7777 or 555-010-8888", "call me at 20240011 , 7 or 555-010-9999 now"]
    texts += [f"ask{' ' * 90}about{' ' * 90}x{i}@y.org" for i in range(4)] + ["ask about 31337-31337"]
    texts += ["w" * 5000 + " near" + " 20240011" * 600]
    found = bp.find(frame(spark, texts), "text", ["doc_id"]).collect()
    told = {r["_carry"]["doc_id"]: [e["pattern"] for e in sorted(r["leads"], key=lambda e: e["start"])] for r in found}
    assert told[8] == ["me at", "at or"] and told[9] == ["me at", ", or"] and told[14] == ["ask about"]
    assert len(told[15]) == 600 and set(told[15]) == {hashlib.sha256(b"w" * 5000).hexdigest() + " near"}
    spans = {r["doc_id"]: r["spans"] for r in bp.digest(bp.scan(frame(spark, texts))).collect()}
    assert spans[8] == "context:11:23,context:27:39" and spans[14] == "context:10:21"


def test_identifier_like_runs_are_whole(spark):
    run = re.compile(r"(?<![A-Za-z0-9@._%+/-])[@._%+/-]*([A-Za-z0-9][A-Za-z0-9@._%+/-]*)")
    texts = ["0123456789abcdef" * 4, "user jonathan.alexander.fitzgerald.1234 x", "--é12345/-_- " + "ab." * 40 + "1.2.3.4x5", "/" * 50 + "a1b2c3", "2024" * 3]
    texts += ["a." * 30_000, "a." * 30_000 + "1234", "1a" * 30_000, "/" * 60_000]
    for r in bp.find(frame(spark, texts), "text", ["doc_id"]).collect():
        text = texts[r["_carry"]["doc_id"]]
        want = {m.span(1) for m in run.finditer(text) if sum(c.isdigit() for c in m[1]) >= 4}
        base = [(b["start"], b["end"]) for b in r["base"]]
        assert {(e["start"], e["end"]) for e in r["leads"]} == {(s, e) for s, e in want if not any(b < e and s < f for b, f in base)}


def settled(rows):
    """Patterns that end trusted, with their scores, by plain loops over the pattern-value graph."""
    edges = {}
    for r in rows:
        for name, sure in (("seeds", 1), ("leads", 0)):
            for e in r[name]:
                if e["pattern"]:
                    key = (e["pattern"], e["value"])
                    edges[key] = max(sure, edges.get(key, 0))
    known = {v for (_, v), sure in edges.items() if sure}
    belief, before = {v: 1.0 for v in known}, None
    while True:
        trusted = {}
        for p in {p for p, _ in edges}:
            values = [belief.get(v, 0.0) for q, v in edges if q == p]
            score = sum(values) / (len(values) + 1)
            if score >= bp.TRUSTED and sum(b >= bp.BELIEVED for b in values) >= bp.SUPPORT:
                trusted[p] = score
        mark = {p: round(s, 6) for p, s in trusted.items()}
        if mark == before:
            return trusted
        before = mark
        belief = {v: 1.0 for v in known}
        for v in {v for _, v in edges} - known:
            wrong = 1.0
            for p, w in edges:
                if w == v and p in trusted:
                    wrong *= 1 - min(trusted[p], 0.999)
            if wrong < 1:
                belief[v] = 1 - wrong


def test_rounds_run_until_settled(spark):
    """A chain of patterns, each trusted only by what the one before it discovers."""
    texts = [f"write to me at +1 555 010 {1000 + i} today" for i in range(60)]
    texts += [f"write to me at 555-{i:03d}-7777 today" for i in range(12)]
    for step, name in enumerate("abcdef"):
        texts += [f"so link {name * 2} 555-{i:03d}-7777 or" for i in range(3 * step, 3 * step + 15)]
    found = bp.find(frame(spark, texts), "text", ["doc_id"])
    want = settled(found.collect())
    got = {r["pattern"]: r["score"] for r in bp.trusted_patterns(found).collect()}
    assert set(got) == set(want) >= {"me at", "link aa", "link ff"}
    assert all(abs(got[p] - want[p]) < 1e-6 for p in want)
    digests = bp.digest(bp.scan(frame(spark, texts))).collect()
    assert all(r["n_spans"] == 1 for r in digests)
