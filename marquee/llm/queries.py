"""The registered queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bootstrapped_pii, bpe_tree, budget_mix, chat_collapse, filter_audit, hnsw_dedup, langid_ftrl, linked_secrets, minhash_bbit, quality_knn, rule_ledger, target_resample, topk_threshold
from marquee.llm.registry import CHECK_SQL, QUERIES, query, table  # noqa: F401
from marquee.session import materialise

OP3_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t
), listed AS (
  SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w
), grams AS (
  SELECT row, i, lead(word, 4) OVER o IS NOT NULL AS whole,
    concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS win
  FROM listed WINDOW o AS (PARTITION BY row ORDER BY i)
), places AS (
  SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM grams WHERE whole
), covered AS (
  SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(i, i + 5)) AS p FROM places WHERE n > 1) GROUP BY row
), m AS (
  SELECT w.doc_id, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
    coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered c USING (row)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 10 * word_chars
    OR 100 * n_dup_lines > 30 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 2 * n_capitals > word_chars) AS kept
FROM m
"""


@query("op3_quality_rules", OP3_SQL)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = rule_ledger.apply_policy(rule_ledger.ledger(table(spark, sf_dir, "documents")))
    base = F.col("fail_bits").bitwiseAND(F.lit(rule_ledger.mask_of(rule_ledger.BASE_POLICY))) != 0
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept"
    )


_RULE_BITS = (
    "n_words < 10", "100 * n_repeat_words > 20 * n_words", "100 * n_symbols > 10 * word_chars", "100 * n_dup_lines > 30 * n_lines",
    "word_chars < 2 * n_words", "word_chars > 20 * n_words", "2 * n_capitals > word_chars",
)
_RULE_NAMES = ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words", "capitals")
ABLATIONS_SQL = OP3_SQL.split("SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines")[0].rstrip() + (
    ", b AS (SELECT " + " + ".join(f"{1 << i} * ({rule})::INT" for i, rule in enumerate(_RULE_BITS)) + " AS bits FROM m) "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (bits & {1 << i} <> 0) AS n_failed, count(*) FILTER (bits = {1 << i}) AS n_only FROM b"
        for i, name in enumerate(_RULE_NAMES)
    )
)


@query("quality_rule_ablations", ABLATIONS_SQL)
def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy rejects, and what it rejects alone, from the ledger once stored."""
    book = materialise(rule_ledger.ledger(table(spark, sf_dir, "documents")), "ledger")
    return rule_ledger.ablations(book)


@query("op9_secrets")
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_secrets.digest(linked_secrets.scan(table(spark, sf_dir, "documents")))


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = bpe_tree.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe_tree.digests(docs, ranks, public_tokenizers.PATTERN).drop("text")


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid_ftrl.fit(docs.where(~langid_ftrl.held_out()))
    found = langid_ftrl.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid_ftrl.held_out().alias("held_out"), "lang_pred", "score")


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~quality_knn.held_out())
    scored = quality_knn.score(docs, quality_knn.fit(docs, labels))
    predicted = (F.col("score") >= quality_knn.KEEP_SCORE).cast("int").alias("predicted")
    return scored.select("doc_id", quality_knn.held_out().alias("held_out"), "score", predicted)


@query("op6_mix_sources")
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = budget_mix.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("times")).cast("long").alias("taken")
    return rows.select(F.col("_carry.doc_id").alias("doc_id"), "size", "source_size", "target", taken)


OP7_SQL = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, count(*) AS n,
    list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns FROM t GROUP BY conv_id
), u AS (
  SELECT min(conv_id) AS conv_id, n, turns, count(*) AS n_copies FROM c GROUP BY n, turns
), kept AS (
  SELECT * FROM u WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.n > u.n AND c.turns[1].t IS NOT DISTINCT FROM u.turns[1].t AND c.turns[1:u.n] = u.turns)
), parts AS (
  SELECT *, unnest(range(0, (n - 1) // 1024 + 1)) AS part FROM kept
)
SELECT conv_id, part, n AS n_turns, n_copies,
  sha256(list_aggregate(list_transform(turns[part * 1024 + 1:part * 1024 + 1024],
    lambda x: '<|im_start|>' || coalesce(x.r, 'user') || chr(10) || coalesce(x.t, '') || '<|im_end|>' || chr(10)), 'string_agg', '')) AS chat_sha256
FROM parts
"""


@query("op7_chat_format", OP7_SQL)
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = chat_collapse.format_chats(table(spark, sf_dir, "conversations"))
    return chats.select("conv_id", "part", "n_turns", "n_copies", F.sha2("chat", 256).alias("chat_sha256"))


OP2_SQL = r"""
WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), listed AS (
  SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM t
), grams AS (
  SELECT doc_id, n, i, word || coalesce(' ' || lead(word, 1) OVER o, '') || coalesce(' ' || lead(word, 2) OVER o, '') AS gram
  FROM listed WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), sets AS (
  SELECT DISTINCT doc_id, gram FROM grams WHERE i <= greatest(1, n - 2)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sets a JOIN sets b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  WITH RECURSIVE r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN edges e ON e.a = r.b)
  SELECT a, min(b) AS component_id FROM r GROUP BY a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id
"""


@query("op2_minhash_dedup", OP2_SQL)
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = minhash_bbit.Near(words=3, percent=85)
    return minhash_bbit.find(table(spark, sf_dir, "documents"), near).select("doc_id", "n_shingles", "component_id", "kept")


OP5_SQL = r"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, label,
    label IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), false)
      AND coalesce(list_bool_or(list_transform(embedding, lambda x: x <> 0)), false) AS usable
  FROM embeddings
), edges AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.usable AND b.usable
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), n AS (
  SELECT a, count(*) AS n_links FROM edges GROUP BY a
), reach AS (
  WITH RECURSIVE r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, e.b FROM r JOIN edges e ON e.a = r.b)
  SELECT a, min(b) AS component_id FROM r GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN reach ON reach.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


@query("op5_embedding_dedup", OP5_SQL)
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_dedup.find(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


COPIES_SQL = OP5_SQL.replace("FROM embeddings", "FROM copies").replace("WITH v AS", """WITH copies AS (
  SELECT vec_id, embedding::DOUBLE[] AS embedding, label FROM embeddings
  UNION ALL SELECT vec_id + 1000000000, list_transform(embedding::DOUBLE[], lambda x, i: x * (1 + ((i + vec_id) % 5 - 2) / 100.0::DOUBLE)), label FROM embeddings
  UNION ALL SELECT e.vec_id + 2000000000, list_transform(h.embedding::DOUBLE[], lambda x, i: x * (1 + ((7 * i + e.vec_id) % 11 - 5) / 1000.0::DOUBLE)), h.label
  FROM embeddings e JOIN (SELECT * FROM embeddings WHERE vec_id = 1) h ON e.vec_id % 2 = 0
), v AS""", 1)


@query("embedding_dedup_copies", COPIES_SQL)
def embedding_dedup_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors with a near copy of each, and half as many again around one of them: links, and a hot group."""
    own = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    moved = lambda vector, step, parts, scale: F.transform(
        vector, lambda x, i: x * (1 + ((step * (i + 1) + F.col("vec_id")) % parts - (parts - 1) / 2) / scale)
    )
    near = own.select((F.col("vec_id") + 1_000_000_000).alias("vec_id"), moved("embedding", 1, 5, 100.0).alias("embedding"), "label")
    hot = own.where("vec_id = 1").select(F.col("embedding").alias("h"), F.col("label").alias("hot_label"), F.lit(0).alias("even"))
    around = own.where("vec_id % 2 = 0").withColumn("even", F.lit(0)).join(F.broadcast(hot), "even").select(
        (F.col("vec_id") + 2_000_000_000).alias("vec_id"), moved("h", 7, 11, 1000.0).alias("embedding"), F.col("hot_label").alias("label")
    )
    return hnsw_dedup.find(own.union(near).union(around)).select("vec_id", "n_links", "component_id", "kept")


@query("op10_personal_data")
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bootstrapped_pii.digest(bootstrapped_pii.scan(table(spark, sf_dir, "documents")))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    doc_id > min(doc_id) OVER (PARTITION BY t) AS repeated FROM d
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(repeated, false)::INT AS mask,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM w LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, mask, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(name, bit)
), o AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), s AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & (own | before) = 0 THEN docs ELSE 0 END) AS kept,
    sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN docs ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN docs ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN docs ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""


@query("op11_filter_audit", OP11_SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT i, i AS c, 0 AS step FROM range(256) AS r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM tab WHERE step < 8
), lut AS (
  SELECT list(c ORDER BY i) AS t FROM tab WHERE step = 8
), texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), item_id, text FROM benchmark
), words AS (
  SELECT kind, row, unnest(list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS word
  FROM texts
), bytes AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)
), hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, lut
), found AS (
  SELECT kind, row, bucket, count(*) AS n FROM words JOIN hashed USING (word) GROUP BY ALL
), sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 't'), 0)::DOUBLE AS t FROM found GROUP BY bucket
), totals AS (
  SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM sums, totals
), weighed AS (
  SELECT row, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n)::DOUBLE)::BIGINT AS weight
  FROM found JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY row
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weighed USING (row) WHERE kind = 'd'
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS able FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= (10 * able) // 100 THEN place END AS rank FROM placed
"""


@query("op12_target_resample", OP12_SQL)
def op12_target_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op13_exact_topk", OP13_SQL)
def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_threshold.search(table(spark, sf_dir, "embeddings"))
