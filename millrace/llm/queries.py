"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import chat, decontam, hardneg, interactions, langid, licenses, neardup, packing, pii, quality, quality_fm, repeats, sharding
from millrace.llm.registry import ORACLES, QUERIES, documents, query

__all__ = ["ORACLES", "QUERIES"]

# The key of the registered query; a real job hands in its own.
PII_KEY = "example key"


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_nnls_packing")
def op1(spark, sf_dir):
    cut = packing.pieces(documents(spark, sf_dir), word_tokenizer())
    digests = cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(digests)


@query("op2_license_scan", r"""
    WITH w AS (
      SELECT doc_id, string_split(trim(regexp_replace(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS words FROM documents),
    x AS (SELECT doc_id, CASE WHEN words = [''] THEN [] ELSE words END AS words FROM w),
    p AS (SELECT * FROM (VALUES (['mit', 'license'], 'mit', true), (['apache', 'license'], 'apache', true),
                                (['general', 'public', 'license'], 'gpl', true), (['cc', 'by', 'nc'], 'cc-by-nc', false),
                                (['creative', 'commons', 'attribution'], 'cc-by', false),
                                (['mozilla', 'public', 'license'], 'mpl', false), (['bsd', 'license'], 'bsd', false),
                                (['hereby', 'granted', 'free'], 'mit', false), (['binary', 'forms'], 'bsd', false),
                                (['gnu', 'lesser', 'general', 'public'], 'lgpl', false),
                                (['gnu', 'affero', 'general', 'public'], 'agpl', false)) v(phrase, label, base)),
    hits AS (SELECT doc_id, label, base, i - 1 AS place
             FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM x
                   WHERE list_has_any(words, ['license', 'nc', 'attribution', 'hereby', 'forms', 'gnu'])) y, p
             WHERE list_slice(words, i, i + len(phrase) - 1) = phrase),
    found AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(place) FILTER (base) AS first_word,
                     max(place) FILTER (base) AS last_word,
                     string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                     string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM hits GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           CASE WHEN labels IS NULL THEN 0.0 ELSE 1.0 END AS score
    FROM x LEFT JOIN found USING (doc_id)""")
def op2(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir))


@query("op4_rule_ledger", r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
    g AS (SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS gram
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
    r AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words
          FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place
                FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS often FROM g) WHERE often > 1) GROUP BY doc_id),
    m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
                 CAST(len(t) - len(regexp_replace(t, '[^\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(len(lines) - list_unique(lines) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                 CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(regexp_replace(t, '\P{L}+', '', 'g')) AS BIGINT) AS n_letters
          FROM w LEFT JOIN r USING (doc_id)),
    b AS (SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (5 * n_symbols > 4 * n_words)::INT
                 + 8 * (n_lines >= 4 AND 10 * n_dup_lines > 5 * n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT
                 + 32 * (word_chars > 25 * n_words)::INT + 64 * (10 * n_letters < 4 * word_chars)::INT AS BIGINT) AS failed_bits FROM m)
    SELECT *, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, 'v2-strict' AS policy FROM b""")
def op4(spark, sf_dir):
    rows = quality.ledger(documents(spark, sf_dir))
    base_failed = F.col("failed_bits").bitwiseAND(F.lit(quality.mask(quality.BASE))) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & quality.keeps()).alias("kept"),
        "n_lines", "n_letters", "failed_bits", F.lit(quality.CURRENT).alias("policy"),
    )


@query("op7_language_id")
def op7(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", langid.held_out().alias("held_out"), "language.*")


@query("op8_two_pass_shuffle")
def op8(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return sharding.shuffle_into_shards(docs).select(
        "doc.doc_id",
        (F.coalesce(F.octet_length("doc.text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("doc.text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_feistel_pseudonyms")
def op9(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    done = pii.pseudonymise(docs, PII_KEY)
    return done.select("doc_id", "text", F.aggregate(F.map_values("pii_found"), F.lit(0), lambda a, n: a + n).alias("n_found"),
                       *[F.coalesce(F.element_at("pii_found", k), F.lit(0)).alias(f"n_{k}") for k in pii.KINDS])


@query("op10_transcript_roles", """
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS turn, role,
           CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS n_lines, coalesce(text, '') AS text,
           '<|' || role || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' AS rendered
    FROM conversations""")
def op10(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns = chat.transcript(rows, "conv_id", "turn", "role", "text")
    return chat.parse(turns, chat.fit(turns)).withColumnRenamed("conv", "conv_id")


@query("op6_bwt_repeats")
def op6(spark, sf_dir):
    return repeats.clean(documents(spark, sf_dir))


# All pairs by their common shingles; banding finds those at 0.8 or more with a recall of 0.9995.
@query("op5_minhash_join", r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS words FROM documents),
    n AS (SELECT doc_id, words, array_to_string(words, ' ') AS node FROM w),
    rep AS (SELECT node, min(doc_id) AS id, count(*) - 1 AS n_copies, any_value(words) AS words FROM n WHERE node <> '' GROUP BY node),
    s AS (SELECT DISTINCT id, array_to_string(list_slice(words, i, i + 4), ' ') AS g
          FROM (SELECT id, words, unnest(range(1, greatest(1, len(words) - 4) + 1)) AS i FROM rep)),
    z AS (SELECT id, count(*) AS c FROM s GROUP BY id),
    p AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.id < b.id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN z x ON x.id = a JOIN z y ON y.id = b WHERE 5 * k >= 4 * (x.c + y.c - k)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    reach AS (SELECT id, id AS root FROM rep UNION SELECT e.b, reach.root FROM reach JOIN e ON e.a = reach.id),
    cls AS (SELECT id, min(root) AS class_id FROM reach GROUP BY id),
    deg AS (SELECT a AS id, count(*) AS n_links FROM e GROUP BY a)
    SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0) AS n_links, coalesce(n_copies, 0) AS n_copies
    FROM n LEFT JOIN rep USING (node) LEFT JOIN cls ON cls.id = rep.id LEFT JOIN deg ON deg.id = rep.id""")
def op5(spark, sf_dir):
    return neardup.classes(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "class_id", "n_links", "n_copies")


@query("op3_template_decontamination")
def op3(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = decontam.contaminated(documents(spark, sf_dir), items)
    return hits.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("shared").cast("long").alias("n_shared"),
                       "share", "slots", "changed", "kind")


@query("op12_filter_audit", r"""
    WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                      min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
    marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    c AS (SELECT part, (len(words) < 200)::INT + 2 * (100 * list_unique(words) < 50 * len(words))::INT
                 + 4 * (100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * len(t))::INT
                 + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > first_id, false)::INT AS bits,
                 coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
          FROM w LEFT JOIN marks USING (doc_id)),
    cells AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM c GROUP BY part, bits),
    one AS (SELECT * FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(f)),
    orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM one a, one b, one c, one d, one e
               WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
    steps AS (SELECT filter_order, CAST(step AS INT) AS step, 1 << (ascii(filter_order[step]) - 65) AS own,
                     CAST(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))) AS BIGINT) AS b
              FROM orders, range(1, 6) r(step)),
    found AS (SELECT part, filter_order, step,
                     sum(CASE WHEN bits & (coalesce(b, 0) | own) = 0 THEN n ELSE 0 END) AS kept,
                     sum(CASE WHEN bits & coalesce(b, 0) = 0 AND bits & own <> 0 THEN n ELSE 0 END) AS removed,
                     sum(CASE WHEN bits & coalesce(b, 0) <> 0 AND bits & own <> 0 THEN n ELSE 0 END) AS redundant,
                     sum(CASE WHEN bits = own THEN n ELSE 0 END) AS unique_fails,
                     sum(CASE WHEN bits & coalesce(b, 0) = 0 AND bits & own <> 0 THEN good ELSE 0 END) AS good_lost,
                     sum(CASE WHEN bits & coalesce(b, 0) = 0 AND bits & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
              FROM cells, steps GROUP BY ALL)
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
           CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM found""")
def op12(spark, sf_dir):
    return interactions.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op13_hard_negatives", """
    WITH q AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
               FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                      CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
               FROM q a, q b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    positives AS (SELECT * FROM scores WHERE same
                  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INT) AS rank
    FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
    QUALIFY rank <= 3""")
def op13(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(rows.withColumn("label", shifted))


@query("op11_factorisation_machine")
def op11(spark, sf_dir):
    docs = documents(spark, sf_dir)
    told = quality_fm.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), result="score")
    return told.select("doc_id", quality_fm.held_out().alias("held_out"), "score",
                       (F.col("score") >= quality_fm.THRESHOLD).cast("int").alias("predicted"))
