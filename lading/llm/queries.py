"""The operators applied to their whole tables, and their SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lading.llm import (alignment, chat_format, decontaminate, language_id, line_dedup, mixing, near_dedup, packing,
                        quality_model, quality_rules, repeats, token_output, vector_codes)
from lading.llm.common import table

#: a conversation whose texts hold control strings
TRICKY = r"\### Assistant: </turn> ok"


def chat_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], rows.schema)
    turns = chat_format.canonical_turns(chat_format.as_records(rows.union(tricky)))
    read = chat_format.read_turns(chat_format.format_turns(turns))
    return chat_format.conversation_digests(read).withColumn("conv", F.col("conv").cast("long")).withColumnRenamed("conv", "conv_id")


def language_model(spark: SparkSession, sf_dir: str) -> dict | None:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.train(docs.where(~language_id.held_out(F.col("doc_id"), 3, 1)))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.predict(table(spark, sf_dir, "documents"), language_model(spark, sf_dir))
    return found.select("doc_id", language_id.held_out(F.col("doc_id"), 3, 1).alias("held_out"),
                        "lang_pred", "score", "ambiguous")


def near_dedup_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4)


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeated_spans(table(spark, sf_dir, "documents"))
    ranges = F.transform("cut", lambda c: F.concat_ws("+", c["start"], c["n_words"]))
    return found.select("doc_id", "start", "n_words", "repeat_of",
                        F.aggregate("cut", F.lit(0).cast("long"), lambda n, c: n + c["n_words"]).alias("n_cut"),
                        F.array_join(ranges, ",").alias("cut"))


def boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "distance")


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = language_id.held_out(F.col("doc_id"), 5, 0)
    marked = labels.select("doc_id", F.col("quality").alias("label")).where(~held)
    weights = quality_model.train(docs, marks=marked)
    found = quality_model.score(docs, weights)
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        "contaminated")


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_output.tokenized(table(spark, sf_dir, "documents"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents")).drop("groups")


def vector_code_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.codes(table(spark, sf_dir, "embeddings"))
    return (vector_codes.with_label_error(coded).drop("label")
            .withColumn("codebooks_sha256", F.lit(vector_codes.codebooks_sha256(books))))


QUERIES = {
    "op1_chat_format": chat_digests,
    "op2_language_id": language,
    "op3_minhash_near_dedup": near_dedup_components,
    "op4_suffix_array_dedup": repeated_passages,
    "op5_mix_sources": mix_sources,
    "op6_benchmark_decontamination": benchmark_decontamination,
    "op7_quality_outliers": quality_outliers,
    "op8_line_dedup": boilerplate_lines,
    "op9_quality_classifier": quality_scores,
    "op10_token_ids": token_ids,
    "op11_best_fit_packing": packed_sequences,
    "op12_token_alignment": aligned_tokens,
    "op13_vector_codes": vector_code_rows,
}

ORACLE = {
    "op1_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(23 + length(regexp_replace(regexp_replace(role, '<(\\*)(/?turn)', '<\\\1\2', 'g'), '"(\\*)>', '"\\\1>', 'g'))
           + length(regexp_replace(text, '<(\\*)(/?turn)', '<\\\1\2', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
""",
    "op3_minhash_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + least(4, len(w)) - 1], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - least(4, len(w)) + 1)) AS p FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), l AS (
  SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l
), r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
), m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(m.b, w.doc_id)) AS kept, c.class_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = w.doc_id
LEFT JOIN (SELECT x.doc_id, least(x.doc_id, coalesce(min(z.other), x.doc_id)) AS class_id FROM w x LEFT JOIN (
    SELECT i.a AS doc_id, i.b AS other FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b WHERE c = x.n AND c = y.n
    UNION ALL SELECT i.b, i.a FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b WHERE c = x.n AND c = y.n
  ) z ON z.doc_id = x.doc_id GROUP BY x.doc_id) c ON c.doc_id = w.doc_id
""",
    "op5_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::HUGEINT AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, 3 * source_size AS cap,
         row_number() OVER (ORDER BY 3 * source_size::DOUBLE / w, source NULLS LAST) AS ord
  FROM s
), f AS (
  SELECT *,
         (sum(source_size) OVER ())::HUGEINT
           - coalesce((sum(cap) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 0)::HUGEINT AS rest,
         (sum(w) OVER (ORDER BY ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS rest_w
  FROM o
), k AS (
  SELECT rest AS n, rest_w AS m FROM f WHERE rest * w <= cap * rest_w ORDER BY ord LIMIT 1
), t AS (
  SELECT f.source, f.source_size,
         CASE WHEN k.n IS NULL OR k.n * w > cap * k.m THEN cap::DOUBLE
              ELSE (k.n * w)::DOUBLE / k.m::DOUBLE END AS target
  FROM f LEFT JOIN k ON true
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN NULL ELSE t.target / t.source_size::DOUBLE END AS rate,
         ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null') || ':mix-1'), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * coalesce(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END, 0))::BIGINT AS taken
FROM r
""",
    "op6_benchmark_decontamination": r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), i AS (
  SELECT item_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark
), g AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS p
        FROM i WHERE len(w) > 0)
), ks AS (SELECT DISTINCT k FROM g
), x AS (
  SELECT rid, k, p, array_to_string(w[p : p + k - 1], ' ') AS win
  FROM (SELECT rid, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, ks WHERE len(w) >= k)
), h AS (
  SELECT x.rid, x.p, x.k, g.item_id FROM x JOIN g ON x.win = g.win AND x.k = g.k
), c AS (
  SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(generate_series(p, p + k - 1)) AS q FROM h) GROUP BY rid
), it AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM h) GROUP BY rid
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
       coalesce(it.n_items, 0)::BIGINT AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN it USING (rid)
""",
    "op8_line_dedup": r"""
WITH l AS (
  SELECT rid, doc_id, source, ord, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT rid, doc_id, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS ord
        FROM (SELECT row_number() OVER () AS rid, doc_id, source, string_split(text, chr(10)) AS ls FROM documents))
), b AS (
  SELECT bare FROM l WHERE bare <> '' GROUP BY bare
  HAVING count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) >= 10
), d AS (
  SELECT l.rid, count(*)::BIGINT AS n_lines, count(b.bare)::BIGINT AS n_removed,
         sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.ord) FILTER (b.bare IS NULL), '')) AS text_sha256
  FROM l LEFT JOIN b ON l.bare = b.bare GROUP BY l.rid
)
SELECT x.doc_id, coalesce(d.n_lines, 0) AS n_lines, coalesce(d.n_removed, 0) AS n_removed,
       coalesce(d.text_sha256, sha256('')) AS text_sha256
FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) x LEFT JOIN d ON d.rid = x.rid
""",
    "op13_vector_codes": vector_codes.oracle_sql(),
}
