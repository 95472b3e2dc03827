"""One query per operator over its whole table, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import decontaminate, embedding_dup, hard_negatives, html_text, langid, near_dup, packing, periodic, quality, sharding, substring, token_counts, toxicity
from keelson.llm.common import read

SHARDS = 24
TOKEN_LIMIT = 4096


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, base: str) -> DataFrame:
    """Per document: classifier evidence, host and path posteriors, posterior quality and decision."""
    docs = read(spark, base, "documents")
    model = quality.fit_classifier(docs, read(spark, base, "labels"))
    return quality.score_quality(docs, model, keep=["doc_id"]).select(
        "doc_id", F.col("_evidence").alias("evidence"), F.col("_host_post").alias("host_posterior"), F.col("_path_post").alias("path_posterior"),
        F.col("_quality").alias("quality"), F.col("_good").alias("kept"))


def op2_substring_dedup(spark: SparkSession, base: str) -> DataFrame:
    found = substring.substring_dedup(read(spark, base, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.sha2(F.col("_kept"), 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, base: str) -> DataFrame:
    found = decontaminate.find_contamination(read(spark, base, "documents"), read(spark, base, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"), decontaminate.contaminated(F.col("_n_hit"), F.col("_n_words")).alias("contaminated"))


def op4_toxicity(spark: SparkSession, base: str) -> DataFrame:
    docs = read(spark, base, "documents")
    model = toxicity.fit_model(docs, read(spark, base, "labels"))
    return toxicity.score_toxicity(docs, model, keep=["doc_id"]).select(
        "doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_packing(spark: SparkSession, base: str) -> DataFrame:
    pieces = packing.pack_documents(read(spark, base, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_near_dup(spark: SparkSession, base: str) -> DataFrame:
    return near_dup.link_documents(read(spark, base, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op7_sharding(spark: SparkSession, base: str) -> DataFrame:
    rows = sharding.shard_rows(read(spark, base, "documents"), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_html_text(spark: SparkSession, base: str) -> DataFrame:
    found = html_text.extract_text(read(spark, base, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))


def op9_embedding_dup(spark: SparkSession, base: str) -> DataFrame:
    return embedding_dup.link_vectors(read(spark, base, "embeddings"))


def op10_token_counts(spark: SparkSession, base: str) -> DataFrame:
    docs = read(spark, base, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    found = token_counts.count_tokens(docs, tokenizer_file("piece_bpe_32k.model"), keep=["doc_id", "n_bytes"])
    return found.select("doc_id", "n_bytes", F.col("_n_tokens").alias("n_tokens"), (F.col("_n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op11_periodic_runs(spark: SparkSession, base: str) -> DataFrame:
    docs = read(spark, base, "documents").select("doc_id", "text")
    docs = docs.withColumn("text", periodic.periodic_tail(F.col("doc_id"), F.col("text")))
    found = periodic.find_runs(docs, keep=["doc_id"])
    longest = F.array_max(F.transform("_runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    found = found.select("doc_id", "_runs", "_kept", longest.alias("best"))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    length, period = F.col("best.length"), -F.col("best.short")
    return found.select("doc_id", F.size("_runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"), F.sha2(F.array_join(F.transform("_runs", line), ""), 256).alias("runs_sha256"), F.sha2(F.col("_kept"), 256).alias("collapsed_sha256"))


def op12_language(spark: SparkSession, base: str) -> DataFrame:
    docs = read(spark, base, "documents")
    trees = langid.fit_trees(docs.where(F.col("doc_id").isNotNull() & ~langid.is_held_out(F.col("doc_id"))))
    found = langid.identify(docs.select("doc_id", "text"), trees, keep=["doc_id"])
    return found.select("doc_id", langid.is_held_out(F.col("doc_id")).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))


def op13_hard_negatives(spark: SparkSession, base: str) -> DataFrame:
    vectors = read(spark, base, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.select("vec_id", "embedding", shifted.alias("label")), F.col("id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_quality, op2_substring_dedup, op3_decontamination, op4_toxicity, op5_packing, op6_near_dup, op7_sharding, op8_html_text, op9_embedding_dup, op10_token_counts,
                                op11_periodic_runs, op12_language, op13_hard_negatives)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_SQL_SUBSTRING = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
spot AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS s FROM spot),
lead_doc AS (SELECT s, min(doc_id) AS d FROM win GROUP BY s),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN lead_doc USING (s) WHERE d < doc_id),
one AS (SELECT doc_id, words[p] AS word, p FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM w)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM one ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id) h USING (doc_id)
"""

_ALNUM = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_SQL_DECONTAMINATION = f"""
WITH w AS (SELECT doc_id, {_ALNUM.format('text')} AS words FROM documents),
b AS (SELECT item_id, {_ALNUM.format('text')} AS words FROM benchmark),
long_at AS (SELECT item_id, words, unnest(range(1, len(words) - 11)) AS i FROM b WHERE len(words) >= 13),
pat AS (SELECT DISTINCT item_id, array_to_string(words[i:i + 12], ' ') AS s, 13 AS n FROM long_at
        UNION SELECT DISTINCT item_id, array_to_string(words, ' '), len(words) FROM b WHERE len(words) BETWEEN 1 AND 12),
sizes AS (SELECT DISTINCT n FROM pat),
spot AS (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, sizes WHERE len(words) >= n),
occ AS (SELECT doc_id, i, n, item_id FROM (SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS s FROM spot) JOIN pat USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(c, ',' ORDER BY c) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS c FROM occ) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_LOWER = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

_SQL_NEAR_DUP = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_LOWER} AS words FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 2)) AS i FROM w WHERE len(words) >= 4)
       UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
same AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM same JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
least AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id, w.doc_id = least(w.doc_id, coalesce(m, w.doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least ON x = w.doc_id
"""

_SQL_SHARDING = f"""
WITH RECURSIVE walk AS (
  SELECT doc_id, CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE doc_id::HUGEINT END AS k, -1::BIGINT AS b, 0::BIGINT AS j FROM documents
  UNION ALL
  SELECT doc_id, k2, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT doc_id, j, ((k * (2862933555777941757::HUGEINT % 4294967296) + ((k * (2862933555777941757::HUGEINT // 4294967296)) % 4294967296) * 4294967296 + 1) % 18446744073709551616) AS k2
        FROM walk WHERE j < {SHARDS})),
home AS (SELECT doc_id, b AS shard, CASE WHEN j = {SHARDS} THEN {SHARDS} ELSE b END AS grown FROM walk WHERE j >= {SHARDS})
SELECT doc_id, (strlen(coalesce(text, '')) + 8)::BIGINT AS size, NULL AS text_crc32, 'key' AS law, shard::INT AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1)::BIGINT AS slot, grown::INT AS grown_shard
FROM documents JOIN home USING (doc_id)
"""

_SQL_EMBEDDING = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
least AS (SELECT x, min(y) AS m FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM v LEFT JOIN least ON least.x = vec_id LEFT JOIN n ON n.x = vec_id
"""

_SQL_HARD_NEGATIVES = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (SELECT a.id AS anchor_id, a.label AS own, v.id, v.label, list_inner_product(a.e, v.e)::BIGINT AS score FROM v a JOIN v ON a.id <> v.id AND a.id % 50 = 0),
pos AS (SELECT anchor_id, own, id AS positive_id, score AS p FROM pair WHERE own = label QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
neg AS (SELECT anchor_id, positive_id, id AS negative_id, p AS positive_score, score AS negative_score,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
        FROM pos JOIN pair USING (anchor_id, own) WHERE label <> own AND 50 * p <= 100 * score AND 100 * score <= 95 * p)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""

# The checksum of sharding has no DuckDB function, so its SQL serves the tests without that column.
SHARDING_SQL = _SQL_SHARDING

ORACLES = {"op2_substring_dedup": _SQL_SUBSTRING, "op3_decontamination": _SQL_DECONTAMINATION, "op6_near_dup": _SQL_NEAR_DUP, "op9_embedding_dup": _SQL_EMBEDDING,
           "op13_hard_negatives": _SQL_HARD_NEGATIVES}
