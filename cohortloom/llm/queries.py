"""Registered queries of the corpus operators and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import (
    byte_bpe, centroid_clustering, code_compression, decontaminate, exact_dedup, html_text, language_id, sharding, simhash_dedup,
    token_counts, token_files, toxicity, url_filter,
)
from cohortloom.llm.common import documents
from cohortloom.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(language_id.fold("doc_id", 3) == 1, F.lit(False))
    model = language_id.fit(docs, ~held_out)
    return language_id.identify(docs, model).withColumn("held_out", held_out)


RANKS = "byte_bpe_multi_50k.tiktoken"


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Encodes and decodes every text; ids and bytes as digests."""
    return byte_bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Fitted on the labels of the documents that aren't held out."""
    learn = F.coalesce(language_id.fold("doc_id", 4) != 2, F.lit(False))
    return toxicity.fit(docs, documents(spark, sf_dir, "labels"), learn)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = toxicity.score_texts(docs, toxicity_model(spark, docs, sf_dir))
    held_out = F.coalesce(language_id.fold("doc_id", 4) == 2, F.lit(False))
    return scored.withColumn("held_out", held_out).withColumn(
        "predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(documents(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(documents(spark, sf_dir, "pages"), url_filter.RULES)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    token_files.write_ids(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_ids(spark, folder).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_records(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "v_slot",
    )


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", simhash_dedup.hex_print().alias("fingerprint"), F.col("component").alias("component_id"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, places = centroid_clustering.cluster(documents(spark, sf_dir, "embeddings"))
    return centroid_clustering.with_inertia(found, places).withColumnRenamed("id", "vec_id")


def op12_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = code_compression.compress(documents(spark, sf_dir, "embeddings"))
    return code_compression.with_label_error(coded).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(code_compression.codebook_digest(books)).alias("codebooks_sha256"))


PIECES = "piece_bpe_32k.model"


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(PIECES))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # its stages use this module's queries

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_decontamination": op3_decontamination,
    "op4_toxicity": op4_toxicity,
    "op5_html_extraction": op5_html_extraction,
    "op6_url_filters": op6_url_filters,
    "op7_token_files": op7_token_files,
    "op8_sharding": op8_sharding,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_code_compression": op12_code_compression,
    "op13_token_counts": op13_token_counts,
    "pipeline": pipeline,
}

# Integer vectors, one row per component, and floor(s / n) of integers.
_WHOLE = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_FLOOR = "(s - ((s % n) + n) % n) // n"


def _clustering_sql(k: int = 40, rounds: int = 5) -> str:
    """Plain k-means of the same contract: all distances in every round."""
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {_WHOLE}),
points AS MATERIALIZED (SELECT vec_id, generate_subscripts(v, 1) AS p, unnest(v) AS x FROM kept),
first_rows AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM kept QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, generate_subscripts(v, 1) AS p, unnest(v) AS x FROM first_rows)"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, min({{'d': d, 'c': c}}) AS m
  FROM (SELECT vec_id, c, sum((a.x - b.x) * (a.x - b.x))::BIGINT AS d FROM points a JOIN c{i} b USING (p) GROUP BY vec_id, c)
  GROUP BY vec_id)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c, p, coalesce({_FLOOR}, x) AS x FROM c{i} LEFT JOIN (
    SELECT m.c AS c, p, sum(x)::BIGINT AS s, count(*) AS n FROM points JOIN a{i} USING (vec_id) GROUP BY m.c, p) USING (c, p))""")
    return ",".join(steps) + f"""
SELECT vec_id, m.c::INT AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia,
       (sum(m.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY p)) AS centroid_sha256 FROM c{rounds} GROUP BY c) z ON z.c = m.c"""


def _compression_sql(entries: int = 16, rounds: int = 6) -> str:
    """Plain product quantisation of the same contract: all entries for every part."""
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {_WHOLE}),
flat AS (SELECT vec_id, generate_subscripts(v, 1) - 1 AS k, unnest(v) AS x FROM kept),
points AS MATERIALIZED (SELECT vec_id, k // 8 AS part, k % 8 AS p, x FROM flat),
first_rows AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {entries}),
c0 AS MATERIALIZED (SELECT part, e, p, x FROM points JOIN first_rows USING (vec_id))"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, part, min({{'d': d, 'e': e}}) AS m
  FROM (SELECT vec_id, part, e, sum((a.x - b.x) * (a.x - b.x))::BIGINT AS d
        FROM points a JOIN c{i} b USING (part, p) GROUP BY vec_id, part, e)
  GROUP BY vec_id, part)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT part, e, p, coalesce({_FLOOR}, x) AS x FROM c{i} LEFT JOIN (
    SELECT part, m.e AS e, p, sum(x)::BIGINT AS s, count(*) AS n
    FROM points JOIN a{i} USING (vec_id, part) GROUP BY part, m.e, p) USING (part, e, p))""")
    return ",".join(steps) + f""",
coded AS (
  SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, e, p)) FROM c{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


SQL: dict[str, str] = {
    "op11_centroid_clustering": _clustering_sql(),
    "op12_code_compression": _compression_sql(),
    "op10_exact_dedup": r"""
WITH normal AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM normal WINDOW same AS (PARTITION BY text_sha256)""",
}
