"""The registered queries of the operators: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import crc_mod, word_count, written



def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_mixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.language_id import detect, fit
    docs = _table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = fit(docs.where(~held_out))
    found = detect(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.toxicity import fit, score
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    net = fit(docs, labels.where(~held_out))
    return score(docs.select("doc_id", "text"), net).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_bounded_space_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from mercato.llm.packing import pack
    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                  ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.suffix_dedup import remove_repeats
    left = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.mixing import mix
    docs = _table(spark, sf_dir, "documents")
    sized = written(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", F.xxhash64("text").alias("text_hash"),
                                word_count(F.col("text")).alias("size")), "sizes")
    mixed, sources = mix(sized, place_by=("doc_id", "text_hash"))
    taken = mixed.groupBy("row").agg(F.sum("size").alias("taken"), F.sort_array(F.collect_list("shard")).alias("shards"))  # 3 draws at most
    each = sized.join(F.broadcast(sources.withColumnRenamed("source", "_source")), F.col("source").eqNullSafe(F.col("_source")))
    return (each.join(taken, "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                    F.coalesce("shards", F.array().cast("array<int>")).alias("shards")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.license_scan import scan
    return scan(_table(spark, sf_dir, "documents"))


def op7_naive_bayes_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.quality_classifier import fit, score
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = fit(docs, labels.where(~held_out))
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.hamming_search import top_k
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(rows, rows.where("vec_id % 100 = 0"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.jaccard_join import jaccard_components
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.quality_rules import fit, rules
    docs = _table(spark, sf_dir, "documents")
    out = rules(docs, fit(docs, _table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "ratio")


def op11_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.exact_whitening import whiten
    return whiten(_table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from mercato.llm.token_alignment import align_documents
    found, _ = align_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return found


def op13_benchmark_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.decontamination import contaminated
    found = contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_mixtures": op1_language_mixtures,
    "op2_recurrent_toxicity": op2_recurrent_toxicity,
    "op3_bounded_space_packing": op3_bounded_space_packing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_source_mix": op5_source_mix,
    "op6_license_scan": op6_license_scan,
    "op7_naive_bayes_margin": op7_naive_bayes_margin,
    "op8_hamming_top_k": op8_hamming_top_k,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_exact_whitening": op11_exact_whitening,
    "op12_token_alignment": op12_token_alignment,
    "op13_benchmark_index": op13_benchmark_index,
}

def _license_sql() -> str:
    """Every text against every notice, by exact word shingles."""
    from mercato.llm.license_scan import LOWER, NOTICES, UPPER, template_words
    notices = ", ".join("('{}', [{}])".format(k, ", ".join("'" + w.replace("'", "''") + "'" for w in template_words(v))) for k, v in NOTICES.items())
    lists = "[array_to_string(w[i:i + size - 1], ' ') for i in range(1, CAST(greatest(len(w) - size + 2, 1) AS BIGINT))]"
    return f"""
WITH notices(license, w) AS (VALUES {notices}),
wanted AS (SELECT license, size, unnest(list_distinct({lists})) AS s FROM (SELECT license, w, least(5, len(w)) AS size FROM notices)),
held AS (SELECT doc_id, size, unnest(list_distinct({lists})) AS s
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
       (SELECT DISTINCT size FROM wanted)),
shared AS (SELECT doc_id, license, COUNT(DISTINCT s) AS n_shared FROM held JOIN wanted USING (size, s) GROUP BY 1, 2),
number AS (SELECT license, COUNT(*) AS t FROM wanted GROUP BY 1)
SELECT doc_id, license, n_shared, CAST(n_shared AS DOUBLE) / t AS containment
FROM shared JOIN number USING (license) WHERE 100 * n_shared >= 75 * t"""


#: All windows of a document, as text, against the items' windows of the same number of words.
_LEAK_SQL = r"""
WITH sized AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
test AS (SELECT item_id, w, CAST(least(10, len(w)) AS BIGINT) AS k FROM (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark) WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item_id, k, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, CAST(len(w) - k + 2 AS BIGINT))]) AS s FROM test),
places AS (SELECT r, k, unnest(range(1, CAST(greatest(len(w) - k + 2, 1) AS BIGINT))) AS i,
    unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, CAST(greatest(len(w) - k + 2, 1) AS BIGINT))]) AS s
  FROM sized, (SELECT DISTINCT k FROM test) WHERE len(w) > 0),
found AS (SELECT r, i, k, item_id FROM places JOIN phrases USING (k, s)),
hit AS (SELECT r, COUNT(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM found)) GROUP BY r),
items AS (SELECT r, COUNT(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS named FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(named, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM sized LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""

#: DuckDB SQL where SQL expresses the operator.
ORACLE_SQL: dict[str, str] = {
    "op6_license_scan": _license_sql(),
    "op8_hamming_top_k": """
WITH pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id AS id,
         CAST(list_sum([CASE WHEN (coalesce(q.embedding[i], 0) > 0) <> (coalesce(r.embedding[i], 0) > 0) THEN 1 ELSE 0 END for i in range(1, 65)]) AS INTEGER) AS distance
  FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id
  WHERE q.vec_id % 100 = 0 AND q.embedding IS NOT NULL AND r.embedding IS NOT NULL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank, id, distance
FROM pairs QUALIFY rank <= 10""",
    "op13_benchmark_index": _LEAK_SQL,
}
