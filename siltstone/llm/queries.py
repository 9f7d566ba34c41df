"""The registered queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op6_repair_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.repair_store import grammar_round_trip

    return grammar_round_trip(_read(spark, sf_dir, "documents"), word_bpe())


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.token_counts import count_tokens

    return count_tokens(_read(spark, sf_dir, "documents"), word_bpe())


def op2_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.packing import pack_documents

    return pack_documents(_read(spark, sf_dir, "documents"), word_bpe()).drop("ids")


def op3_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.decontamination import benchmark_leaks

    return benchmark_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.line_frequency import line_quality

    return line_quality(_read(spark, sf_dir, "documents"))


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from siltstone.llm.sharding import shard_by_bytes

    found = shard_by_bytes(_read(spark, sf_dir, "documents"))
    return found.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op7_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.toxicity import score_documents

    return score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.arc_to_warc import archive_round_trip

    return archive_round_trip(_read(spark, sf_dir, "pages"))


def op8_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.simhash_trie import hex_fingerprint, near_duplicates

    found = near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint(found["fp"]).alias("fingerprint"), "component_id")


def op10_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.pii import find_personal_data

    return find_personal_data(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_separator_scan": op1_separator_scan,
    "op2_bm25_packing": op2_bm25_packing,
    "op3_simhash_windows": op3_simhash_windows,
    "op4_line_frequency": op4_line_frequency,
    "op5_byte_shards": op5_byte_shards,
    "op7_clause_grammar": op7_clause_grammar,
    "op8_simhash_trie": op8_simhash_trie,
    "op9_arc_to_warc": op9_arc_to_warc,
    "op10_crf_pii": op10_crf_pii,
    "op6_repair_grammar": op6_repair_grammar,
}

ORACLE: dict[str, str] = {}

ORACLE["op4_line_frequency"] = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
t AS (SELECT doc_id, ws, list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS g FROM w),
u AS (SELECT doc_id, unnest(g) AS g, unnest(range(1, len(g) + 1)) AS i FROM t),
c AS (SELECT doc_id, g FROM u GROUP BY doc_id, g HAVING count(*) > 1),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT u.doc_id, u.i, unnest([0, 1, 2]) AS k FROM u JOIN c USING (doc_id, g)) GROUP BY doc_id),
l AS (SELECT doc_id, source, unnest(list_transform(ls, lambda x: array_to_string(regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' '))) AS line FROM w),
f AS (SELECT source, line FROM l GROUP BY source, line HAVING count(DISTINCT doc_id) > 20),
r AS (SELECT doc_id, sum(len(string_split(line, ' '))) AS n FROM l JOIN f USING (source, line) GROUP BY doc_id),
b AS (SELECT w.doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words, coalesce(r.n, 0) AS removed_words
      FROM w LEFT JOIN p USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT 100 * removed_words > 50 * n_words AS kept, removed_words::BIGINT AS removed_words
FROM b"""

ORACLE["op5_byte_shards"] = r"""
WITH RECURSIVE k(i, c, j) AS (SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) t(i) UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, j + 1 FROM k WHERE j < 8),
t AS (SELECT list(c ORDER BY i) AS crc FROM k WHERE j = 8),
d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
e AS (SELECT doc_id, octet_length(b) + 1 AS size,
  list_reduce(list_transform(regexp_extract_all(hex(b), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda c, x: xor(c // 256, crc[xor(c % 256, x) + 1]), 4294967295) AS c FROM d, t),
s AS (SELECT doc_id, size, xor(c, 4294967295) AS text_crc32, coalesce(sum(size) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(size) OVER () AS total FROM e),
h AS (SELECT *, least(15, (2 * before + size) * 16 // (2 * total))::INT AS shard FROM s)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, shard, (row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1)::BIGINT AS slot, 'bytes' AS law, NULL::INT AS grown_shard FROM h"""

ORACLE["op9_arc_to_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM m"""
