"""The registered queries of the subpackage: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bytebpe, cotrain, decontaminate, divergence, htmlmain, langid, linequality, neardup, phrases, reshard, substring, tokencount, vectordup


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.round_trip_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlmain.report(_table(spark, sf_dir, "pages"))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_report(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshard.plan(spark, f"{sf_dir}/documents.parquet")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.report(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linequality.judged(_table(spark, sf_dir, "documents"))


def op11_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectordup.linked(_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_decontaminate, op2_language_id, op3_byte_bpe, op4_near_duplicates, op5_main_text, op6_repeated_passages, op7_quality_classifier, op8_reshard, op9_token_counts, op10_line_quality, op11_vector_duplicates, op12_collocations, op13_source_divergence)}


#: DuckDB SQL for the same rows, where SQL can express the method's results.
ORACLES: dict[str, str] = {
    "op1_decontaminate": r"""
WITH d AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
spots AS (SELECT item_id, w, least(len(w), 10) AS k, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS h FROM spots),
sizes AS (SELECT DISTINCT k FROM win),
s AS (SELECT doc_id, k, w, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d JOIN sizes ON len(w) >= k),
occ AS (SELECT s.doc_id, s.p, s.k, win.item_id FROM (SELECT doc_id, p, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS h FROM s) s JOIN win ON s.k = win.k AND s.h = win.h),
hits AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + k - 1)) AS i FROM occ) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op4_near_duplicates": r"""
WITH RECURSIVE d AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') END AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS h FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
links AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS doc, doc_id AS reached FROM d UNION SELECT r.doc, links.y FROM r JOIN links ON r.reached = links.x),
c AS (SELECT doc, min(reached) AS component_id FROM r GROUP BY doc)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept FROM d JOIN c ON c.doc = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""",
    "op6_repeated_passages": r"""
WITH d AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w FROM documents),
s AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS p FROM d WHERE len(w) >= 20),
k AS (SELECT doc_id, p, sha256(array_to_string(list_slice(w, p, p + 19), ' ')) AS h FROM s),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS n FROM k) WHERE n > 1),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 19)) AS i FROM r),
n AS (SELECT doc_id, count(*) AS n_removed FROM g GROUP BY doc_id),
u AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM d),
t AS (SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.i) AS kept FROM u ANTI JOIN g ON u.doc_id = g.doc_id AND u.i = g.i GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
""",
    "op10_line_quality": r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS txt, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
v AS (SELECT doc_id, p, word, lead(word) OVER o AS second, lead(word, 2) OVER o AS third FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, word, second, third) AS n FROM v WHERE third IS NOT NULL) WHERE n > 1),
again AS (SELECT doc_id, count(DISTINCT p + i) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS x(i) GROUP BY doc_id),
chars AS (SELECT doc_id, sum(length(word)) AS word_chars FROM u GROUP BY doc_id),
lines AS (SELECT doc_id, host, txt, unnest(string_split(txt, chr(10))) AS line FROM d),
full_lines AS (SELECT doc_id, host, txt, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS x FROM lines),
real AS (SELECT doc_id, host, txt, line, array_to_string(x, ' ') AS normal, len(x) AS n FROM full_lines WHERE len(x) > 0),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM real GROUP BY doc_id),
sizes AS (SELECT host, count(DISTINCT txt) AS host_docs FROM d GROUP BY host),
counted AS (SELECT host, normal, count(DISTINCT txt) AS n_docs FROM real GROUP BY host, normal HAVING count(DISTINCT txt) >= 20),
frequent AS (SELECT c.host, c.normal FROM counted c JOIN sizes s ON c.host IS NOT DISTINCT FROM s.host WHERE c.n_docs > CAST(0.1 AS DOUBLE) * s.host_docs),
lost AS (SELECT r.doc_id, sum(r.n) AS n_line_words FROM real r JOIN frequent f ON r.host IS NOT DISTINCT FROM f.host AND r.normal = f.normal GROUP BY r.doc_id),
s AS (SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(chars.word_chars, 0) AS BIGINT) AS word_chars, CAST(length(regexp_replace(d.txt, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dups.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(again.n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n_line_words, 0) AS BIGINT) AS n_line_words
  FROM d LEFT JOIN chars USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN again USING (doc_id) LEFT JOIN lost USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND n_words - n_line_words >= 50 AND 2 * (n_words - n_line_words) >= n_words AS kept FROM b
""",
}


def oracle_sql() -> dict[str, str]:
    return ORACLES | {"op12_collocations": phrases.ORACLE, "op13_source_divergence": divergence.ORACLE}
