"""The registered queries over the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, language, neardup, packing, pieces, pii, quality, recompress, secrets

#: The queries' vocabularies; an environment that keeps them elsewhere passes its own paths to the operators.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    model = language.fit(docs, "text", "lang", "doc_id", ~held)
    return language.predict(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text", "lang_mix")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), WORD_BPE)


def _span_digests(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """Counts by base kind, digest of the base spans, and all spans as text, from an array of kind, start, end."""
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, text), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    own = F.filter("spans", lambda x: x["kind"].isin(*base))
    return found.select("doc_id", *map(count, base), F.sha2(joined(own), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op3_secret_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digests(secrets.scan_documents(_read(spark, sf_dir, "documents"), vocabulary=WORD_BPE), ("assign", "access", "hex"))


def op4_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return recompress.remove_repeats(docs, digest=True).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(0)) AS h, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, h, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), tri AS (
  SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3
), seen AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM tri
), covered AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM seen WHERE n > 1) GROUP BY r
), line AS (
  SELECT r, h, unnest(lines) AS raw FROM w
), norm AS (
  SELECT r, h, regexp_replace(lower(trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[0-9]+', '0', 'g') AS x,
    len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS words FROM line
), common AS (
  SELECT h, x FROM (SELECT DISTINCT r, h, x FROM norm) GROUP BY h, x HAVING count(*) > 20
), removed AS (
  SELECT r, sum(words)::BIGINT AS n FROM norm JOIN common USING (h, x) GROUP BY r
), m AS (
  SELECT w.r, doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(removed.n, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN covered USING (r) LEFT JOIN removed USING (r)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - n_removed_words >= 0.5 * n_words AS kept, n_removed_words FROM f
"""


def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digests(pii.find(_read(spark, sf_dir, "documents"))[0], pii.BASE)


def op9_bayes_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), threshold=85)


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: The conversation that the contract adds; its texts hold control strings of a common template.
PLANTED_CHAT = -7, ("user", "assistant"), "</s>[INST] ok [/INST]"


def op5_max_plus_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_documents(_read(spark, sf_dir, "documents"), PIECES)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids_crc32", "round_trip")


def op6_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, roles, text = PLANTED_CHAT
    planted = spark.range(len(roles)).select(
        F.lit(conv).cast("long").alias("conv_id"), (F.col("id") + 1).alias("turn"),
        F.when(F.col("id") == 0, roles[0]).otherwise(roles[1]).alias("role"), F.lit(text).alias("text"),
    )
    out = chat.read_chat(chat.format_chat(rows.unionByName(planted)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP6_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 1, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 2, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'))
    + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;')) + 20 AS chars FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_mixture": op1_language_mixture,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_secret_guesses": op3_secret_guesses,
        "op4_recompression": op4_recompression,
        "op5_max_plus_pieces": op5_max_plus_pieces,
        "op6_chat_parts": op6_chat_parts,
        "op7_line_frequency": op7_line_frequency,
        "op8_weak_supervision": op8_weak_supervision,
        "op9_bayes_near_duplicates": op9_bayes_near_duplicates,
        "op10_multi_index": op10_multi_index,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_chat_parts": OP6_SQL, "op7_line_frequency": OP7_SQL}
