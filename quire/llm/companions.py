"""Columns of operators that SQL can state, as queries of their own: folds, languages that cannot be told, strict personal data, base scores.

Each runs the operator's own query and keeps those columns, so what SQL checks is what the operator gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .language_id import op10_language_id
from .ngram_lm import op4_ngram_lm
from .pii import op3_pii
from .quality import op1_quality
from .turns import CRC32_SQL, CRC32_TABLE_SQL


def _fold(mod: int, held: int) -> str:
    return f"{CRC32_SQL.format(text='doc_id::VARCHAR', table='crc.t')} % {mod} = {held}"


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def quality_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = (F.col("score").between(0, 1) & ((F.col("score") >= 0.5).cast("int") == F.col("predicted"))).alias("fits")
    return op1_quality(spark, sf_dir).select("doc_id", "held_out", fits)


def language_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_language_id(spark, sf_dir).select("doc_id", "held_out", (F.col("lang_pred") == "und").alias("und"), F.col("score").between(0, 1).alias("fits"))


def strict_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_ngram_lm(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


QUERIES = {f.__name__: f for f in (quality_folds, language_folds, strict_personal_data, base_scores)}
ORACLES = {
    "quality_folds": f"WITH crc AS ({CRC32_TABLE_SQL}) SELECT doc_id, {_fold(3, 1)} AS held_out, true AS fits FROM documents, crc",
    "language_folds": f"WITH crc AS ({CRC32_TABLE_SQL}) SELECT doc_id, {_fold(4, 2)} AS held_out, NOT regexp_matches(coalesce(text, ''), '\\p{{L}}') AS und, true AS fits FROM documents, crc",
    "strict_personal_data": r"""
WITH f AS (SELECT doc_id, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS email, regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') AS ip,
  regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+') AS card, regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]') AS phone FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
g AS (SELECT doc_id, email, ip, list_transform(card, lambda x: reverse(regexp_replace(x, '[^0-9]', '', 'g'))) AS card, list_transform(phone, lambda x: length(regexp_replace(x, '[^0-9]', '', 'g'))) AS phone FROM f)
SELECT doc_id, len(email)::BIGINT AS n_email, len(list_filter(ip, lambda x: list_max(list_transform(string_split(x, '.'), lambda p: coalesce(try_cast(p AS BIGINT), 999))) <= 255))::BIGINT AS n_ip,
  len(list_filter(card, lambda x: length(x) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length(x)), lambda i: CASE WHEN i % 2 = 0 THEN ascii(x[i + 1]) - 48 ELSE (ascii(x[i + 1]) - 48) * 2 - CASE WHEN ascii(x[i + 1]) > 52 THEN 9 ELSE 0 END END)) % 10 = 0))::BIGINT AS n_card,
  len(list_filter(phone, lambda n: n BETWEEN 9 AND 15))::BIGINT AS n_phone FROM g""",
    "base_scores": f"""
WITH crc AS ({CRC32_TABLE_SQL}), d AS (SELECT doc_id, {_fold(5, 1)} AS held_out, list_append(list_filter(string_split_regex({LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''), ' ') AS w FROM documents, crc),
t AS (SELECT doc_id, held_out, unnest(w) AS tok FROM d), c AS (SELECT tok, count(*) AS c FROM t WHERE NOT held_out GROUP BY 1), n AS (SELECT sum(c)::BIGINT AS total, count(*) AS kinds FROM c)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c.c) AS n_known, any_value(total) AS train_tokens, round(sum(log10((coalesce(c.c, 0) + 0.5) / (total + 0.5 * (kinds + 1)))), 4) AS base_score
FROM t LEFT JOIN c USING (tok), n GROUP BY 1, 2""",
}
