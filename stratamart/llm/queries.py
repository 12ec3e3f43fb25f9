"""The registered queries of this folder: each applies its operator to a whole table of ``sf_dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, decontaminate, divergence, exact_dedup, html_extract, lm_score, mixing, near_dedup, quality, secrets,
               spelling, suffix_dedup, toxicity)

OWN_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(OWN_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.format_chats(rows.unionByName(own)))


OP2_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>|/?ROLE\]|TEXT\])', '\1\\\2\3', 'g'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 WHEN 'system' THEN 17
      ELSE 19 + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>|/?ROLE\]|TEXT\])', '\1\\\2\3', 'g')) END AS n
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


OP4_SQL = f"""
WITH n AS (SELECT doc_id, {_ASCII_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n"""

QUERIES = {"op2_chat_format": op2_chat_format, "op3_secrets": op3_secrets, "op4_exact_dedup": op4_exact_dedup}
ORACLES = {"op2_chat_format": OP2_SQL, "op4_exact_dedup": OP4_SQL}


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES |= {"op1_decontaminate": op1_decontaminate, "op6_quality": op6_quality, "op7_mix": op7_mix, "op8_toxicity": op8_toxicity}


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), words=2)


QUERIES |= {"op5_near_dedup": op5_near_dedup}


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(documents(spark, sf_dir))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(documents(spark, sf_dir))


QUERIES |= {"op9_repeats": op9_repeats, "op10_lm_score": op10_lm_score}


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT k, lang, source, unnest(terms) AS term FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS n FROM groups g JOIN kept USING (lang)
          LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
      FROM cells JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
      FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL) JOIN v USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
telling AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p.p - q.q) * (p.p - q.q)) // (p.p + q.q) AS value
            FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (FROM pairs UNION ALL FROM telling) QUALIFY part = 'pair' OR rank <= 10"""

QUERIES |= {"op11_spelling": op11_spelling, "op12_main_text": op12_main_text, "op13_divergence": op13_divergence}
ORACLES |= {"op13_divergence": OP13_SQL}
