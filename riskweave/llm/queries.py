"""One query for each corpus operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import (
    conversation_repair,
    decontaminate,
    hmm_scoring,
    html_extract,
    line_dedup,
    line_rules,
    mixture,
    pseudonyms,
    quality_knn,
    secret_scan,
    sharding,
    simhash_ball,
    source_audit,
)
from riskweave.session import table


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return quality_knn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixture.mix(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document, and the items found or nearly so."""
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated", "n_near")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot and shard of every document."""
    return sharding.shard(table(spark, sf_dir, "documents")).select("doc_id", "slot", "shard")


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts and the verdict on every document."""
    return line_rules.measure(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without lines that an earlier three-line window has."""
    return line_dedup.marked(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", F.col("line_text").alias("text"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and near-duplicate class of every document."""
    return simhash_ball.classes(table(spark, sf_dir, "documents"))


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms for personal data."""
    return pseudonyms.protect(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    return conversation_repair.report(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def op12_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log-probability of every document by the base model and by the hidden Markov model."""
    return hmm_scoring.score(table(spark, sf_dir, "documents"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source of a language is from its others, and its most unusual terms."""
    return source_audit.audit(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of the corpus pipeline, one after another."""
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extract,
        op2_quality_knn,
        op3_mixture,
        op4_secret_scan,
        op5_decontaminate,
        op6_sharding,
        op7_line_rules,
        op8_line_dedup,
        op9_simhash,
        op10_pseudonyms,
        op11_conversation_repair,
        op12_hmm_scoring,
        op13_source_audit,
        pipeline,
    )
}

#: The words of a text as a list, and 10-word windows, in DuckDB.
_OP5 = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), i AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), wins AS (
  SELECT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)
), places AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)
), hits AS (
  SELECT DISTINCT doc_id, s, places.n, item_id FROM places JOIN wins USING (win)
), per AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
), want AS (
  SELECT win, n, unnest(range(0, n)) AS i, unnest(string_split(win, ' ')) AS term FROM (SELECT DISTINCT win, n FROM wins)
), have AS (
  SELECT doc_id, unnest(range(0, len(w))) AS p, unnest(w) AS term FROM d
), freq AS (
  SELECT term, count(*) AS f FROM have GROUP BY term
), rarest AS (
  SELECT win, n, arg_min(i, (coalesce(f, 0), term, i)) AS r FROM want LEFT JOIN freq USING (term) GROUP BY win, n
), close AS (
  SELECT doc_id, win FROM (SELECT doc_id, win, n, i, r, delta, p - i + delta AS s FROM have JOIN want USING (term) JOIN rarest USING (win, n), (VALUES (-1), (0), (1)) t(delta))
  GROUP BY doc_id, win, n, s HAVING count(DISTINCT i) = n AND count(*) FILTER (i = r AND delta = 0) > 0
), near AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near FROM (SELECT DISTINCT doc_id, win FROM close) JOIN wins USING (win) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
"""

_NOTICES = " OR ".join(f"contains(lower(line), '{n}')" for n in line_rules.NOTICES)

_OP7 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS s, w FROM d WHERE len(w) >= 3
), grams AS (
  SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, w[s:s + 2]) AS c FROM win
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([s, s + 1, s + 2]) AS p FROM grams WHERE c > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(ls) AS line FROM d
), judged AS (
  SELECT doc_id, line, length(line) AS n, length(regexp_replace(line, '[^\p{{Lu}}]+', '', 'g')) AS up, length(regexp_replace(line, '[^\p{{L}}]+', '', 'g')) AS letters,
    length(regexp_replace(line, '[^#*$%&|<>]+', '', 'g')) AS sym, length(regexp_replace(line, '[^|»·]+', '', 'g')) AS sep,
    len(string_split_regex(line, '[!?]{{2,}}')) - 1 AS shouts,
    len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n_w FROM lines
), lost AS (
  SELECT doc_id, sum(CASE WHEN sym > {line_rules.MAX_SYMBOL_SHARE} * n OR shouts > {line_rules.MAX_SHOUTS}
      OR (letters >= {line_rules.MIN_LETTERS} AND up > {line_rules.MAX_UPPER_SHARE} * letters) OR sep >= {line_rules.MAX_SEPARATORS}
      OR (n_w <= {line_rules.SHORT_WORDS} AND NOT regexp_matches(line, '[.!?\x{{2026}}:;,"''\x{{201D}}\x{{BB}})\]]\s*$')) OR {_NOTICES}
    THEN n ELSE 0 END)::DOUBLE / sum(n)::DOUBLE AS share FROM judged GROUP BY doc_id
), base AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(share, 1.0)::DOUBLE AS lost_share
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_share <= {line_rules.MAX_LOST_SHARE} AS kept, lost_share
FROM base
"""

_OP8 = r"""
WITH l AS (
  SELECT doc_id, coalesce(text, '') AS t, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
), worded AS (
  SELECT doc_id, pos, trim(line, ' ') AS line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k, count(*) OVER (PARTITION BY doc_id) AS n
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), win AS (
  SELECT a.doc_id, a.k, string_agg(b.line, chr(10) ORDER BY b.k) AS win
  FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND b.k BETWEEN a.k AND a.k + 2
  WHERE a.k <= greatest(a.n - 2, 1) GROUP BY a.doc_id, a.k
), later AS (
  SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY win ORDER BY doc_id, k) AS r FROM win) WHERE r > 1
), gone AS (
  SELECT DISTINCT w.doc_id, w.pos FROM worded w JOIN later ON w.doc_id = later.doc_id AND w.k BETWEEN later.k AND later.k + 2
)
SELECT l.doc_id, count(w.pos)::BIGINT AS n_lines, count(gone.pos)::BIGINT AS n_removed,
       coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (gone.pos IS NULL), '') AS text
FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos
       LEFT JOIN worded w ON l.doc_id = w.doc_id AND l.pos = w.pos GROUP BY l.doc_id
"""

ORACLES = {
    "op5_decontaminate": _OP5,
    "op6_sharding": sharding.ORACLE,
    "op7_line_rules": _OP7,
    "op8_line_dedup": _OP8,
    "op11_conversation_repair": conversation_repair.ORACLE,
    "op13_source_audit": source_audit.ORACLE,
}
