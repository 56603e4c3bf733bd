"""op9_quality_rules: the rules over the whole table ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotmarket.llm import quality_rules
from lotmarket.llm.common import table


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select("doc_id", *quality_rules.BASE_COLUMNS, "kept", "broken_rules")


QUERIES = {"op9_quality_rules": op9_quality_rules}

_STOP = ", ".join(f"'{w}'" for w in sorted({w for ws in quality_rules.STOP_WORDS.values() for w in ws.split()}))


def _rules_sql() -> str:
    """The threshold table as SQL cases over columns named as its metrics."""
    cases = []
    for r in quality_rules.RULES:
        sides = [f"{r.metric} < {r.low}"] * (r.low is not None) + [f"{r.metric} > {r.high}"] * (r.high is not None)
        cases.append(f"CASE WHEN {' OR '.join(sides)} THEN '{r.name}' END")
    return "concat_ws(',', " + ", ".join(cases) + ")"


SQL = {"op9_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parts AS (SELECT doc_id, unnest(regexp_split_to_array(t, '[\x20\x09-\x0D]+')) AS word,
                 unnest(range(1, len(regexp_split_to_array(t, '[\x20\x09-\x0D]+')) + 1)) AS k FROM d),
words AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i FROM parts WHERE word <> ''),
grams AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p || ' ' || lead(word, 3) OVER p
                 || ' ' || lead(word, 4) OVER p AS g FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams WHERE g IS NOT NULL) WHERE n > 1),
covered AS (SELECT doc_id, sum(least(5, coalesce(after - i, 5))) AS n_repeat_words
            FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM twice) GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, sum(CASE WHEN regexp_matches(word, '\p{{L}}') THEN 0 ELSE 1 END) AS letterless,
                   sum(CASE WHEN lower(word) IN ({_STOP}) THEN 1 ELSE 0 END) AS stops FROM words GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines,
                 sum(CASE WHEN regexp_matches(x, '^[\x20\x09]*[-*•]') THEN 1 ELSE 0 END) AS bullets,
                 sum(CASE WHEN regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$') THEN 1 ELSE 0 END) AS ellipses
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
                letterless, stops, n_lines, bullets, ellipses,
                length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS uppers,
                length(regexp_replace(regexp_replace(t, '!+', '!', 'g'), '[^!]+', '', 'g')) AS bangs
         FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN counted USING (doc_id) LEFT JOIN lines USING (doc_id)),
ratios AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                  CASE WHEN n_words > 0 THEN CAST(word_chars AS DOUBLE) / n_words END AS mean_word_chars,
                  CASE WHEN n_words > 0 THEN CAST(n_symbols AS DOUBLE) / n_words END AS symbol_ratio,
                  CASE WHEN n_words > 0 THEN CAST(letterless AS DOUBLE) / n_words END AS letterless_ratio,
                  CASE WHEN n_words >= {quality_rules.MIN_STOP_WORDS} THEN CAST(stops AS DOUBLE) / n_words END AS stop_ratio,
                  CASE WHEN word_chars > 0 THEN CAST(uppers AS DOUBLE) / word_chars END AS upper_ratio,
                  CASE WHEN n_words > 0 THEN CAST(bangs AS DOUBLE) / n_words END AS bang_ratio,
                  CASE WHEN n_lines > 0 THEN CAST(n_dup_lines AS DOUBLE) / n_lines END AS dup_line_ratio,
                  CASE WHEN n_lines > 0 THEN CAST(bullets AS DOUBLE) / n_lines END AS bullet_line_ratio,
                  CASE WHEN n_lines > 0 THEN CAST(ellipses AS DOUBLE) / n_lines END AS ellipsis_line_ratio FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND broken_rules = '' AS kept, broken_rules
FROM (SELECT *, {_rules_sql()} AS broken_rules FROM ratios)
"""}
