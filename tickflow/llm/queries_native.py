"""Queries of the operators that are DataFrame functions throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.exact_dedup import exact_dedup
from tickflow.llm.licenses import (
    ENDS,
    LINE_ENDS,
    known_sentences,
    license_scan,
    rule_sequences,
)
from tickflow.llm.mixing import mix_sources
from tickflow.llm.quality import quality_rules
from tickflow.llm.registry import query, table
from tickflow.llm.text import or_empty

EXACT_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)
"""


@query("op1_exact_dedup", EXACT_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup(docs, carry={"text_sha256": F.sha2(or_empty("text"), 256)}).drop("_digest")


QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d
), starts AS (
  SELECT r, unnest(range(1, len(ws) - 6)) AS i,
         unnest(list_transform(range(1, len(ws) - 6),
                               lambda j: array_to_string(ws[j:j + 7], ' '))) AS words8
  FROM w WHERE len(ws) >= 8
), twice AS (
  SELECT r, i FROM starts QUALIFY count(*) OVER (PARTITION BY r, words8) > 1
), covered AS (
  SELECT r, count(*) AS n
  FROM (SELECT DISTINCT r, unnest(range(i, i + 8)) AS pos FROM twice) GROUP BY r
), raw_lines AS (
  SELECT r, host, doc_id, text, unnest(string_split(text, chr(10))) AS line FROM d
), lines AS (
  SELECT *, trim(regexp_replace(
              translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r
), held AS (
  SELECT host, doc_id, text, norm, len(string_split(norm, ' ')) AS n
  FROM lines GROUP BY host, doc_id, text, norm
), above AS (
  SELECT host, norm, min(doc_id) AS holder FROM held GROUP BY host, norm HAVING count(*) > 10
), lost AS (
  SELECT h.host, h.doc_id, h.text, sum(CASE WHEN h.doc_id <> a.holder THEN h.n ELSE 0 END) AS removed,
         sum(h.n) AS total
  FROM held h LEFT JOIN above a USING (host, norm) GROUP BY h.host, h.doc_id, h.text
), m AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         coalesce(removed, 0)::BIGINT AS removed_words, coalesce(total, 0) AS total
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN covered USING (r)
  LEFT JOIN lost USING (host, doc_id, text)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND NOT 100 * removed_words > 70 * total AS kept,
       removed_words
FROM m
"""


@query("op2_quality_rules", QUALITY_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    known = ", ".join(f"('{s}', '{name}')" for s, name in known_sentences().items())

    def cut(ends: str) -> str:
        ends = ends.replace("'", "''")
        return f"""
          SELECT r, coalesce(string_agg('|' || name || '|', '' ORDER BY i), '') AS ids
          FROM (SELECT r, unnest(s) AS s, unnest(range(len(s))) AS i
                FROM (SELECT r, string_split(
                        regexp_replace(text, '{ends}', '\\1' || chr(1), 'g'), chr(1)) AS s
                      FROM d))
          LEFT JOIN known ON sentence = trim(regexp_replace(
            translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^a-z0-9]+', ' ', 'g'))
          GROUP BY r"""

    rules = ", ".join(
        "{'rest': '', 'found': []::VARCHAR[], 'seq': '%s', 'lic': '%s'}"
        % ("".join(f"|{n}|" for n in names), licence)
        for licence, names in rule_sequences()
    )

    def matches(ids: str) -> str:
        return f"""
          (list_reduce(list_prepend({{'rest': {ids}, 'found': []::VARCHAR[], 'seq': '', 'lic': ''}}, rules),
             lambda a, x: {{'rest': replace(a.rest, x.seq, '-'),
                           'found': CASE WHEN contains(a.rest, x.seq) THEN list_append(a.found, x.lic)
                                         ELSE a.found END, 'seq': '', 'lic': ''}})).found"""

    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    known(sentence, name) AS (VALUES {known}),
    a AS ({cut(ENDS)}), b AS ({cut(LINE_ENDS)}),
    f AS (
      SELECT doc_id, a.ids AS w, b.ids AS l,
             list_sort(list_distinct(list_concat({matches("a.ids")}, {matches("b.ids")}))) AS licences
      FROM d JOIN a USING (r) JOIN b USING (r), (SELECT [{rules}] AS rules) known_rules
    )
    SELECT doc_id,
           replace(trim(CASE WHEN length(l) > length(w) THEN l ELSE w END, '|'), '||', ',')
             AS sentence_ids,
           array_to_string(licences, ',') AS licenses, len(licences)::BIGINT AS n_licenses
    FROM f
    """


@query("op3_license_scan", _license_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


@query("op10_mix_sources")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))
