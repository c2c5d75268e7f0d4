"""Queries of the operators on conversations, repeated passages and phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.conversation_trie import numbered_turns, prefix_trie, with_family_heads
from tickflow.llm.passages import without_repeats
from tickflow.llm.phrases import collocations
from tickflow.llm.registry import query, table
from tickflow.session import materialize

#: Conversations of a family start with turns of its first one: up to eight.
FAMILY, HEADS = 5, 9

TRIE_SQL = """
WITH turns AS (
  SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crc AS (
  SELECT c, own, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda s, x: list_reduce(list_prepend(xor(s, x), range(8)),
             lambda a, i: xor(a >> 1, 3988292384 * (a & 1))))) % 9 AS h
  FROM turns
), rebuilt AS (
  SELECT a.c, list_concat(coalesce(f.own, [])[1:a.h], a.own[a.h + 1:]) AS path
  FROM crc a LEFT JOIN turns f ON f.c = a.c - a.c % 5
), prefixes AS (
  SELECT c, d, path[1:d] AS path, len(path) = d AS ends
  FROM (SELECT c, path, unnest(range(len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, bool_and(ends) AS leaf,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '') AS ids
  FROM prefixes GROUP BY path, d
), below AS (
  SELECT path[1:k] AS path, count(*) FILTER (WHERE leaf) AS n_leaves,
         count(*) FILTER (WHERE d = k + 1) AS n_children,
         sum(CASE WHEN d > 0 THEN (n_convs - 1) * strlen(path[d].text) ELSE 0 END) AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS k FROM nodes) GROUP BY path[1:k]
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       b.n_children, b.n_leaves, b.saved::BIGINT AS saved_tokens, sha256(n.ids) AS ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN nodes p ON n.d > 0 AND p.path = n.path[1:n.d - 1]
"""


@query("op11_conversation_trie", TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = materialize(numbered_turns(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie(*with_family_heads(turns, FAMILY, HEADS))


PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), runs AS (
  SELECT lang, len, unnest(list_transform(range(1, greatest(len(ws) - len + 2, 1)),
                             lambda i: array_to_string(ws[i:i + len - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3), (4)) AS sizes(len)
), f AS (
  SELECT lang, phrase, any_value(len) AS len, count(*) AS f FROM runs GROUP BY lang, phrase
), n AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len = 1 GROUP BY lang
), c AS (
  SELECT lang, phrase, len, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE len > 1 AND f >= 30
), inside AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS most
  FROM c, range(2, 4) sizes(m), range(1, 4) places(i)
  WHERE m < len AND i + m - 1 <= len GROUP BY ALL
), parts AS MATERIALIZED (
  SELECT lang, phrase, a, k, array_to_string(ws[:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, len)) AS k FROM c)
), cuts AS (
  SELECT p.lang, p.phrase, p.a, k, l.f AS l, r.f AS r,
         ((2000000::HUGEINT * p.a) // (l.f::HUGEINT + r.f))::BIGINT AS score
  FROM parts p JOIN f l ON l.lang = p.lang AND l.phrase = p.head
  JOIN f r ON r.lang = p.lang AND r.phrase = p.rest
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score,
         row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.most IS NULL OR 100::HUGEINT * i.most < 80::HUGEINT * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op13_phrase_collocations", PHRASE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query("op12_repeated_passages")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    kept = F.sha2("kept_bytes", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", kept)
