"""Queries of the operators that need Python inside their tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.language import LanguageSpec, identify, train
from tickflow.llm.near_dedup import near_duplicates
from tickflow.llm.pii import BASE_KINDS, find_pii
from tickflow.llm.pieces import decode_pieces, encode_pieces
from tickflow.llm.registry import query, table
from tickflow.llm.slots import perhaps
from tickflow.llm.text import or_empty
from tickflow.llm.toxicity import score_toxicity
from tickflow.llm.toxicity import train as train_toxicity
from tickflow.llm.warc import read_warc, write_warc
from tickflow.session import scratch_path

#: Where the SentencePiece model lies on every machine.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def held_out() -> Column:
    """Rows that no model learns from: a fourth, by their id. Null ids are not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter("toxic IN (0, 1)")
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learned = docs.select("doc_id", "text").filter(~held_out())
    # Labels grow with the documents: the same join at every size.
    labelled = perhaps(learned, labels, ["doc_id"]).join(labels.hint("merge"), "doc_id")
    model = train_toxicity(labelled)
    scored = score_toxicity(docs, model)
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


@query("op7_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = docs.filter("doc_id is not null and text is not null and lang is not null")
    model = train(learned.filter(~held_out()), LanguageSpec())
    return identify(docs, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous"
    )


@query("op8_near_duplicates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many pieces, a hash of their ids, whether they decode to the text."""
    docs = table(spark, sf_dir, "documents").withColumn("original", or_empty("text"))
    encoded = encode_pieces(docs, PIECE_MODEL, carry=("doc_id", "original"))
    measured = encoded.withColumn("n_pieces", F.size("ids").cast("long")).withColumn(
        "ids_hash", F.xxhash64("ids")
    )
    carried = ("doc_id", "original", "n_pieces", "ids_hash")
    decoded = decode_pieces(measured, PIECE_MODEL, carry=carried)
    same = F.col("text") == F.col("original")
    return decoded.select("doc_id", "n_pieces", "ids_hash", same.alias("lossless"))


WARC_SQL = """
WITH d AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS holder, sha1(payload) AS hex FROM d),
b AS (
  SELECT page_id, holder, payload, string_agg(substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (5 * (3 - i % 4))) & 31)::INT,
           1), '' ORDER BY i) AS digest
  FROM t, range(32) r(i) GROUP BY page_id, holder, payload
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM b
"""


@query("op5_warc", WARC_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).drop("url", "intact")


@query("op6_personal_data")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind))
    return found.select(
        "doc_id",
        *[count(kind).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
