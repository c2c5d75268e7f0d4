"""The corpus pipeline: raw documents to deduplicated, mixed and segmented ones.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickflow.llm.exact_dedup import exact_dedup
from tickflow.llm.links import join_dealt
from tickflow.llm.mixing import mix_sources
from tickflow.llm.near_dedup import near_duplicates
from tickflow.llm.pieces import encode_pieces
from tickflow.llm.quality import quality_filter
from tickflow.llm.queries import LLM_ORACLES, LLM_QUERIES
from tickflow.llm.queries_free import PIECE_MODEL
from tickflow.llm.registry import query, table
from tickflow.llm.slots import bitmap, with_hit, without
from tickflow.session import materialize

__all__ = ["LLM_ORACLES", "LLM_QUERIES", "ORACLE_SQL", "STAGES", "run"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row as one value next to a key of its id and text, so that no name can clash."""
    key = F.xxhash64("doc_id", F.xxhash64("text")).alias("_key")
    return docs.select(key, F.struct("*").alias("_row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their host's boilerplate lines.

    A null text fails. Rows that repeat an id and a text on a host share one verdict. An
    empty table stays empty, here and in all stages.
    """
    return quality_filter(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, also where a row repeats its id with its text.

    It is one with the largest id; any id is larger than none. Null texts are empty ones.
    """
    judged = exact_dedup(docs, carry={"_row": F.struct("*")}).filter("kept")
    single = judged.filter("group_size = 1").select("_row")
    first = judged.filter("group_size > 1").dropDuplicates(["keep_id", "_digest"]).select("_row")
    return single.union(first).select("_row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Rows are told apart by id and text, so another text under a dropped row's id stays.
    Texts without a word stay, as do rows without an id unless a row with one has their
    words; rows that share the smallest id and its words in other letters or spacing all
    stay.
    """
    dropped = near_duplicates(docs).filter("NOT kept")
    dropped = dropped.select(F.xxhash64("doc_id", "text_hash").alias("_key")).distinct()
    return without(_keyed(docs), materialize(dropped, "dropped"), "_key").select("_row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture uses them; those it has no use for go.

    Texts without a word are in no mixture. Rows that repeat an id and a text are used
    alike, each of them. Most documents are used once and stay where they are read.
    """
    key = F.xxhash64("doc_id", "text_hash").alias("_key")
    used = mix_sources(docs).groupBy(key).agg((F.max("epoch") + 1).alias("_uses"))
    used = materialize(used, "used")
    rows = _keyed(docs)
    uses = F.coalesce("_uses", F.lit(0))
    odd = rows.select("_key").distinct().join(used, "_key", "left").select("_key", uses.alias("_uses"))
    odd = materialize(odd.filter("_uses <> 1"), "odd")
    hit = with_hit(rows, ["_key"], bitmap(odd, ["_key"]), "_hit")
    once = hit.filter("NOT _hit").select("_row")
    # The facts grow with the rows, so they are joined alike at every size.
    met = join_dealt(hit.filter("_hit"), odd.hint("merge"), "_key", "left")
    met = met.withColumn("_uses", F.coalesce("_uses", F.lit(1))).filter("_uses > 0")
    met = met.select("_row", F.explode(F.sequence(F.lit(1), F.col("_uses")))).select("_row")
    return once.union(met).select("_row.*")


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces, other ones for each use of a document.

    Null texts have no ids. Only rows that share an id and a text are put together, to
    number them.
    """
    rows = _keyed(docs)
    twice = rows.groupBy("_key").agg(F.count("*").alias("_n")).filter("_n > 1").select("_key")
    hit = with_hit(rows, ["_key"], bitmap(materialize(twice, "twice"), ["_key"]), "_hit")
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.lit(0)))
    met = hit.filter("_hit").withColumn("_copy", nth)
    rows = hit.filter("NOT _hit").withColumn("_copy", F.lit(1)).unionByName(met)
    rows = rows.select("_row", "_copy", F.col("_row.doc_id").alias("_doc"), F.col("_row.text").alias("_text_"))
    encoded = encode_pieces(
        rows, PIECE_MODEL, id_col="_doc", text_col="_text_", copy=F.col("_copy"), carry=("_row",)
    )
    return encoded.select("_row.*", "ids")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mix", mix),
    ("sentencepiece", segment),
]

#: Segmentation and components can't be told in SQL; tests compare with brute force.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
