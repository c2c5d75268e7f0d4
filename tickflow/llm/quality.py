"""Quality rules: per-document base measures and cross-document line frequency.

Normalised lines are hashed and their distinct documents counted per host; a line
above the limit stays only in the document with the smallest id that holds it (its
keeper) and goes from all others. A document that loses more than a set share of its
words that way is depleted. Documents are told apart by id and text, so copies under
ids of their own count each: of a text that a host has more often than the limit, the
one with the smallest id stays.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.links import join_dealt
from tickflow.llm.slots import bitmap, with_hit
from tickflow.llm.text import SEPARATORS, WORD, ascii_lower, or_empty, without, words
from tickflow.session import materialize

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class QualitySpec:
    #: A line in more distinct documents of one host than this is boilerplate.
    max_docs: int = 10
    #: A document that loses more than this share (percent) of its lines' words is depleted.
    max_removed_pct: int = 70
    min_words: int = 20
    max_repeat_pct: int = 30


def _normal(line: Column) -> Column:
    """Letters in lower case, white space runs as one space."""
    return F.trim(F.regexp_replace(ascii_lower(line), r"[\x20\x09-\x0D]+", " "))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it.

    A column would do, but the optimiser writes its expression into each place of a
    pushed-down filter that names it, and so into functions called per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words_: Column) -> Column:
    """Words inside windows of 8 words that the text has twice or more."""
    none = F.lit(0).cast("long")

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return F.transform(
            starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
        )

    def repeated(keys: Column) -> Column:
        ordered = F.sort_array(
            F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return _let(ordered, lambda o: _let(starts(o), covered))

    def starts(ordered: Column) -> Column:
        """Equal windows are neighbours here; the starts of all of them, in text order."""
        twice = F.filter(
            ordered,
            lambda x, k: (F.get(ordered, k - 1)["h"] == x["h"])
            | (F.get(ordered, k + 1)["h"] == x["h"]),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(places: Column) -> Column:
        """A window covers words up to its end or the next one's start."""
        gaps = F.transform(
            places,
            lambda s, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - s, F.lit(WINDOW))
            ),
        )
        return F.aggregate(gaps, none, lambda total, n: total + n)

    def counted(hashes: Column) -> Column:
        differ = lambda k: F.size(F.array_distinct(k)) == F.size(k)
        some = _let(windows(hashes), lambda k: F.when(differ(k), none).otherwise(repeated(k)))
        return F.when(F.size(hashes) < WINDOW, none).otherwise(some)

    return _let(F.transform(words_, lambda w: F.xxhash64(w)), counted)


def base_measures(rows: DataFrame) -> DataFrame:
    """Add the base columns to rows with ``_text`` (never null)."""
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    normal = F.array_distinct(F.transform(F.col("_lines"), _normal))
    measured = rows.withColumn("_words", words(text)).withColumn("_lines", lines)
    return measured.select(
        *rows.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(without(text, SEPARATORS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).alias("n_repeat_words"),
        F.aggregate(
            F.transform(normal, _spaces), F.lit(0).cast("long"), lambda total, n: total + n
        ).alias("_line_words"),
    )


def _spaces(line: Column) -> Column:
    """Words of a normalised line that has some."""
    return F.length(line) - F.length(without(line, " ")) + 1


def frequent_lines(rows: DataFrame, spec: QualitySpec) -> DataFrame:
    """Per document with lines to remove: _doc, removed_words, removed_lines.

    ``rows``: _id, _host, _doc, _text. ``removed_lines`` holds line hashes.
    """
    lines = (
        rows.select("_id", "_host", "_doc", F.explode(F.split("_text", "\n")).alias("_line"))
        .filter(F.col("_line").rlike(WORD))
        .withColumn("_line", _normal(F.col("_line")))
        .withColumn("_hash", F.xxhash64("_line"))
        .withColumn("_key", F.xxhash64("_host", "_hash"))
    )
    held = materialize(
        lines.groupBy("_key", "_hash", "_host", "_doc").agg(
            F.min("_id").alias("_first"), F.max(_spaces(F.col("_line"))).alias("_n")
        ),
        "lines",
    )
    # Grouped by the key alone and joined by key and hash: both sides are dealt out
    # for the join, and a line that a third of all documents hold can be split.
    above = (
        held.groupBy("_key")
        .agg(
            F.max("_hash").alias("_hash"),
            F.count("*").alias("_docs"),
            F.min("_first").alias("_holder"),
        )
        .filter(F.col("_docs") > spec.max_docs)
    )
    removed = held.join(above, ["_key", "_hash"]).filter(
        ~F.col("_first").eqNullSafe(F.col("_holder"))
    )
    return removed.groupBy("_doc").agg(
        F.sum("_n").cast("long").alias("removed_words"),
        F.collect_set("_hash").alias("removed_lines"),
    )


def _judged(rows: DataFrame, spec: QualitySpec) -> DataFrame:
    """Rows (_id, _host, _text and others) with all measures and the verdict."""
    rows = rows.withColumn("_doc", F.xxhash64("_host", "_id", "_text"))
    lost = frequent_lines(rows.select("_id", "_host", "_doc", "_text"), spec)
    lost = materialize(lost.select("_doc", "removed_words", "removed_lines"), "lost")
    # Only rows that may lose lines meet them; the others stay where they are read.
    hit = with_hit(rows, ["_doc"], bitmap(lost, ["_doc"]), "_hit")
    # The facts grow with the rows, so they are joined alike at every size.
    losing = join_dealt(base_measures(hit.filter("_hit").drop("_hit")), lost.hint("merge"), "_doc", "left")
    whole = base_measures(hit.filter("NOT _hit").drop("_hit"))
    whole = whole.select("*", *[F.lit(None).cast(t).alias(c) for c, t in lost.dtypes if c != "_doc"])
    pct = F.lit(100).cast("long")
    base_failed = (F.col("n_words") < spec.min_words) | (
        pct * F.col("n_repeat_words") > spec.max_repeat_pct * F.col("n_words")
    )
    depleted = pct * F.col("removed_words") > spec.max_removed_pct * F.col("_line_words")
    return (
        losing.unionByName(whole)
        .drop("_text")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", base_failed)
        # One term, so that a filter on it is not split and worked out before the join.
        .withColumn("kept", F.greatest(base_failed.cast("int"), depleted.cast("int")) == 0)
    )


def _rows(docs: DataFrame, id_col: str, text_col: str, host_col: str, *more: Column) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("_id"),
        or_empty(host_col).alias("_host"),
        or_empty(text_col).alias("_text"),
        *more,
    )


def quality_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    spec: QualitySpec = QualitySpec(),
) -> DataFrame:
    """One row per input row: the base measures, base_failed, kept and removed_words.

    A null text has no words and fails. Null and empty hosts are one host. A document
    whose id is null keeps a line only where all that hold it have none. Rows that repeat
    an id and a text on a host are one document and share its verdict, as do rows without
    an id that repeat a text; lines without a word are no lines. An empty table gives an
    empty result; other columns of ``docs`` are not read.
    """
    return _judged(_rows(docs, id_col, text_col, host_col), spec).select(
        F.col("_id").alias("doc_id"),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        *("base_failed", "kept", "removed_words"),
    )


def quality_filter(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    spec: QualitySpec = QualitySpec(),
) -> DataFrame:
    """The kept rows with all their columns, and without the lines above the limit.

    Defined for nulls, empty and repeated rows as ``quality_rules`` is. Texts that lose
    no line stay as they are; of others, a column ``n_chars`` is counted anew.
    """
    rows = _rows(docs, id_col, text_col, host_col, F.struct("*").alias("_row"))
    cleaned = _cleaned(F.col(f"_row.{text_col}"), F.col("removed_lines"))
    return (
        _judged(rows, spec)
        .filter("kept")
        .select("_row", cleaned.alias("_clean"))
        .select(*[_column(c, text_col).alias(c) for c in docs.columns])
    )


def _column(name: str, text_col: str) -> Column:
    old = F.col("_row").getField(name)
    if name == text_col:
        return F.col("_clean")
    if name == "n_chars":
        same = F.col("_row").getField(text_col).eqNullSafe(F.col("_clean"))
        return F.when(same, old).otherwise(F.length("_clean").cast("long"))
    return old


def _cleaned(text: Column, removed_lines: Column) -> Column:
    """``text`` without the lines whose hash is in ``removed_lines`` (null: none)."""
    kept = F.filter(
        F.split(text, "\n"),
        lambda line: ~F.array_contains(removed_lines, F.xxhash64(_normal(line))),
    )
    return F.when(removed_lines.isNull(), text).otherwise(F.array_join(kept, "\n"))
