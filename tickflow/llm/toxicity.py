"""Toxic passages by maximum-scoring segments.

Words get log-odds of toxic against other documents with a Dirichlet prior in the
proportions of the whole training text; words whose log-odds are not significant count
as neutral, and every word pays a small toll, so scores fall along harmless prose. A
linear scan finds all maximal segments. How high segments get by chance follows an
extreme-value law whose scale comes from the score distribution and whose constant is
fitted on harmless documents; what segments have beyond chance adds up to a document's
evidence, and a logistic curve turns that into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.bloom import Bloom
from tickflow.llm.links import join_dealt
from tickflow.session import materialize

WORD = re.compile(r"[^\W\d_]+")
#: Width of the bins that scores are gathered in for the extreme-value law.
SCORE_BIN = 1e-4


@dataclass(frozen=True)
class ToxicSpec:
    #: Weight of the prior, as a share of the training counts.
    prior: float = 0.1
    #: Log-odds this many standard errors from 0 are significant.
    least_z: float = 4.0
    #: What every word costs.
    toll: float = 0.05
    #: A segment that chance brings this often per document or less is significant.
    chance: float = 0.05
    #: Evidence is fitted in bins of this width, up to a largest one.
    bin_width: float = 0.25
    #: More evidence than this makes no difference; scores of such texts tie.
    largest: float = 60.0
    #: Significant words that are broadcast, about 100 bytes each. A larger model is
    #: joined with the texts' words instead.
    broadcast_words: int = 1 << 18


@dataclass(frozen=True)
class ToxicModel:
    """Word scores, extreme-value parameters and the logistic curve.

    ``scores`` is None where there are too many words to broadcast; ``table`` (word,
    delta), a written one, has them in either case.
    """

    scores: dict[str, float] | None
    table: DataFrame | None
    scale: float
    constant: float
    offset: float
    slope: float
    spec: ToxicSpec

    def evidence(self, segments: list[tuple[int, int, float]], n_words: int) -> float:
        """What significant segments have beyond chance, in units of the law's scale."""
        by_chance = np.log(self.constant * max(n_words, 1))
        beyond = (self.scale * score - by_chance for _, _, score in segments)
        return min(sum(x for x in beyond if x >= -np.log(self.spec.chance)), self.spec.largest)

    def score(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-(self.offset + self.slope * evidence))))


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def hits(words: list[str], scores: dict[str, float]) -> list[tuple[int, float]]:
    """Places of words with a score, and their scores."""
    return [(i, scores[word]) for i, word in enumerate(words) if word in scores]


def segments(scored: Iterable[tuple[int, float]], toll: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments: (first word, end, score), in one linear scan.

    ``scored`` are the places of words with a score, in order; all other words cost the
    toll.

    Each candidate holds its start, end and the running totals before and at its end. A
    new positive word joins the nearest candidate that starts lower and ends lower than
    it does, with all between; otherwise it is a candidate of its own.
    """
    total, last, found = 0.0, 0, []
    for i, score in scored:
        total -= toll * (i - last)
        last = i + 1
        before, total = total, total + score - toll
        if total <= before:
            continue
        start, low = i, before
        k = len(found) - 1
        while True:
            while k >= 0 and found[k][2] >= low:
                k = found[k][4]
            if k < 0 or found[k][3] >= total:
                break
            start, low = found[k][0], found[k][2]
            del found[k:]
            k = len(found) - 1
        found.append((start, i + 1, low, total, k))
    return [(start, end, high - low) for start, end, low, high, _ in found]


def _word_counts(labelled: DataFrame) -> DataFrame:
    """(word, toxic, clean): training documents of either label that hold the word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(), Counter()
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for text, label in zip(texts, labels, strict=True):
                found[label].update(set(tokens(text)))
            words = list(found[0] | found[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words, type=pa.string()),
                    *[pa.array([found[y][w] for w in words], type=pa.int64()) for y in (1, 0)],
                ],
                names=["word", "toxic", "clean"],
            )

    counts = labelled.select("text", "toxic").mapInArrow(
        count, "word string, toxic long, clean long"
    )
    return counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _log_odds(counts: DataFrame, spec: ToxicSpec) -> tuple[DataFrame, np.ndarray, np.ndarray, float]:
    """(word, delta) of significant words as a written table; binned scores with how often
    their words are in harmless text, and all other words' share."""
    n = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    toxic, clean = n.toxic or 0, n.clean or 0
    prior, mass = (F.col("toxic") + F.col("clean")) * spec.prior, (toxic + clean) * spec.prior

    def odds(own: str, total: int) -> Column:
        held = F.col(own) + prior
        return F.log(held) - F.log(total + mass - held)

    delta = odds("toxic", toxic) - odds("clean", clean)
    error = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    best = counts.select("word", "clean", delta.alias("delta"), (delta / error).alias("z"))
    best = best.filter(F.abs("z") >= spec.least_z) if toxic and clean else best.limit(0)
    often = ((F.col("clean") + 0.5) / (clean + 1)).alias("often")
    best = materialize(best.select("word", "delta", often), "significant")
    # Scores lie within a few dozen units of 0, so bins are bounded.
    bins = best.groupBy(F.round(F.col("delta") / SCORE_BIN).alias("bin")).agg(F.sum("often").alias("often"))
    bins = bins.orderBy("bin").collect()
    scores = np.array([row.bin * SCORE_BIN for row in bins])
    often = np.array([row.often for row in bins])
    return best.select("word", "delta"), scores, often, max(1 - often.sum(), 1e-9)


def _scale(scores: np.ndarray, often: np.ndarray, rest: float, toll: float) -> float:
    """The positive root of sum(often * exp(scale * score)) = 1 over words of harmless text."""
    paid = np.append(scores - toll, -toll)
    weight = np.append(often, rest) / (often.sum() + rest)

    def excess(x: float) -> float:
        return float(np.log((weight * np.exp(np.minimum(x * paid, 700))).sum()))

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _fit_curve(evidence: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a logistic curve by Newton's method, with a weak pull to 0."""
    x = np.column_stack([np.ones(len(evidence)), evidence])
    beta, n = np.zeros(2), toxic + clean
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (toxic - n * p) - 1e-3 * beta
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta + np.linalg.solve(hessian, gradient)
    return float(beta[0]), float(max(beta[1], 0))


def train(labelled: DataFrame, spec: ToxicSpec = ToxicSpec()) -> ToxicModel:
    """A model from rows (text, toxic) with toxic 0 or 1, all of them.

    The driver gets binned scores, binned evidence, and the significant words if they are
    few enough to be broadcast.
    """
    labelled = materialize(labelled.select("text", "toxic"), "labelled")
    table, binned, often, rest = _log_odds(materialize(_word_counts(labelled), "words"), spec)
    scale = _scale(binned, often, rest, spec.toll) if (binned > spec.toll).any() else 1.0
    scores = None
    if table.count() <= spec.broadcast_words:
        scores = {row.word: row.delta for row in table.collect()}
    # By the law, constant * n * exp(-scale * top) is exponential with mean 1.
    model = ToxicModel(scores, table, scale, 1.0, 0.0, 1.0, spec)
    chance = F.col("n_words") * F.exp(-scale * F.col("top"))
    mean = (
        _scanned(labelled.filter("toxic = 0"), model, "text")
        .filter("n_words > 0")
        .agg(F.avg(chance).alias("mean"))
        .first()
        .mean
    )
    model = ToxicModel(scores, table, scale, 1 / mean if mean else 1.0, 0.0, 1.0, spec)
    place = F.round(F.col("evidence") / spec.bin_width)
    bins = (
        _scanned(labelled, model, "text")
        .groupBy(place.alias("place"))
        .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
        .collect()
    )
    toxic = np.array([row.toxic for row in bins], dtype=float)
    n = np.array([row.n for row in bins], dtype=float)
    evidence = np.array([row.place for row in bins]) * spec.bin_width
    offset, slope = _fit_curve(evidence, toxic, n - toxic) if bins else (-3.0, 1.0)
    return ToxicModel(scores, table, scale, model.constant, offset, slope, spec)


PASSAGE = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
MEASURES = "n_words long, passages array<struct<first: bigint, end: bigint, score: double>>, top double, evidence double, score double"


def _measured(model: ToxicModel, texts: Iterable[tuple[int, list[tuple[int, float]]]]) -> list[pa.Array]:
    """The measures of texts, given as their numbers of words and their words with scores."""
    sizes, passages, tops, evidence = [], [], [], []
    for n, scored in texts:
        found = segments(scored, model.spec.toll)
        sizes.append(n)
        tops.append(max((s[2] for s in found), default=0.0))
        evidence.append(model.evidence(found, n))
        passages.append(
            [{"first": a, "end": b, "score": s} for a, b, s in found if model.evidence([(a, b, s)], n) > 0]
        )
    return [
        pa.array(sizes, type=pa.int64()),
        pa.array(passages, type=pa.list_(PASSAGE)),
        *[pa.array(x, type=pa.float64()) for x in (tops, evidence, map(model.score, evidence))],
    ]


def _scanned(rows: DataFrame, model: ToxicModel, text_col: str) -> DataFrame:
    """The rows without their text, with n_words, passages, top, evidence and score."""
    if model.scores is None:
        return _joined(rows, model, text_col)
    shared = rows.sparkSession.sparkContext.broadcast(replace(model, table=None))
    carried = [c for c in rows.columns if c != text_col]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            words = (tokens(text) for text in batch.column(0).to_pylist())
            found = _measured(model, ((len(w), hits(w, model.scores)) for w in words))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *found],
                names=[*carried, "n_words", "passages", "top", "evidence", "score"],
            )

    types = dict(rows.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in carried], MEASURES])
    return rows.select(text_col, *carried).mapInArrow(scan, schema)


def _joined(rows: DataFrame, model: ToxicModel, text_col: str) -> DataFrame:
    """The same where the model is too large to broadcast.

    Words that may be significant, by a filter of bounded size, become rows (text, place,
    word) and are joined with the scores; only those of a text come together again. Rows
    are numbered in a written table, so a task that is tried again meets the same numbers.
    """
    carried = [c for c in rows.columns if c != text_col]
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    numbered = materialize(numbered.withColumnRenamed(text_col, "_text"), "numbered")
    table = materialize(model.table.withColumn("key", F.xxhash64("word")), "scores")
    filter_ = Bloom(table.select("key"))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([tokens(text) for text in batch.column(1).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["_row", "_words"])

    words = numbered.select("_row", "_text").mapInArrow(places, "_row long, _words array<string>")
    words = materialize(words, "word-lists")
    flat = words.select("_row", F.posexplode("_words").alias("place", "word"))
    flat = flat.withColumn("key", F.xxhash64("word"))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(3).to_numpy().view(np.uint64)
            yield batch.filter(pa.array(filter_.holds(keys)))

    likely = flat.mapInArrow(maybe, "_row long, place int, word string, key long")
    scored = join_dealt(likely.drop("key"), table.select("word", "delta"), "word")
    scored = scored.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("place", "delta"))).alias("_hits"))
    sized = words.select("_row", F.size("_words").cast("long").alias("_n")).join(scored, "_row", "left")
    narrow = numbered.select("_row", F.struct(*carried).alias("_carried")).join(sized, "_row")
    shared = rows.sparkSession.sparkContext.broadcast(replace(model, table=None))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            found = _measured(
                model, ((n, [(h["place"], h["delta"]) for h in own or []]) for n, own in texts)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *found],
                names=["_carried", "n_words", "passages", "top", "evidence", "score"],
            )

    kind = narrow.schema["_carried"].dataType.simpleString()
    found = narrow.select("_carried", "_n", "_hits").mapInArrow(scan, f"_carried {kind}, {MEASURES}")
    return found.select("_carried.*", "n_words", "passages", "top", "evidence", "score")


def score_toxicity(
    docs: DataFrame, model: ToxicModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_words, passages, top, evidence, score.

    ``passages`` are the significant segments as word positions with their scores. Null,
    empty and wordless texts have no evidence and the score that goes with none; so has
    everything where there was nothing to learn from. Repeated rows are scored alike; an
    empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    return _scanned(rows, model, "_text")
