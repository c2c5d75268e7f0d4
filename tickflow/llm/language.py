"""Language identification with error-correcting output codes.

Each language has a codeword of bits; for each bit a binary classifier over hashed
byte n-grams tells the languages with that bit set from the others. A text goes to
the language whose codeword is nearest, each bit's loss weighted by how well its
classifier separates the languages. Training needs nothing but n-gram counts per
language, which add up over all labelled rows in one aggregation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.shingles import slices, string_buffers

UNKNOWN = "und"
#: Texts scored together; a text's counts take 256 KB.
SCORED = 64
#: Bytes whose n-grams are counted together.
SPAN = 1 << 20
_U = np.uint32


@dataclass(frozen=True)
class LanguageSpec:
    #: Bytes of an n-gram.
    sizes: tuple[int, ...] = (1, 2, 3, 4)
    #: Places that n-grams are hashed to, as a power of two.
    hash_bits: int = 15
    smoothing: float = 0.5
    #: Bits of a codeword are this many times the logarithm of the number of languages.
    code_factor: float = 10.0
    #: Languages for which all ways to split them in two become bits.
    exhaustive: int = 7
    #: N-grams from which on a text's evidence weighs in full.
    full_evidence: int = 60
    #: Codewords closer than this (difference of losses) make a text ambiguous.
    ambiguity: float = 0.25
    seed: int = 5

    @property
    def places(self) -> int:
        return 1 << self.hash_bits


_BYTES = np.arange(256)
_IS_LETTER = (_BYTES >= 128) | ((_BYTES >= 97) & (_BYTES <= 122))
_FOLDED = np.where(_IS_LETTER, _BYTES, 32).astype(_U)
_ASCII_LETTER = re.compile("[A-Za-z]")


def gram_places(raw: np.ndarray, spec: LanguageSpec) -> list[np.ndarray]:
    """For each size, the place of the n-gram that begins at each byte; -1 for none.

    What is no letter counts as a space, and n-grams hold no space but at their ends.
    """
    folded = _FOLDED[raw]
    space = folded == 32
    out = []
    for size in spec.sizes:
        n = len(folded) - size + 1
        if n <= 0:
            out.append(np.zeros(0, dtype=np.int32))
            continue
        code = np.full(n, size, dtype=_U)
        for k in range(size):
            code = (code ^ folded[k : k + n]) * _U(0x9E3779B1)
            code ^= code >> _U(15)
        place = (code >> _U(32 - spec.hash_bits)).astype(np.int32)
        if size == 1:
            place[space[:n]] = -1
        for k in range(1, size - 1):
            place[space[k : k + n]] = -1
        if size > 1:
            place[space[:n] & space[size - 1 :][:n] & (size == 2)] = -1
        out.append(place)
    return out


def gram_counts(
    raw: np.ndarray, offsets: np.ndarray, group: np.ndarray, n_groups: int, spec: LanguageSpec
) -> np.ndarray:
    """N-gram counts, a row for each group of texts. N-grams don't cross texts.

    Long texts are gone through in spans, so memory follows the span, not the text.
    """
    counts = np.zeros(n_groups * spec.places, dtype=np.int64)
    for begin in range(0, len(raw), SPAN):
        part = raw[begin : begin + SPAN + max(spec.sizes) - 1]
        sizes = np.diff(np.clip(offsets, begin, begin + len(part)))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        at = []
        for size, place in zip(spec.sizes, gram_places(part, spec), strict=True):
            place = place[:SPAN]
            n = len(place)
            inside = np.flatnonzero((place >= 0) & (owner[:n] == owner[size - 1 :][:n]))
            at.append(group[owner[inside]] * spec.places + place[inside])
        counts += np.bincount(np.concatenate(at), minlength=len(counts))
    return counts.reshape(n_groups, spec.places)


def _runs(
    batch: pa.RecordBatch, column: int, texts: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch, of so many texts at most, with their lower-case bytes and offsets."""
    raw, offsets = string_buffers(pc.utf8_lower(batch.column(column)))
    for a, b in slices(offsets, 1 << 20):
        for i in range(a, b, texts):
            part = offsets[i : min(i + texts, b) + 1]
            yield batch.slice(i, len(part) - 1), raw[part[0] : part[-1]], part - part[0]


def codewords(n: int, spec: LanguageSpec) -> np.ndarray:
    """A row of bits for each of n languages; columns split the languages in two."""
    if n <= 1:
        return np.zeros((n, 0), dtype=bool)
    if n <= spec.exhaustive:
        splits = np.arange(1, 2 ** (n - 1))
        return (splits[None, :] >> np.arange(n)[:, None] & 1).astype(bool)
    bits = int(np.ceil(spec.code_factor * np.log2(n)))
    rng = np.random.default_rng(spec.seed)
    best, widest = None, -1
    for _ in range(100):
        code = rng.random((n, bits)) < 0.5
        code = code[:, code.any(axis=0) & ~code.all(axis=0)]
        apart = min(int((code[i] != code[i + 1 :]).sum(axis=1).min()) for i in range(n - 1))
        if apart > widest:
            best, widest = code, apart
    return best


@dataclass(frozen=True)
class LanguageModel:
    """Languages, their codewords, and the bits' classifiers; a few MB."""

    languages: list[str]
    code: np.ndarray
    #: Log-odds of a bit per place, and of the bits' reliability.
    weights: np.ndarray
    trust: np.ndarray
    spec: LanguageSpec

    def decode(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language's index, its score from 0 to 1, and whether it is ambiguous."""
        total = counts.sum(axis=1)
        if self.code.shape[1] == 0:
            return np.zeros(len(counts), int), np.ones(len(counts)), np.zeros(len(counts), bool)
        evidence = np.minimum(total, self.spec.full_evidence) / np.maximum(total, 1)
        margin = counts @ self.weights * evidence[:, None]
        signs = np.where(self.code, 1.0, -1.0)
        loss = np.logaddexp(0, -margin[:, None, :] * signs[None]) @ self.trust
        best = loss.argmin(axis=1)
        likely = np.exp(loss.min(axis=1, keepdims=True) - loss)
        near = np.sort(loss, axis=1)
        return best, 1 / likely.sum(axis=1), near[:, 1] - near[:, 0] < self.spec.ambiguity


def train(labelled: DataFrame, spec: LanguageSpec) -> LanguageModel:
    """A model from all rows (text, lang) without nulls.

    The driver gets n-gram counts per language: languages x places numbers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, raw, offsets in _runs(batch, 0, batch.num_rows):
                langs, group = np.unique(part.column(1).to_pylist(), return_inverse=True)
                counts = gram_counts(raw, offsets, group, len(langs), spec)
                for lang, own in zip(langs.tolist(), counts, strict=True):
                    totals[lang] = totals.get(lang, 0) + own
        for lang, own in totals.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array(some), pa.array(own[some])],
                names=["lang", "place", "n"],
            )

    counted = (
        labelled.select("text", "lang")
        .mapInArrow(count, "lang string, place long, n long")
        .groupBy("lang", "place")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(counted["lang"].unique())
    shares = np.full((len(languages), spec.places), spec.smoothing)
    index = counted["lang"].map({lang: i for i, lang in enumerate(languages)})
    if len(counted):
        np.add.at(shares, (index.to_numpy(), counted["place"].to_numpy()), counted["n"].to_numpy())
    shares /= shares.sum(axis=1, keepdims=True)
    code = codewords(len(languages), spec)
    weights = np.zeros((spec.places, code.shape[1]))
    for b in range(code.shape[1]):
        on = code[:, b]
        weights[:, b] = np.log(shares[on].mean(axis=0)) - np.log(shares[~on].mean(axis=0))
    # A bit is as reliable as the margin of the language that it tells worst.
    worst = ((shares @ weights) * np.where(code, 1, -1)).min(axis=0, initial=np.inf)
    trust = np.maximum(worst, 1e-6)
    trust = trust / trust.sum() * len(trust)
    return LanguageModel(languages, code, weights, trust, spec)


def identify(
    docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, ambiguous.

    Null texts and texts without a letter are ``und`` with a score of 0, and so is
    everything where no language was learned. Ties go to the language first in the
    alphabet. Repeated rows are judged alike; an empty table gives an empty result; other
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for part, raw, offsets in _runs(batch, 1, SCORED):
                texts = part.column(1).to_pylist()
                known = np.array([bool(t) and _has_letter(t) for t in texts], dtype=bool)
                if model.languages:
                    own = np.arange(len(texts))
                    counts = gram_counts(raw, offsets, own, len(texts), model.spec)
                    best, score, unsure = model.decode(counts)
                else:
                    known[:] = False
                    best, score, unsure = (np.zeros(len(texts), t) for t in (int, float, bool))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(names[np.where(known, best, -1)], type=pa.string()),
                        pa.array(np.where(known, score, 0.0)),
                        pa.array(unsure & known),
                    ],
                    names=["doc_id", "lang_pred", "score", "ambiguous"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col))
    id_type = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(
        judge, f"doc_id {id_type}, lang_pred string, score double, ambiguous boolean"
    )


def _has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text)
