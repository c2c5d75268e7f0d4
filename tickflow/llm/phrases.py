"""Phrase collocations by SON: mine shards completely, then count the candidates exactly.

Documents are dealt to a few shards; a shard's local support is the support times the
shard's share of its language, so a phrase with the support has the local one in some
shard. A shard is no task's work: its counts are pre-aggregated by blocks of text and
summed by Spark, so shards stay few and the local support stays meaningful at any size.
Mining goes by levels. Words come first, then pairs of frequent words, then longer
phrases all of whose pairs are frequent in the shard; Bloom filters of bounded size tell
a block what to leave out, and let through too much at worst. What is frequent in any
shard is then counted over all documents, grouped by its text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.batches import gathered, small_batches
from tickflow.llm.bloom import Bloom
from tickflow.llm.rolling import LETTERS, PrefixHashes
from tickflow.llm.shingles import mix, slices, span_end, string_buffers
from tickflow.llm.text import or_empty
from tickflow.session import materialize

_U = np.uint64
_PLACE = _U(0x9E3779B97F4A7C15)
_BYTES = np.arange(256, dtype=np.uint8)
_FOLDED = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES).astype(np.uint8)
#: Characters that end a piece: punctuation, line feed, VT, FF, CR.
_IS_BREAK = np.isin(_BYTES, np.frombuffer(b".,;:!?\n\x0b\x0c\r", dtype=np.uint8))
_IS_WORD = ~(_IS_BREAK | np.isin(_BYTES, np.frombuffer(b" \t", dtype=np.uint8)))
_LETTERS = LETTERS[_FOLDED]
#: Bits of a key for the shard.
_SHARD, _KEY = _U(15), ~_U(15)
#: Bytes of text that are counted together before anything is shuffled.
BLOCK_BYTES = 1 << 22


@dataclass(frozen=True)
class PhraseSpec:
    longest: int = 4
    support: int = 30
    #: Shards that are mined on their own, 16 at most.
    shards: int = 4
    #: A candidate inside a longer one with this share (percent) of its count is dropped.
    covered_pct: int = 80
    scale: int = 2_000_000
    #: Phrases reported per language.
    top: int = 2000


class Block:
    """The words of some texts: their hashes, and the pieces they stand in."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray) -> None:
        self.chunks, hashes, starts, pieces, at, breaks = [], [], [], [], 0, 0
        while at < len(raw):
            end = span_end(raw, offsets, at)
            part = raw[at:end]
            body = _IS_WORD[part]
            edges = np.flatnonzero(body[1:] != body[:-1]) + 1
            inner = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
            inner = inner[inner > 0]
            # Where a text begins inside a run of letters, one word ends and one begins.
            inner = np.unique(inner[body[inner] & body[inner - 1]])
            outer = [np.zeros(int(body[0]), np.int64), np.full(int(body[-1]), len(part))]
            edges = np.concatenate([outer[0], edges, outer[1]])
            if len(inner):
                edges = np.sort(np.concatenate([edges, inner, inner]))
            begin, stop = edges[::2], edges[1::2]
            broken = np.cumsum(_IS_BREAK[part], dtype=np.int32)
            hashes.append(PrefixHashes(part, _LETTERS).between(begin, stop))
            self.chunks.append((part, body, stop - begin))
            starts.append(begin + at)
            pieces.append(broken[begin] + np.int32(breaks))
            breaks += int(broken[-1])
            at = end
        self.word = np.concatenate([np.zeros(0, dtype=_U), *hashes])
        begin = np.concatenate([np.zeros(0, dtype=np.int64), *starts])
        self.text = (np.searchsorted(offsets, begin, side="right") - 1).astype(np.int32)
        # Both parts never fall from word to word, so their sum tells pieces apart.
        self.piece = np.concatenate([np.zeros(0, dtype=np.int32), *pieces]) + self.text

    def dictionary(self) -> tuple[pa.Array, np.ndarray]:
        """The distinct words, and each word's place among them."""
        strings = [
            pa.LargeStringArray.from_buffers(
                len(sizes),
                pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)])),
                pa.py_buffer(_FOLDED[part[body]]),
            )
            for part, body, sizes in self.chunks
        ]
        if not strings:
            return pa.array([], pa.large_string()), np.zeros(0, dtype=np.int64)
        words = pa.chunked_array(strings).dictionary_encode().combine_chunks()
        return words.dictionary, np.asarray(words.indices, dtype=np.int64)

    def starts(self, n: int) -> np.ndarray:
        """Where n words in a row stand in one piece."""
        if len(self.piece) < n:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.piece[n - 1 :] == self.piece[: len(self.piece) - n + 1])


class _Langs:
    """Languages of a block's texts: names, and per text its place among them."""

    def __init__(self, column: pa.Array) -> None:
        coded = column.dictionary_encode()
        self.names, self.of = coded.dictionary, np.asarray(coded.indices, dtype=np.int64)
        own = [xxhash.xxh3_64_intdigest(x.encode(), seed=1) for x in self.names.to_pylist()]
        self.hash = np.array(own, dtype=_U)


def _keys(words: np.ndarray, lang: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n words from each of ``at`` on; ``lang`` has their languages' hashes.

    The lowest bits are free for a shard.
    """
    key = lang + _U(n)
    for k in range(n):
        key = (key ^ (key >> _U(29))) * _PLACE + words[at + k]
    return mix(key) & _KEY


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[Block, _Langs, int, int]]:
    raw, offsets = string_buffers(batch.column(0))
    for a, b in slices(offsets, BLOCK_BYTES, 1 << 30):
        part = offsets[a : b + 1]
        block = Block(raw[part[0] : part[-1]], part - part[0])
        yield block, _Langs(batch.column(1).slice(a, b - a)), a, b


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a sorted array, and their numbers."""
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(new)
    return ordered[at], np.diff(np.append(at, len(ordered)))


def _grouped(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A row's place and the number of rows, for rows that are equal in all columns."""
    group = np.zeros(len(columns[0]), dtype=np.int64)
    for column in columns:
        group = group * (int(column.max(initial=0)) + 1) + column
        _, first, group, counts = np.unique(
            group, return_index=True, return_inverse=True, return_counts=True
        )
    return first, counts


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase, key, f) of single words, for rows (_text, _lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, BLOCK_BYTES):
            for block, langs, _, _ in _blocks(batch):
                words, codes = block.dictionary()
                n = len(langs.names)
                pairs, counts = _runs(np.sort(codes * n + langs.of[block.text]))
                code, lang = pairs // max(n, 1), pairs % max(n, 1)
                raw, bounds = string_buffers(words)
                hashes = PrefixHashes(raw).between(bounds[:-1], bounds[1:])
                keys = _keys(hashes, langs.hash[lang], code, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.names.take(pa.array(lang)),
                        words.take(pa.array(code)).cast(pa.string()),
                        pa.array(keys.view(np.int64)),
                        pa.array(counts),
                    ],
                    names=["lang", "phrase", "key", "n"],
                )

    parts = texts.select("_text", "_lang").mapInArrow(count, "lang string, phrase string, key long, n long")
    return parts.groupBy("lang", "phrase").agg(F.max("key").alias("key"), F.sum("n").alias("f"))


def _frequent(texts: DataFrame, sizes: tuple[int, ...], words: Bloom, pairs: Bloom | None) -> DataFrame:
    """(key): phrases of the given sizes with the local support of a shard, whose number
    is in the key's lowest bits.

    ``texts``: _text, _lang, shard, need. Pairs are of frequent words; longer phrases of
    pairs that are frequent in the shard. Counts are summed as parts of the need.
    """

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, BLOCK_BYTES):
            for block, langs, a, b in _blocks(batch):
                shards, needs = (batch.column(i).slice(a, b - a).to_numpy() for i in (2, 3))
                lang = langs.hash[langs.of][block.text]
                shard = shards.astype(_U)[block.text]
                common = words.holds(_keys(block.word, lang, np.arange(len(block.word)), 1))
                two = block.starts(2)
                two = two[common[two] & common[two + 1]]
                if pairs:
                    two = two[pairs.holds(_keys(block.word, lang[two], two, 2) | shard[two])]
                linked = np.zeros(len(block.word) + max(sizes), dtype=bool)
                linked[two] = True
                for n in sizes:
                    at = two
                    for k in range(n - 1):
                        at = at[linked[at + k]]
                    at = at[block.piece[at + n - 1] == block.piece[at]]
                    keys = _keys(block.word, lang[at], at, n) | shard[at]
                    for i in range(len(langs.names)):
                        own = keys if len(langs.names) == 1 else keys[langs.of[block.text[at]] == i]
                        key, counts = _runs(np.sort(own))
                        need = np.ones(int(_SHARD) + 1)
                        mine_ = langs.of == i
                        need[shards[mine_]] = needs[mine_]
                        share = counts / need[(key & _SHARD).astype(np.int64)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key.view(np.int64)), pa.array(share)], names=["key", "share"]
                        )

    parts = texts.select("_text", "_lang", "shard", "need").mapInArrow(mine, "key long, share double")
    # Sums of quotients may fall short of one by their rounding.
    return parts.groupBy("key").agg(F.sum("share").alias("share")).filter("share > 1 - 1e-6").select("key")


def _counted(texts: DataFrame, candidates: Bloom, longest: int) -> DataFrame:
    """(lang, phrase, f) of phrases that may be candidates, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, BLOCK_BYTES):
            for block, langs, _, _ in _blocks(batch):
                (words, codes), of = block.dictionary(), langs.of[block.text]
                for n in range(2, longest + 1):
                    at = block.starts(n)
                    at = at[candidates.holds(_keys(block.word, langs.hash[of[at]], at, n))]
                    first, counts = _grouped([of[at], *[codes[at + k] for k in range(n)]])
                    at = at[first]
                    parts = [words.take(pa.array(codes[at + k])) for k in range(n)]
                    joined = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
                    yield pa.RecordBatch.from_arrays(
                        [langs.names.take(pa.array(of[at])), joined.cast(pa.string()), pa.array(counts)],
                        names=["lang", "phrase", "n"],
                    )

    parts = texts.select("_text", "_lang").mapInArrow(count, "lang string, phrase string, n long")
    return parts.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _exact(x: str | Column) -> Column:
    """For products beyond 64 bits."""
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(20,0)")


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _scored(candidates: DataFrame, counts: DataFrame, scale: int) -> DataFrame:
    """Candidates (lang, phrase, a) with l, r and score of the lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(words) - 1)))
    parts = cuts.select(
        *("lang", "phrase", "a", "k"),
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("is_first"), _part(words, F.lit(1), F.col("k")).alias("part")),
                F.struct(F.lit(False).alias("is_first"), _part(words, F.col("k") + 1, F.size(words)).alias("part")),
            )
        ).alias("_side"),
    ).select("lang", "phrase", "a", "k", "_side.is_first", "_side.part")
    known = parts.join(counts.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    side = lambda first: F.max(F.when(F.col("is_first") == first, F.col("f")))
    both = known.groupBy("lang", "phrase", "a", "k").agg(side(True).alias("l"), side(False).alias("r"))
    score = F.expr(f"cast({scale} * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + r) as long)")
    lowest = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_cut"))
    return lowest.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")


def _not_covered(candidates: DataFrame, pct: int) -> DataFrame:
    """Candidates without those that stand in a longer one nearly as often."""
    words = F.split("phrase", " ")
    n = F.size(words)
    longer = candidates.filter(n > 2).select("lang", F.col("a").alias("f"), words.alias("words"))
    size = F.size("words")
    inner = longer.withColumn("m", F.explode(F.sequence(F.lit(2), size - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)))
    inner = inner.select("lang", _part(F.col("words"), F.col("at"), F.col("m")).alias("phrase"), "f")
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("_most"))
    covered = _exact("_most") * 100 >= _exact("a") * pct
    left = candidates.join(most, ["lang", "phrase"], "left")
    return left.filter(F.col("_most").isNull() | ~covered).drop("_most")


def collocations(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    spec: PhraseSpec = PhraseSpec(),
) -> DataFrame:
    """Per language its highest-scoring phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase is two to ``longest`` words of one piece, A-Z lower-cased, joined by spaces;
    ``a`` counts its occurrences, ``n`` all words of the language, l and r the two parts
    of the cut where ``scale * a / (l + r)`` (floored) is lowest, the first of equals.
    Ranks go by score and a, descending, then by the phrase's bytes. Null texts are empty,
    null languages are ``und``; null and repeated ids make no difference, as ids only deal
    documents to shards. Repeated rows count each time. An empty table, or one without
    phrases of the support, gives an empty result; other columns are not read.
    """
    texts = docs.select(
        or_empty(text_col).alias("_text"),
        F.coalesce(F.col(lang_col), F.lit("und")).alias("_lang"),
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(spec.shards)).cast("int").alias("shard"),
    )
    with small_batches(docs.sparkSession):
        words = materialize(word_counts(texts), "words")
        frequent_words = Bloom(materialize(words.filter(F.col("f") >= spec.support).select("key"), "common"))
        # A shard's share of its language by characters; shares sum up to one.
        shares = texts.groupBy("_lang", "shard").agg(F.sum(F.length("_text").cast("long")).alias("chars"))
        whole = F.sum("chars").over(Window.partitionBy("_lang"))
        need = F.expr(
            f"cast(({spec.support} * cast(chars as decimal(20,0)) + whole - 1) div greatest(whole, 1) as long)"
        )
        shares = shares.withColumn("whole", whole).select("_lang", "shard", F.greatest(need, F.lit(1)).alias("need"))
        dealt = texts.join(materialize(shares, "shares"), ["_lang", "shard"])
        pairs = materialize(_frequent(dealt, (2,), frequent_words, None), "pairs")
        longer = _frequent(dealt, tuple(range(3, spec.longest + 1)), frequent_words, Bloom(pairs))
        in_any = F.col("key").bitwiseAND(F.lit(~int(_SHARD))).alias("key")
        mined = materialize(pairs.union(longer).select(in_any).distinct(), "mined")
        counted = materialize(
            _counted(texts, Bloom(mined), spec.longest).filter(F.col("f") >= spec.support), "counted"
        )
    candidates = counted.withColumnRenamed("f", "a")
    counts = counted.unionByName(words.filter(F.col("f") >= spec.support).drop("key"))
    scored = _scored(_not_covered(candidates, spec.covered_pct), counts, spec.scale)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= spec.top)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select(
        *("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
