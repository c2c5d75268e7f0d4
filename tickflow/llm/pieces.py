"""SentencePiece BPE with seeded merge-dropout, and its lossless decoding.

A text is segmented as a SentencePiece BPE model does it: of a word's agenda of
adjacent pairs, the one whose merged piece scores highest merges first, the leftmost
of equals. With dropout, each candidate merge is skipped or not by a coin: a hash keyed
with the seed, the document, its copy, the word's place in the text and what would be
merged. One seed always gives the same segmentation; other seeds, documents, copies and
places give other ones, all of them of the model's merges.

No piece spans the start of a word, so words are segmented on their own. A skipped merge
changes the outcome only if it would have been the next one. So the merges of a word
without skips are worked out once and kept; each occurrence tosses its coins along them,
and at the first skip goes on with the merges the word has without that one, which are
kept as well. Every pattern of skips has a segmentation of its own. What is met for the
first time is segmented by its coins directly and kept only when it comes again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.shingles import mix, string_buffers

SPACE = "\u2581"
#: Merges of words kept per task; beyond that, all go and are worked out anew.
KEPT = 1 << 19
#: Longer words hardly repeat; each occurrence is segmented by its own coins.
LONG = 20
#: Characters of text that are segmented, and handed on, together.
BATCH_CHARS = 1 << 20
_NORMAL, _BYTE = 1, 6
_NEVER = np.int32(2**31 - 1)
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


class _Grown:
    """An array that more is put at the end of."""

    def __init__(self, dtype) -> None:
        self.room, self.n = np.empty(1 << 12, dtype=dtype), 0

    def __getitem__(self, at):
        return self.room[: self.n][at]

    def extend(self, values: np.ndarray) -> None:
        end = self.n + len(values)
        if end > len(self.room):
            room = np.empty(max(end, 2 * len(self.room)), dtype=self.room.dtype)
            room[: self.n] = self.room[: self.n]
            self.room = room
        self.room[self.n : end] = values
        self.n = end


def _ragged(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each, count of them, one after the other."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


def cut_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units of texts, one after the other, and how many each text has.

    A unit is a word with the spaces before it, a line feed, or spaces before one or at
    the end. A text that isn't empty has a space put before it.
    """
    raw, offsets = string_buffers(texts)
    sizes = np.diff(offsets)
    some = np.flatnonzero(sizes)
    out = np.full(len(raw) + len(some), ord(" "), dtype=np.uint8)
    out[np.arange(len(raw)) + np.repeat(np.cumsum(sizes > 0), sizes)] = raw
    heads = offsets[some] + np.arange(len(some))
    space, line = out == ord(" "), out == ord("\n")
    first = line.copy()
    first[1:] |= line[:-1] | (space[1:] & ~space[:-1])
    first[heads] = True
    at = np.flatnonzero(first)
    counts = np.zeros(len(sizes), dtype=np.int64)
    counts[some] = np.diff(np.searchsorted(at, np.append(heads, len(out))))
    ends = np.append(at, len(out))
    units = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(out))
    return units, counts


class _Places:
    """Where each of some distinct keys stands; the last place, of no key, for others."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.shift = _U(64 - (8 * len(keys)).bit_length())
        self.table = np.full(1 << (64 - int(self.shift)), -1, dtype=np.int32)
        left, slot = np.arange(len(keys) - 1), self._slots(keys)
        while len(left):
            open_ = left[self.table[slot[left]] < 0]
            taken, one = np.unique(slot[open_], return_index=True)
            self.table[taken] = open_[one]
            left = left[self.table[slot[left]] != left]
            slot[left] = (slot[left] + 1) % len(self.table)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(_U) * _STEP) >> self.shift).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        at = self.table[slot]
        left = np.flatnonzero((at >= 0) & (self.keys[at] != keys))
        while len(left):
            slot[left] = (slot[left] + 1) % len(self.table)
            at[left] = self.table[slot[left]]
            left = left[(at[left] >= 0) & (self.keys[at[left]] != keys[left])]
        return at


class PieceModel:
    """A SentencePiece BPE model with byte fallback, read from its file.

    ``epoch`` is a part of the coins' key, next to the seed.
    """

    def __init__(self, path: str, seed: int, dropout: float, epoch: int = 0) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        plain = not (spec.precompiled_charsmap or spec.normalization_rule_tsv)
        if not plain or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("the model changes texts before it segments them")
        self.byte_ids, self.bytes, scored = [0] * 256, [], {}
        for i, p in enumerate(model.pieces):
            raw = b""
            if p.type == _NORMAL:
                if SPACE in p.piece.lstrip(SPACE) or "\n" in p.piece:
                    raise ValueError("a piece spans words; texts can't be cut at spaces")
                scored[p.piece] = (i, p.score)
                raw = p.piece.replace(SPACE, " ").encode()
            elif p.type == _BYTE:
                raw = bytes([int(p.piece[1:-1], 16)])
                self.byte_ids[raw[0]] = i
            self.bytes.append(raw)
        self.pieces = len(self.bytes)
        self.piece_at = np.cumsum([0, *map(len, self.bytes)])
        self.piece_bytes = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self._index(scored)
        self.key = mix(
            mix(np.array([seed % 2**64], dtype=_U)) + np.array([epoch % 2**64], dtype=_U) * _STEP
        )[0]
        self.limit = _U(round(dropout * 2**53))
        self._forget()

    def _forget(self) -> None:
        """No words are kept: a state is a word and the merges it has skipped so far."""
        self.roots: dict[str, int] = {}
        self.skips: list[tuple[str, tuple[int, ...]]] = []
        #: Where the merges and ids of a state begin; one entry more than states.
        self.merge_at, self.id_at = _Grown(np.int64), _Grown(np.int64)
        self.merge_at.extend([0])
        self.id_at.extend([0])
        #: Per merge: its span, the hash of that, and the state that skips it; -1 where no
        #: occurrence did so far, -2 where one did.
        self.spans, self.hashes, self.child = _Grown(np.int64), _Grown(_U), _Grown(np.int64)
        self.ids = _Grown(np.int32)

    def _index(self, scored: dict[str, tuple[int, float]]) -> None:
        """Symbols by code point, and what each pair of symbols merges to, by rank."""
        symbols = {piece: i for piece, (i, _) in scored.items()}
        for char in sorted(set("".join(scored))):
            symbols.setdefault(char, len(self.bytes) + len(symbols))
        self.chars = np.full(0x110000, -1, dtype=np.int64)
        for symbol, i in symbols.items():
            if len(symbol) == 1:
                self.chars[ord(symbol)] = i
        # A space is the model's space mark; a mark in the text is spelled in bytes.
        self.chars[ord(" ")], self.chars[ord(SPACE)] = self.chars[ord(SPACE)], -1
        order = sorted({-score for _, score in scored.values()})
        place = {score: i for i, score in enumerate(order)}
        pairs = sorted(
            (symbols[piece[:k]] << 32 | symbols[piece[k:]], place[-score], i)
            for piece, (i, score) in scored.items()
            for k in range(1, len(piece))
            if piece[:k] in symbols and piece[k:] in symbols
        )
        self.places = _Places(np.array([p[0] for p in pairs] + [2**62], dtype=np.int64))
        self.ranks = np.array([p[1] for p in pairs] + [_NEVER], dtype=np.int32)
        self.merged = np.array([p[2] for p in pairs] + [-1], dtype=np.int64)
        # A piece is last if no merge with it comes before or with its own: then all its
        # merges in a word can be made at once.
        own = np.full(max(symbols.values()) + 1, -1)
        for i, score in scored.values():
            own[i] = place[-score]
        self.last = np.bincount(own + 1, minlength=len(order) + 1)[own + 1] == 1
        keys = self.places.keys[:-1]
        for part in (keys >> 32, keys & (2**32 - 1)):
            self.last[part[self.ranks[:-1] <= own[part]]] = False

    def _candidates(self, left, right):
        """Rank and merged symbol of adjacent symbols."""
        at = self.places.of(np.where((left < 0) | (right < 0), -1, left << 32 | right))
        return self.ranks[at], self.merged[at]

    def _hashed(self, span: np.ndarray) -> np.ndarray:
        return mix(span.astype(_U) + self.key)

    def _skipped(self, coins: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        return (mix(coins ^ hashes) >> _U(11)) < self.limit

    def segment(self, units: list[str], coins: np.ndarray) -> list[bytes]:
        """Ids (32 bits each) of units, each with the coins given for it."""
        coins = coins.astype(_U)

        def skipped(word: np.ndarray, span: np.ndarray) -> np.ndarray:
            return self._skipped(coins[word], self._hashed(span))

        return self._merge(units, skipped if self.limit else None)[0]

    def _merge(self, units: list[str], skipped) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of units, and the merges made: word and span, in order.

        ``skipped`` tells of words and spans which are not to be merged. All units'
        agendas are worked off together, the merges of one piece of each in a round.
        """
        lengths = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        first = np.cumsum(lengths) - lengths
        codes = np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32)
        word = np.repeat(np.arange(len(units)), lengths)
        start = np.arange(len(codes)) - first[word]
        symbol, done, merges = self.chars[codes], [], []

        def spanned(at: np.ndarray) -> np.ndarray:
            """Start, middle and end of the pairs of the symbols at ``at``, as one number."""
            after = np.minimum(at + 2, len(word) - 1)
            last = (at + 2 >= len(word)) | (word[after] != word[at])
            end = np.where(last, lengths[word[at]], start[after])
            return (start[at] << 42) + (start[at + 1] << 21) + end

        def ranked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Of the pairs of the symbols at ``at`` with their right neighbours."""
            rank, result = self._candidates(symbol[at], symbol[at + 1])
            if skipped:
                some = np.flatnonzero(rank != _NEVER)
                rank[some[skipped(word[at[some]], spanned(at[some]))]] = _NEVER
            return rank, result

        rank = np.full(len(symbol), _NEVER, dtype=np.int32)
        result = np.full(len(symbol), -1, dtype=np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], result[inner] = ranked(inner)
        while len(symbol):
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(heads, len(word)))
            best = np.minimum.reduceat(rank, heads)
            top = np.repeat(best, sizes)
            open_ = top != _NEVER
            if not open_.all():
                done.append((word[~open_], start[~open_], symbol[~open_]))
            hits = np.flatnonzero((rank == top) & open_)
            if len(hits):
                # The leftmost one, or every one that no earlier one takes a symbol from.
                each = np.arange(len(hits))
                run = np.maximum.accumulate(np.where(np.diff(hits, prepend=-2) > 1, each, 0))
                free = self.last[result[hits]] & ((each - run) % 2 == 0)
                hits = hits[free | (np.diff(word[hits], prepend=-1) > 0)]
            merges.append((word[hits], spanned(hits)))
            symbol[hits] = result[hits]
            stay = open_
            stay[hits + 1] = False
            moved = (np.cumsum(stay) - 1)[hits]
            symbol, word, start, rank, result = (
                x[stay] for x in (symbol, word, start, rank, result)
            )
            rank[moved] = _NEVER
            # New pairs: with the right neighbour, and of the left one with the merged piece.
            right = moved[moved + 1 < len(word)]
            right = right[word[right + 1] == word[right]]
            left = moved[moved > 0] - 1
            left = left[word[left] == word[left + 1]]
            for at in (right, left):
                if len(at):
                    rank[at], result[at] = ranked(at)
        word, start, symbol = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.lexsort((start, word))
        ids = self._spelled(units, word[order], start[order], symbol[order])
        owner, span = (np.concatenate(x) for x in zip(*merges, strict=True))
        order = np.argsort(owner, kind="stable")
        return ids, owner[order], span[order]

    def _spelled(self, units, word, start, symbol) -> list[bytes]:
        """Ids as bytes per unit; symbols that are no piece are spelled byte by byte."""
        raw = symbol.astype("<i4").tobytes()
        bounds = (np.searchsorted(word, np.arange(len(units) + 1)) * 4).tolist()
        out = [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in np.unique(word[(symbol < 0) | (symbol >= self.pieces)]).tolist():
            ids = []
            for k in range(bounds[i] // 4, bounds[i + 1] // 4):
                if 0 <= symbol[k] < self.pieces:
                    ids.append(symbol[k])
                else:
                    spelled = units[i][start[k]].replace(" ", SPACE).encode()
                    ids.extend(self.byte_ids[b] for b in spelled)
            out[i] = np.array(ids, dtype="<i4").tobytes()
        return out

    def _keep(self, states: list[tuple[str, tuple[int, ...]]]) -> np.ndarray:
        """Work out new states: words with the spans of the merges they skip."""
        # Kept words are short, so that a word's number and a span fit in one.
        def packed(word: np.ndarray, span: np.ndarray) -> np.ndarray:
            return (word << 15) + (span >> 42 << 10) + ((span >> 21 & 31) << 5) + (span & 31)

        counts = np.array([len(skips) for _, skips in states])
        gone = np.fromiter(chain.from_iterable(skips for _, skips in states), dtype=np.int64)
        gone = np.append(np.sort(packed(np.repeat(np.arange(len(states)), counts), gone)), 2**62)

        def skipped(word: np.ndarray, span: np.ndarray) -> np.ndarray:
            key = packed(word, span)
            return gone[np.searchsorted(gone, key)] == key

        units = [unit for unit, _ in states]
        ids, owner, span = self._merge(units, skipped if len(gone) > 1 else None)
        new = len(self.skips) + np.arange(len(states))
        self.skips.extend(states)
        ends = np.cumsum(np.bincount(owner, minlength=len(states)))
        self.merge_at.extend(self.merge_at[-1] + ends)
        self.id_at.extend(self.ids.n + np.cumsum([len(x) // 4 for x in ids]))
        self.spans.extend(span)
        self.hashes.extend(self._hashed(span))
        self.child.extend(np.full(len(span), -1))
        self.ids.extend(np.frombuffer(b"".join(ids), dtype="<i4"))
        return new

    def _walk(self, state: np.ndarray, coins: np.ndarray) -> np.ndarray:
        """The states occurrences end in, or -1: coins are tossed along the merges."""
        state = state.copy()
        left, begin = np.arange(len(state)), self.merge_at[state]
        while len(left):
            count = self.merge_at[state[left] + 1] - begin
            at = _ragged(begin, count)
            owner = np.repeat(np.arange(len(left)), count)
            hit = np.flatnonzero(self._skipped(coins[left][owner], self.hashes[at]))
            hit = hit[np.diff(owner[hit], prepend=-1) > 0]
            at, left = at[hit], left[owner[hit]]
            new, times = np.unique(at[self.child[at] < 0], return_counts=True)
            again = (times > 1) | (self.child[new] == -2)
            self.child.room[new[~again]] = -2
            new = new[again]
            if len(new):
                parents = np.searchsorted(self.merge_at[:], new, side="right") - 1
                pairs = zip(parents.tolist(), self.spans[new].tolist(), strict=True)
                more = [(self.skips[p][0], (*self.skips[p][1], span)) for p, span in pairs]
                # The child has the same merges up to the skipped one.
                self.child.room[new] = self._keep(more)
            go = self.child[at] >= 0
            state[left[~go]] = -1
            at, left = at[go], left[go]
            place = at - self.merge_at[state[left]]
            state[left] = self.child[at]
            begin = self.merge_at[state[left]] + place
        return state

    def _coins(self, counts: np.ndarray, places: list[int], copies: list[int] | None) -> np.ndarray:
        """Keys of the words' coins, by the texts' numbers of words, numbers and copies."""
        document = mix(np.array(places, dtype=np.int64).astype(_U) + self.key)
        if copies is not None:
            document = mix(document + np.array(copies, dtype=np.int64).astype(_U) * _STEP)
        nth = _ragged(np.ones(len(counts), dtype=np.int64), counts).astype(_U)
        return mix(np.repeat(document, counts) + nth * _STEP)

    def encode(
        self, texts: list[str] | pa.Array, places: list[int], copies: list[int] | None = None
    ) -> list[bytes]:
        """Ids (32 bits each) of texts; coins go by the document's number and copy."""
        if max(self.spans.n, len(self.roots)) > KEPT:
            self._forget()
        texts = pa.array(texts, type=pa.string()) if isinstance(texts, list) else texts
        units, counts = cut_units(texts)
        if not len(units):
            return [b""] * len(texts)
        coded = units.dictionary_encode()
        code, names = np.asarray(coded.indices, dtype=np.int64), coded.dictionary.to_pylist()
        coins = self._coins(counts, places, copies)
        roots = [self.roots.get(unit) for unit in names]
        new = []
        for i, times in enumerate(np.bincount(code, minlength=len(names)).tolist()):
            if roots[i] is None or roots[i] < 0:
                unit = names[i]
                if len(unit) > LONG:
                    roots[i] = -1
                elif times > 1 or roots[i] is not None:
                    new.append(i)
                else:
                    roots[i] = self.roots[unit] = -1
        if new:
            kept = self._keep([(names[i], ()) for i in new]).tolist()
            for i, state in zip(new, kept, strict=True):
                roots[i] = self.roots[names[i]] = state
        root = np.array(roots, dtype=np.int64)[code]
        begin, end = np.empty(len(code), dtype=np.int64), np.empty(len(code), dtype=np.int64)
        if self.limit:
            known = np.flatnonzero(root >= 0)
            root[known] = self._walk(root[known], coins[known])
        known, own = np.flatnonzero(root >= 0), np.flatnonzero(root < 0)
        begin[known], end[known] = self.id_at[root[known]], self.id_at[root[known] + 1]
        kept = self.ids.n
        if len(own):
            ids = self.segment([names[i] for i in code[own].tolist()], coins[own])
            end[own] = kept + np.cumsum([len(x) // 4 for x in ids])
            begin[own] = np.append(kept, end[own][:-1])
            self.ids.extend(np.frombuffer(b"".join(ids), dtype="<i4"))
        raw = self.ids[_ragged(begin, end - begin)].astype("<i4").tobytes()
        self.ids.n = kept
        ends = np.append(0, np.cumsum(end - begin))[np.append(0, np.cumsum(counts))] * 4
        return [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts of ids in a row, each from one of ``bounds`` to the next."""
        sizes = self.piece_at[ids + 1] - self.piece_at[ids]
        raw = self.piece_bytes[_ragged(self.piece_at[ids], sizes)]
        ends = np.append(0, np.cumsum(sizes))[bounds]
        some = np.flatnonzero(np.diff(ends))
        if (raw[ends[some]] == ord(" ")).all():
            kept = np.ones(len(raw), dtype=bool)
            kept[ends[some]] = False
            ends = ends - np.append(0, np.cumsum(np.diff(ends) > 0))
            buffers = [pa.py_buffer(ends), pa.py_buffer(raw[kept])]
            texts = pa.LargeStringArray.from_buffers(len(bounds) - 1, *buffers)
            try:
                texts.validate(full=True)
                return texts.cast(pa.string())
            except pa.ArrowInvalid:
                pass
        own = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        return pa.array([self.decode(ids[a:b].tolist()) for a, b in own], type=pa.string())

    def decode(self, ids: list[int]) -> str:
        """The text of ids; of an invalid byte sequence, replacement characters."""
        table = self.bytes
        return b"".join([table[i] for i in ids]).decode(errors="replace")[1:]


def runs(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts (or lists) in ``column`` have a bounded length."""
    lengths = pc.fill_null(
        (pc.list_value_length if pa.types.is_list(batch.column(column).type) else pc.utf8_length)(
            batch.column(column)
        ),
        0,
    ).to_numpy()
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        before = ends[at] - lengths[at]
        end = max(int(np.searchsorted(ends, before + BATCH_CHARS, side="right")), at + 1)
        yield batch.slice(at, end - at)
        at = end


@lru_cache(maxsize=2)
def piece_model(path: str, seed: int, dropout: float) -> PieceModel:
    return PieceModel(path, seed, dropout)


def encode_pieces(
    docs: DataFrame,
    model_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 11,
    dropout: float = 0.1,
    copy: Column | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: the carried columns, then ``ids`` (array of int).

    Null and empty texts have no ids. Rows that repeat an id and a text have the same
    ids unless ``copy``, a whole number such as the epoch, tells them apart; for a null id
    stands a hash of the text. An empty table gives an empty result. The model file must
    be at ``model_path`` wherever tasks run. ``carry`` names columns of ``docs`` to keep;
    others are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path, seed, dropout)
        for batch in batches:
            for part in runs(batch, 1):
                numbers = [
                    zlib.crc32((part.column(1)[i].as_py() or "").encode()) if n is None else n
                    for i, n in enumerate(part.column(0).to_pylist())
                ]
                found = model.encode(part.column(1), numbers, part.column(2).to_pylist())
                bounds = np.cumsum([0, *(len(ids) // 4 for ids in found)])
                lists = pa.ListArray.from_arrays(
                    pa.array(bounds, type=pa.int32()),
                    pa.array(np.frombuffer(b"".join(found), dtype="<i4")),
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[3:], lists], names=[*carry, "ids"]
                )

    types = dict(docs.dtypes)
    names = [f"`{c}` {types[c]}" for c in carry]
    inner = docs.select(
        F.col(id_col).cast("long").alias("_number"),
        F.col(text_col).alias("_text"),
        (F.lit(0) if copy is None else copy).cast("long").alias("_copy"),
        *[F.col(c).alias(f"_{i}") for i, c in enumerate(carry)],
    )
    return inner.mapInArrow(encode, ", ".join([*names, "ids array<int>"]))


def decode_pieces(
    encoded: DataFrame, model_path: str, *, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per input row: the carried columns, then ``text`` from ``ids``.

    No ids (or null) give the empty text. Segmentations of any seed decode alike.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path, 0, 0.0)
        for batch in batches:
            for part in runs(batch, 0):
                lists = part.column(0)
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                ids = lists.flatten().to_numpy().astype(np.int64)  # without those of null lists
                texts = model.decode_all(ids, np.append(0, np.cumsum(sizes)))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], texts], names=[*carry, "text"])

    types = dict(encoded.dtypes)
    names = [f"`{c}` {types[c]}" for c in carry]
    inner = encoded.select("ids", *[F.col(c).alias(f"_{i}") for i, c in enumerate(carry)])
    return inner.mapInArrow(decode, ", ".join([*names, "text string"]))
