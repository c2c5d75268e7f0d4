"""Repeated passages: distributed merge sort of suffixes that knows common prefixes.

Every byte covered by a string of ``length`` bytes that also starts elsewhere goes. Such
a string, a window, has an anchor: of its grams the one with the least hash, the leftmost
of equals. Equal windows have their anchors at equal places, so only suffixes at anchors
are sorted: to the right as far as the anchor's windows reach, and then on with the bytes
to the left, backwards. Windows that share an anchor follow each other, so there is about
one suffix in 170 bytes.

Blocks of texts sort their suffixes and front-code them; ranges of prefix hashes are
exchanged, and in a range the blocks' runs are merged by a loser tree. In merged order
the shared lengths tell which suffixes agree far enough to the right, and the same for
the left sides which agree far enough to the left; two windows are equal if both hold.

Two screens keep text out of the exchange, with counts that are summed before they are
shuffled. Anchors whose gram is nowhere else have no equal window. Where a gram is very
frequent, its windows are taken in parts of ``width``; a part's suffix is sorted only if
the core that all its windows share is found again, and goes to a range by its core.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.bloom import Bloom
from tickflow.llm.rolling import PrefixHashes
from tickflow.llm.shingles import mix, slices, string_buffers
from tickflow.llm.slots import bitmap, with_hit
from tickflow.llm.suffix_runs import front_code, front_decode, merge_runs
from tickflow.llm.text import or_empty
from tickflow.session import materialize

_U = np.uint64
#: Window starts that are worked on together.
SPAN = 1 << 20
#: Bytes of text that are sorted into one run; suffixes of a run.
RUN_BYTES, RUN_SUFFIXES = 1 << 23, 1 << 15
MEASURES = ("n_bytes", "n_removed", "n_spans", "kept_bytes")
_PLACES = _U((1 << 24) - 1)


@dataclass(frozen=True)
class PassageSpec:
    #: Bytes of a window.
    length: int = 400
    #: Bytes of a gram; an anchor is one of a window's grams.
    gram: int = 64
    #: Windows of a frequent gram that are taken together.
    width: int = 32
    #: Suffixes with one gram beyond which it is frequent.
    frequent: int = 256
    #: Suffixes that a range holds on average.
    per_range: int = 10_000

    @property
    def reach(self) -> int:
        """Places that a window's anchor can have."""
        return self.length - self.gram + 1


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=_U)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    on = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(on[:n], upto[width - 1 : width - 1 + n])


@dataclass
class Suffixes:
    """Suffixes at ``start``, whose windows start ``low`` to ``high`` bytes before it."""

    text: np.ndarray
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray
    #: Hash of the prefix that all of a suffix's windows have.
    prefix: np.ndarray

    def take(self, at: np.ndarray) -> Suffixes:
        return Suffixes(self.text[at], self.start[at], self.low[at], self.high[at], self.prefix[at])


def anchored(
    raw: np.ndarray, offsets: np.ndarray, spec: PassageSpec
) -> Iterator[tuple[Suffixes, PrefixHashes, int]]:
    """Per span of some texts its anchors, its hashes and where it begins."""
    for at in range(0, len(raw) - spec.length + 1, SPAN):
        part = raw[at : at + SPAN + spec.length - 1]
        hashes = PrefixHashes(part)
        grams = hashes.all(spec.gram)
        places = np.arange(len(grams), dtype=_U)
        best = (_least((grams & ~_PLACES) | places, spec.reach) & _PLACES).astype(np.int64)
        inside = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, at + len(part))] - at
        cuts = np.concatenate([inside, inside - spec.length + 1])
        first = np.zeros(len(best) + 1, dtype=bool)
        first[1:-1] = best[1:] != best[:-1]
        first[cuts[(cuts >= 0) & (cuts < len(best))]] = True
        first[[0, -1]] = True
        bounds = np.flatnonzero(first)
        begin, last = bounds[:-1], bounds[1:] - 1
        text = np.searchsorted(offsets, begin + at, side="right") - 1
        whole = begin + at + spec.length <= offsets[text + 1]
        begin, last, text = begin[whole], last[whole], text[whole]
        anchor = best[begin]
        # Mixed anew: the least hashes of windows are small.
        prefix = mix(grams[anchor])
        yield Suffixes(text, anchor + at, anchor - last, anchor - begin, prefix), hashes, at


def _parts(found: Suffixes, hashes: PrefixHashes, at: int, spec: PassageSpec) -> Suffixes:
    """The suffixes cut into parts of ``width`` windows, with the hashes of their cores."""
    first, last = found.low // spec.width, found.high // spec.width
    count = last - first + 1
    owner = np.repeat(np.arange(len(first)), count)
    shift = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]) * spec.width
    start = found.start[owner] - shift
    low = np.maximum(found.low[owner] - shift, 0)
    high = np.minimum(found.high[owner] - shift, spec.width - 1)
    cores = hashes.at(start - at, spec.length - spec.width + 1) + _U(1)
    return Suffixes(found.text[owner], start, low, high, cores)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    raw, offsets = string_buffers(batch.column(0))
    for a, b in slices(offsets, RUN_BYTES, 1 << 30):
        part = offsets[a : b + 1]
        yield raw[part[0] : part[-1]], part - part[0], a, b


def _counts(texts: DataFrame, spec: PassageSpec, grams: tuple[Bloom, Bloom] | None) -> DataFrame:
    """(key, n): how many suffixes have a prefix; with ``grams`` (shared, frequent ones),
    parts of the suffixes with a frequent one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, offsets, _, _ in _texts(batch):
                keys = [np.zeros(0, dtype=_U)]
                for found, hashes, at in anchored(raw, offsets, spec):
                    if grams:
                        often = grams[1].holds(found.prefix)
                        found = _parts(found.take(np.flatnonzero(often)), hashes, at, spec)
                    keys.append(found.prefix)
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"]
                )

    parts = texts.select("_text").mapInArrow(count, "key long, n long")
    return parts.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")


class _Screens:
    """What tells tasks which suffixes may have equal windows elsewhere."""

    def __init__(self, texts: DataFrame, spec: PassageSpec) -> None:
        self.spec = spec
        grams = materialize(_counts(texts, spec, None), "grams")
        often = materialize(grams.filter(F.col("n") > spec.frequent), "often")
        self.shared, self.often = Bloom(grams), Bloom(often)
        self.any_often = not often.isEmpty()
        self.cores = self.shared
        if self.any_often:
            self.cores = Bloom(materialize(_counts(texts, spec, (self.shared, self.often)), "cores"))
        self.suffixes = grams.agg(F.sum("n")).first()[0] or 0

    def open(self, raw: np.ndarray, offsets: np.ndarray) -> Suffixes:
        """The suffixes of some texts that may have equal windows."""
        kept = []
        for found, hashes, at in anchored(raw, offsets, self.spec):
            found = found.take(np.flatnonzero(self.shared.holds(found.prefix)))
            if self.any_often:
                often = self.often.holds(found.prefix)
                parts = _parts(found.take(np.flatnonzero(often)), hashes, at, self.spec)
                kept.append(parts.take(np.flatnonzero(self.cores.holds(parts.prefix))))
                found = found.take(np.flatnonzero(~often))
            kept.append(found)
        names = ("text", "start", "low", "high", "prefix")
        if not kept:
            return Suffixes(*[np.zeros(0, dtype=np.int64)] * 4, np.zeros(0, dtype=_U))
        return Suffixes(*[np.concatenate([getattr(k, n) for k in kept]) for n in names])


def _packed(columns: list[np.ndarray], strings: list[bytes], many: np.ndarray) -> bytes:
    """A run as bytes: its front-coded strings, and per suffix right and left length, whether
    it stands for several, its start and the two hashes of its text."""
    shared, rests = front_code(strings)
    parts = [shared, *(columns[i].astype(np.uint16) for i in (0, 1)), many.astype(np.uint8), *columns[2:]]
    return struct.pack("<I", len(strings)) + b"".join(p.tobytes() for p in parts) + rests


class _Run:
    """A run read from bytes."""

    def __init__(self, raw: bytes) -> None:
        (n,) = struct.unpack_from("<I", raw)
        at, read = 4, []
        for kind in ("u2", "u2", "u2", "u1", "i8", "i8", "i8"):
            read.append(np.frombuffer(raw, dtype="<" + kind, count=n, offset=at))
            at += n * read[-1].itemsize
        self.shared, right, left, self.many, *self.place = read
        self.right, self.left = right.astype(np.int64), left.astype(np.int64)
        self.strings = front_decode(self.shared, self.right + self.left, raw[at:])


RUN = "range long, run binary, ta long, tb long, first long, last long"


def _runs(texts: DataFrame, screens: _Screens, ranges: int) -> DataFrame:
    """Rows with the runs per range, and rows with spans (first, last) of texts.

    Suffixes that are equal in all windows stand once in a run; the spans of the others,
    which repeat it, are sent at once.
    """
    spec = screens.spec

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [batch.column(c).to_numpy() for c in (1, 2)]
            for raw, offsets, a, _ in _texts(batch):
                found = screens.open(raw, offsets)
                data = raw.tobytes()
                for i in range(0, len(found.start), RUN_SUFFIXES):
                    part = found.take(slice(i, i + RUN_SUFFIXES))
                    yield from sorted_run(part, data, offsets, [h[a:] for h in hashes])

    def sorted_run(part: Suffixes, data: bytes, offsets: np.ndarray, hashes) -> Iterator[pa.RecordBatch]:
        right, left = spec.length - part.low, part.high
        place = ((part.prefix >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int64)
        strings = [
            data[s : s + r] + data[s - n : s][::-1]
            for s, r, n in zip(part.start.tolist(), right.tolist(), left.tolist(), strict=True)
        ]
        keys = [(p, s) for p, s in zip(place.tolist(), strings, strict=True)]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)
        strings = [strings[i] for i in order.tolist()]
        right, left, place = right[order], left[order], place[order]
        again = np.zeros(len(order), dtype=bool)
        again[1:] = [x == y for x, y in zip(strings[1:], strings[:-1], strict=True)]
        again[1:] &= (right[1:] == right[:-1]) & (place[1:] == place[:-1])
        many = np.append(again[1:], False)
        text = part.text[order]
        own = [h[text] for h in hashes]
        start = part.start[order] - offsets[text]
        new = np.flatnonzero(~again)
        cuts = np.flatnonzero(np.diff(place[new])) + 1
        rows = []
        for group in np.split(new, cuts):
            columns = [x[group] for x in (right, left, start, *own)]
            run = _packed(columns, [strings[i] for i in group.tolist()], many[group])
            rows.append((int(place[group[0]]), run))
        empty = pa.nulls(len(rows), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), *[empty] * 4],
            names=["range", "run", "ta", "tb", "first", "last"],
        )
        at = np.flatnonzero(again)
        if len(at):
            first, last = start[at] - left[at], start[at] + right[at]
            yield _span_rows(own[0][at], own[1][at], first, last)

    return texts.select("_text", "_ta", "_tb").mapInArrow(sort, RUN)


def _merged(ta: np.ndarray, tb: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Spans of texts, those that touch as one, ordered by text and place."""
    if not len(ta):
        return ta, tb, first, last
    order = np.lexsort((first, tb, ta))
    ta, tb, first, last = (x[order] for x in (ta, tb, first, last))
    new = np.ones(len(ta), dtype=bool)
    new[1:] = (ta[1:] != ta[:-1]) | (tb[1:] != tb[:-1])
    # Ends of earlier texts must not reach into later ones.
    group = np.cumsum(new)
    lift = group * (int(last.max(initial=0)) + 2)
    reach = np.maximum.accumulate(last + lift)
    new[1:] |= first[1:] + lift[1:] > reach[:-1]
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(ta)) - 1
    return ta[at], tb[at], first[at], (reach - lift)[ends]


def _span_rows(ta, tb, first, last) -> pa.RecordBatch:
    spans = _merged(ta, tb, first, last)
    n = len(spans[0])
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), *[pa.array(x) for x in spans]],
        names=["range", "run", "ta", "tb", "first", "last"],
    )


def repeated_windows(right: np.ndarray, left: np.ndarray, many: np.ndarray, sides, spec: PassageSpec) -> np.ndarray:
    """Per suffix of a merged range and offset: whether that window has an equal one.

    ``right`` and ``left`` are the suffixes' lengths to both sides, in merged order;
    ``sides`` their shared lengths in merged order, the order of their left sides and
    shared lengths in that.
    """
    shared, by_left, shared_left = sides
    n = len(right)
    low, out = spec.length - right, np.zeros((n, spec.reach), dtype=bool)
    of_left = np.empty(n, dtype=np.int64)
    for offset in range(int(low.min(initial=0)), int(left.max(initial=-1)) + 1):
        at = np.flatnonzero((low <= offset) & (offset <= left))
        if len(at) > 1 or many[at].any():
            rights = np.cumsum(shared < spec.length - offset)
            of_left[by_left] = np.cumsum(shared_left < offset)
            key = rights[at] * (n + 1) + of_left[at]
            _, group, count = np.unique(key, return_inverse=True, return_counts=True)
            count = count + np.bincount(group, many[at], len(count))
            out[at, offset] = count[group] > 1
    return out


def _repeats(runs: DataFrame, spec: PassageSpec) -> DataFrame:
    """Spans (ta, tb, first, last) of windows with equal ones, by merging each range's runs."""

    def merge(rows: pa.Table) -> pa.Table:
        read = [_Run(raw) for raw in rows["run"].to_pylist()]
        origin, shared = merge_runs([(r.strings, r.shared) for r in read])
        origin, shared = np.array(origin), np.array(shared)
        # The merged order as places in all runs in a row.
        order = np.empty(len(origin), dtype=np.int64)
        order[np.argsort(origin, kind="stable")] = np.arange(len(origin))
        column = lambda name: np.concatenate([getattr(r, name) for r in read])[order]
        right, left, many = column("right"), column("left"), column("many").astype(bool)
        start, ta, tb = (np.concatenate([r.place[i] for r in read])[order] for i in range(3))
        strings = [s for r in read for s in r.strings]
        # Suffixes with equal sides are one; it stands for several.
        same = np.zeros(len(order), dtype=bool)
        whole = right + left
        same[1:] = (shared[1:] == whole[1:]) & (whole[1:] == whole[:-1]) & (right[1:] == right[:-1])
        one = np.flatnonzero(~same)
        group = np.cumsum(~same) - 1
        several = (np.bincount(group, minlength=len(one)) > 1) | (np.bincount(group, many, len(one)) > 0)
        backward = [strings[order[i]][right[i] :] for i in one.tolist()]
        by_left = np.array(sorted(range(len(one)), key=backward.__getitem__), dtype=np.int64)
        shared_left = front_code([backward[i] for i in by_left.tolist()])[0].astype(np.int64)
        sides = (shared[one], by_left, shared_left)
        windows = repeated_windows(right[one], left[one], several, sides, spec)
        step = np.diff(np.pad(windows, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        who, low = np.nonzero(step == 1)
        high = np.nonzero(step == -1)[1] - 1
        # Every suffix of a group has the group's spans.
        count = np.bincount(who, minlength=len(one))
        at = np.cumsum(count) - count
        each = count[group]
        member = np.repeat(np.arange(len(group)), each)
        span = np.arange(len(member)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(at[group], each)
        first = start[member] - high[span]
        last = start[member] - low[span] + spec.length
        spans = _merged(ta[member], tb[member], first, last)
        return pa.table([pa.array(x) for x in spans], names=["ta", "tb", "first", "last"])

    return runs.groupBy("range").applyInArrow(merge, "ta long, tb long, first long, last long")


def _cut(texts: DataFrame) -> DataFrame:
    """Rows (_text, _spans, _carry) with their measures and the bytes that are left."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffers(batch.column(0))
            data, removed, spans, kept = raw.tobytes(), [], [], []
            for a, b, own in zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch.column(1).to_pylist(), strict=True):
                at, left, n = a, [], 0
                for first, last in _joined(own or []):
                    left.append(data[at : a + first])
                    at, n = a + last, n + 1
                left.append(data[at:b])
                kept.append(b"".join(left))
                removed.append(b - a - len(kept[-1]))
                spans.append(n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2),
                    pa.array(np.diff(offsets)),
                    pa.array(removed, type=pa.int64()),
                    pa.array(spans, type=pa.int64()),
                    pa.array(kept, type=pa.binary()),
                ],
                names=["_carry", *MEASURES],
            )

    carried = texts.schema["_carry"].dataType.simpleString()
    schema = f"_carry {carried}, n_bytes long, n_removed long, n_spans long, kept_bytes binary"
    return texts.select("_text", "_spans", "_carry").mapInArrow(cut, schema)


def _joined(spans: list[dict]) -> Iterator[tuple[int, int]]:
    """Maximal spans, in order."""
    first = last = None
    for a, b in sorted((s["first"], s["last"]) for s in spans):
        if first is None:
            first, last = a, b
        elif a <= last:
            last = max(last, b)
        else:
            yield first, last
            first, last = a, b
    if first is not None:
        yield first, last


def without_repeats(
    docs: DataFrame,
    *,
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    spec: PassageSpec = PassageSpec(),
) -> DataFrame:
    """One row per input row: the carried columns, n_bytes, n_removed, n_spans, kept_bytes.

    Texts are UTF-8 bytes, null ones empty. Every byte goes that is covered by a string
    of ``spec.length`` bytes which also starts at another place, of the same text or of
    any other row's; overlapping places count, and strings are judged on the input.
    ``n_spans`` counts maximal removed runs; ``kept_bytes`` has the other bytes in a row,
    which need not be valid UTF-8. Copies lose everything, the first one too, if they are
    long enough. Rows may repeat ids, which are not looked at; texts with equal 128-bit
    digests are taken to be equal. An empty table gives an empty result; columns that
    aren't carried are not read.
    """
    text = or_empty(text_col)
    rows = docs.select(
        text.alias("_text"),
        F.xxhash64(F.lit(1), text).alias("_ta"),
        F.xxhash64(F.lit(2), text).alias("_tb"),
        F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(carry)]).alias("_carry"),
    )
    long_ = rows.filter(F.octet_length("_text") >= spec.length)
    screens = _Screens(long_, spec)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(screens.suffixes // spec.per_range, 2 * partitions)
    runs = materialize(_runs(long_, screens, ranges), "runs")
    repeats = _repeats(runs.filter("range is not null").select("range", "run"), spec)
    spans = runs.filter("range is null").select("ta", "tb", "first", "last").union(repeats).distinct()
    spans = spans.groupBy(F.col("ta").alias("_ta"), F.col("tb").alias("_tb")).agg(
        F.collect_list(F.struct("first", "last")).alias("_spans")
    )
    spans = materialize(spans, "spans")
    hit = with_hit(rows, ["_ta", "_tb"], bitmap(spans, ["_ta", "_tb"]), "_hit")
    # A third column makes Spark deal out both sides, so that a hot text can be split.
    check = (F.hash("_ta", "_tb") % 2).alias("_check")
    keys = ["_ta", "_tb", "_check"]
    met = hit.filter("_hit").select("*", check).join(spans.select("*", check), keys, "left")
    n_bytes, zero = F.octet_length("_text").cast("long"), F.lit(0).cast("long")
    whole = hit.filter("NOT _hit").select("_carry", n_bytes, zero, zero, F.col("_text").cast("binary"))
    return _cut(met).union(whole).select(
        *[F.col(f"_carry._{i}").alias(c) for i, c in enumerate(carry)], *MEASURES
    )
