"""Word shingles of Arrow batches, vectorised over the bytes of a whole batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words in a shingle.
SHINGLE_WORDS = 5
#: Bytes hashed at a time; a longer word makes its span longer.
SPAN_BYTES = 1 << 20
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _odd(i: int) -> np.uint64:
    return mix(np.array([i * _STEP % 2**64], dtype=_U))[0] | _U(1)


_BYTES = np.arange(256)
_FOLDED = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES)
_LETTER = mix((_FOLDED.astype(_U) + _U(1)) * _U(_STEP))
_IS_SEPARATOR = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
_BASE = int(_odd(7))
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_PLACE = [_odd(100 + i) for i in range(SHINGLE_WORDS)]


class _Powers:
    """Powers of the hash base and of its inverse, as long as the longest span so far."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, dtype=_U)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            self.up, self.down = (
                np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, b, dtype=_U)]), dtype=_U)
                for b in (_BASE, _BASE_INVERSE)
            )


_POWERS = _Powers()


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null rows are empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _word_hashes(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of ``raw``; ``cuts`` are places where texts begin."""
    body = ~_IS_SEPARATOR[raw]
    broken = ~body
    before = np.concatenate([[True], broken[:-1]])
    after = np.concatenate([broken[1:], [True]])
    before[cuts] = True
    after[cuts[cuts > 0] - 1] = True
    starts = np.flatnonzero(body & before)
    ends = np.flatnonzero(body & after) + 1
    _POWERS.grow(len(raw))
    sums = np.concatenate([[_U(0)], np.cumsum(_LETTER[raw] * _POWERS.up[: len(raw)], dtype=_U)])
    hashes = (sums[ends] - sums[starts]) * _POWERS.down[starts]
    return mix(hashes + (ends - starts).astype(_U) * _U(_STEP)), starts


def span_end(raw: np.ndarray, offsets: np.ndarray, at: int) -> int:
    """The first separator or text start from ``SPAN_BYTES`` after ``at`` on."""
    end = at + SPAN_BYTES
    while end < len(raw):
        gaps = np.flatnonzero(_IS_SEPARATOR[raw[end : end + SPAN_BYTES]])
        text = int(offsets[np.searchsorted(offsets, end)])
        if len(gaps) or text <= end + SPAN_BYTES:
            return min(end + int(gaps[0]), text) if len(gaps) else text
        end += SPAN_BYTES
    return len(raw)


def batch_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and where each text's words begin and end."""
    hashes, starts, at = [np.zeros(0, dtype=_U)], [np.zeros(0, dtype=np.int64)], 0
    while at < len(raw):
        end = span_end(raw, offsets, at)
        cuts = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
        found, begun = _word_hashes(raw[at:end], cuts)
        hashes.append(found)
        starts.append(begun + at)
        at = end
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and where each text's begin.

    A text with fewer words than a shingle has one: its whole sequence. Without words it
    has none.
    """
    words, bounds = batch_words(raw, offsets)
    sums = np.zeros(max(len(words) - SHINGLE_WORDS + 1, 0), dtype=_U)
    for k, place in enumerate(_PLACE):
        sums += words[k : k + len(sums)] * place
    sums = mix(sums)
    parts, counts = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if b - a >= SHINGLE_WORDS:
            own = np.sort(sums[a : b - SHINGLE_WORDS + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            place = np.array(_PLACE[: b - a], dtype=_U)
            own = mix(np.array([(words[a:b] * place).sum(dtype=_U) + _U(b - a)], dtype=_U))
        else:
            continue
        parts.append(own)
        counts[i] = len(own)
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=_U)
    return flat, np.concatenate([[0], np.cumsum(counts)])


def slices(
    offsets: np.ndarray, most: int = 2 * SPAN_BYTES, texts: int = 2048
) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes and ``texts`` rows; longer texts run alone."""
    at = 0
    while at < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = max(min(end, at + texts), at + 1)
        yield at, end
        at = end
