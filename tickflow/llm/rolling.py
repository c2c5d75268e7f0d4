"""Hashes of many strings of one run of bytes, by prefix sums."""

from __future__ import annotations

import numpy as np

from tickflow.llm.shingles import mix

_U = np.uint64
_MULTIPLIER = 0xD1342543DE82EF95
_STEP = _U(0x9E3779B97F4A7C15)
#: What each byte adds.
LETTERS = mix((np.arange(256, dtype=_U) + _U(1)) * _STEP)
#: Powers that are worked out at least.
_ROOM = (1 << 20) + 4096


class PrefixHashes:
    """A sum per place of a run of bytes; strings get their hashes by difference."""

    _up = _down = np.zeros(0, dtype=_U)

    def __init__(self, raw: np.ndarray, letters: np.ndarray = LETTERS) -> None:
        cls = PrefixHashes
        if len(raw) + 1 > len(cls._up):
            n = max(len(raw) + 1, _ROOM)
            inverse = pow(_MULTIPLIER, -1, 1 << 64)
            cls._up, cls._down = (
                np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, b, dtype=_U)]), dtype=_U)
                for b in (_MULTIPLIER, inverse)
            )
        self.sums = np.zeros(len(raw) + 1, dtype=_U)
        np.cumsum(letters[raw] * cls._up[: len(raw)], dtype=_U, out=self.sums[1:])

    def all(self, n: int) -> np.ndarray:
        """Of the n bytes from each place on."""
        places = len(self.sums) - n
        return mix((self.sums[n:] - self.sums[:places]) * PrefixHashes._down[:places])

    def at(self, places: np.ndarray, n: int) -> np.ndarray:
        """Of the n bytes from some places on."""
        return mix((self.sums[places + n] - self.sums[places]) * PrefixHashes._down[places])

    def between(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of strings of any length."""
        own = (self.sums[end] - self.sums[begin]) * PrefixHashes._down[begin]
        return mix(own + (end - begin).astype(_U) * _STEP)
