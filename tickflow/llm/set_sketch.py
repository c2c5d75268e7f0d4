"""SetSketch: registers of exponentially spaced, truncated minima.

Every element draws the points of a Poisson process; each point goes to one register,
so a register's first point over all elements is the least of independent exponential
variables. It is kept as ``floor(1 - log_base(point))``, truncated to the register's
range. Registers of a union are the larger ones of its parts, and equal elements
always give equal points, so similar sets agree in most registers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tickflow.llm.shingles import mix

_U = np.uint64
#: Points drawn in one go.
DRAWS = 1 << 18


@dataclass(frozen=True)
class SketchSpec:
    bands: int = 64
    #: Registers that two sets must agree in to become candidates.
    rows: int = 7
    base: float = 1.1
    #: Rate of a register's points per element.
    rate: float = 20.0

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def registers(flat: np.ndarray, bounds: np.ndarray, spec: SketchSpec) -> np.ndarray:
    """A row of 8-bit registers for each set; 0 everywhere for an empty one."""
    n_sets, m = len(bounds) - 1, spec.registers
    least = np.full(n_sets * m, np.inf)
    owner = np.repeat(np.arange(n_sets), np.diff(bounds))
    state, point, drawn = flat, np.zeros(len(flat)), 0
    while len(state):
        k = int(np.clip(DRAWS // len(state), 1, m))
        latest = np.empty(len(state))
        for a in range(0, len(state), DRAWS):
            b = min(a + DRAWS, len(state))
            steps = np.arange(drawn + 1, drawn + k + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)
            bits = mix(state[a:b, None] + steps)
            gaps = -np.log(((bits >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53)
            points = point[a:b, None] + np.cumsum(gaps, axis=1)
            places = owner[a:b, None] * m + (mix(bits) % _U(m)).astype(np.int64)
            np.minimum.at(least, places.ravel(), points.ravel())
            latest[a:b] = points[:, -1]
        # An element whose latest point is above all its set's minima has no more to give.
        open_ = latest < least.reshape(n_sets, m).max(axis=1)[owner]
        state, point, owner = state[open_], latest[open_], owner[open_]
        drawn += k
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(least / (spec.rate * m)) / np.log(spec.base))
    return np.clip(level, 0, 255).astype(np.uint8).reshape(n_sets, m)


def estimated_jaccard(
    one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray, spec: SketchSpec
) -> np.ndarray:
    """The most likely Jaccard similarity, given how many registers are larger, equal, smaller.

    With known cardinalities the likelihood is concave in the similarity, so its top is
    found by golden-section search between 0 and the ratio of the sizes.
    """
    more = (one > two).sum(axis=1)
    less = (one < two).sum(axis=1)
    same = spec.registers - more - less
    total = n_one + n_two
    u, v = n_one / total, n_two / total
    shrink, log_base = (spec.base - 1) / spec.base, np.log(spec.base)

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * shrink) / log_base

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = chance(u - v * j), chance(v - u * j)
        tiny = 1e-12
        return (
            more * np.log(up + tiny)
            + less * np.log(down + tiny)
            + same * np.log(np.maximum(1 - up - down, tiny))
        )

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    ratio = (5**0.5 - 1) / 2
    for _ in range(32):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        better = likelihood(left) > likelihood(right)
        high, low = np.where(better, right, high), np.where(better, low, left)
    return (low + high) / 2
