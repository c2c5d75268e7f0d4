"""Sorted runs of strings: front-coded for the exchange, merged by a loser tree.

A run is a sorted list of byte strings. Front-coded, each string is the length of the
prefix it shares with the one before and the rest. A loser tree merges runs; every head
carries how much it shares with the string put out last, so two heads are compared by
these numbers alone where they differ, and from the shared length on where they don't.
No byte that is known to be equal is looked at again, and the merged order comes with
the shared length of each string with the one before.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of strings that share ``known`` bytes at least."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(run: Sequence[bytes]) -> tuple[np.ndarray, bytes]:
    """(shared lengths, rests in a row) of a sorted run."""
    shared = np.zeros(len(run), dtype=np.uint16)
    rests, before = [], b""
    for i, string in enumerate(run):
        n = shared_prefix(before, string) if i else 0
        shared[i] = n
        rests.append(string[n:])
        before = string
    return shared, b"".join(rests)


def front_decode(shared: np.ndarray, lengths: np.ndarray, rests: bytes) -> list[bytes]:
    """The strings of a run, from their shared lengths, whole lengths and rests."""
    run, before, at = [], b"", 0
    for n, length in zip(shared.tolist(), lengths.tolist(), strict=True):
        end = at + length - n
        before = before[:n] + rests[at:end]
        run.append(before)
        at = end
    return run


def merge_runs(runs: Sequence[tuple[Sequence[bytes], Sequence[int]]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs, each with its shared lengths.

    Returns the runs that the merged strings come from, in order (a run's strings keep
    theirs), and the shared length of each merged string with the one before.
    """
    k = len(runs)
    heads = [run[0] if len(run) else None for run, _ in runs]
    known = [0] * k  # shared with the string put out last
    place = [0] * k
    sizes = [len(run) for run, _ in runs]

    def beats(a: int, b: int) -> bool:
        """Whether head a goes before head b; the loser then knows what it shares with it."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None
        if known[a] != known[b]:
            return known[a] > known[b]
        n = shared_prefix(x, y, known[a])
        first = n == len(x) or (n < len(y) and x[n] < y[n])
        known[b if first else a] = n
        return first

    # Leaves are k ... 2k - 1; an inner node keeps the loser of its match.
    losers = [0] * max(k, 1)
    winners = [0] * (2 * k)
    winners[k:] = range(k)
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        first = beats(a, b)
        winners[node], losers[node] = (a, b) if first else (b, a)
    best = winners[1] if k else 0
    origin, shared = [], []
    for _ in range(sum(sizes)):
        origin.append(best)
        shared.append(known[best])
        place[best] += 1
        if place[best] < sizes[best]:
            heads[best] = runs[best][0][place[best]]
            known[best] = int(runs[best][1][place[best]])
        else:
            heads[best] = None
        node = (best + k) // 2
        while node:
            if beats(losers[node], best):
                losers[node], best = best, losers[node]
            node //= 2
    return origin, shared
