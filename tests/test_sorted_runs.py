"""A product's messages of one batch, sorted and replayed without holding them all."""

import os

import numpy as np
import pandas as pd
import pyarrow as pa
from tickflow.streaming import sorted_runs
from tickflow.streaming.book_state import BookState
from tickflow.streaming.sorted_runs import in_order


def test_runs_on_disk_are_merged_in_order(monkeypatch, tmp_path):
    monkeypatch.setenv("SPARK_LOCAL_DIRS", str(tmp_path))
    written = []
    write = sorted_runs._write
    monkeypatch.setattr(sorted_runs, "_write", lambda *a: written.append(a[1]) or write(*a))
    keys = np.random.default_rng(7).integers(0, 500, 3000)
    keys[2900:] = 3  # late, and often the same
    tables = [pa.table({"k": keys[i : i + 70], "i": range(i, min(i + 70, 3000))}) for i in range(0, 3000, 70)]
    blocks = list(in_order(tables, "k", run_bytes=4096, rows=16))
    rows = pa.concat_tables(blocks)
    assert rows["k"].to_pylist() == sorted(keys.tolist())
    assert sorted(rows["i"].to_pylist()) == list(range(3000))
    assert len(written) > 8 and all(p.startswith(str(tmp_path)) for p in written)
    assert os.listdir(tmp_path) == []
    assert list(in_order([], "k")) == []


class Kept:
    """State of one key in a dict."""

    def __init__(self):
        self.rows, self.value = {}, None

    def iterator(self):
        return iter(self.rows.items())

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        self.rows.pop(key, None)

    def clear(self):
        self.rows.clear()

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def book_frames(n: int):
    """A snapshot and n deltas, some unreadable, some without a clock, in frames out of order."""
    at = pd.Timestamp("2026-07-27")
    rows = [(0, at, 1.0, True, [True, False], [100.0, 102.0], [3.0, 6.0])]
    for i in range(1, n):
        price = None if i % 97 == 0 else 100.0 + i % 2 * 2
        clock = pd.NaT if i % 89 == 0 else at + pd.Timedelta(seconds=i)
        epoch = None if i % 83 == 0 else 1.0
        rows.append((i, clock, epoch, False, [i % 2 == 0], [price], [1.0 + i % 7]))
    names = ["arrival_seq", "event_ts", "conn_epoch", "is_snapshot", "is_bid", "price", "size"]
    frame = pd.DataFrame(rows, columns=names).assign(product_id="A", time="")
    mixed = frame.sample(frac=1, random_state=5)
    return [mixed[i : i + 1000] for i in range(0, n, 1000)]


def replayed(frames):
    class Handle:
        def getMapState(self, *_):
            return Kept()

        def getValueState(self, *_):
            return Kept()

    state = BookState(5)
    state.init(Handle())
    return list(state.handleInputRows(("A",), iter(frames), None)), state


def test_a_large_batch_leaves_in_small_frames():
    n = 20_000
    tops, state = replayed(book_frames(n))
    assert max(len(t) for t in tops) <= 2048
    rows = pd.concat(tops)
    stale = sum(i % 83 == 0 for i in range(1, n))
    assert rows.arrival_seq.is_monotonic_increasing and len(rows) == n - stale
    assert rows.event_ts.isna().sum() == sum(i % 89 == 0 and i % 83 != 0 for i in range(1, n))
    assert rows.dropped.iloc[-1] == stale and rows.disorder.max() == 0
    assert state.meta.value[5:] == (1, n - 1, 0, stale)
    whole = pd.concat(book_frames(n)).sort_values("arrival_seq")
    assert pd.concat(replayed([whole])[0]).equals(rows)
