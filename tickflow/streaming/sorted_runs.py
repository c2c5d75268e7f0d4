"""Sorting what one key has in a batch without holding it."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc


def _folder() -> str | None:
    """Where the executor keeps its own scratch files."""
    return os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None


def in_order(
    tables: Iterable[pa.Table], order: str, run_bytes: int = 1 << 25, rows: int = 1 << 10
) -> Iterator[pa.Table]:
    """The rows of ``tables`` by ``order``, in tables of some thousand rows.

    Up to ``run_bytes`` are sorted in memory; beyond that, sorted runs go to files of the
    worker's own, and ``rows`` of each run are held while they are merged. ``order`` has no
    NULLs.
    """
    held: list[pa.Table] = []
    size = 0
    with tempfile.TemporaryDirectory(prefix="runs-", dir=_folder()) as folder:
        paths: list[str] = []
        for table in tables:
            held.append(table)
            size += table.nbytes
            if size >= run_bytes:
                paths.append(_write(_sorted(held, order), f"{folder}/{len(paths)}", rows))
                held, size = [], 0
        last = _sorted(held, order).to_batches(max_chunksize=rows) if held else []
        runs = [_read(path) for path in paths]
        yield from _merged([*runs, iter(last)], order)


def _sorted(tables: list[pa.Table], order: str) -> pa.Table:
    return pa.concat_tables(tables).sort_by(order)


def _write(table: pa.Table, path: str, rows: int) -> str:
    with pa.OSFile(path, "wb") as out, pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table, max_chunksize=rows)
    return path


def _read(path: str) -> Iterator[pa.RecordBatch]:
    with pa.OSFile(path) as source, pa.ipc.open_stream(source) as reader:
        yield from reader


def _merged(runs: list[Iterator[pa.RecordBatch]], order: str) -> Iterator[pa.Table]:
    """What is at most the smallest of the runs' last loaded values is complete."""
    heads = {i: pa.Table.from_batches([b]) for i, run in enumerate(runs) if (b := next(run, None))}
    while heads:
        upto = min(head[order][-1].as_py() for head in heads.values())
        parts = []
        for i, head in list(heads.items()):
            n = pc.sum(pc.less_equal(head[order], upto)).as_py()
            if n:
                parts.append(head.slice(0, n))
            if n < head.num_rows:
                heads[i] = head.slice(n)
            elif (more := next(runs[i], None)) is not None:
                heads[i] = pa.Table.from_batches([more])
            else:
                del heads[i]
        yield _sorted(parts, order)
