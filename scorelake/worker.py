"""Small helpers that run inside tasks. Pickled by value, so executors need no copy of the package."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def nearest(query_ids, query, pool_ids, pool, k):
    """k nearest pool rows of each query row, itself excluded; ties by id."""
    out = []
    for start in range(0, len(query), 512):
        part = query[start:start + 512]
        gap = ((part**2).sum(1)[:, None] - 2 * part @ pool.T + (pool**2).sum(1)[None, :]).clip(min=0)
        gap[query_ids[start:start + 512][:, None] == pool_ids[None, :]] = np.inf
        width = min(len(pool), k + 8)
        near = np.argpartition(gap, width - 1, axis=1)[:, :width]
        for i, row in enumerate(near):
            # Exact distances decide, so block order cannot change a neighbour.
            exact = ((pool[row] - part[i]) ** 2).sum(1)
            ok = pool_ids[row] != query_ids[start + i]
            order = np.lexsort((pool_ids[row][ok], exact[ok]))[:k]
            for j in order:
                out.append((query_ids[start + i], pool_ids[row][ok][j], exact[ok][j], pool[row][ok][j]))
    return out


def walk_chunk(ts: np.ndarray, window: int):
    """For each request as a window opener: where its chain of windows stands at the end of the chunk.

    Returns (next opener or n, closing time of the last window, rows counted in it).
    """
    n = len(ts)
    nxt = np.searchsorted(ts, ts + window, side="right")
    close, count = np.empty(n, np.int64), np.empty(n, np.int64)
    for i in range(n - 1, -1, -1):
        j = nxt[i]
        if j >= n:
            close[i], count[i] = ts[i] + window, n - i
        else:
            close[i], count[i] = close[j], count[j]
    return nxt, close, count


def summarise_chunks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """One row per (key, chunk) of rows sorted by key, chunk and time: see ``fixed_window_limit``."""
    names = ["g", "chunk", "n", "first", "last", "upto", "close", "count"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * 3

    def summary(key, chunk, parts):
        t = np.concatenate(parts)
        _, close, count = walk_chunk(t, window)
        # An entry that closes at u starts at the first request after u. Entries can only be open
        # until one window after the chunk begins, and equal exits are stored once.
        last = min(int(np.searchsorted(t, t[0] + window, side="right")), len(t) - 1)
        keep = [i for i in range(last + 1) if i == last or close[i] != close[i + 1] or count[i] != count[i + 1]]
        return key, chunk, len(t), int(t[0]), int(t[-1]), t[keep].tolist(), close[keep].tolist(), count[keep].tolist()

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    now, parts, out = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("__g").to_pylist()
        chunks = batch.column("__chunk").to_numpy()
        times = batch.column("__t").to_numpy()
        same = np.array([a == b for a, b in zip(keys[1:], keys)], dtype=bool) & (chunks[1:] == chunks[:-1])
        edges = [0, *(np.flatnonzero(~same) + 1).tolist(), len(keys)]
        for a, b in zip(edges, edges[1:]):
            if now != (keys[a], int(chunks[a])):
                if parts:
                    out.append(summary(*now, parts))
                now, parts = (keys[a], int(chunks[a])), []
            parts.append(times[a:b])
        if len(out) >= 1000:
            yield pack(out)
            out = []
    if parts:
        out.append(summary(*now, parts))
    if out:
        yield pack(out)


def chain_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entry state of every (key, chunk), from summaries sorted by key and chunk."""
    key, open_until, used = None, None, 0
    fresh = True
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if fresh or r["g"] != key:
                key, open_until, used, fresh = r["g"], None, 0, False
            out.append((key, r["chunk"], open_until, used))
            if open_until is not None and open_until >= r["last"]:
                used += r["n"]
                continue
            opener = r["first"] if open_until is None else open_until + 1
            spot = min(int(np.searchsorted(np.asarray(r["upto"]), opener, side="left")), len(r["upto"]) - 1)
            open_until, used = r["close"][spot], r["count"][spot]
        if out:
            g, chunk, begun, taken = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g, pa.string()), pa.array(chunk, pa.int64()), pa.array(begun, pa.int64()), pa.array(taken, pa.int64())],
                ["__eg", "__echunk", "__open", "__used"])


def decide_requests(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Add the window start, position and decision to rows sorted by key, chunk and time."""
    now, start, used = None, 0, 0
    for batch in batches:
        keys, chunks = batch.column("__g").to_pylist(), batch.column("__chunk").to_pylist()
        times, limits = batch.column("__t").to_pylist(), batch.column("__limit").to_pylist()
        opens, takens = batch.column("__open").to_pylist(), batch.column("__used").to_pylist()
        starts, places, allowed = [], [], []
        for i, t in enumerate(times):
            if now != (keys[i], chunks[i]):
                now = (keys[i], chunks[i])
                start, used = (None, 0) if opens[i] is None else (opens[i] - window, takens[i])
            if start is None or t - start > window:
                start, used = t, 0
            used += 1
            starts.append(start)
            places.append(used)
            allowed.append(used <= limits[i])
        names = [n for n in batch.schema.names if not n.startswith("__")]
        columns = [batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(
            columns + [pa.array(starts, pa.int64()), pa.array(places, pa.int64()), pa.array(allowed, pa.bool_())],
            names + ["window_start", "position", "allowed"])


class WindowLimit(StatefulProcessor):
    """State per key: when the open window began and how many requests it has taken."""

    def __init__(self, window_micros: int):
        self.window = window_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        shape = StructType([StructField("start", LongType()), StructField("used", LongType())])
        self.state = handle.getValueState("window", shape)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["t", "id"], kind="stable")
        start, used = self.state.get() if self.state.exists() else (None, 0)
        t = pdf["t"].to_numpy()
        begun, place = np.empty(len(t), np.int64), np.empty(len(t), np.int64)
        for i, now in enumerate(t):
            if start is None or now - start > self.window:
                start, used = int(now), 0
            used += 1
            begun[i], place[i] = start, used
        self.state.update((start, used))
        yield pd.DataFrame({
            "key": [key[0]] * len(t), "id": pdf["id"].to_numpy(), "t": t, "window_start": begun, "position": place,
            "allowed": place <= pdf["limit"].to_numpy(),
        })

    def close(self) -> None:
        pass
