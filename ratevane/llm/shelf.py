"""Sorted arrays as files in the shared folder, and searches in them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import numpy as np
from pyarrow import fs


def save(folder: str, arrays: dict[str, np.ndarray]) -> None:
    """Arrays as one file that appears whole or not at all, whichever attempt of a task writes it; numbers take as few bytes as they need."""
    kept = {k: a if a.dtype.kind != "u" or not len(a) or k in ("major", "minor") else a.astype(np.min_scalar_type(int(a.max()))) for k, a in arrays.items()}
    head, at = {}, 0
    for k, a in kept.items():
        head[k] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 64)
    store, where = fs.FileSystem.from_uri(folder)
    parent, _, name = where.rpartition("/")
    store.create_dir(parent, recursive=True)
    part = f"{parent}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for a in kept.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    store.move(part, where)


def load(file: str) -> dict[str, np.ndarray]:
    """The arrays, memory-mapped where the shared folder is one of the file system's; else read."""
    store, at = fs.FileSystem.from_uri(file)
    if store.type_name == "local":
        raw = np.asarray(np.memmap(at, np.uint8, "r"))  # a plain view: slices of it cost less
    else:
        with store.open_input_stream(at) as stream:
            raw = np.frombuffer(stream.read(), np.uint8)
    base = 8 + int.from_bytes(raw[:8].tobytes(), "little")
    return {k: raw[base + o : base + o + n * np.dtype(t).itemsize].view(t) for k, (t, n, o) in json.loads(raw[8:base].tobytes()).items()}


def lower_bound(key: Callable[[np.ndarray], np.ndarray], lo: np.ndarray, hi: np.ndarray, want: np.ndarray) -> np.ndarray:
    """The first place from `lo` on, `hi` at most, whose key isn't less than what is wanted."""
    out = lo.copy()
    live = np.flatnonzero(lo < hi)
    lo, hi, want = lo[live], hi[live], want[live]
    while len(live):
        mid = (lo + hi) >> 1
        less = key(mid) < want
        lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
        more = lo < hi
        if not more.all():
            out[live[~more]] = lo[~more]
            live, lo, hi, want = live[more], lo[more], hi[more], want[more]
    return out
