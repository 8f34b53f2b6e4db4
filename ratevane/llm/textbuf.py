"""Texts of an Arrow column as one byte buffer: spans of words and lines, and their hashes, without a Python loop."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one vectorised step handles; temporaries are about a hundred times this. A longer text is a step of its own.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: empty), and where each begins, with the end of the last."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of whole texts of about `limit` bytes."""
    data, off = buffers(column)
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, to, data[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the longest runs of true bytes; none crosses a text's end."""
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    s, e = inside.copy(), inside.copy()
    s[1:] &= ~inside[:-1] | edge[1:n]
    e[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(s)
    return starts, np.flatnonzero(e) + 1, np.searchsorted(off, starts, "right") - 1


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of anything but space and the characters 9 to 13."""
    return spans(~SPACE[data], off)


def line_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of \\n-split lines, empty ones too; an empty text has one empty line."""
    cuts = np.flatnonzero(data == 10)
    starts = np.concatenate([off[:-1], cuts + 1])
    ends = np.concatenate([cuts, off[1:]])
    docs = np.concatenate([np.arange(len(off) - 1), np.searchsorted(off, cuts, "right") - 1])
    order = np.lexsort((starts, docs))
    docs_end = np.concatenate([docs[len(off) - 1 :], np.arange(len(off) - 1)])
    order_end = np.lexsort((ends, docs_end))
    return starts[order], ends[order_end], docs[order]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers under which close values part."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    return value_hashes(_BYTE[data], starts, ends)


def value_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of unsigned 64-bit values: differences of the prefix sums of a polynomial."""
    n = len(values)
    powers = np.full(n + 1, _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers[:n], out=prefix[1:])
    back = np.full(n + 1, _BASE_INV, np.uint64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    return mix((prefix[ends] - prefix[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def per_text(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of a value per byte over each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z become a-z; all other bytes stay."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


#: Letters and digits of ASCII after lower-casing, and all bytes of other characters.
PLAIN = np.zeros(256, bool)
PLAIN[48:58] = PLAIN[97:123] = PLAIN[128:] = True


def plain_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, texts) of the lower-cased runs of letters, digits and characters beyond ASCII, laid out with one space after each."""
    low = lowered(data)
    inside = PLAIN[low]
    start, end, doc = spans(inside, off)
    size = end - start
    to = np.cumsum(size + 1) - size - 1
    out = np.full(int(size.sum()) + len(size), 32, np.uint8)
    out[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = low[inside]
    return out, to, to + size, doc


def spread(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in the row) of every element of rows of these sizes."""
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - (np.cumsum(size) - size)[row]
