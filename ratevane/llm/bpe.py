"""Byte-level BPE by the ranks of a public vocabulary: encoding and decoding."""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import map_texts, slim
from .pretokenise import boundaries
from .textbuf import chunks

#: Pieces that a worker remembers, of at most CACHED_BYTES each; both bound its memory, neither changes a result.
CACHED_PIECES, CACHED_BYTES = 300_000, 48


class Encoder(dict):
    """Pieces to their ids, packed as little-endian unsigned 32-bit integers; merged when first asked for."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pieces = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            self.pieces[rank] = piece
        self.sizes = np.fromiter(map(len, self.pieces), np.int64, len(self.pieces))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.pieces), np.uint8)  # all pieces, one after the other

    def __missing__(self, piece: bytes) -> bytes:
        ids = np.array(self.merged(piece), "<u4").tobytes()
        if len(piece) <= CACHED_BYTES:
            self[piece] = ids
        return ids

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a piece: the adjacent pair of lowest rank joins, the leftmost first, until no pair has a rank."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > 100:
            return self.merged_long(piece)
        part = [piece[i : i + 1] for i in range(len(piece))]
        rank = [ranks.get(a + b, 1 << 40) for a, b in zip(part, part[1:], strict=False)]
        while rank and (least := min(rank)) < 1 << 40:
            i = rank.index(least)
            part[i : i + 2] = [part[i] + part[i + 1]]
            del rank[i]
            if i < len(rank):
                rank[i] = ranks.get(part[i] + part[i + 1], 1 << 40)
            if i:
                rank[i - 1] = ranks.get(part[i - 1] + part[i], 1 << 40)
        return [ranks[x] for x in part]

    def merged_long(self, piece: bytes) -> list[int]:
        """The same in n log n steps: a heap of pairs over linked parts."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that begins here; 0: no part begins here
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or end[mid] != to:
                continue
            end[i], end[mid] = to, 0
            if to < n:
                before[to] = i
                if (r := ranks.get(piece[i : end[to]])) is not None:
                    heapq.heappush(heap, (r, i, end[to]))
            if (j := before[i]) >= 0 and (r := ranks.get(piece[j:to])) is not None:
                heapq.heappush(heap, (r, j, to))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[list[bytes], list[np.ndarray], list[np.ndarray]]:
        """Of each text of a chunk: its packed ids, where each piece begins in its bytes, and how many ids stand before each piece."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), "<u4")
        byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        begin = byte[boundaries(points, np.searchsorted(byte, off))]
        if len(self) > CACHED_PIECES:
            self.clear()
        cut = np.searchsorted(begin, off)
        edge = np.append(begin, len(data)).tolist()
        packed = list(map(self.__getitem__, [raw[a:b] for a, b in zip(edge, edge[1:], strict=False)]))
        first = np.zeros(len(packed) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed)) >> 2, out=first[1:])
        texts = list(zip(cut.tolist(), cut[1:].tolist(), off.tolist(), strict=False))
        return [b"".join(packed[a:b]) for a, b, _ in texts], [begin[a:b] - o for a, b, o in texts], [first[a:b] - first[a] for a, b, _ in texts]

    def decode(self, ids: np.ndarray, begin: np.ndarray, first: np.ndarray) -> bytes:
        """The bytes of ids, each id's put where its piece's offset says; pieces that don't abut are an error.

        `begin` has the byte at which each piece begins, `first` how many ids stand before it.
        """
        if not len(ids):
            return b""
        size = self.sizes[ids]
        end = np.cumsum(size)
        before = end - size
        piece = np.searchsorted(first, np.arange(len(ids)), "right") - 1
        at = begin[piece] + before - before[first][piece]
        if (at != before).any():
            raise ValueError("ids and piece offsets don't belong together")
        place = np.arange(end[-1]) + np.repeat(self.starts[ids] - at, size)
        return self.flat[place].tobytes()


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, piece_offsets, piece_ids) of every row, each list packed as little-endian unsigned 32-bit integers.

    `piece_offsets` has the byte at which each piece of the text begins, `piece_ids` how many ids stand before it. No special tokens:
    their strings in a text are ordinary text. A null or empty text has no ids. Rows that repeat are encoded each. Other columns are
    ignored; no rows give none. `path` names the vocabulary on the executors; nothing of it is stored.
    """

    def body(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, made = encoder(path), ([], [], [])
        for _, _, data, off in chunks(batch.column(1)):
            packed, begin, first = own.encode(data, off)
            made[0].extend(packed)
            made[1].extend(b.astype("<u4").tobytes() for b in begin)
            made[2].extend(f.astype("<u4").tobytes() for f in first)
        return pa.record_batch([batch.column(0), *(pa.array(m, pa.binary()) for m in made)], names=["doc_id", "ids", "piece_offsets", "piece_ids"])

    return map_texts(slim(df, id_col, text_col), body, "doc_id bigint, ids binary, piece_offsets binary, piece_ids binary")


def decode_ids(df: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of encode_texts(): the bytes that the ids stand for, placed by the piece offsets."""

    def body(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, n, decoded = encoder(path), [], []
        for row in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            ids, begin, first = (np.frombuffer(x, "<u4").astype(np.int64) for x in row)
            n.append(len(ids))
            decoded.append(own.decode(ids, begin, first))
        return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), batch.column(1), pa.array(decoded, pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"])

    return map_texts(df.select("doc_id", "ids", "piece_offsets", "piece_ids"), body, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")
