"""Directly addressable codes for token ids.

An id is split into 8-bit chunks, lowest first.  Level 0 holds the lowest chunk of every id, level k the next
chunk of the ids that have one.  Each level has a continuation bitmap (bit i: value i goes on in the next
level) with a rank directory (set bits before every 512th position), so the place of value i in the next
level is one directory entry and a popcount of at most 512 bits.  Any id, or any run of ids, is read without
decoding what stands before it.

File layout, little-endian:
  magic "DAC1", u32 levels, u64 ids, u64 documents
  document table: i64 doc_id (-2**63 for null) and u64 first id, per document
  for every level: u64 values, then chunks (u8 each), bitmap (u8 per 8 values, low bit first, 64-byte padded),
  directory (u64 per 512 values)
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DAC1"
RANK = 512
NO_ID = -(1 << 63)
POP = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.uint8)


def encode(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels (chunks, bitmap, directory) of unsigned ids below 2**32."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while True:
        chunk, rest = (rest & 0xFF).astype(np.uint8), rest >> 8
        more = rest > 0
        bitmap = np.packbits(more, bitorder="little")
        bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % (RANK // 8), np.uint8)])
        ones = POP[bitmap].reshape(-1, RANK // 8).sum(axis=1, dtype=np.uint64)
        directory = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ones, dtype=np.uint64)])[:max(1, len(ones))]
        levels.append((chunk, bitmap, directory))
        rest = rest[more]
        if not len(rest):
            return levels


def file_bytes(doc_ids: list, lens: list[int], ids: np.ndarray) -> bytes:
    starts = np.concatenate([[0], np.cumsum(lens)])[:-1] if lens else np.zeros(0)
    table = np.empty((len(lens), 2), "<i8")
    table[:, 0] = [NO_ID if d is None else d for d in doc_ids]
    table[:, 1] = starts
    levels = encode(ids)
    out = [MAGIC, struct.pack("<IQQ", len(levels), len(ids), len(lens)), table.tobytes()]
    for chunk, bitmap, directory in levels:
        out += [struct.pack("<Q", len(chunk)), chunk.tobytes(), bitmap.tobytes(), directory.astype("<u8").tobytes()]
    return b"".join(out)


class File:
    """Random access to the ids of a file's bytes."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a DAC1 file")
        n_levels, self.n_ids, n_docs = struct.unpack_from("<IQQ", data, 4)
        at = 24
        self.docs = np.frombuffer(data, "<i8", 2 * n_docs, at).reshape(-1, 2)
        at += 16 * n_docs
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            width = -(-n // RANK) * (RANK // 8)
            chunk = np.frombuffer(data, np.uint8, n, at)
            bitmap = np.frombuffer(data, np.uint8, width, at + n)
            rows = max(1, -(-n // RANK))
            directory = np.frombuffer(data, "<u8", rows, at + n + width)
            at += n + width + 8 * rows
            self.levels.append((chunk, bitmap, directory))

    @staticmethod
    def _rank(level, i: int) -> int:
        """Set bits before position i."""
        chunk, bitmap, directory = level
        if not len(chunk):
            return 0
        block = min(i // RANK, len(directory) - 1)
        first = block * (RANK // 8)
        whole = int(POP[bitmap[first:i // 8]].sum(dtype=np.int64))
        part = int(POP[bitmap[i // 8] & ((1 << i % 8) - 1)]) if i % 8 else 0
        return int(directory[block]) + whole + part

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids at positions start <= i < stop."""
        if not 0 <= start <= stop <= self.n_ids:
            raise IndexError((start, stop, self.n_ids))
        out = np.zeros(stop - start, np.uint32)
        where, a, b = np.arange(stop - start), start, stop
        for k, level in enumerate(self.levels):
            if a == b:
                break
            chunk, bitmap, _ = level
            out[where] |= chunk[a:b].astype(np.uint32) << np.uint32(8 * k)
            bits = np.unpackbits(bitmap[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a]
            where = where[bits.astype(bool)]
            a, b = self._rank(level, a), self._rank(level, b)
        return out

    def token(self, i: int) -> int:
        return int(self.ids(i, i + 1)[0])

    def some_docs(self, k: int, stop: int) -> list[tuple[int | None, int, np.ndarray]]:
        """(id, first position, tokens) of documents k <= i < stop, read in one piece."""
        ids, first = self.docs[k:stop, 0].tolist(), self.docs[k:stop + 1, 1].tolist()
        if len(first) == len(ids):                           # the last document ends with the file
            first.append(self.n_ids)
        run = self.ids(first[0], first[-1])
        return [(None if d == NO_ID else d, a, run[a - first[0]:b - first[0]]) for d, a, b in zip(ids, first, first[1:])]

    def doc(self, k: int) -> tuple[int | None, np.ndarray]:
        """Id and tokens of the k-th document."""
        d, _, ids = self.some_docs(k, k + 1)[0]
        return d, ids
