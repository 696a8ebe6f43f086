"""Directly addressable codes: variable-length integers with access to any one.

An integer is cut into chunks of a level's bits each, lowest first, as many as
it needs. Level k holds the k-th chunks of all integers that have one, side by
side, and a bitmap that says which of them go on to level k + 1. The place of
an integer's next chunk is the number of set bits before its bit, which a
directory of running counts gives without reading the bitmap's beginning.

Layout, little-endian: ``DAC1``, levels as u8, bits of a level as u8, two zero
bytes, count as u64; then for each level its length as u64, its chunks as u8
or u16, its bitmap (lowest bit first, whole directory blocks), and its
directory, one u32 a block and one for the end.
"""

from __future__ import annotations

import struct

import numpy as np

HEADER = struct.Struct("<4sBBHQ")
LENGTH = struct.Struct("<Q")
MAGIC = b"DAC1"
BLOCK_BITS = 512
BLOCK_BYTES = BLOCK_BITS // 8


def encode(values: np.ndarray, bits: int = 8) -> bytes:
    """The codes of unsigned integers below 2**32; ``bits`` is 8 or 16."""
    if bits not in (8, 16):
        raise ValueError("chunks have 8 or 16 bits")
    kind = f"<u{bits // 8}"
    rest = np.ascontiguousarray(values, np.uint32)
    out, levels = [], 0
    while levels == 0 or len(rest):
        goes_on = rest >> bits > 0
        blocks = -(-len(rest) // BLOCK_BITS)
        bitmap = np.zeros(blocks * BLOCK_BYTES, np.uint8)
        packed = np.packbits(goes_on, bitorder="little")
        bitmap[: len(packed)] = packed
        counts = np.bitwise_count(bitmap).reshape(blocks, BLOCK_BYTES).sum(axis=1, dtype=np.int64)
        directory = np.zeros(blocks + 1, "<u4")
        directory[1:] = np.cumsum(counts)
        out += [LENGTH.pack(len(rest)), (rest & (1 << bits) - 1).astype(kind).tobytes()]
        out += [bitmap.tobytes(), directory.tobytes()]
        rest = rest[goes_on] >> bits
        levels += 1
    return b"".join([HEADER.pack(MAGIC, levels, bits, 0, len(values)), *out])


class Reader:
    """Any integer, or a run of them, from the bytes that :func:`encode` gives."""

    def __init__(self, data: bytes) -> None:
        magic, levels, self.bits, _, self.count = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        at, width = HEADER.size, self.bits // 8
        self.levels = []
        for _ in range(levels):
            (length,) = LENGTH.unpack_from(data, at)
            at += LENGTH.size
            blocks = -(-length // BLOCK_BITS)
            chunks = np.frombuffer(data, f"<u{width}", length, at)
            at += length * width
            bitmap = np.frombuffer(data, np.uint8, blocks * BLOCK_BYTES, at)
            at += blocks * BLOCK_BYTES
            directory = np.frombuffer(data, "<u4", blocks + 1, at)
            at += 4 * (blocks + 1)
            self.levels.append((chunks, bitmap, directory))

    def __len__(self) -> int:
        return self.count

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, place: int) -> int:
        """Set bits before a place: the directory's count and at most one block's bits."""
        block, bit = divmod(place, BLOCK_BITS)
        low = block * BLOCK_BYTES
        whole, odd = divmod(bit, 8)
        count = int(directory[block]) + int(np.bitwise_count(bitmap[low : low + whole]).sum())
        return count + (int(bitmap[low + whole]) & (1 << odd) - 1).bit_count() if odd else count

    def __getitem__(self, place: int) -> int:
        if not 0 <= place < self.count:
            raise IndexError(place)
        value = 0
        for level, (chunks, bitmap, directory) in enumerate(self.levels):
            value |= int(chunks[place]) << level * self.bits
            if not bitmap[place >> 3] >> (place & 7) & 1:
                break
            place = self._rank(bitmap, directory, place)
        return value

    def run(self, begin: int, end: int) -> np.ndarray:
        """The integers from ``begin`` up to ``end``, reading only their own chunks."""
        if not 0 <= begin <= end <= self.count:
            raise IndexError((begin, end))
        out = np.zeros(end - begin, np.uint32)
        at = np.arange(end - begin)
        for level, (chunks, bitmap, directory) in enumerate(self.levels):
            out[at] |= chunks[begin:end].astype(np.uint32) << np.uint32(level * self.bits)
            low = begin >> 3
            bits = np.unpackbits(bitmap[low : -(-end // 8)], bitorder="little")
            goes_on = bits[begin - 8 * low : end - 8 * low].astype(bool)
            if not goes_on.any():
                break
            begin = self._rank(bitmap, directory, begin)
            at = at[goes_on]
            end = begin + len(at)
        return out
