"""Documents in blocks of tasks, and the numbers of a block's pieces.

A block is a run of consecutive documents of one task, closed after a bounded
amount of text or of distinct pieces. Within it a piece is known by a number,
the most frequent piece having 0, so that a document is a short array of
numbers and a piece leaves its task once per block, however frequent it is: no
shuffle key has more rows than there are blocks.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gridtide.llm import pieces, util

BLOCK_CHARS = 32_000_000
BLOCK_WORDS = 1_500_000
_codec = pa.Codec("zstd", compression_level=1)
_WIDE = 0xFFFF
try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another C library
    _libc = None


def pack(numbers: np.ndarray) -> bytes:
    """Numbers as compressed bytes: 16 bits each in two byte planes, larger ones behind an escape."""
    low = np.minimum(numbers, _WIDE).astype("<u2")
    high = numbers[numbers >= _WIDE].astype("<u4")
    raw = low.view(np.uint8).reshape(-1, 2).T.tobytes() + high.tobytes()
    return np.array([len(low), len(high)], "<u4").tobytes() + _codec.compress(raw, asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n, wide = np.frombuffer(data, "<u4", 2).tolist()
    raw = np.frombuffer(_codec.decompress(data[8:], n * 2 + wide * 4, asbytes=True), np.uint8)
    out = np.ascontiguousarray(raw[: n * 2].reshape(2, n).T).view("<u2").ravel().astype(np.uint32)
    if wide:
        out[out == _WIDE] = raw[n * 2 :].view("<u4") if raw[n * 2 :].flags.aligned else np.frombuffer(raw[n * 2 :].tobytes(), "<u4")
    return out


def pack_all(*arrays: np.ndarray) -> bytes:
    """Several arrays, one behind the other."""
    packed = [pack(a) for a in arrays]
    return np.array([len(p) for p in packed], "<u4").tobytes() + b"".join(packed)


def unpack_all(data: bytes, n: int) -> list[np.ndarray]:
    ends = np.cumsum(np.frombuffer(data, "<u4", n)) + 4 * n
    return [unpack(data[a:b]) for a, b in zip([4 * n, *ends.tolist()], ends.tolist(), strict=False)]


def give_back() -> None:
    """Return freed memory to the machine: a worker lives on, and others need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


class Block:
    """The pieces of some documents."""

    def __init__(self, cut: Callable[[list[str]], pieces.Cut]):
        self.cut = cut
        self.rows: list[pa.Array] = []
        self.words: list[pa.Array] = []
        self.index: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.often = np.zeros(0, np.int64)
        self.chars = self.held = self.part = 0

    def add(self, texts: list[str | None], rows: pa.Array | None) -> None:
        counts = np.zeros(len(texts), np.int64)
        for owners, some in pieces.parts(texts):
            found = self.cut(some)
            self.words.append(found.words)
            self.index.append(found.index)
            np.add.at(counts, owners, found.counts)
            self.held += len(found.words)
            self.chars += sum(map(len, some))
        self.counts.append(counts)
        if rows is not None:
            self.rows.append(pc.take(rows, pa.array(np.arange(len(rows)))))  # a copy, which doesn't hold the texts

    def numbered(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(pieces, the most frequent first; numbers of all pieces in reading order; how many each document has).

        ``often`` then holds how often each of the pieces occurs.
        """
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        if not self.words:
            return pa.array([], pa.string()), np.zeros(0, np.int32), counts
        merged = pa.concat_arrays(self.words).dictionary_encode()
        same = np.split(merged.indices.to_numpy(), np.cumsum([len(w) for w in self.words])[:-1])
        flat = np.concatenate([s[i] for s, i in zip(same, self.index, strict=True)])
        self.index = []
        often = np.bincount(flat, minlength=len(merged.dictionary))
        order = np.argsort(-often, kind="stable")
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        used = int((often > 0).sum())  # what stands between pieces is none
        self.often = often[order[:used]]
        return merged.dictionary.take(pa.array(order[:used])), number[flat], counts


def blocks(
    batches: Iterator[pa.RecordBatch], cut: Callable[[list[str]], pieces.Cut], text: str = "text", rows: str | None = "row"
) -> Iterator[Block]:
    """The blocks of a task's documents, in order."""
    block = Block(cut)
    for batch in batches:
        for part in util.slices(batch, text):
            block.add(part.column(text).to_pylist(), part.column(rows) if rows else None)
            if "part" in part.schema.names:
                block.part = part.column("part")[0].as_py()
            if block.chars >= BLOCK_CHARS or block.held >= BLOCK_WORDS:
                yield block
                block = Block(cut)
                give_back()
    if block.counts:
        yield block
    del block
    give_back()
