"""Exact byte-pair merging, many words at once.

:class:`Merges` holds a BPE vocabulary as flat arrays. Words of up to
``SHORT`` symbols are merged together as rows of one matrix: each round merges,
in every row that still can, the leftmost pair of lowest rank. Longer words go
through a heap (O(n log n)), with the same order of merges.
"""

from __future__ import annotations

import heapq
import json

import numpy as np

SHORT = 32
NONE = np.int32(2**31 - 1)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def byte_symbols() -> dict[int, str]:
    """Byte -> the printable character that stands for it in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return out


class Merges:
    """Vocabulary and merges of a byte-level BPE tokenizer file."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        vocab = dict(spec["model"]["vocab"])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        symbols = byte_symbols()
        back = {c: b for b, c in symbols.items()}
        self.first = np.array([vocab[symbols[b]] for b in range(256)], np.int32)
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.new_id = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self._pairs = {(int(a), int(b)): r for r, (a, b) in enumerate(zip(left, right, strict=True))}
        self._bits = max(10, int(len(pairs) * 4).bit_length())
        self._key = np.full(1 << self._bits, -1, np.int64)
        self._rank = np.full(1 << self._bits, NONE, np.int32)
        mask = (1 << self._bits) - 1
        for r, key in enumerate((left << 32 | right).tolist()):
            at = (key * int(_MULT) & 0xFFFFFFFFFFFFFFFF) >> (64 - self._bits)
            while self._key[at] != -1 and self._key[at] != key:
                at = (at + 1) & mask
            if self._key[at] == -1:
                self._key[at], self._rank[at] = key, r

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where the pair is no merge."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = ((key.view(np.uint64) * _MULT) >> np.uint64(64 - self._bits)).astype(np.int64)
        found = self._key[at]
        out = np.where(found == key, self._rank[at], NONE)
        todo = np.flatnonzero((found != key) & (found != -1))
        mask = (1 << self._bits) - 1
        while len(todo):
            at[todo] = (at[todo] + 1) & mask
            found = self._key[at[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self._rank[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out: list[bytes] = [b""] * len(words)
        for low, high in ((1, 8), (9, 16), (17, SHORT)):
            some = np.flatnonzero((sizes >= low) & (sizes <= high))
            for begin in range(0, len(some), 65536):
                part = some[begin : begin + 65536]
                ids, kept = self._matrix([words[i] for i in part.tolist()], high)
                flat = ids[np.arange(ids.shape[1])[None, :] < kept[:, None]].astype("<u4").tobytes()
                ends = (np.cumsum(kept) * 4).tolist()
                last = 0
                for i, end in zip(part.tolist(), ends, strict=True):
                    out[i] = flat[last:end]
                    last = end
        for i in np.flatnonzero(sizes > SHORT).tolist():
            out[i] = np.array(self.merge_long(words[i]), "<u4").tobytes()
        return out

    def _matrix(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(words)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        length = np.fromiter(map(len, words), np.int64, n)
        out, kept = self.first[raw], length.copy()
        rows = np.arange(n)
        a = out.copy()
        cols = np.arange(width - 1)
        rank = np.where(
            cols[None, :] < length[:, None] - 1, self.ranks(a[:, :-1].ravel(), a[:, 1:].ravel()).reshape(n, -1), NONE
        )
        while len(rows):
            j = rank.argmin(axis=1)
            at = np.arange(len(rows))
            best = rank[at, j]
            done = best == NONE
            if done.any():
                out[rows[done]], kept[rows[done]] = a[done], length[done]
                go = ~done
                rows, a, rank, length, j, best = rows[go], a[go], rank[go], length[go], j[go], best[go]
                at = np.arange(len(rows))
                if not len(rows):
                    break
            # the pair (j, j+1) becomes one symbol at j; everything right of it moves one place left
            move = cols[None, :] > j[:, None]
            a[:, :-1] = np.where(move, a[:, 1:], a[:, :-1])
            a[at, j] = self.new_id[best]
            rank[:, :-1] = np.where(move[:, :-1], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = NONE
            length = length - 1
            left = np.flatnonzero(j > 0)
            rank[left, j[left] - 1] = self.ranks(a[left, j[left] - 1], a[left, j[left]])
            more = j < length - 1
            rank[~more, j[~more]] = NONE
            right = np.flatnonzero(more)
            rank[right, j[right]] = self.ranks(a[right, j[right]], a[right, j[right] + 1])
        return out, kept

    def merge_long(self, word: bytes) -> list[int]:
        """One word by a heap of (rank, position)."""
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self._pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, x, y = heapq.heappop(heap)
            j = after[i] if ids[i] == x else -1
            if j < 0 or ids[j] != y:
                continue
            ids[i], ids[j] = int(self.new_id[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for p in (before[i], i):
                if p >= 0 and after[p] >= 0:
                    k = self._pairs.get((ids[p], ids[after[p]]))
                    if k is not None:
                        heapq.heappush(heap, (k, p, ids[p], ids[after[p]]))
        return [x for x in ids if x >= 0]
