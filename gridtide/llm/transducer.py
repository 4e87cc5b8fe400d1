"""Minimal acyclic transducer: a set of words in an automaton that shares
prefixes and suffixes, with each word's token ids as its output.

Every edge carries the number of accepted words that sort before those reached
through it, so the sum along a word's path is the word's place in byte order
(its output key); one table maps that place to the ids. The whole transducer is
one flat file of arrays that any number of processes can map into memory.
"""

from __future__ import annotations

import mmap

import numpy as np

_MAGIC = 0x54445543
_ARRAYS = ("first", "label", "target", "skip", "final", "offset", "ids")
_KINDS = {"label": np.uint8, "final": np.uint8}


def build(entries: list[tuple[bytes, bytes]]) -> bytes:
    """The file of a transducer for (word, ids as bytes); words are distinct and not empty.

    Incremental construction over the sorted words: the path of the last word
    is kept open, closed states are looked up among the equal ones seen before.
    """
    entries = sorted(entries)
    edges: list[list[tuple[int, int]]] = [[]]
    final = [False]
    known: dict[tuple, int] = {}
    path = [0]
    free: list[int] = []

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            key = (final[state], tuple(edges[state]))
            same = known.get(key)
            if same is None:
                known[key] = state
            else:
                parent = edges[path[-1]]
                parent[-1] = (parent[-1][0], same)
                edges[state], final[state] = [], False
                free.append(state)

    last = b""
    for word, _ in entries:
        depth = 0
        while depth < min(len(last), len(word)) and last[depth] == word[depth]:
            depth += 1
        close(depth)
        for c in word[depth:]:
            if free:
                state = free.pop()
            else:
                state = len(edges)
                edges.append([])
                final.append(False)
            edges[path[-1]].append((c, state))
            path.append(state)
        final[path[-1]] = True
        last = word
    close(0)

    # number the states that are left, from the root; count the words below each
    order, seen = [0], {0: 0}
    for state in order:
        for _, t in edges[state]:
            if t not in seen:
                seen[t] = len(order)
                order.append(t)
    below: dict[int, int] = {}
    stack = [0]
    while stack:
        state = stack[-1]
        todo = [t for _, t in edges[state] if t not in below]
        if todo:
            stack.extend(todo)
            continue
        stack.pop()
        below[state] = final[state] + sum(below[t] for _, t in edges[state])
    first, label, target, skip = [0], [], [], []
    for state in order:
        passed = int(final[state])
        for c, t in edges[state]:
            label.append(c)
            target.append(seen[t])
            skip.append(passed)
            passed += below[t]
        first.append(len(label))
    sizes = [len(x) // 4 for _, x in entries]
    arrays = {
        "first": first, "label": label, "target": target, "skip": skip,
        "final": [int(final[s]) for s in order], "offset": np.cumsum([0, *sizes]),
        "ids": np.frombuffer(b"".join(x for _, x in entries), "<u4"),
    }
    parts = []
    for name in _ARRAYS:
        data = np.asarray(arrays[name]).astype(_KINDS.get(name, np.uint32)).tobytes()
        parts.append(data + b"\0" * (-len(data) % 8))
    head = np.array([_MAGIC, *(len(arrays[n]) for n in _ARRAYS)], "<u8").tobytes()
    return head + b"".join(parts)


class Transducer:
    """A transducer file, mapped into memory (or held as bytes)."""

    def __init__(self, path: str | None = None, data: bytes | None = None):
        if path is not None:
            with open(path, "rb") as f:
                data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(data, "<u8", 1 + len(_ARRAYS))
        if int(head[0]) != _MAGIC:
            raise ValueError("not a transducer file")
        at = head.nbytes
        for name, n in zip(_ARRAYS, head[1:].tolist(), strict=True):
            kind = np.dtype(_KINDS.get(name, np.uint32))
            setattr(self, name, np.frombuffer(data, kind, n, at))
            at += n * kind.itemsize + (-n * kind.itemsize % 8)
        self.words = len(self.offset) - 1
        # one key per edge, ascending: all edges of a state are neighbours and sorted by label
        owner = np.repeat(np.arange(len(self.first) - 1, dtype=np.int64), np.diff(self.first.astype(np.int64)))
        self._edge = owner << 8 | self.label

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in byte order; -1 for words the lexicon lacks. All words walk together."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not self.words:
            return out
        size = np.fromiter(map(len, words), np.int64, n)
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        flat = np.frombuffer(b"".join(words), np.uint8)
        live, state, place, depth = np.flatnonzero(size > 0), None, None, 0
        state, place = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        while len(live):
            key = state << 8 | flat[start[live] + depth]
            e = np.searchsorted(self._edge, key)
            ok = e < len(self._edge)
            ok[ok] = self._edge[e[ok]] == key[ok]
            live, e, place = live[ok], e[ok], place[ok]
            place = place + self.skip[e]
            state = self.target[e].astype(np.int64)
            depth += 1
            ended = size[live] == depth
            hit = ended & (self.final[state] == 1)
            out[live[hit]] = place[hit]
            live, state, place = live[~ended], state[~ended], place[~ended]
        return out

    def lookup(self, words: list[bytes]) -> list[bytes | None]:
        """The ids (little-endian unsigned 32-bit) of each word, or None."""
        low = self.offset
        return [
            None if p < 0 else self.ids[int(low[p]) : int(low[p + 1])].tobytes() for p in self.places(words).tolist()
        ]
