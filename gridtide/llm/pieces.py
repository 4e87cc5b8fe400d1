"""Texts cut into pieces by the split pattern of byte-level vocabularies, in bulk.

The pattern's classes (letters, numbers, white space) are read off the
tokenizer library itself, not taken from another Unicode table. A batch of
texts is cut by array operations over its code points; the distinct pieces and
each piece's number come from Arrow's dictionary encoding, so no Python object
is made for a piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

#: Characters handled at once; a longer text is cut between two plain words.
BATCH_CHARS = 2_000_000
_END, _LETTER, _NUMBER, _OTHER, _SPACE = range(5)
#: The endings that the split pattern takes together with their apostrophe.
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")
#: A blank between plain characters always begins a piece.
_safe_cut = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


@cache
def library_classes() -> np.ndarray:
    """Class of each code point, as the tokenizer library's own patterns see it.

    Each class is asked for once: the library drops what its pattern doesn't
    match, so a pattern of one class leaves exactly that class of all code points.
    """
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    out = np.full(0x110000, _OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\s", _SPACE)):
        library = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        for first in range(0, 0x110000, 0x1000):
            points = np.arange(first, first + 0x1000, dtype="<u4")
            points = points[(points < 0xD800) | (points >= 0xE000)]
            found = bytes(library.encode_ordinary(points.tobytes().decode("utf-32-le"))).decode()
            out[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    return out


def character_class(kind: str) -> str:
    """The library's letters ("L"), numbers ("N") or white space ("s") as the inside of a regular expression's class."""
    points = np.flatnonzero(library_classes() == {"L": _LETTER, "N": _NUMBER, "s": _SPACE}[kind])
    runs = np.split(points, np.flatnonzero(np.diff(points) > 1) + 1)
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)


def parts(texts: list[str | None], limit: int = BATCH_CHARS) -> Iterator[tuple[list[int], list[str]]]:
    """(numbers of the texts, their parts) in batches of about ``limit`` characters; null texts have no part."""
    owners, held, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            end = len(text)
            if end - at > limit and (found := _safe_cut.search(text, at + limit)):
                end = found.start()
            owners.append(i)
            held.append(text if end - at == len(text) else text[at:end])
            size += end - at
            at = end
            if size >= limit:
                yield owners, held
                owners, held, size = [], [], 0
    if held:
        yield owners, held


@dataclass
class Cut:
    """Pieces of a batch of texts: ``words[index]`` in reading order, ``counts`` of them for each text."""

    words: pa.Array
    index: np.ndarray
    counts: np.ndarray


def _joined(texts: list[str]) -> tuple[str, np.ndarray]:
    """All texts, each with a line break behind it, and the places of these line breaks."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return "\n".join(texts) + "\n", np.cumsum(sizes + 1) - 1


def _byte_places(text: str, points: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Byte offsets (UTF-8) of places among the code points."""
    if text.isascii():
        return places
    wide = np.zeros(len(points) + 1, np.int32 if len(points) < 1 << 29 else np.int64)
    for least in (0x80, 0x800, 0x10000):
        wide[1:] += points >= least
    return places + np.cumsum(wide, out=wide)[places]


def _encoded(data: bytes, starts: np.ndarray, ends_at: np.ndarray) -> Cut:
    """Dictionary of the slices of ``data`` between ``starts``; the slices at ``ends_at`` (ordinals) close a text."""
    offsets = np.append(starts, len(data)).astype(np.int32)
    sliced = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    coded = sliced.dictionary_encode()
    counts = np.diff(ends_at, prepend=-1) - 1  # without the slice that closes the text
    return Cut(coded.dictionary, np.delete(coded.indices.to_numpy(), ends_at), counts)


def cut(texts: list[str]) -> Cut:
    """The matches of the split pattern in each text.

    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``:
    a piece begins where the class changes; before other characters a run of
    white space gives up its last one, which joins them if it is a blank; an
    apostrophe that begins a piece takes a short ending with it.
    """
    text, ends = _joined(texts)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kinds = library_classes()[points]
    kinds[ends] = _END
    begins = np.empty(len(points), bool)
    begins[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
    begins[ends] = True
    after = np.flatnonzero((kinds[:-1] == _SPACE) & (kinds[1:] != _SPACE) & (kinds[1:] != _END)) + 1
    begins[after - 1] = True
    begins[after] = points[after - 1] != 0x20
    quotes = np.flatnonzero((points == 0x27) & begins)  # the last place is a text's end, never an apostrophe
    if len(quotes):
        one = points[quotes + 1]
        two = points[np.minimum(quotes + 2, len(points) - 1)]
        length = np.zeros(len(quotes), np.int64)
        for ending in SHORT_ENDINGS:
            length[one == ord(ending)] = 2
        for ending in LONG_ENDINGS:
            length[(one == ord(ending[0])) & (two == ord(ending[1]))] = 3
        short = length > 0
        begins[quotes[short] + 1] = False
        begins[quotes[short] + length[short]] = True
    places = np.flatnonzero(begins)
    return _encoded(text.encode(), _byte_places(text, points, places), np.searchsorted(places, ends))


def letter_runs(texts: list[str]) -> Cut:
    """Each text's runs of letters, whatever stands between them."""
    text, ends = _joined(texts)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    letter = library_classes()[points] == _LETTER
    begins = np.empty(len(points), bool)
    begins[0] = True
    np.not_equal(letter[1:], letter[:-1], out=begins[1:])
    places = np.flatnonzero(begins)
    found = _encoded(text.encode(), _byte_places(text, points, places), np.zeros(0, np.int64))
    kept = letter[places]
    # a text's runs are those that begin before its end
    counts = np.diff(np.searchsorted(places[kept], ends), prepend=0)
    return Cut(found.words, found.index[kept], counts)


def blank_runs(texts: list[str]) -> Cut:
    """Each text cut before every run of blanks that follows another character."""
    text, ends = _joined(texts)
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    if not text.isascii():
        # line breaks behind the texts, as bytes
        ends = _byte_places(text, np.frombuffer(text.encode("utf-32-le"), "<u4"), ends)
    blank = raw == 0x20
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[0] = True
    begins[ends] = True
    begins[ends[:-1] + 1] = True
    places = np.flatnonzero(begins)
    return _encoded(data, places, np.searchsorted(places, ends))


def gather(starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all items of the ``chosen`` runs, one run after another, and the runs' sizes."""
    size = sizes[chosen]
    total = int(size.sum())
    first = np.repeat(starts[chosen] - (np.cumsum(size) - size), size)
    return first + np.arange(total), size


def total(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values`` with ``counts`` members (0 for an empty run)."""
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]
