"""Token ids as wavelet matrices: one compressed blob per shard (operator 10).

A shard holds the ids of consecutive documents. Its distinct ids are numbered
in ascending order and only ``ceil(log2(distinct))`` bit planes are stored, each
with a rank directory (ones before every 512th bit), so that the blob itself
answers: the id at a place, how often an id occurs in a range, and where its
k-th occurrence is -- without unpacking the shard. The shards are rows of a
Parquet table (``part, seq, tokens, docs, blob``), which gives atomic commits
and reads on any file system.

Defined results: a null text is an empty text (only the end id); documents are
written in ascending ``doc_id`` (nulls first), repeated ids by their text; an
empty table writes no shard and reads back no row; extra columns are ignored.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
import uuid
from collections.abc import Iterable, Iterator
from functools import cache, partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridtide.llm import pieces, util
from gridtide.session import checkpoint_dir

#: Tokens after which a shard is closed (a single longer document makes a longer shard).
SHARD_TOKENS = 1 << 20
#: Bits between two entries of a rank directory.
STEP = 512
#: Words after which a worker's cache keeps only those of the texts at hand (bounds its memory).
CACHE = 500_000
#: Bytes of documents whose words are looked up together, and what a document counts besides its text.
GROUP_BYTES, ROW_BYTES = 16_000_000, 64
#: Texts that Spark hands a worker at once while shards are written.
BATCH_ROWS = 1000
_CLOSING = ".,;:!?"
#: An ending that the vocabulary takes with its apostrophe though a blank stands before it.
_own_ending = re.compile(r"\s'(?:s|t|re|ve|m|ll|d)")
_MAGIC = 0x574D5831


class Shard:
    """A wavelet matrix over one sequence of ids."""

    def __init__(self, blob: bytes):
        head = np.frombuffer(blob, "<u4", 4)
        if int(head[0]) != _MAGIC:
            raise ValueError("not a wavelet shard")
        self.n, self.levels, distinct = (int(x) for x in head[1:])
        at = 16
        self.alphabet = np.frombuffer(blob, "<u4", distinct, at)
        at += distinct * 4
        self.zeros = np.frombuffer(blob, "<u4", self.levels, at).astype(np.int64)
        at += self.levels * 4
        steps, width = self.n // STEP + 1, -(-self.n // 8)
        self.planes, self.ranks = [], []
        for _ in range(self.levels):
            self.ranks.append(np.frombuffer(blob, "<u4", steps, at))
            at += steps * 4
            self.planes.append(np.frombuffer(blob, np.uint8, width, at))
            at += width

    @staticmethod
    def pack(ids: np.ndarray) -> bytes:
        ids = np.ascontiguousarray(ids, dtype=np.uint32)
        n = len(ids)
        seen = np.bincount(ids) if n and int(ids.max()) < 1 << 20 else None
        alphabet = np.flatnonzero(seen) if seen is not None else np.unique(ids)
        distinct = len(alphabet)
        levels = max(1, int(distinct - 1).bit_length()) if distinct else 0
        small = np.uint16 if levels <= 16 else np.uint32
        if seen is not None:
            code = np.zeros(len(seen), small)
            code[alphabet] = np.arange(distinct, dtype=small)
            x = code[ids]
        else:
            x = np.searchsorted(alphabet, ids).astype(small)
        zeros, parts = [], []
        for k in range(levels - 1, -1, -1):
            bits = (x >> small(k)) & small(1)
            one = bits.astype(bool)
            packed = np.packbits(one, bitorder="little")
            whole = np.zeros((n // STEP + 1) * (STEP // 8), np.uint8)
            whole[: len(packed)] = packed
            ones = np.bitwise_count(whole.view(np.uint64)).reshape(-1, STEP // 64).sum(axis=1, dtype=np.int64)
            parts += [np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4").tobytes(), packed.tobytes()]
            low = np.compress(~one, x)
            zeros.append(len(low))
            x = np.concatenate((low, np.compress(one, x)))
        head = np.array([_MAGIC, n, levels, distinct], "<u4").tobytes()
        return head + alphabet.astype("<u4").tobytes() + np.array(zeros, "<u4").tobytes() + b"".join(parts)

    def unpack(self) -> np.ndarray:
        """All ids, in order: the planes are undone from the last to the first."""
        x = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            z = int(self.zeros[level])
            back = np.empty_like(x)
            back[np.flatnonzero(~one)] = x[:z]
            back[np.flatnonzero(one)] = x[z:] | x.dtype.type(1 << (self.levels - 1 - level))
            x = back
        return self.alphabet[x] if self.n else np.zeros(0, np.uint32)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        step = i // STEP
        part = self.planes[level][step * STEP // 8 : -(-i // 8)]
        rest = i - step * STEP
        bits = int.from_bytes(part.tobytes(), "little") & ((1 << rest) - 1)
        return int(self.ranks[level][step]) + bits.bit_count()

    def __getitem__(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for level in range(self.levels):
            bit = int(self.planes[level][i >> 3]) >> (i & 7) & 1
            ones = self._ones(level, i)
            i = int(self.zeros[level]) + ones if bit else i - ones
            code = code << 1 | bit
        return int(self.alphabet[code])

    def _code(self, token: int) -> int:
        c = int(np.searchsorted(self.alphabet, token))
        return c if c < len(self.alphabet) and int(self.alphabet[c]) == token else -1

    def _range(self, code: int, low: int, high: int) -> tuple[int, int]:
        for level in range(self.levels):
            a, b = self._ones(level, low), self._ones(level, high)
            if code >> (self.levels - 1 - level) & 1:
                low, high = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of an id in ``[low, high)``."""
        code = self._code(token)
        high = self.n if high is None else high
        if code < 0 or low >= high:
            return 0
        a, b = self._range(code, low, high)
        return b - a

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) bit of a kind in a plane: binary search over the directory, then the block."""
        steps = np.arange(len(self.ranks[level]), dtype=np.int64) * STEP
        before = self.ranks[level].astype(np.int64) if bit else steps - self.ranks[level]
        step = int(np.searchsorted(before, k, side="right")) - 1
        block = np.unpackbits(self.planes[level][step * STEP // 8 : (step + 1) * STEP // 8], bitorder="little")
        return step * STEP + int(np.flatnonzero(block == bit)[k - int(before[step])])

    def occurrence(self, token: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence of an id; -1 if there are fewer."""
        code = self._code(token)
        if code < 0:
            return -1
        low, high = self._range(code, 0, self.n)
        if k < 0 or k >= high - low:
            return -1
        i = low + k
        for level in range(self.levels - 1, -1, -1):
            bit = code >> (self.levels - 1 - level) & 1
            i = self._select(level, bit, i - int(self.zeros[level]) if bit else i)
        return i


@cache
def _simple_points() -> np.ndarray:
    """Characters that the vocabulary's normalizer changes one by one, if at all: ASCII, letters of the
    European alphabets that aren't composed with others, and common signs."""
    out = np.zeros(0x110000, bool)
    out[:0x80] = True
    for c in range(0xA1, 0x530):
        low = chr(c).lower()
        letter = unicodedata.category(chr(c)) in ("Ll", "Lu") and len(low) == 1 and unicodedata.category(low) == "Ll"
        out[c] = letter and unicodedata.is_normalized("NFC", chr(c) + low)
    out[[0x3A3, 0x130]] = False  # lower-cased by their neighbours, or to more than one
    out[[0xA7, 0xB0, 0xBF, 0xA1, 0xAB, 0xBB, 0x20AC, 0x2026, *range(0x2010, 0x2023)]] = True
    return out


def _cells(ids: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The runs of ``ids`` that end before each of ``ends``, as the bytes of their ids."""
    offsets = np.append(0, ends).astype(np.int64) * 4
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


def _parts_of(cells: pa.LargeBinaryArray) -> tuple[np.ndarray, bytes]:
    """Offsets of the values, from 0, and the bytes of all of them."""
    _, offsets, data = cells.buffers()
    at = np.frombuffer(offsets, np.int64, len(cells) + 1, cells.offset * 8)
    return at - at[0], data.slice(int(at[0]), int(at[-1] - at[0])).to_pybytes() if data else b""


def _encoded(library, texts: list[str]) -> Iterator:
    """The library's encodings, of a bounded number of texts at a time: they take far more room than the ids."""
    for i in range(0, len(texts), 128):
        yield from library.encode_batch_fast(texts[i : i + 128], add_special_tokens=False)


class WordEncoder:
    """The tokenizers library behind a cache of words.

    The vocabulary drops white space and never merges across it, nor across
    letters, digits and signs. Texts of simple characters are cut there in bulk,
    and each distinct piece that is new to the worker goes to the library once.
    Their cache is a dictionary of Arrow: encoding the known words and all pieces
    with one dictionary numbers the pieces and appends the new ones, and ``pool``
    holds each word's ids, so no Python object is made for a known word.
    Other texts are cut at blanks only; the pieces new to the worker go to the
    library together, with a special token between them.
    """

    def __init__(self, tokenizer_json: str):
        # a task has one core: the library's threads would each hold memory of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(tokenizer_json)
        self.library.no_truncation()
        self.library.no_padding()
        # the same model for words that the normalizer leaves as they are: cut at blanks, no patterns
        self.plain = Tokenizer(self.library.model)
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), as_bytes])
        added = self.library.get_added_tokens_decoder()
        mark = next(iter(added.items()))
        self.mark_id, self.mark = mark[0], mark[1].content
        self.special = [token.content.lower() for token in added.values()]
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        """The empty word alone, which has no ids, as the cache of simple texts."""
        self.known = pa.array([""], pa.string())
        self.pool = pa.array([b""], pa.large_binary())

    def learn(self, found: list[str]) -> None:
        """Put the ids of the pieces into the cache.

        The ids of "word," are those of "word" and of ",": letters and closing
        punctuation are never merged. Words go to the library in lower case
        (where they are ASCII: its normalizer does no more), many at a time.
        """
        plan, words, rest = [], set(), set()
        for p in found:
            word = p.rstrip(_CLOSING)
            plain = word.isascii()
            # other letters may be taken apart by the normalizer, and a mark joins the punctuation
            if word.isalpha() and (plain or unicodedata.normalize("NFC", word.lower()).isalpha()):
                low = word.lower() if plain else word
                tail = p[len(word) :]
                plan.append((p, low, tail))
                if low not in self.cache:
                    words.add(low)
                if tail not in self.cache:
                    rest.add(tail)
            else:
                rest.add(p)
        cache = self.cache
        for new, encode in ((list(words), partial(self._words, self.library)), (list(rest), self._marked)):
            cache.update(zip(new, encode(new).to_pylist(), strict=True))
        for p, low, tail in plan:
            cache[p] = cache[low] + cache[tail]

    def _words(self, library, words: list[str]) -> pa.LargeBinaryArray:
        """Ids of words of letters: each ends with the only token of it that ends a word."""
        runs = [words[i : i + 64] for i in range(0, len(words), 64)]
        out = []
        for run, e in zip(runs, _encoded(library, [" ".join(run) for run in runs]), strict=True):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            # else a letter that the normalizer takes apart
            out.append(_cells(ids, ends) if len(ends) == len(run) else self._marked(run))
        return pa.concat_arrays(out or [self.pool[:0]])

    def _marked(self, found: list[str]) -> pa.LargeBinaryArray:
        """Ids of any pieces, with a special token between them; those that hold it themselves go one by one."""
        alone = [i for i, p in enumerate(found) if self.mark in p]
        joined = sorted(set(range(len(found))).difference(alone)) if alone else range(len(found))
        runs = [[found[i] for i in joined[k : k + 64]] for k in range(0, len(joined), 64)]
        texts = [self.mark.join(run) + self.mark for run in runs]
        out = []
        for e in _encoded(self.library, texts):
            ids = np.array(e.ids, "<u4")
            mark = ids == self.mark_id
            out.append(_cells(ids[~mark], np.flatnonzero(mark) - np.arange(np.count_nonzero(mark))))
        for e in _encoded(self.library, [found[i] for i in alone]):
            out.append(_cells(np.array(e.ids, "<u4"), np.array([len(e.ids)])))
        cells = pa.concat_arrays(out or [self.pool[:0]])
        return cells.take(pa.array(np.argsort([*joined, *alone]))) if alone else cells

    def _lowered(self, text: str) -> str | None:
        """The text in lower case, if it may be cut at letters, digits and signs."""
        low = text.lower()
        if ("'" in low and _own_ending.search(low)) or any(token in low for token in self.special):
            return None
        if not low.isascii() and not _simple_points()[np.frombuffer(text.encode("utf-32-le"), "<u4")].all():
            return None
        return low

    def _simple(self, texts: Iterable[str]) -> dict[int, bytes]:
        """Ids, by number, of texts that are cut in bulk: each distinct piece once, then by position."""
        out = {}
        cuts = [(owners, pieces.cut(some)) for owners, some in pieces.parts(texts)]
        if not cuts:
            return out
        units = [pc.utf8_ltrim(found.words, " ") for _, found in cuts]
        coded = pa.chunked_array([self.known, *units]).dictionary_encode().chunks[1:]
        self._learn_units(coded[0].dictionary)
        numbers = [part.indices.to_numpy() for part in coded]
        for (owners, found), number in zip(cuts, numbers, strict=True):
            offsets, data = _parts_of(self.pool.take(pa.array(number[found.index])))
            ends = offsets[np.cumsum(found.counts)].tolist()
            for i, a, b in zip(owners, [0, *ends], ends, strict=False):
                out[i] = out[i] + data[a:b] if i in out else data[a:b]
        if len(self.known) > CACHE:
            self._keep(pa.array(np.unique(np.concatenate(numbers))))
        return out

    def _learn_units(self, words: pa.StringArray) -> None:
        """``words`` are the known ones and then new ones, whose ids join the pool."""
        new = words[len(self.known) :].to_numpy(zero_copy_only=False).tolist()
        letters = np.fromiter(map(str.isalpha, new), bool, len(new))
        first, rest = np.flatnonzero(letters).tolist(), np.flatnonzero(~letters).tolist()
        cells = pa.concat_arrays([self._words(self.plain, [new[i] for i in first]), self._marked([new[i] for i in rest])])
        order = np.empty(len(new), np.int64)
        order[first + rest] = np.arange(len(new))
        self.pool = pa.concat_arrays([self.pool, cells.take(pa.array(order))])
        self.known = words

    def _keep(self, used: pa.Array) -> None:
        """Only the words with the given numbers stay in the cache, or none if they are too many themselves."""
        if len(used) > CACHE:
            self._forget()
        else:
            self.known, self.pool = self.known.take(used), self.pool.take(used)

    def __call__(self, texts: Iterable[str | None]) -> list[bytes]:
        n, others = 0, {}

        def lowered() -> Iterator[str]:
            nonlocal n
            for t in texts:
                low = self._lowered(t or "")
                if low is None:
                    others[n] = t
                n += 1
                yield low or ""

        out = self._simple(lowered())
        some, size = [], 0
        for i, t in others.items():
            some.append(i)
            size += len(t)
            if size > util.SLICE_BYTES // 4:
                out |= zip(some, self._at_blanks([others[k] for k in some]), strict=True)
                some, size = [], 0
        out |= zip(some, self._at_blanks([others[k] for k in some]), strict=True)
        return [out.get(i, b"") for i in range(n)]

    def _at_blanks(self, texts: list[str]) -> list[bytes]:
        """Texts that are cut at blanks only: the pieces new to the worker go to the library together."""
        if len(self.cache) > CACHE:
            self.cache = {}
        split = [t.replace("\n", " ").split(" ") for t in texts]
        self.learn([p for p in set().union(*split) if p not in self.cache])
        return [b"".join(map(self.cache.__getitem__, ps)) for ps in split]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Slices of the batches, about ``GROUP_BYTES`` of documents at a time (or one longer text)."""
    held, size = [], 0
    for batch in batches:
        for piece in util.slices(batch, "text"):
            n = (pc.sum(pc.binary_length(piece.column("text"))).as_py() or 0) + ROW_BYTES * piece.num_rows
            if held and size + n > GROUP_BYTES:
                yield held
                held, size = [], 0
            held.append(piece)
            size += n
    if held:
        yield held


_workers: dict[int, WordEncoder] = {}

_SHARD = "part int, seq int, before long, tokens long, doc_ids array<long>, ends array<long>, blob binary"


def write_shards(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode every text, append ``end_id``, and write the shards in ascending ``doc_id``.

    Documents are range-partitioned by ``doc_id``: a partition's shards follow
    those of the partition before it, and no task holds more than one shard and
    one group of texts.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _workers.get(os.getpid()) or _workers.setdefault(os.getpid(), WordEncoder(vocabulary.value))
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        held, ids, tokens = [], [], 0

        def close():
            data = np.frombuffer(b"".join(held), "<u4")
            ends = np.cumsum([len(h) // 4 for h in held])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()),
                    pa.array([len(data)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                    pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([Shard.pack(data)], pa.binary()),
                ],
                names=["part", "seq", "before", "tokens", "doc_ids", "ends", "blob"],
            )

        for group in _groups(batches):
            gc.disable()
            encoded = encode(t for piece in group for t in piece.column("text").to_pylist())
            gc.enable()
            for doc_id, x in zip((d for piece in group for d in piece.column("doc_id").to_pylist()), encoded, strict=True):
                held.append(x + end)
                ids.append(doc_id)
                tokens += len(x) // 4 + 1
                if tokens >= shard_tokens:
                    yield close()
                    seq, before, held, ids, tokens = seq + 1, before + tokens, [], [], 0
        if held:
            yield close()

    with util.arrow_rows(spark, BATCH_ROWS):
        rows.mapInArrow(run, _SHARD).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document, unpacked from the shards; ``start`` counts all ids before it."""
    shards = spark.read.schema(_SHARD).parquet(path)
    parts = shards.groupBy("part").agg(F.sum("tokens").alias("n"))
    # one row per write task: the running sum over them needs one small task
    base = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                data = pa.py_buffer(Shard(one.column("blob")[0].as_py()).unpack().astype("<u4"))
                ends = one.column("ends")[0].values.to_numpy()
                starts = np.concatenate(([0], ends[:-1]))
                ids = one.column("doc_ids")[0].values
                first = one.column("before")[0].as_py()
                for i in range(0, len(ends), 2000):
                    a, b = starts[i : i + 2000], ends[i : i + 2000]
                    at = ((np.append(a, b[-1]) - a[0]) * 4).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([one.column("part")[0].as_py()] * len(a), pa.int32()),
                            ids[i : i + 2000],
                            pa.array(a + first, pa.int64()),
                            pa.Array.from_buffers(
                                pa.binary(), len(a), [None, pa.py_buffer(at), data.slice(int(a[0]) * 4, int(b[-1] - a[0]) * 4)]
                            ),
                        ],
                        names=["part", "doc_id", "at", "ids"],
                    )

    rows = shards.mapInArrow(run, "part int, doc_id long, at long, ids binary")
    return rows.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "ids")


def op10(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Write the wavelet shards of all ``documents``, read them back, and report place, size and checksum."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/wavelet-{uuid.uuid4().hex}"
    write_shards(util.table(spark, sf_dir, "documents"), path, tokenizer_path or _default_path())
    return read_documents(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )



def _default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
