"""Byte-level BPE by a global shuffle of distinct words (operator 12).

Texts are cut into pre-tokens by the split pattern and exploded, block by block
(``blocks.py``): a row for each distinct word of a block with its number, and
for each document the numbers of its words by position. The word rows are
shuffled by the word and sorted, so that equal words of the whole corpus stand
together: each distinct word is encoded once, and its ids join every row of its
run. The rows then go back to their block, where the documents' positions are
filled with the ids. Decoding joins the ids with the vocabulary's token-byte
table.

Scale: a frequent word has one row per block, not one per occurrence, so no word
is a hot key. A task holds one block's ids at most. The vocabulary (its size is
fixed by its file) is the only thing broadcast.

The texts are read twice, for the words and for the positions. Each block
is named by a hash of its words: if the second reading deals the documents
otherwise (an input whose order isn't fixed), they find no words and the task
fails with a message; store such an input first.

Defined results: a null text is an empty text (no ids, empty bytes); an empty
table gives an empty table; extra columns of any name are passed through, and a
column named like the output is replaced; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gridtide.llm import blocks, pieces, util

#: Tokens that are put together at once.
_TOKENS = 500_000
#: Words of the documents whose positions are packed together.
_GROUP = 20_000
#: Words that leave a task as one batch, before the shuffle by word and behind it.
_ROWS = 20_000
_SENT = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file (a base64 token and its rank per line)."""
    lines = Path(path).read_bytes().split(b"\n")
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line)}


class Words:
    """Ids of single words; the library merges each as it stands."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.library = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})

    def __call__(self, word: str) -> np.ndarray:
        return np.array(self.library.encode_ordinary(word), np.uint32)


def _name(block: blocks.Block, seq: int, words: pa.Array) -> int:
    """A block's name: a hash of its place, its words and their order (``words`` is a whole array of its own)."""
    sizes = pc.binary_length(words).to_numpy()
    h = xxhash.xxh64(sizes.tobytes(), seed=block.part << 24 | seq)
    if len(sizes):
        h.update(memoryview(words.buffers()[2])[: int(sizes.sum())])
    return h.intdigest() >> 1


def _words(batches):
    for seq, block in enumerate(blocks.blocks(batches, pieces.cut, rows=None)):
        words, _, _ = block.numbered()
        name = _name(block, seq, words)
        for at in range(0, len(words), _ROWS):
            some = words.slice(at, _ROWS)
            n = len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, name)), pa.array(np.arange(at, at + n), pa.int32()), some], names=["block", "no", "word"]
            )


def _positions(batches):
    """A row per document with its number of words; the first of each group of documents holds the group's positions."""
    for seq, block in enumerate(blocks.blocks(batches, pieces.cut)):
        words, numbers, counts = block.numbered()
        name = _name(block, seq, words)
        rows = pa.concat_arrays(block.rows)
        ends = np.cumsum(counts)
        groups = np.searchsorted(ends - counts, np.arange(0, int(ends[-1]) + _GROUP, _GROUP))
        first, held = np.unique(groups[groups < len(counts)]), {}
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(counts)], strict=True):
            held[a] = blocks.pack(numbers[ends[a] - counts[a] : ends[b - 1]])
        for at in range(0, len(counts), 2000):
            n = min(2000, len(counts) - at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, name)), pa.array(np.arange(at, at + n) + len(words), pa.int32()),
                    pa.array([held.get(i) for i in range(at, at + n)], pa.binary()),
                    pa.array(counts[at : at + n], pa.int32()), rows.slice(at, n),
                ],
                names=["block", "no", "data", "n", "row"],
            )


def encode(docs: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` without ``text``, with ``ids``: the text's token ids, little-endian unsigned 32-bit, as binary."""
    spark = docs.sparkSession
    util.ship(spark)
    vocabulary = spark.sparkContext.broadcast(read_ranks(ranks_path))
    kept = [c for c in docs.columns if c.lower() not in (text.lower(), ids.lower())]
    row = F.struct(*[docs[c] for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    # the partition's own number: a task's number also counts the other side of a union
    source = docs.select(docs[text].alias("text"), row.alias("row"), F.spark_partition_id().alias("part"))
    row_type = source.schema["row"].dataType

    def merge(batches):
        word_ids = Words(vocabulary.value)
        last, found, held = None, None, []
        for batch in batches:
            out = []
            # equal words stand together: a word is encoded when its run begins
            for word in batch.column("word").to_pylist():
                if word != last:
                    last, found = word, word_ids(word)
                out.append(found)
            held.append((batch.column("block").to_numpy(), batch.column("no").to_numpy(), out))
            if sum(len(x) for _, _, x in held) >= _SENT:
                yield _sent(held)
                held = []
        if held:
            yield _sent(held)
        blocks.give_back()

    # both readings take the same columns, so that they get the same batches
    words = source.mapInArrow(_words, "block long, no int, word string")
    known = words.repartition("word").sortWithinPartitions("word").mapInArrow(merge, "block long, data binary")
    fields = {"block": T.LongType(), "no": T.IntegerType(), "data": T.BinaryType(), "n": T.IntegerType(), "row": row_type}
    positions = source.mapInArrow(_positions, T.StructType([T.StructField(c, kind) for c, kind in fields.items()]))
    both = known.unionByName(positions, allowMissingColumns=True)
    # a block's words come first, then its documents in order
    together = both.repartition("block").sortWithinPartitions("block", "no")
    out = T.StructType([T.StructField("row", row_type), T.StructField("ids", T.BinaryType())])
    row_kind = to_arrow_type(row_type)

    def fill(batches):
        block, pending, filled = None, [], None
        for batch in batches:
            at = 0
            names = batch.column("block").to_numpy()
            is_word = ~np.asarray(batch.column("n").is_valid())
            while at < batch.num_rows:
                end = at + int(np.argmax(np.append((names[at:] != names[at]) | (is_word[at:] != is_word[at]), True)))
                some = batch.slice(at, end - at)
                if names[at] != block:
                    block, pending, filled = names[at], [], None
                    blocks.give_back()
                if is_word[at]:
                    pending += some.column("data").to_pylist()
                else:
                    if filled is None:
                        filled, pending = _Block(pending), []
                    yield from filled.documents(some, row_kind)
                at = end

    filled = together.mapInArrow(fill, out)
    return filled.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("ids").alias(ids))


def _sent(held) -> pa.RecordBatch:
    """Ids of words on their way to their blocks: a row per block, its words by number (steps, sizes, ids)."""
    names, numbers = (np.concatenate([h[i] for h in held]) for i in (0, 1))
    ids = [x for _, _, out in held for x in out]
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat, starts = np.concatenate(ids), np.cumsum(sizes) - sizes
    order = np.lexsort((numbers, names))
    names, numbers = names[order], numbers[order]
    first = np.flatnonzero(np.append(True, names[1:] != names[:-1])).tolist()
    made = []
    for a, b in zip(first, [*first[1:], len(names)], strict=True):
        places, each = pieces.gather(starts, sizes, order[a:b])
        made.append(blocks.pack_all(np.diff(numbers[a:b], prepend=0), each, flat[places]))
    return pa.RecordBatch.from_arrays([pa.array(names[first]), pa.array(made, pa.binary())], names=["block", "data"])


class _Block:
    """The ids of a block's words, and the positions that are still to be filled."""

    def __init__(self, words: list[bytes]):
        none = [np.zeros(0, np.uint32)] * 3
        steps, sizes, ids = zip(none, *[blocks.unpack_all(x, 3) for x in words], strict=True)
        numbers, sizes, self.flat = np.concatenate([np.cumsum(x) for x in steps]), np.concatenate(sizes), np.concatenate(ids)
        self.sizes, self.starts = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        self.sizes[numbers], self.starts[numbers] = sizes, np.cumsum(sizes, dtype=np.int64) - sizes
        self.ids, self.at = b"", 0

    def _group(self, packed: bytes) -> None:
        """Ids of a group of documents, and where each word of them ends."""
        numbers = blocks.unpack(packed)
        if len(numbers) and (not len(self.sizes) or int(numbers.max()) >= len(self.sizes)):
            raise RuntimeError("the documents came in another order when they were read again: store them first")
        places, each = pieces.gather(self.starts, self.sizes, numbers)
        self.ids, self.at = self.flat[places].tobytes(), 0
        self.ends = np.concatenate(([0], np.cumsum(each)))

    def documents(self, some: pa.RecordBatch, row_kind):
        rows, made, size, first = some.column("row"), [], 0, 0
        packed, counts = some.column("data").to_pylist(), some.column("n").to_pylist()
        for i, (data, n) in enumerate(zip(packed, counts, strict=True)):
            if data is not None:
                self._group(data)
            a, b = self.ends[self.at], self.ends[self.at + n]
            made.append(self.ids[a * 4 : b * 4])
            self.at += n
            size += int(b - a)
            if size >= _TOKENS or i + 1 == len(counts):
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(first, len(made)).cast(row_kind), pa.array(made, pa.binary())], names=["row", "ids"]
                )
                made, size, first = [], 0, i + 1


def _bytes(tokens: pa.Array) -> bytes:
    """All values of a fresh array, one after another."""
    size = pc.sum(pc.binary_length(tokens)).as_py()
    return memoryview(tokens.buffers()[2])[:size].tobytes() if size else b""


def decode(docs: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with ``decoded``: the bytes of the ids' tokens one after another (null ids: no bytes).

    The token-byte table has a row per id of the vocabulary; it is joined in
    the tasks, an array at a time.
    """
    spark = docs.sparkSession
    ranks = read_ranks(ranks_path)
    table: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        table[i] = token
    shared = spark.sparkContext.broadcast(table)

    def make():
        tokens = pa.array(shared.value, pa.binary())
        sizes = np.array([len(t or b"") for t in shared.value], np.int64)

        def join(values):
            flat = np.frombuffer(b"".join([v or b"" for v in values]), "<u4")
            counts = np.fromiter((len(v or b"") // 4 for v in values), np.int64, len(values))
            data = b"".join([_bytes(tokens.take(pa.array(flat[at : at + _TOKENS]))) for at in range(0, len(flat), _TOKENS)])
            ends = np.cumsum(pieces.total(sizes[flat], counts)).tolist()
            return [[data[a:b] for a, b in zip([0, *ends], ends, strict=False)]]

        return join

    return util.per_text(docs, ids, [(decoded, T.BinaryType())], make)


def digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, from the operator's ids and decoded bytes."""
    done = decode(encode(docs.select("doc_id", "text"), ranks_path), ranks_path)
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    """Encode and decode every text of ``documents``; digests of the ids and of the decoded bytes."""
    import public_tokenizers

    return digests(util.table(spark, sf_dir, "documents"), ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
