"""BPE encoding and decoding of whole texts (operator 9).

Method: the most frequent words of the corpus (pieces of the split pattern),
counted over every document, are compiled with their ids into a minimal acyclic
transducer; its file is placed on every executor and mapped into memory by the
workers. A word that the lexicon lacks is merged exactly. Results are those of the tokenizer file's own
library with ``add_special_tokens=False`` and ``skip_special_tokens=False``.

Defined results: a null text is an empty text (no ids, empty decoded text); an
empty corpus gives an empty lexicon and every word is merged; extra columns are
passed through, and a column named like an output is replaced; repeated rows
are encoded each.
"""

from __future__ import annotations

import re
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.llm import blocks, pieces, transducer, util
from gridtide.llm.bpe import Merges
from gridtide.session import checkpoint_dir

#: Fixed value: the pattern by which byte-level vocabularies of this kind split a text before merging (see ``pieces.cut``).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words in the lexicon; longer words (bytes) stay out of it, so its size is bounded.
LEXICON_WORDS = 100_000
LEXICON_WORD_BYTES = 48
#: Words that leave a task as one batch.
_SENT = 20_000

_loaded: dict[str, object] = {}


def _once(key: str, make):
    """One instance per Python worker; only the latest few are held."""
    if key not in _loaded:
        while len(_loaded) > 4:
            _loaded.pop(next(iter(_loaded)))
        _loaded[key] = make()
    return _loaded[key]


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): how often each run of letters occurs, over all texts."""
    return _counts(docs, text, pieces.letter_runs)


def piece_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): how often each piece of the split pattern occurs, with its blank, over all texts."""
    return _counts(docs, text, pieces.cut)


def _counts(docs: DataFrame, text: str, cut) -> DataFrame:
    """Counts, added up per block of documents before the shuffle."""

    def count(batches):
        for block in blocks.blocks(batches, cut, text, None):
            words, _, _ = block.numbered()
            for at in range(0, len(words), _SENT):
                part = slice(at, at + _SENT)
                yield pa.RecordBatch.from_arrays([words.slice(at, _SENT), pa.array(block.often[part])], names=["word", "n"])

    util.ship(docs.sparkSession)
    parts = docs.select(text).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, words: int) -> list[tuple[str, int]]:
    """The ``words`` most frequent (word, n), the most frequent first, ties by the word; all, if there are fewer.

    The least count is read off a histogram in steps of 1/64 of a doubling
    (a few thousand rows for any corpus), so that tasks send the driver no word
    that isn't taken; of the step in which the limit falls the first are taken.
    """
    step = F.floor(F.log2(F.col("n")) * 64)
    counts = util.stored(counts.withColumn("step", step), "word-counts")
    least = edge = None
    held = 0
    for row in sorted(counts.groupBy("step").agg(F.count("*").alias("k")).collect(), reverse=True):
        if held + row["k"] > words:
            edge = row["step"]
            break
        held += row["k"]
        least = row["step"]
    found = [] if least is None else counts.where(F.col("step") >= least).select("word", "n").collect()
    if edge is not None and held < words:
        found += _first(counts.where(F.col("step") == edge).select("word", "n"), words - held)
    return sorted(((w, n) for w, n in found), key=lambda x: (-x[1], x[0]))


def _first(counts: DataFrame, words: int) -> list:
    """The first ``words`` of more rows, by count and word: whole ranges of a stored sort, and the first of the next range."""
    order = F.desc("n"), F.col("word")
    ranges = util.stored(counts.orderBy(*order).withColumn("range", F.spark_partition_id()), "word-order")
    held, found = 0, []
    for row in sorted(ranges.groupBy("range").agg(F.count("*").alias("k")).collect()):
        if held + row["k"] > words:
            found = ranges.where(F.col("range") == row["range"]).orderBy(*order).limit(words - held).collect() if held < words else []
            found += ranges.where(F.col("range") < row["range"]).collect()
            break
        held += row["k"]
    return [(r["word"], r["n"]) for r in found]


class Lexicon:
    """The vocabulary and the transducer, placed for the executors."""

    def __init__(self, spark: SparkSession, tokenizer_path: str, data: bytes):
        self.vocabulary = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))
        self.key = f"lexicon-{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/{self.key}")
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out = fs.create(target, True)
        for i in range(0, len(data), 1 << 20):
            out.write(bytearray(data[i : i + (1 << 20)]))
        out.close()
        spark.sparkContext.addFile(fs.makeQualified(target).toString())

    def open(self) -> tuple[Merges, transducer.Transducer]:
        """Called in tasks: the parsed vocabulary and the mapped transducer."""
        merges = _once("m" + self.key, lambda: Merges(self.vocabulary.value))
        return merges, _once("t" + self.key, lambda: transducer.Transducer(SparkFiles.get(self.key)))

    def __getstate__(self):
        return {"vocabulary": self.vocabulary, "key": self.key}


def build_lexicon(docs: DataFrame, tokenizer_path: str, text: str = "text", words: int = LEXICON_WORDS) -> Lexicon:
    """Count all pieces, take at most the ``words`` most frequent and compile them.

    The driver receives at most ``words`` words of ``LEXICON_WORD_BYTES`` bytes.
    """
    spark = docs.sparkSession
    # a piece may have its blank besides
    top = frequent(piece_counts(docs, text).where(F.octet_length("word") <= LEXICON_WORD_BYTES + 1), words)
    merges = Merges(Path(tokenizer_path).read_text(encoding="utf-8"))
    found = [word.encode() for word, _ in top]
    return Lexicon(spark, tokenizer_path, transducer.build(list(zip(found, merges.encode(found), strict=True))))


class Encoder:
    """Texts to ids inside one worker."""

    def __init__(self, merges: Merges, lexicon: transducer.Transducer):
        self.merges, self.lexicon = merges, lexicon
        self.special = (
            re.compile("(" + "|".join(re.escape(s) for s in sorted(merges.special, key=len, reverse=True)) + ")")
            if merges.special
            else None
        )

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words as the split pattern yields them: by the lexicon, else merged."""
        ids = self.lexicon.lookup(words)
        rest = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(rest, self.merges.encode([words[i] for i in rest]), strict=True):
            ids[i] = x
        return ids

    def plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special tokens: each distinct word of a batch once, then by position."""
        out = [b""] * len(texts)
        for owners, some in pieces.parts(texts):
            found = pieces.cut(some)
            ids = self.words(found.words.cast(pa.binary()).to_pylist())
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            places, each = pieces.gather(np.cumsum(sizes) - sizes, sizes, found.index)
            data = np.frombuffer(b"".join(ids), "<u4")[places].tobytes()
            ends = (np.cumsum(pieces.total(each, found.counts)) * 4).tolist()
            for i, a, b in zip(owners, [0, *ends], ends, strict=False):
                out[i] = out[i] + data[a:b] if out[i] else data[a:b]
        return out

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        # special tokens cut a text; what stands between them is encoded by itself
        split = [self.special.split(t) if t and self.special else [t or ""] for t in texts]
        ids = iter(self.plain([p for parts in split for p in parts[::2]]))
        token = {s: np.array([i], "<u4").tobytes() for s, i in self.merges.special.items()}
        return [b"".join([token[p] if i % 2 else next(ids) for i, p in enumerate(parts)]) for parts in split]


def encode(docs: DataFrame, lexicon: Lexicon, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids``: the whole text's token ids, little-endian unsigned 32-bit, as binary."""

    def make():
        merges, automaton = lexicon.open()
        encoder = _once("e" + lexicon.key, lambda: Encoder(merges, automaton))

        return lambda texts: [encoder(texts)]

    return util.per_text(docs, text, [(ids, T.BinaryType())], make)


def decode(docs: DataFrame, lexicon: Lexicon, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with ``text``: the ids' bytes as UTF-8 (broken sequences become U+FFFD); null ids give an empty text."""

    def make():
        merges, _ = lexicon.open()
        token = merges.token_bytes.__getitem__

        def run(values):
            return [[b"".join(map(token, np.frombuffer(v or b"", "<u4").tolist())).decode("utf-8", "replace") for v in values]]

        return run

    return util.per_text(docs, ids, [(text, T.StringType())], make)


def op9(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Encode and decode every text of ``documents``; digests of the ids and of the decoded text."""
    docs = util.table(spark, sf_dir, "documents")
    return digests(docs, tokenizer_path or _default_path())


def digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, from the operator's ids and decoded texts."""
    lexicon = build_lexicon(docs, tokenizer_path)
    done = decode(encode(docs.select("doc_id", "text"), lexicon).select("doc_id", "ids"), lexicon)
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def _default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
