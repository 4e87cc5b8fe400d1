"""Alignment of two tokenizers' ids over one text (operator 11).

Both tokenizations of " " + text are cut where tokens of both end at the same
byte; a group holds the tokens between two such places, and every pair of an
A and a B token of a group is a link. Most groups are one A and one B token of
the same bytes: an array over A's vocabulary, made beforehand, holds for each A
id the B id of the same bytes, and such links are counted in vectors as long as
A's vocabulary, one per block of documents. Only the remaining pairs are
shuffled, once per block and pair with the number of documents that hold it;
their corpus-wide counts go back to the blocks, where the documents' sums are
taken.

Encoding is exact and by words: A's pre-tokens and B's runs of blanks with the
characters behind them are merged independently of each other, so each distinct
one of a block is encoded once. (B's pieces hold a blank only in front, which is
checked when the vocabulary is read.)

Scale: no shuffle key has more rows than there are blocks; the vectors have a
fixed length; a group of many tokens is counted by its distinct ids.

Defined results: a text that is null or empty, or that one of the tokenizers
doesn't give back byte by byte, has no tokens: zeros and an empty digest. Each
row is a document of its own (repeated ids and texts count each). An empty
table gives an empty table. Ties for the highest count are all best. Extra
columns of any name are passed through by :func:`align`.
"""

from __future__ import annotations

import hashlib
import itertools
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gridtide.llm import blocks, pieces, util
from gridtide.llm.bpe import Merges

#: Pairs of tokens that are spelled out at once.
_PAIRS = 4_000_000
#: A group with more pairs than this is counted by its distinct ids.
_LARGE = 4096
#: Characters of the documents that are aligned at once.
_CHARS = 4_000_000
_FACTS = ("n_a", "n_b", "n_groups", "n_links")


class Pieces:
    """The second vocabulary: pieces with a sign for the blank, and bytes where it has none."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        sign = "▁"
        n = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(n)]
        if any(sign in name.lstrip(sign) for name in names):
            raise ValueError("a piece holds a blank behind other characters: words can't be encoded by themselves")
        self.token_bytes = [
            bytes([int(name[3:5], 16)]) if self.library.is_byte(i) else name.replace(sign, " ").encode()
            for i, name in enumerate(names)
        ]
        self.plain = [not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i)) for i in range(n)]
        self.blank = self.library.piece_to_id(sign)

    def encode(self, runs: list[str]) -> list[list[int]]:
        """Ids of runs that begin with a blank (the library puts one before each text itself)."""
        ids = self.library.encode([run[1:] for run in runs], num_threads=1)
        for i, run in enumerate(runs):
            if run == " ":  # the library gives an empty text no token
                ids[i] = [self.blank]
        return ids


class Vocabularies:
    """Both vocabularies in a worker, and the array of the ids with the same bytes."""

    def __init__(self, a_json: str, b_model: bytes):
        self.a, self.b = Merges(a_json), Pieces(b_model)
        self.n_a, self.n_b = len(self.a.token_bytes), len(self.b.token_bytes)
        self.a_sizes = np.array([len(t) for t in self.a.token_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b.token_bytes], np.int64)
        first: dict[bytes, int] = {}
        for plain in (True, False):
            for i, token in enumerate(self.b.token_bytes):
                if self.b.plain[i] == plain:
                    first.setdefault(token, i)
        self.same = np.array([first.get(t, -1) for t in self.a.token_bytes], np.int64)
        # what follows a token in the digest: "," inside a group's side, "|" between the sides, ";" behind a group
        sides = ((self.n_a, ","), (self.n_a, "|"), (self.n_b, ","), (self.n_b, ";"))
        self.spelled = pa.array([f"{i}{mark}" for n, mark in sides for i in range(n)])
        self.spelled_sizes = np.array([len(x) for x in self.spelled.to_pylist()], np.int64)

    def a_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, how many each word has, whether they give the word back)."""
        raw = [w.encode() for w in words]
        return self._checked(raw, [np.frombuffer(x, "<u4").tolist() for x in self.a.encode(raw)], self.a.token_bytes)

    def b_ids(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._checked([r.encode() for r in runs], self.b.encode(runs), self.b.token_bytes)

    @staticmethod
    def _checked(raw, ids, token_bytes):
        token = token_bytes.__getitem__
        right = np.array([b"".join(map(token, x)) == r for x, r in zip(ids, raw, strict=True)], bool)
        sizes = np.array([len(x) for x in ids], np.int64)
        return np.array(list(itertools.chain.from_iterable(ids)), np.int64), sizes, right


_held: dict[str, Vocabularies] = {}


def _vocabularies(key: str, shared) -> Vocabularies:
    """One instance per Python worker."""
    if key not in _held:
        _held.clear()
        _held[key] = Vocabularies(*shared.value)
    return _held[key]


class Aligned:
    """One batch of documents: their links and facts."""

    def __init__(self, v: Vocabularies, texts: list[str | None]):
        self.v, self.n = v, len(texts)
        spaced = [" " + t if t else None for t in texts]
        a, a_counts, a_right = self._tokens(spaced, pieces.cut, v.a_ids)
        b, b_counts, b_right = self._tokens(spaced, pieces.blank_runs, v.b_ids)
        good = a_right & b_right & np.array([t is not None for t in spaced])
        self.a, self.b = a[np.repeat(good, a_counts)], b[np.repeat(good, b_counts)]
        self.n_a, self.n_b = a_counts * good, b_counts * good
        self._groups()

    def _tokens(self, texts, cut, encode):
        """(ids of all texts, how many each has, whether they give the text back)."""
        ids, counts, right = [], np.zeros(self.n, np.int64), np.ones(self.n, bool)
        for owners, some in pieces.parts(texts):
            found = cut(some)
            flat, sizes, good = encode(found.words.to_pylist())
            places, each = pieces.gather(np.cumsum(sizes) - sizes, sizes, found.index)
            ids.append(flat[places])
            np.add.at(counts, owners, pieces.total(each, found.counts))
            bad = pieces.total(~good[found.index], found.counts) > 0
            right[np.array(owners)[bad]] = False
        return np.concatenate(ids) if ids else np.zeros(0, np.int64), counts, right

    def _groups(self):
        # all good texts stand one behind the other; both sides end each of them at the same byte
        v = self.v
        a_ends, b_ends = np.cumsum(v.a_sizes[self.a]), np.cumsum(v.b_sizes[self.b])
        mark = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 1, np.uint8)
        mark[a_ends] = 1
        mark[b_ends] |= 2
        a_last, b_last = mark[a_ends] == 3, mark[b_ends] == 3
        self.a_last, self.b_last = a_last, b_last
        self.a_group, self.b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        groups = int(a_last.sum())
        self.a_in, self.b_in = np.bincount(self.a_group, minlength=groups), np.bincount(self.b_group, minlength=groups)
        self.a_first, self.b_first = np.cumsum(self.a_in) - self.a_in, np.cumsum(self.b_in) - self.b_in
        doc_of_a = np.repeat(np.arange(self.n), self.n_a)
        self.doc = doc_of_a[self.a_first] if groups else np.zeros(0, np.int64)
        self.n_groups = np.bincount(self.doc, minlength=self.n)
        self.n_links = pieces.total(self.a_in * self.b_in, self.n_groups)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, how often) of the links, distinct; a pair is ``a * n_b + b``."""
        v = self.v
        one = np.flatnonzero((self.a_in == 1) & (self.b_in == 1))
        size = self.a_in * self.b_in
        pair = self.a[self.a_first[one]] * v.n_b + self.b[self.b_first[one]]
        found = [self._distinct(self.doc[one], pair, np.ones(len(one), np.int64))]
        more = np.flatnonzero((size > 1) & (size <= _LARGE))
        bounds = np.searchsorted(np.cumsum(size[more]), np.arange(0, int(size[more].sum()) + _PAIRS, _PAIRS), side="right")
        for low, high in itertools.pairwise([0, *bounds[1:].tolist(), len(more)]):
            some = more[low:high]
            if not len(some):
                continue
            # each A token of a group as often as the group has B tokens, against the B tokens in turn
            each_a, per_a = pieces.gather(self.a_first, self.a_in, some)
            width = np.repeat(self.b_in[some], per_a)
            a = np.repeat(self.a[each_a], width)
            begin = np.repeat(self.b_first[some], per_a)
            b = self.b[np.repeat(begin - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))]
            found.append(self._distinct(np.repeat(self.doc[some], size[some]), a * v.n_b + b, np.ones(len(a), np.int64)))
        for g in np.flatnonzero(size > _LARGE).tolist():
            a, a_n = np.unique(self.a[self.a_first[g] : self.a_first[g] + self.a_in[g]], return_counts=True)
            b, b_n = np.unique(self.b[self.b_first[g] : self.b_first[g] + self.b_in[g]], return_counts=True)
            pair = (a[:, None] * v.n_b + b[None, :]).ravel()
            found.append((np.full(len(pair), self.doc[g]), pair, (a_n[:, None] * b_n[None, :]).ravel()))
        return self._distinct(*[np.concatenate(x) for x in zip(*found, strict=True)])

    @staticmethod
    def _distinct(doc, pair, n):
        wide = len(pair) and int(pair.max()) >= 1 << 32
        order = np.lexsort((pair, doc)) if wide else np.argsort(doc << 32 | pair, kind="stable")
        doc, pair, n = doc[order], pair[order], n[order]
        first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1]))) if len(doc) else order
        return doc[first], pair[first], np.add.reduceat(n, first) if len(first) else n

    def digests(self) -> list[str]:
        """SHA-256 of each document's groups, spelled "a,a|b,b;a|b"; nothing without tokens."""
        v = self.v
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + self.b_first[self.a_group]] = self.a + v.n_a * self.a_last
        code[np.arange(len(self.b)) + (self.a_first + self.a_in)[self.b_group]] = self.b + 2 * v.n_a + v.n_b * self.b_last
        ends = np.cumsum(pieces.total(v.spelled_sizes[code], self.n_a + self.n_b)).tolist()
        data = memoryview(v.spelled.take(pa.array(code)).buffers()[2]) if len(code) else b""
        return [hashlib.sha256(data[a : b - 1]).hexdigest() if b > a else "" for a, b in zip([0, *ends], ends, strict=False)]


class _Block:
    """Links of the documents of a block."""

    def __init__(self):
        self.rows, self.facts, self.digests, self.links = [], [], [], []
        self.n = self.chars = 0

    def add(self, v: Vocabularies, texts, rows) -> None:
        found = Aligned(v, texts)
        self.rows.append(rows.take(pa.array(np.arange(len(rows)))))
        self.facts.append(np.stack([found.n_a, found.n_b, found.n_groups, found.n_links]))
        self.digests += found.digests()
        doc, pair, n = found.links()
        self.links.append((doc + self.n, pair, n))
        self.n += len(texts)
        self.chars += sum(len(t) for t in texts if t)

    def out(self, v: Vocabularies, place: int, row_kind):
        doc, pair, n = (np.concatenate(x) for x in zip(*self.links, strict=True))
        a, b = pair // v.n_b, pair % v.n_b
        same = v.same[a] == b
        # links of the same bytes: a vector as long as A's vocabulary
        held = np.bincount(a[same], minlength=v.n_a)
        some = np.flatnonzero(held)
        yield _batch(row_kind, len(some), a=some, n=held[some])
        distinct, number = np.unique(pair[~same], return_inverse=True)
        docs = np.bincount(number, minlength=len(distinct))
        for at in range(0, len(distinct), 50_000):
            part = distinct[at : at + 50_000]
            yield _batch(
                row_kind, len(part), block=np.full(len(part), place), no=np.arange(at, at + len(part)),
                a=part // v.n_b, b=part % v.n_b, n=docs[at : at + 50_000],
            )
        by_same, by_more = np.bincount(doc[same], minlength=self.n), np.bincount(doc[~same], minlength=self.n)
        facts, rows = np.concatenate(self.facts, axis=1), pa.concat_arrays(self.rows)
        same_ids, same_n, more_ids, more_n = a[same], n[same], number, n[~same]
        same_ends, more_ends = np.cumsum(by_same), np.cumsum(by_more)
        for at in range(0, self.n, 2000):
            part = range(at, min(self.n, at + 2000))
            yield _batch(
                row_kind, len(part), block=np.full(len(part), place), row=rows.slice(at, len(part)),
                digest=self.digests[at : at + 2000],
                same=[_both(same_ids, same_n, same_ends[i] - by_same[i], same_ends[i]) for i in part],
                more=[_both(more_ids, more_n, more_ends[i] - by_more[i], more_ends[i]) for i in part],
                **{name: facts[k, at : at + len(part)] for k, name in enumerate(_FACTS)},
            )


def _both(ids: np.ndarray, n: np.ndarray, low: int, high: int) -> bytes:
    return blocks.pack(np.concatenate((ids[low:high], n[low:high])))


_COLUMNS = {
    "block": pa.int64(), "no": pa.int32(), "a": pa.int32(), "b": pa.int32(), "n": pa.int64(), "row": None, "digest": pa.string(),
    "same": pa.binary(), "more": pa.binary(), **dict.fromkeys(_FACTS, pa.int64()),
}


def _batch(row_kind, size: int, /, **columns) -> pa.RecordBatch:
    made = []
    for name, kind in _COLUMNS.items():
        kind = kind or row_kind
        x = columns.get(name)
        made.append(pa.nulls(size, kind) if x is None else x.cast(kind) if isinstance(x, pa.Array) else pa.array(x).cast(kind))
    return pa.RecordBatch.from_arrays(made, names=list(_COLUMNS))


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the facts of each document's alignment.

    ``n_a``, ``n_b``, ``n_groups``, ``n_links``; ``n_best``, the links whose
    pair is in as many documents as the best pair of its A id; ``count_sum``,
    the sum of these numbers of documents over the links; ``groups_sha256``.
    """
    spark = docs.sparkSession
    util.ship(spark)
    a_json, b_model = Path(a_path).read_text(encoding="utf-8"), Path(b_path).read_bytes()
    key = hashlib.sha256(a_json.encode() + b_model).hexdigest()
    vocabularies = spark.sparkContext.broadcast((a_json, b_model))
    names = [*_FACTS, "n_best", "count_sum", "groups_sha256"]
    kept = [c for c in docs.columns if c.lower() not in (text.lower(), *names)]
    row = F.struct(*[docs[c] for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    source = docs.select(docs[text].alias("text"), row.alias("row"))
    row_type = source.schema["row"].dataType
    row_kind = to_arrow_type(row_type)

    def links(batches):
        v = _vocabularies(key, vocabularies)
        block, seq = _Block(), 0
        for batch in batches:
            for part in util.slices(batch, "text", _CHARS):
                block.add(v, part.column("text").to_pylist(), part.column("row"))
                if block.chars >= blocks.BLOCK_CHARS:
                    yield from block.out(v, TaskContext.get().partitionId() << 24 | seq, row_kind)
                    block, seq = _Block(), seq + 1
        if block.n:
            yield from block.out(v, TaskContext.get().partitionId() << 24 | seq, row_kind)

    simple = {"block": "long", "no": "int", "a": "int", "b": "int", "n": "long", "digest": "string", "same": "binary", "more": "binary"}
    fields = [
        T.StructField(c, row_type if c == "row" else T._parse_datatype_string(simple.get(c, "long"))) for c in _COLUMNS
    ]
    found = util.stored(source.mapInArrow(links, T.StructType(fields)), "align-links")
    # at most a row for each id of the vocabulary
    vector = found.where("block is null").groupBy("a").agg(F.sum("n").alias("count"))
    # a pair has a row per block at most
    over = Window.partitionBy("a", "b")
    pairs = found.where("b is not null").select("block", "no", "a", F.sum("n").over(over).alias("count"))
    pairs = util.stored(pairs, "align-pairs")
    best = vector.unionByName(pairs.select("a", "count")).groupBy("a").agg(F.max("count").alias("best"))
    size = len(Merges(a_json).token_bytes)
    counts, bests = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in vector.collect():
        counts[r["a"]] = r["count"]
    for r in best.collect():
        bests[r["a"]] = r["best"]
    shared = spark.sparkContext.broadcast((counts, bests))
    documents = found.where("row is not null").select("block", "row", "digest", "same", "more", *_FACTS)
    both = pairs.unionByName(documents, allowMissingColumns=True)
    together = both.repartition("block").sortWithinPartitions("block", F.asc_nulls_last("no"))
    out = T.StructType(
        [T.StructField("row", row_type), *[T.StructField(c, T.LongType()) for c in names[:-1]], T.StructField(names[-1], T.StringType())]
    )

    def sums(batches):
        same_counts, bests = shared.value
        same_best = same_counts == bests
        block, held, pair_counts, pair_best = None, [], None, None
        for batch in batches:
            at = 0
            places = batch.column("block").to_numpy()
            is_pair = np.asarray(batch.column("no").is_valid())
            while at < batch.num_rows:
                end = at + int(np.argmax(np.append((places[at:] != places[at]) | (is_pair[at:] != is_pair[at]), True)))
                some = batch.slice(at, end - at)
                if places[at] != block:
                    block, held, pair_counts = places[at], [], None
                if is_pair[at]:
                    n = some.column("count").to_numpy()
                    held.append((n, n == bests[some.column("a").to_numpy()]))
                else:
                    if pair_counts is None:
                        pair_counts = np.concatenate([np.zeros(0, np.int64), *[x for x, _ in held]])
                        pair_best = np.concatenate([np.zeros(0, bool), *[x for _, x in held]])
                        held = []
                    facts = []
                    for same, more in zip(some.column("same").to_pylist(), some.column("more").to_pylist(), strict=True):
                        ids, n = blocks.unpack(same).reshape(2, -1).astype(np.int64)
                        no, m = blocks.unpack(more).reshape(2, -1).astype(np.int64)
                        facts.append(
                            (int(n @ same_best[ids] + m @ pair_best[no]), int(n @ same_counts[ids] + m @ pair_counts[no]))
                        )
                    n_best, count_sum = zip(*facts, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column("row").cast(row_kind), *[some.column(c) for c in _FACTS],
                            pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), some.column("digest"),
                        ],
                        names=["row", *names],
                    )
                at = end

    done = together.mapInArrow(sums, out)
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept], *names)


def op11(spark: SparkSession, sf_dir: str, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Align the two tokenizers over every text of ``documents``."""
    import public_tokenizers

    a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
    b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
    return align(util.table(spark, sf_dir, "documents").select("doc_id", "text"), a_path, b_path)
