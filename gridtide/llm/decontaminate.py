"""Benchmark decontamination by a BM25 inverted index with block-max WAND (operator 4).

The questions of the benchmark's items, cut into segments of at most ``SEGMENT``
words, form an inverted index: per word its segments with their BM25 impact, and
the largest impact per block of segments. Impacts are divided by the segment's
own threshold: the least score that a contained copy of it can have. A copy
keeps ``OVERLAP`` of the question's shingles, so at least one segment keeps that
share of the shingles that begin in it; a lost word takes up to five of them, and
the greatest sum of impacts that can be lost so is found by dynamic programming. So no contained copy is missed, however
much of its score lies in a few rare words. Every passage of every document
(``PASSAGE`` words, half overlapping) is a query. A passage whose words' largest impacts sum
to less than 1 has no hit; else only blocks whose bounds reach it
are scored, exactly, and all segments at or above their threshold are retrieved.
A retrieved item counts as contained if its question's and its answer's words
overlap with the document: shares of the question's five-word shingles, and of
the answer's words, of at least ``OVERLAP`` each, and likewise of the shingles
of question and answer together, with or without those that cross from one to
the other (a label or line between them breaks these). The answer is an item's
last sentence or line (the whole, if it has one only). Question and answer may
stand apart; a question's segment is found where it stands within half a passage.

Numbers of segments and mean length are those of the whole benchmark; items are
dealt by a hash into shards of about ``SHARD_WORDS`` words of items, one
pass over the documents for each, whose hits are stored before the next. So a
broadcast is bounded for any benchmark, and the hits and scores are the same for
any size of the shards.

Defined results: null and empty texts contain nothing; items without a word
match nothing; repeated items are reported each; ties don't matter, as all hits
at or above the threshold are kept; an empty table on either side gives no hit;
extra columns pass through, and a column named like the output is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.llm import util

PASSAGE = 128
SEGMENT = 48
OVERLAP = 0.8
SHINGLE = 5
#: Segments in a block of the index.
BLOCK = 4
#: Bounds of blocks that are held at once while passages are searched.
_CELLS = 2_000_000
K1, B = 1.2, 0.75
#: Words of items in one broadcast shard of the index.
SHARD_WORDS = 2_000_000

# Words are runs of ASCII letters and digits and of other characters but general punctuation and blanks.
_split_at = bytes(32 if not chr(b).isalnum() else b for b in range(128)) + bytes(range(128, 256))
_other_gaps = re.compile("[\x80-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf\u2000-\u206f\u3000-\u303f]")
_sentence = re.compile(r"(?<=[.?!])\s+|\n+")

HITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("question", T.DoubleType()),
            T.StructField("answer", T.DoubleType()),
        ]
    )
)


def words(text: str | None) -> list[bytes]:
    low = (text or "").lower()
    if not low.isascii():
        low = _other_gaps.sub(" ", low)
    return low.encode().translate(_split_at).split()


def question_answer(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """The words before the last sentence or line, and its words; a single sentence is both."""
    parts = [w for p in _sentence.split(text or "") if (w := words(p))]
    if len(parts) < 2:
        return (parts[0], parts[0]) if parts else ([], [])
    return [w for p in parts[:-1] for w in p], parts[-1]


def shingles(ws: list, size: int = SHINGLE) -> set[tuple]:
    return {tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def segments(question: list[bytes]) -> list[tuple[list[bytes], np.ndarray]]:
    """The question's words in segments of about equal length, each with the weight of the shingles that begin
    at its words: 1 at the first place of a distinct shingle, else 0."""
    if not question:
        return []
    seen, weight = set(), np.zeros(len(question), np.int64)
    for i in range(max(1, len(question) - SHINGLE + 1)):
        if (shingle := tuple(question[i : i + SHINGLE])) not in seen:
            seen.add(shingle)
            weight[i] = 1
    step = math.ceil(len(question) / math.ceil(len(question) / SEGMENT))
    return [(question[i : i + step], weight[i : i + step]) for i in range(0, len(question), step)]


def most_lost(impacts: list[float], weight: np.ndarray, budget: int) -> float:
    """The greatest sum of impacts that words can have which take at most ``budget`` shingles with them.

    ``impacts`` are those of the words by place (0 where a word occurred before); a word at place ``p`` takes the
    shingles that begin at ``p - SHINGLE + 1`` to ``p``. Kept per place of the last lost word and budget used.
    """
    ends = np.concatenate(([0], np.cumsum(weight))).tolist()
    best: list[list[float]] = []  # best[p][used]: the last lost word is at p
    free = [-math.inf] * (budget + 1)  # the best with a last lost word SHINGLE or more places back, or none
    free[0] = 0.0
    answer = 0.0
    for p, impact in enumerate(impacts):
        low = max(0, p - SHINGLE + 1)
        if p >= SHINGLE:
            free = [max(a, b) for a, b in zip(free, best[p - SHINGLE], strict=True)]
        here = [-math.inf] * (budget + 1)
        for last, row in [(None, free), *((q, best[q]) for q in range(low, p))]:
            cost = ends[p + 1] - ends[low if last is None else max(low, last + 1)]
            for used in range(budget + 1 - cost):
                if row[used] + impact > here[used + cost]:
                    here[used + cost] = row[used] + impact
        best.append(here)
        answer = max(answer, *here)
    return answer


class Statistics:
    """Number of segments, their mean length and how many have each word, over the whole benchmark."""

    def __init__(self):
        self.n = self.length = 0
        self.df: Counter = Counter()

    def add(self, text: str | None) -> int:
        """Count an item; the number of its words."""
        for segment, _ in segments(question_answer(text)[0]):
            self.n += 1
            self.length += len(segment)
            self.df.update(set(segment))
        return len(words(text))

    @classmethod
    def of(cls, texts) -> Statistics:
        out = cls()
        for text in texts:
            out.add(text)
        return out

    def impacts(self, segment: list[bytes]) -> dict[bytes, float]:
        norm = K1 * (1 - B + B * len(segment) * self.n / max(1, self.length))
        idf = {w: math.log(1 + (self.n - self.df[w] + 0.5) / (self.df[w] + 0.5)) for w in segment}
        return {w: idf[w] * f * (K1 + 1) / (f + norm) for w, f in Counter(segment).items()}


class Index:
    """Segments of items: postings of impacts as shares of the segment's threshold, and block maxima."""

    def __init__(self, items: list[tuple[int, str | None]], statistics: Statistics | None = None):
        statistics = statistics or Statistics.of(text for _, text in items)
        self.items, self.owner, self.threshold = [], [], []
        postings = defaultdict(list)
        for item_id, text in items:
            q, a = question_answer(text)
            if not q:
                continue
            self.items.append((item_id, q, a, words(text)))
            for segment, weight in segments(q):
                if not weight.any():
                    continue  # a repeat of earlier shingles: another segment has them
                impact = statistics.impacts(segment)
                first = {w: i for i, w in reversed(list(enumerate(segment)))}
                by_place = [impact[w] if first[w] == i else 0.0 for i, w in enumerate(segment)]
                budget = int((1 - OVERLAP) * int(weight.sum()) + 1e-9)
                least = (sum(impact.values()) - most_lost(by_place, weight, budget)) * (1 - 1e-9)
                for w, x in impact.items():
                    postings[w].append((len(self.owner), x / max(least, 1e-9)))
                self.owner.append(len(self.items) - 1)
                self.threshold.append(least)
        n = len(self.owner)
        self.term = {w: i for i, w in enumerate(sorted(postings))}
        # all words of items have a number, those of the questions' segments come first; items hold numbers
        self.number = dict(self.term)
        for _, _, _, all_words in self.items:
            for w in all_words:
                self.number.setdefault(w, len(self.number))
        self.words = len(self.number)
        number = self.number.__getitem__
        of = lambda ws: shingles(list(map(number, ws)))
        self.items = [(i, of(q), set(map(number, a)), of(a), of(ws)) for i, q, a, ws in self.items]
        self.blocks = -(-n // BLOCK)
        self.first = np.zeros(len(self.term) + 1, np.int64)
        segment, impact = [], []
        for t, w in enumerate(self.term):
            for k, x in postings[w]:
                segment.append(k)
                impact.append(x)
            self.first[t + 1] = len(segment)
        self.segment = np.array(segment, np.int64)
        self.impact = np.array(impact, np.float64)
        self.bound = np.zeros(len(self.term) + 1)  # the last entry: words that no item has
        # per term its blocks and their largest impact
        of = np.repeat(np.arange(len(self.term)), np.diff(self.first))
        key = of * max(1, self.blocks) + self.segment // BLOCK
        self.block_key, at = np.unique(key, return_inverse=True)
        self.block_max = np.zeros(len(self.block_key))
        np.maximum.at(self.block_max, at, self.impact)
        self.block_of = self.block_key % max(1, self.blocks)
        self.block_first = np.searchsorted(self.block_key // max(1, self.blocks), np.arange(len(self.term) + 1))
        np.maximum.at(self.bound, of, self.impact)

    @staticmethod
    def _spans(first: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of all postings of the terms, and how many each term has."""
        low, size = first[terms], first[terms + 1] - first[terms]
        return np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum())), size

    def retrieve(self, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, score) of all hits of at least the segment's threshold, for passages of sorted terms (rows)."""
        distinct = passages < len(self.term)
        distinct[:, 1:] &= passages[:, 1:] != passages[:, :-1]  # a word counts once
        row, column = np.nonzero(distinct)
        terms = passages[row, column]
        # bounds of all blocks that a passage's words touch; the others stay closed
        at, size = self._spans(self.block_first, terms)
        bound = np.bincount(np.repeat(row, size) * self.blocks + self.block_of[at], self.block_max[at], len(passages) * self.blocks)
        opened = bound >= 1
        some = opened.reshape(len(passages), self.blocks).any(axis=1)[row]
        row, terms = row[some], terms[some]
        at, size = self._spans(self.first, terms)
        row = np.repeat(row, size)
        kept = opened[row * self.blocks + self.segment[at] // BLOCK]
        key, place = np.unique(row[kept] * len(self.owner) + self.segment[at[kept]], return_inverse=True)
        score = np.bincount(place, self.impact[at[kept]], len(key))
        hit = score >= 1
        segment = key[hit] % max(1, len(self.owner))
        return segment, score[hit] * np.array(self.threshold)[segment]

    def _found(self, ids: np.ndarray, size: int) -> set[tuple]:
        """The document's runs of ``size`` words that are all words of items."""
        known = np.concatenate(([0], np.cumsum(ids < self.words)))
        places = np.flatnonzero(known[size:] - known[: len(known) - size] == size)
        return set(map(tuple, ids[places[:, None] + np.arange(size)].tolist())) if len(places) else set()

    def hits(self, text: str | None) -> list[tuple[int, float, float, float]]:
        """(item_id, best score, question overlap, answer overlap) of the items contained in the text."""
        if not text or not self.items:
            return []
        ws = words(text)
        if not ws:
            return []
        n = len(ws)
        ids = np.fromiter(map(self.number.get, ws, repeat(self.words)), np.int64, n)
        half = PASSAGE // 2
        width = max(1, -(-n // half))
        none = len(self.term)
        grid = np.full((width + 1) * half, none, np.int64)
        np.minimum(ids, none, out=grid[:n])  # words that no question has aren't searched
        grid = grid.reshape(width + 1, half)
        best: dict[int, float] = {}
        # a passage is two neighbouring halves; passages go through in runs, so memory stays bounded
        rows = max(1, min(4096, _CELLS // max(1, self.blocks)))
        for low in range(0, max(1, width - 1), rows):
            halves = grid[low : low + rows + 1]
            rough = self.bound[halves].sum(axis=1)
            able = np.flatnonzero(rough[:-1] + rough[1:] >= 1)
            if not len(able):
                continue
            passages = np.sort(np.concatenate((halves[able], halves[able + 1]), axis=1), axis=1)
            for k, score in zip(*(x.tolist() for x in self.retrieve(passages)), strict=True):
                item = self.owner[k]
                best[item] = max(best.get(item, 0.0), score)
        if not best:
            return []
        by_size, seen, out = {}, set(ids.tolist()), []
        for item, score in sorted(best.items()):
            item_id, question, answer, ending, whole = self.items[item]
            found = []
            for part in (question, ending, whole):
                size = len(next(iter(part)))
                if size not in by_size:
                    by_size[size] = self._found(ids, size)
                found.append(len(part & by_size[size]))
            q, a = found[0] / len(question), len(answer & seen) / len(answer)
            parts = (found[0] + found[1]) / (len(question) + len(ending))
            if min(q, a, max(parts, found[2] / len(whole))) >= OVERLAP:
                out.append((item_id, score, q, a))
        return out


def shards(benchmark: DataFrame, item_id: str = "item_id", text: str = "text"):
    """Indexes over the benchmark's items, dealt by a hash into shards of about SHARD_WORDS words.

    Items are read one partition at a time; the driver holds one shard and the benchmark's word counts.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    statistics, size = Statistics(), 0
    for r in items.select("text").toLocalIterator():
        size += statistics.add(r["text"])
    if not statistics.n:
        return
    n = -(-size // SHARD_WORDS)
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        held = items.where(shard == i).collect()
        if held:
            yield Index([(r["item_id"], r["text"]) for r in held], statistics)


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", hits: str = "hits") -> DataFrame:
    """``docs`` with ``hits``: the benchmark items each whole text contains."""
    out = docs.withColumn(hits, F.array().cast(HITS))
    for i, index in enumerate(shards(benchmark)):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def make(shared=shared):
            return lambda texts: [[shared.value.hits(t) for t in texts]]

        if i:  # one index at a time in a plan
            out = util.stored(out, "decontaminate")
        more = util.fresh(out, "found")
        found = util.per_text(out, text, [(more, HITS)], make)
        out = found.withColumn(hits, F.concat(hits, more)).drop(more)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item."""
    hits = util.fresh(docs, "hits")
    return find(docs, benchmark, text, hits).where(F.size(hits) == 0).drop(hits)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, score, question, answer) of every benchmark item found in a document."""
    docs = util.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, util.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")
