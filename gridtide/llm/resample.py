"""Target-distribution importance resampling by bit-sliced sums (operator 13).

Every word (or run of words) of a text falls into a hash bucket. A bucket's
gain is the logarithm of how much more often the target has it than the corpus,
in whole thousandths. A document's bucket counts are kept as bit planes
(plane ``j`` holds bit ``j`` of every bucket's count), the gains as signed bit
planes (magnitude bits of the positive and of the negative gains). The sum of
count times gain is then the sum over pairs of planes of the number of common
ones times a power of two -- exact integers, without a multiplication per
feature. Weights get a seeded Gumbel noise, and the highest scores are drawn:
a sample without replacement in which documents count by their importance.

Scale: counts are pre-aggregated per task (one number per bucket), so a shuffle
carries ``buckets`` rows a task; gains are one number per bucket on the driver.
Ranks come from a histogram of the whole-number scores (its size is bounded by
their range), then only the documents at or above the cut are sorted, by ranges.

Defined results: a null or empty text has no feature, weight 0, and its score is
the noise; an empty corpus returns no row, an empty target gives every bucket
the gain of no occurrence; a null ``doc_id`` hashes like an empty id and ranks
before all ids; repeated rows are documents of their own, ties between them
broken by their weight and feature count (rows equal in all are interchangeable);
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtide.llm import util

BUCKETS = 10_000
WORDS = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Characters of a text that are read at once (whole words).
_READ = 1 << 20
#: Cells of the count table of the texts that are weighed at once.
_CELLS = 500_000
#: Words whose bucket a worker remembers.
_CACHE = 100_000
#: Texts that Spark hands a worker at once.
_BATCH_ROWS = 1000

#: A-Z in lower case; bytes that belong to no word become blanks.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


class Buckets(dict):
    """Feature bytes -> bucket; starts anew when full."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % self.buckets
        return found


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, a bounded stretch of it at a time."""
    data = (text or "").encode().translate(_WORD_BYTES)
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= _READ else data.find(b" ", at + _READ)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def bucket_numbers(text: str | None, buckets: Buckets, longest: int = WORDS) -> tuple[int, np.ndarray]:
    """(number of words, bucket of each run of 1 to ``longest`` words)."""
    found, carry, n = [], [], 0
    for words in words_of(text):
        n += len(words)
        found += map(buckets.__getitem__, words)
        if longest > 1:
            run = carry + words
            for size in range(2, longest + 1):
                first = max(0, len(carry) - size + 1)
                found += [buckets[b" ".join(run[i : i + size])] for i in range(first, len(run) - size + 1)]
            carry = run[-(longest - 1) :]
    return n, np.array(found, np.int64)


def bucket_totals(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = WORDS) -> np.ndarray:
    """How many features of all texts fall into each bucket (at most ``buckets`` rows reach the driver)."""
    util.ship(docs.sparkSession)

    def count(batches):
        held, known = np.zeros(buckets, np.int64), Buckets(buckets)
        for batch in batches:
            for part in util.slices(batch, text):
                for t in part.column(text).to_pylist():
                    held += np.bincount(bucket_numbers(t, known, longest)[1], minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(held[some])], names=["bucket", "n"])

    counted = docs.select(text).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of each of the B buckets, in doubles."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of rows of non-negative numbers: (plane, row, 64-bit words of a bit per column)."""
    depth = int(values.max(initial=0)).bit_length()
    width = -(-values.shape[1] // 64) * 64
    out = np.zeros((depth, len(values), width // 8), np.uint8)
    for j in range(depth):
        bits = np.packbits(((values >> j) & 1).astype(bool), axis=1)
        out[j, :, : bits.shape[1]] = bits
    return out.view(np.uint64)


class Gains:
    """The gains of all buckets as signed bit planes."""

    def __init__(self, gains: np.ndarray):
        self.positive = planes(np.maximum(gains, 0)[None, :])[:, 0]
        self.negative = planes(np.maximum(-gains, 0)[None, :])[:, 0]

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """Sum of count times gain of each row of bucket counts: common ones of each two planes, by powers of two."""
        out = np.zeros(len(counts), np.int64)
        for j, plane in enumerate(planes(counts)):
            some = np.flatnonzero(plane.any(axis=1))  # higher planes are empty for most documents
            plane = plane[some]
            for sign, bits in ((1, self.positive), (-1, self.negative)):
                for k, gain in enumerate(bits):
                    common = np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
                    out[some] += sign * (common << (j + k))
        return out


def gumbel(doc_id: int | None, seed: int) -> int:
    """The document's noise: floor(-1000 ln(-ln u)), u from the first 32 bits of SHA-256 of "seed:doc_id"."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scores(
    docs: DataFrame, gains: np.ndarray, text: str = "text", key: str = "doc_id", longest: int = WORDS, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs``."""
    util.ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches):
        held = Gains(shared.value)
        size = len(shared.value)
        known = Buckets(size)
        rows = max(1, _CELLS // size)
        for batch in batches:
            for part in util.slices(batch, "text"):
                for at in range(0, part.num_rows, rows):
                    some = part.slice(at, rows)
                    found = [bucket_numbers(t, known, longest) for t in some.column("text").to_pylist()]
                    n = np.array([len(b) for _, b in found], np.int64)
                    cells = np.concatenate([b + i * size for i, (_, b) in enumerate(found)])
                    counts = np.bincount(cells, minlength=len(found) * size).reshape(len(found), size)
                    # the planes are cut from the narrowest numbers that hold the counts
                    counts = counts.astype(np.min_scalar_type(int(counts.max(initial=0))))
                    weight = np.where(n > 0, held.sums(counts) // np.maximum(n, 1), 0)
                    ids = some.column("doc_id").to_pylist()
                    noise = np.array([gumbel(d, seed) for d in ids], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column("doc_id").cast(pa.int64()), pa.array([w for w, _ in found], pa.int64()),
                            pa.array(n), pa.array(weight), pa.array(weight + noise),
                        ],
                        names=["doc_id", "n_words", "n_features", "weight", "score"],
                    )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """All rows with ``rank``: 1, 2, 3... for the highest scores of the documents long enough, null for the rest.

    floor(percent * N / 100) of the N documents with at least ``least_words``
    words are drawn, ties by the smaller ``doc_id``.
    """
    spark = scored.sparkSession
    scored = util.stored(scored, "resample-scores")
    fits = F.col("n_words") >= least_words
    # a score is a whole number of bounded range, so its histogram is small whatever the number of documents
    steps = sorted(scored.where(fits).groupBy("score").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["score"])
    wanted = percent * sum(r["n"] for r in steps) // 100
    held, cut = 0, None
    for row in steps:
        if held >= wanted:
            break
        held, cut = held + row["n"], row["score"]
    if cut is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    above = fits & (F.col("score") >= cut)
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.col("weight"), F.col("n_features"), F.col("n_words")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def number(batches):
        at = 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.arange(at, at + batch.num_rows))], names=[*batch.schema.names, "at"]
            )
            at += batch.num_rows

    # a stored row number splits even rows that are equal in all; ranges of it need no second shuffle
    ranged = scored.where(above).withColumn("row", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(n, *order, "row").sortWithinPartitions(*order, "row").drop("row")
    kinds = ", ".join(f"{c} long" for c in [*ranged.columns, "at"])
    ranged = util.stored(ranged.mapInArrow(number, kinds).withColumn("range", F.spark_partition_id()), "resample-ranges")
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n"))
    # one row per range partition
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    rank = F.col("before") + F.col("at") + 1
    ranked = ranged.join(F.broadcast(before), "range").select(*scored.columns, F.when(rank <= wanted, rank).alias("rank"))
    return ranked.unionByName(scored.where(~above).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    buckets: int = BUCKETS,
    longest: int = WORDS,
    seed: int = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Every row of ``docs`` weighed by how much its words resemble ``target``, and the drawn ones ranked."""
    with util.arrow_rows(docs.sparkSession, _BATCH_ROWS):
        gains = bucket_gains(bucket_totals(docs, text, buckets, longest), bucket_totals(target, text, buckets, longest))
        return draw(scores(docs, gains, text, key, longest, seed), percent, least_words)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` weighed against ``benchmark``; the highest tenth is drawn."""
    drawn = resample(util.table(spark, sf_dir, "documents"), util.table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
