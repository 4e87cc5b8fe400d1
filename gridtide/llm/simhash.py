"""SimHash near-duplicates by deletion-variant signatures (operator 3).

A fingerprint is cut into ``segments`` parts so few that of any two fingerprints
within ``max_bits`` one part differs by at most one bit. Every part is indexed
under its variants with one bit taken out (a wildcard); fingerprints that share
a variant meet in an equality join of bounded groups, their distance is
verified, and only a spanning forest of each group's links is kept, so a large
group of near copies costs links in proportion to its members.

Equal fingerprints (all copies) are one entry of the index.

Defined results: null and empty texts have no word and the zero fingerprint,
linked like any other; a text of fewer words than a shingle is one shingle;
ties of a bit (exactly half) give 0; repeated rows are classed alike; a null
``doc_id`` is never a component's id unless it has no other; ``keep_one`` keeps a
row of every class, also of those that share a null or repeated id; an empty
table gives no row. Extra columns are ignored by the index and kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.llm import links, util

WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints compared at once in one task (a larger group is split into pairs of blocks).
BLOCK = 2048


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint of one text, as an unsigned integer."""
    split = (text or "").encode().lower().split()
    if not split:
        return 0
    joined = b" ".join(split)
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1)
    starts = (ends - np.fromiter(map(len, split), np.int64, len(split)) - 1).tolist()
    n = max(1, len(split) - words + 1)
    last = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last, strict=False)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 4096):
        ones += np.unpackbits(h[i : i + 4096, None].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", words: int = WORDS, out: str = "fp") -> DataFrame:
    """``docs`` with ``out``: the text's fingerprint as a signed bigint."""

    def make():
        return lambda texts: [[f - (1 << 64) if f >> 63 else f for f in (fingerprint(t, words) for t in texts)]]

    return util.per_text(docs, text, [(out, T.LongType())], make)


def variants(fp, max_bits: int = MAX_BITS):
    """Column: the signatures of a fingerprint, one per segment and wildcard place, as bigints."""
    segments = max_bits // 2 + 1  # at most max_bits // segments = 1 differing bits in the best segment
    cuts = [round(64 * i / segments) for i in range(segments + 1)]
    out = []
    for s, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for place in range(high - low):
            name = s * 64 + place
            out.append(part.bitwiseAND(F.lit(~(1 << place))).bitwiseOR(F.lit(name << 40)))
    return F.array(*out)


def _forest(values: list[int], max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the values within ``max_bits`` of each other."""
    if len(values) == 2:
        a, b = values
        return [(a, b)] if ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count() <= max_bits else []
    x = np.unique(np.array(values, np.int64))
    rest, out = np.arange(len(x)), []
    while len(rest):
        todo, rest = [int(rest[0])], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            near = np.bitwise_count((x[rest] ^ x[i]).view(np.uint64)) <= max_bits
            found = rest[near]
            out += [(int(x[i]), int(x[j])) for j in found]
            todo += found.tolist()
            rest = rest[~near]
    return out


def near_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect all pairs within ``max_bits``."""
    util.ship(fps.sparkSession)
    signed = fps.select("fp", F.explode(variants(F.col("fp"), max_bits)).alias("sig"))
    found = links.groups(signed, "sig", "fp", BLOCK, F.col("fp"))
    # two by chance under one signature: their distance is taken before anything goes to Python
    two = F.bit_count(F.col("members")[0].bitwiseXOR(F.col("members")[1])) <= max_bits
    found = found.where(F.when(F.size("members") == 2, two).otherwise(True)).select(F.col("members").alias("fps"))

    def run(batches):
        for batch in batches:
            pairs = set()
            for values in batch.column("fps").to_pylist():
                pairs.update(_forest(values, max_bits))
            a, b = zip(*pairs, strict=True) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return found.mapInArrow(run, "a long, b long").distinct()


def _rooted(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``distinct`` (one row of each ``fp``) with ``root``: the same value for all fingerprints of a class."""
    of = links.components(near_links(distinct, max_bits)).withColumnRenamed("node", "fp")
    return distinct.join(of, "fp", "left").withColumn("root", F.coalesce("component", "fp")).drop("component")


def _text_key(text: str):
    """Column: what tells the rows of one id apart, equal for equal texts."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def classes(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest doc_id reachable over links."""
    base = util.stored(fingerprints(docs.select(doc_id, text), text, words).select(doc_id, "fp"), "simhash")
    least = util.stored(base.groupBy("fp").agg(F.min(doc_id).alias("least")), "simhash-distinct")
    joined = _rooted(least, max_bits)
    roots = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = util.stored(joined.join(roots, "root").select("fp", "component_id"), "simhash-classes")
    return base.join(ids, "fp").select(doc_id, "fp", "component_id")


def keep_one(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with one row of each class: of its rows with the smallest id (null if it has no other) one.

    The row is chosen per class, not per id: a null or repeated id may stand for
    unrelated texts. It is named by id and text, so texts aren't grouped.
    """
    made = fingerprints(docs.select(doc_id, text), text, words)
    base = util.stored(made.select(F.col(doc_id).alias("id"), "fp", _text_key(text).alias("key")), "simhash")
    rows = base.groupBy("fp", "id", "key").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key", "n")).alias("row")
    least = util.stored(rows.groupBy("fp").agg(first), "simhash-distinct")
    chosen = _rooted(least, max_bits).groupBy("root").agg(F.min("row").alias("row"))
    key, *names = (util.fresh(docs, name) for name in ("text_key", "kept_id", "kept_key", "kept_n"))
    kept = util.stored(chosen.select("row.id", "row.key", "row.n").toDF(*names), "simhash-kept")
    keyed = docs.withColumn(key, _text_key(text))
    same = keyed[doc_id].eqNullSafe(kept[names[0]]) & (keyed[key] == kept[names[1]])
    once = keyed.join(kept.where(F.col(names[2]) == 1), same, "left_semi")
    again = keyed.join(kept.where(F.col(names[2]) > 1), same, "left_semi").dropDuplicates([doc_id, key])
    return once.union(again).drop(key)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = classes(util.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
