"""Near-duplicate embeddings by collision-counting projections (operator 1).

Each vector is projected on many random lines. Two vectors collide on a line if
the one lies in a window around the other; pairs that collide on at least as
many lines as two vectors at the threshold do with the chosen recall are
verified by their cosine in double precision.

Windows on single sorted lines can't find the candidates at scale: a threshold
pair's difference is a fixed share of a line's spread, so a window around each
vector holds a fixed share of all vectors of its label -- measured on two tables
of 10,256 and 51,282 vectors, 23 % of all pairs on each line (1.2 and 29.9
million, 24.7 times as many for 5 times the vectors). Candidates are therefore
pairs that share a cell of one of the tables of ``LINES`` lines each, on which
the projections are cut into cells instead of sorted; the collision count over
all lines then filters them. Cell widths, the number of tables and the
least count come from the threshold and the recall alone. Equal vectors with
the same label are one entry. Members of a crowded cell are dealt over blocks of
bounded size, all pairs of which meet; a task returns a number of links per
member and a spanning forest, never the pairs. A pair is counted only in the
first table in which its cells agree.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows whose label is null, link with nothing and are their own
component; vectors of different lengths don't link; repeated ``vec_id`` with
equal vectors count as links; an empty table gives no row.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import links, util

COSINE = 0.98
#: Share of the pairs at the threshold that may be missed by the cells, and by the counting.
MISS = 5e-4
#: Lines in a table's cell, width of a cell and of the collision window in standard deviations of a
#: threshold pair's difference.
LINES = 5
CELL = 5.0
WINDOW = 2.0
BLOCK = 512
SEED = 20
_ROWS = 256


def plan(cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(tables, least count): so many tables that a pair at the threshold shares a cell in one but for ``miss``;
    the largest count that such a pair reaches but for ``miss``."""
    same = 1 - math.sqrt(2 / math.pi) / CELL  # for a uniformly shifted grid and a normal difference
    tables = math.ceil(math.log(miss) / math.log(1 - same**LINES))
    hit = math.erf(WINDOW / math.sqrt(2))
    m, total, least = tables * LINES, 0.0, 0
    for k in range(m + 1):
        total += math.comb(m, k) * hit**k * (1 - hit) ** (m - k)
        if total > miss:
            least = k
            break
    return tables, least


@lru_cache(maxsize=8)
def _projector(width: int, tables: int, cosine: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Random lines, shifts of the cells, and the standard deviation of a threshold pair's difference."""
    rng = np.random.default_rng(SEED + width)
    spread = math.sqrt(2 - 2 * cosine)
    return rng.standard_normal((width, tables * LINES)), rng.random(tables * LINES), spread


def _units(vectors: list) -> np.ndarray:
    """Unit vectors (rows) of usable vectors of one length, in double precision."""
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _cells(units: np.ndarray, tables: int, cosine: float) -> np.ndarray:
    """The cell of each unit vector in each table, as a hash of its places on the table's lines."""
    lines, shift, spread = _projector(units.shape[1], tables, cosine)
    cell = np.floor(units @ lines / (CELL * spread) + shift).astype(np.int64).reshape(len(units), tables, LINES)
    key = np.full((len(units), tables), units.shape[1], np.uint64)
    for k in range(LINES):
        key = (key ^ cell[:, :, k].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def entries(vectors: DataFrame, cosine: float = COSINE, tables: int | None = None) -> DataFrame:
    """(rep, n, label, embedding, cells): every distinct usable vector of a label, its copies and its cell per table."""
    tables = tables or plan(cosine)[0]
    ok = (F.size("embedding") > 0) & F.col("label").isNotNull() & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ) & F.exists("embedding", lambda x: x != 0)
    distinct = vectors.where(ok).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))

    def run(batches):
        for batch in batches:
            # one vector after another: a vector's cells must not depend on its batch
            cells = [_cells(_units([v]), tables, cosine)[0] for v in batch.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("rep", "n", "label", "embedding")), pa.array(cells, pa.list_(pa.int64()))],
                names=["rep", "n", "label", "embedding", "cells"],
            )

    kinds = dict(vectors.dtypes)
    return distinct.select("rep", "n", "label", "embedding").mapInArrow(
        run, f"rep long, n long, label {kinds['label']}, embedding {kinds['embedding']}, cells array<long>"
    )


def _compare(table, reps, copies, units, cells, first, cosine, least, tables):
    """Links per member and a forest, for the pairs of a group that table ``table`` counts.

    ``first`` tells the block of each member of a group of two blocks, where
    only pairs across them count (the pairs within have groups of their own).
    """
    n, width = len(reps), units.shape[1]
    lines, _, spread = _projector(width, tables, cosine)
    places = units @ lines
    links_of = np.zeros(n, np.int64)
    root = np.arange(n)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    forest = []
    for low in range(0, n, _ROWS):
        rows = np.arange(low, min(n, low + _ROWS))
        pair = np.arange(n)[None, :] > rows[:, None]
        if first is not None:
            pair &= first[None, :] != first[rows][:, None]
        for t in range(table):  # an earlier table has counted the pair
            pair &= cells[rows, t][:, None] != cells[:, t][None, :]
        count = np.zeros(pair.shape, np.int16)
        for k in range(places.shape[1]):
            count += np.abs(places[rows, k][:, None] - places[None, :, k]) <= WINDOW * spread
        i, j = np.nonzero(pair & (count >= least))
        near = np.einsum("ij,ij->i", units[rows[i]], units[j]) >= cosine
        i, j = rows[i[near]], j[near]
        np.add.at(links_of, i, copies[j])
        np.add.at(links_of, j, copies[i])
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                forest.append((int(reps[a]), int(reps[b])))
    return links_of, forest


def near(found: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Rows (a, b, n): b null and n new links of entry a, or a link between entries a and b."""
    util.ship(found.sparkSession)
    tables, least = plan(cosine)
    parted = found.select("rep", "n", "embedding", "label", F.posexplode("cells").alias("t", "cell"))
    # a hash of label, table and cell: other labels or cells under the same key are told apart in the task
    parted = parted.withColumn("key", F.xxhash64("label", "t", "cell"))
    value = F.struct("rep", "n", "embedding", "t", "cell", "label", "block")
    groups = links.groups(parted, "key", "rep", BLOCK, value)

    def run(batches):
        for batch in batches:
            a, b, c = [], [], []
            for row in range(batch.num_rows):
                members = batch.column("members")[row].as_py()
                across = batch.column("gi")[row].as_py() != batch.column("gj")[row].as_py()
                parts = {}
                for m in members:
                    parts.setdefault((m["t"], str(m["label"]), len(m["embedding"]), m["cell"]), []).append(m)
                for (t, *_), part in parts.items():
                    if len(part) < 2:
                        continue
                    reps = np.array([m["rep"] for m in part])
                    units = np.concatenate([_units([m["embedding"]]) for m in part])
                    cells = np.concatenate([_cells(units[i : i + 1], tables, cosine) for i in range(len(part))])
                    counts, forest = _compare(
                        t, reps, np.array([m["n"] for m in part]), units, cells,
                        np.array([m["block"] for m in part]) if across else None, cosine, least, tables,
                    )
                    for i in np.flatnonzero(counts).tolist():
                        a.append(int(reps[i]))
                        b.append(None)
                        c.append(int(counts[i]))
                    for x, y in forest:
                        a.append(x)
                        b.append(y)
                        c.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, c)], names=["a", "b", "n"])

    return groups.select("gi", "gj", "members").mapInArrow(run, "a long, b long, n long")


def classes(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    found = util.stored(entries(vectors, cosine), "vectors")
    pairs = util.stored(near(found, cosine), "vector-links")
    of = links.components(pairs.where("b is not null").select("a", "b"))
    extra = pairs.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("more"))
    known = (
        found.select("rep", F.col("n").alias("copies"))
        .join(extra, "rep", "left")
        .join(of.withColumnRenamed("node", "rep"), "rep", "left")
        .select("rep", "copies", F.coalesce("more", F.lit(0)).alias("more"), F.coalesce("component", "rep").alias("component"))
    )
    known = util.stored(known.where("copies > 1 or more > 0"), "vector-classes")
    # the copies find their entry by label and vector again; entries without links need no partner
    reps = vectors.select("label", "embedding", F.col("vec_id").alias("rep")).join(known, "rep")
    reps = util.stored(reps.select("label", "embedding", "copies", "more", "component").distinct(), "vector-entries")
    out = vectors.select("vec_id", "label", "embedding").join(reps, ["label", "embedding"], "left")
    return out.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.col("more"), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return classes(util.table(spark, sf_dir, "embeddings"))
