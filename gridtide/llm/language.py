"""Language identification (operator 8).

Method: hashed character n-grams (1 to 3) of the lower-cased letters with
TF-IDF weights feed a sparse multinomial logistic regression, trained by
follow-the-regularised-leader with elastic-net penalties; a temperature fitted
on labelled rows outside the training sample calibrates the probabilities.

Document frequencies are counted over all training rows. The model itself is
fitted on a bounded sample: about ``SAMPLE`` rows of each language chosen by a
hash of their id (and as many others for the temperature), in ``SHARDS``
independent parts whose weights are averaged.

Defined results: a text that is null, empty or without a letter is ``und`` with
score 0; without any labelled row every text is ``und``; ties go to the first
language in order; whole texts are read however long; extra columns pass
through, and a column named like an output is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.llm import util

UNKNOWN = "und"
#: Hash buckets of n-grams; the model has this many weights for each language.
BUCKETS = 1 << 14
#: Rows of each language in the training sample, and again for the temperature.
SAMPLE = 600
SHARDS = 4
EPOCHS = 3
#: FTRL: step size, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
TEMPERATURES = [round(float(t), 4) for t in np.geomspace(0.05, 8, 49)]
#: Characters of a text hashed at once.
CHUNK = 1 << 20

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def counts(text: str | None) -> np.ndarray | None:
    """How often each bucket's n-grams occur in the text; None if it has no letter."""
    if not text:
        return None
    total = np.zeros(BUCKETS, np.int64)
    any_letter = False
    table = _letter_table()
    for i in range(0, len(text), CHUNK):
        part = text[max(0, i - 2) : i + CHUNK].lower()
        c = np.frombuffer(part.encode("utf-32-le"), np.uint32)
        c = np.where(table[c], c, 0).astype(np.uint32)
        any_letter = any_letter or bool(c.any())
        one = c * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35) + np.uint32(1)
        three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1) + np.uint32(2)
        shift = np.uint32(32 - BUCKETS.bit_length() + 1)
        # n-grams made of gaps only say nothing
        blank = c == 0
        two = two[~(blank[:-1] & blank[1:])]
        three = three[~(blank[:-2] & blank[1:-1] & blank[2:])]
        for h in (one[~blank], two, three):
            total += np.bincount(h >> shift, minlength=BUCKETS)
    return total if any_letter else None


def vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(buckets, weights) of the text: sublinear term frequency, IDF, unit length."""
    n = counts(text)
    if n is None:
        return None
    at = np.flatnonzero(n)
    w = (1 + np.log(n[at])) * idf[at]
    size = float(np.sqrt(w @ w))
    return at, w / size if size else w


class Ftrl:
    """Multinomial logistic regression by FTRL-proximal, one weight row per language."""

    def __init__(self, classes: int):
        self.z = np.zeros((BUCKETS, classes))
        self.n = np.zeros((BUCKETS, classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p[None, :]
        s = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - s * w
        self.n[at] += g * g


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


class Model:
    """Languages, IDF weights, regression weights and temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float = 1.0):
        self.languages, self.idf, self.weights, self.temperature = languages, idf, weights, temperature

    def logits(self, text: str | None) -> np.ndarray | None:
        v = vector(text, self.idf) if self.languages else None
        return None if v is None else v[1] @ self.weights[v[0]]

    def predict(self, text: str | None) -> tuple[str, float]:
        s = self.logits(text)
        if s is None:
            return UNKNOWN, 0.0
        best = int(s.argmax())
        return self.languages[best], float(softmax(s / self.temperature)[best])


def _document_frequencies(rows: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts with a letter; BUCKETS + 1 rows come back."""

    def run(batches):
        df = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for part in util.slices(batch, text):
                for t in part.column(text).to_pylist():
                    n = counts(t)
                    if n is not None:
                        df[:-1] += n > 0
                        df[-1] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], names=["at", "n"])

    out = np.zeros(BUCKETS + 1, np.int64)
    for at, n in rows.select(text).mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[at] = n
    return out[:-1], int(out[-1])


def train(rows: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Fit on the rows of ``rows`` whose ``lang`` is not null."""
    util.ship(rows.sparkSession)
    rows = rows.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "lang is not null"
    )
    sizes = sorted((r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect())
    languages = [name for name, _ in sizes]
    if not languages:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)))
    df, n = _document_frequencies(rows, "text")
    idf = np.log((1 + n) / (1 + df)) + 1
    # a row's place in [0, 1) by a hash: training below its language's share, calibration in the next share
    place = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / F.lit(1 << 30)
    share = F.create_map(*[x for name, k in sizes for x in (F.lit(name), F.lit(min(0.5, sample / k)))])[F.col("lang")]
    picked = rows.withColumn("place", place).withColumn("share", share)
    label = {name: i for i, name in enumerate(languages)}

    def fit(pdf):
        import pandas as pd

        seen = [(label[g], v) for g, t in zip(pdf["lang"], pdf["text"], strict=True) if (v := vector(t, idf)) is not None]
        model = Ftrl(len(languages))
        order = np.random.default_rng(7)
        for _ in range(EPOCHS):
            for i in order.permutation(len(seen)):
                y, (at, x) = seen[i]
                model.learn(at, x, y)
        w = model.weights()
        at, k = np.nonzero(w)
        return pd.DataFrame({"at": at, "k": k, "w": w[at, k]})

    shard = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(SHARDS)).alias("shard")
    parts = (
        picked.where("place < share").select(shard, "doc_id", "lang", "text").groupBy("shard").applyInPandas(fit, "at int, k int, w double")
    )
    weights = np.zeros((BUCKETS, len(languages)))
    for at, k, w in parts.groupBy("at", "k").agg(F.sum("w").alias("w")).collect():
        weights[at, k] = w / SHARDS
    model = Model(languages, idf, weights)
    rest = picked.where("place >= share and place < 2 * share").select("lang", "text")
    model.temperature = _temperature(rest, model, label)
    return model


def _temperature(rows: DataFrame, model: Model, label: dict[str, int]) -> float:
    """The temperature of least negative log-likelihood on the rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    grid = np.array(TEMPERATURES)

    def run(batches):
        total = np.zeros(len(grid))
        for batch in batches:
            for lang, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                s = shared.value.logits(t)
                if s is not None:
                    scaled = (s - s.max())[None, :] / grid[:, None]
                    total += np.log(np.exp(scaled).sum(axis=1)) - scaled[:, label[lang]]
        yield pa.RecordBatch.from_arrays([pa.array(grid), pa.array(total)], names=["t", "loss"])

    found = rows.mapInArrow(run, "t double, loss double").groupBy("t").agg(F.sum("loss").alias("loss")).collect()
    least = min(((r["loss"], r["t"]) for r in found), default=(0.0, 1.0))
    return least[1] if least[0] > 0 else 1.0


def predict(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its calibrated probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        predict_one = shared.value.predict
        return lambda texts: [list(x) for x in zip(*map(predict_one, texts), strict=True)]

    return util.per_text(docs, text, [(lang, T.StringType()), (score, T.DoubleType())], make)


def held_out(doc_id: str = "doc_id"):
    """Column: whether crc32 of the id as text leaves the remainder 2 (such rows are not learned from)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and score of every document."""
    docs = util.table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")
