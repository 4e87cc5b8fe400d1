import hashlib
import math
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtide.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest=1):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, buckets=resample.BUCKETS, least=20, percent=10, longest=1):
    """Row by row: (doc_id, n_features, weight, score, rank)."""
    hashed = lambda fs: [zlib.crc32(f.encode()) % buckets for f in fs]
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for b in hashed(features(text, longest)[1]):
            s[b] += 1
    for text in target:
        for b in hashed(features(text, longest)[1]):
            t[b] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        words, fs = features(text, longest)
        weight = sum(gain[b] for b in hashed(fs)) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(fit[: percent * len(fit) // 100])}
    return sorted((*r[:4], rank.get(r[0])) for r in rows)


def made(df):
    return sorted((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


TEXTS = ["", None, "One two, two THREE", "naïve 中文 x" * 9, "a\x00b_c-d " * 30, "the end of it all " * 40, "İ ſ K É " * 20]


def test_equals_brute_force(spark, folder):
    docs = [(i, TEXTS[i % 7] and TEXTS[i % 7] + f" w{i % 13} " * (i % 40), "en", "s", 1) for i in range(300)]
    marks = [(i, t) for i, t in enumerate(["the two of it", "w3 w4 中文", None, ""])]
    at = folder("documents", docs, "doc_id long, text string, lang string, source string, n_chars long")
    folder("benchmark", marks, "item_id long, text string", at)
    got = resample.op13(spark, at)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert made(got) == brute([d[:2] for d in docs], [m[1] for m in marks])


def test_runs_of_words_and_other_parameters(spark):
    docs = [(i, f"a b{i % 3} c d{i % 5} e") for i in range(40)]
    marks = ["b1 c d1", "a b2"]
    df, target = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(m,) for m in marks], "text string")
    got = resample.resample(df, target, buckets=100, longest=3, percent=25, least_words=5).drop("n_words")
    assert made(got) == brute(docs, marks, 100, 5, 25, 3)


def test_long_texts_are_read_in_stretches(monkeypatch):
    text = " ".join(f"Wörd{i}," for i in range(500))
    whole = resample.bucket_numbers(text, resample.Buckets(97), 3)
    monkeypatch.setattr(resample, "_READ", 50)
    cut = resample.bucket_numbers(text, resample.Buckets(97), 3)
    assert whole[0] == cut[0] == 500
    assert sorted(whole[1].tolist()) == sorted(cut[1].tolist())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(-30_000, 30_000), min_size=1, max_size=200), st.integers(0, 10**6))
def test_bit_sliced_sums_are_exact(gains, seed):
    counts = np.random.default_rng(seed).integers(0, 1 << 20, (5, len(gains))) * np.random.default_rng(seed + 1).integers(0, 2, (5, 1))
    gains = np.array(gains)
    assert resample.Gains(gains).sums(counts).tolist() == (counts @ gains).tolist()


def test_hot_ids_ties_repeats_and_clashing_columns(spark):
    """A third of the rows share a null id and a text; each is still a document with a rank of its own."""
    long = "word " * 25
    rows = [(None, long, 1, "x")] * 40 + [(7, long, 2, None)] * 3 + [(i, f"t{i} " * 30, 3, "y") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score long, range string")
    got = resample.resample(df, df.limit(0), percent=50).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert len(got) == 123 and ranks == list(range(1, 62))
    order = sorted(got, key=lambda r: (-r.score, -1 if r.doc_id is None else r.doc_id))
    assert [(r.score, r.doc_id) for r in sorted(got, key=lambda r: r["rank"] or 10**9)[:61]] == [(r.score, r.doc_id) for r in order[:61]]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(none, none).collect() == []
    few = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert {(r.doc_id, r["rank"]) for r in resample.resample(few, none).collect()} == {(1, None), (2, None)}


def test_a_worker_weighs_texts_in_little_memory(spark, monkeypatch):
    """Tables of counts of a few texts at a time, in narrow numbers: a worker's arrays stay small."""
    import tracemalloc

    import pyarrow as pa

    caught = {}
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, f, schema: caught.setdefault("run", f))
    gains = np.arange(resample.BUCKETS, dtype=np.int64) % 4001 - 2000
    resample.scores(frame, gains)
    texts = [" ".join(f"w{(i * 31 + j * j) % 3000}" for j in range(300)) for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    weights = [w for part in caught["run"](iter([batch])) for w in part.column("weight").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30_000_000
    known = resample.Buckets(resample.BUCKETS)
    plain = [gains[resample.bucket_numbers(t, known)[1]] for t in texts]
    assert weights == [int(g.sum() // len(g)) for g in plain]
