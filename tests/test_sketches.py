"""Stored quantile sketches: rank error, merging, replaced batches, empty columns."""

import random

import pytest

from gridtide.operators import outliers, sketches


def rank_error(values, q, p):
    """Distance of ``p`` from the ranks that ``q`` covers."""
    values = sorted(values)
    low, high = sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)
    return max(0.0, low - p, p - high)


def shapes():
    r = random.Random(2)
    n = 20_000
    return {
        "even": [float(i) for i in range(n)],
        "skewed": [r.paretovariate(0.8) for _ in range(n)],
        "tied": [float(r.choice([1, 1, 1, 2, 3, 50])) for _ in range(n)],
        "shuffled": r.sample([i * 0.5 - 3000 for i in range(n)], n),
        "two heaps": [r.gauss(-100, 1) if i % 4 else r.gauss(1e6, 5) for i in range(n)],
    }


@pytest.mark.parametrize("name", list(shapes()))
def test_default_and_stored_fences_are_within_one_percent_of_rank(spark, tmp_path, name):
    values = shapes()[name]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double").repartition(4)
    row = outliers.iqr_fences(df, ["v"]).first()
    for q, p in ((row.q1, 0.25), (row.q3, 0.75)):
        assert rank_error(values, q, p) <= 0.01
    store = str(tmp_path / "sketches")
    for batch in range(5):  # batches of very different sizes
        part = df.where(f"i >= {batch ** 3 * 300} and i < {(batch + 1) ** 3 * 300 if batch < 4 else 10**9}")
        sketches.add_batch(part, ["v"], store, f"b{batch}")
    stored = sketches.stored_sketches(spark, store)
    assert stored.count() == 5
    got = sketches.sketched_fences(stored).first()
    for q, p in ((got.q1, 0.25), (got.q3, 0.75)):
        assert rank_error(values, q, p) <= 0.01
    assert got.upper == got.q3 + 1.5 * (got.q3 - got.q1)
    assert sketches.sketched_quantiles(stored).first().n == len(values)


def test_a_batch_replaces_itself_and_nulls_add_nothing(spark, tmp_path):
    store = str(tmp_path / "s")
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (3.0, None), (None, None)], "a double, b double")
    for _ in range(2):
        sketches.add_batch(df, ["a", "b"], store, "x")
    sketches.add_batch(df.limit(0), ["a", "b"], store, "empty")
    got = {r.column: r for r in sketches.sketched_fences(sketches.stored_sketches(spark, store)).collect()}
    assert (got["a"].q1, got["a"].q3) == (1.0, 3.0) and got["b"].q1 is None and got["b"].upper is None
    n = {r.column: r.n for r in sketches.sketched_quantiles(sketches.stored_sketches(spark, store)).collect()}
    assert n == {"a": 2, "b": 0}
