"""Maintained totals: idempotent batches, refused numbers, two writers, snapshots, odd keys."""

import os
import random
from collections import Counter

import pytest

from gridtide.llm import rollup

SCHEMA = "source string, lang string, version string, n_docs long, n_tokens long, n_chars long"


@pytest.fixture
def made(spark, tmp_path):
    return rollup.Rollup(spark, str(tmp_path / "rollup"))


def totals(r):
    return {tuple(x)[:3]: tuple(x)[3:] for x in r.totals().collect()}


def test_random_batches_with_snapshots_equal_plain_sums(spark, made, monkeypatch):
    monkeypatch.setattr(rollup, "COMPACT_EVERY", 3)
    r, want = random.Random(1), Counter()
    for batch in range(8):
        rows = [(r.choice(["a", None]), r.choice(["x", "y", None]), "v", r.choice([1, 1, -1]), r.randint(-9, 9), r.choice([None, 5])) for _ in range(20)]
        df = spark.createDataFrame(rows, SCHEMA)
        assert made.commit(batch, df)
        if batch % 2:
            assert not made.commit(batch, df.repartition(3))  # again, dealt otherwise
        for s, lang, v, *n in rows:
            for i, x in enumerate(n):
                want[s, lang, v, i] += x or 0
    keys = {k[:3] for k in want}
    assert totals(made) == {k: tuple(want[*k, i] for i in range(3)) for k in keys if any(want[*k, i] for i in range(3))}
    folder, held = made._snapshot()
    assert folder and len(held) >= 6 and made.committed() == list(range(8))
    # a reader of the same folder sees the same
    assert totals(rollup.Rollup(spark, made.path)) == totals(made)


def test_a_used_number_with_other_changes_is_refused(spark, made):
    one = spark.createDataFrame([("a", "x", "v", 1, 5, 9)], SCHEMA)
    two = spark.createDataFrame([("a", "x", "v", 1, 6, 9)], SCHEMA)
    assert made.commit(4, one)
    with pytest.raises(ValueError, match="batch 4"):
        made.commit(4, two)
    assert totals(made) == {("a", "x", "v"): (1, 5, 9)} and made.commit(5, two)
    assert totals(made) == {("a", "x", "v"): (2, 11, 18)}


def test_two_writers_and_a_dead_one(spark, made):
    """Deltas without a marker are invisible; a second writer of the batch leaves the first one's deltas alone."""
    one = spark.createDataFrame([("a", "x", "v", 1, 5, 9)], SCHEMA)
    one.write.parquet(f"{made.path}/deltas/1-dead")
    assert totals(made) == {}
    other = rollup.Rollup(spark, made.path)
    # both pass every check before either marker exists: only one marker can be created
    create, order = made._create, []
    made._create = lambda name, text: order.append(other.commit(1, one)) or create(name, text)
    assert made.commit(1, one) is False and order == [True]
    assert totals(made) == {("a", "x", "v"): (1, 5, 9)}
    assert len(os.listdir(f"{made.path}/deltas")) == 2  # the dead writer's and the committed one


def test_keys_with_tokens_left_and_empty_batches(spark, made):
    assert totals(made) == {}
    rows = [("a", "x", "v", 1, 10, 0), ("a", "x", "v", -1, -7, 0), ("b", "x", "v", 1, 3, 3), ("b", "x", "v", -1, -3, -3)]
    assert made.commit(1, spark.createDataFrame([(*x, "extra") for x in rows], SCHEMA + ", batch string"))
    assert totals(made) == {("a", "x", "v"): (0, 3, 0)}
    none = spark.createDataFrame([], SCHEMA)
    assert made.commit(2, none) and not made.commit(2, none) and made.committed() == [1, 2]
    made.compact()
    assert totals(made) == {("a", "x", "v"): (0, 3, 0)}


def test_empty_documents(spark, folder):
    at = folder("documents", [], "doc_id long, text string, source string, lang string")
    folder("labels", [], "doc_id long, quality int, toxic int", at)
    assert rollup.op6(spark, at).collect() == []
