"""The stage store: one writing for several readers, nothing left behind."""

import os

import pytest
from pyspark.sql import functions as F

from gridtide import session
from gridtide.functions.rules import BatchRule, custom_rules
from gridtide.operators import validate
from gridtide.plans import catalog, chain, fixtures

SF = "/root/testdata/sf0.001"


def folder(store):
    return store.path.removeprefix("file:")


def test_chain_with_a_store_equals_the_lazy_chain_and_cleans_up(spark):
    raw = fixtures.telemetry(spark, SF)
    odd = raw.withColumn("date_time", F.when(F.col("file_id") % 91 != 0, F.col("date_time")))
    cfg = catalog.FLAGSHIP
    lazy = chain.run_chain(odd, cfg, exact=True)
    with session.StageStore(spark) as store:
        kept = chain.run_chain(odd, cfg, exact=True, store=store)
        for name in ("cleaned", "failed", "quarantined"):
            a, b = getattr(kept, name), getattr(lazy, name)
            a, b = (x.drop("validation_result") for x in (a, b))
            assert sorted(a.columns) == sorted(b.columns), name
            assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count(), name
        # the failed and the quarantined readings come from the stored rows: no second scan of the input
        for df in (kept.failed, kept.quarantined):
            assert df.inputFiles() and all("/flagged-" in f for f in df.inputFiles())
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert len(os.listdir(folder(store))) >= 2
    assert not os.path.exists(folder(store))


def test_a_store_is_closed_after_a_failure_too(spark):
    with pytest.raises(ZeroDivisionError):
        with session.StageStore(spark) as store:
            assert store.table(spark.range(3)).count() == 3
            1 / 0
    assert not os.path.exists(folder(store))
    session.StageStore(spark).close()  # nothing written: nothing to do


def test_batch_rules_keep_order_nulls_and_clashes(spark):
    df = spark.createDataFrame([(1, 2, "x"), (None, 2, "y"), (5, None, "z"), (9, 1, None)], "a long, b long, word string").repartition(2)
    seen = []

    def larger(a, b):
        import pyarrow.compute as pc

        return pc.greater(a, b)

    def has_y(word):
        return [w is not None and "y" in w for w in word.to_pylist()]

    rules = [
        BatchRule("a over b", ("a", "b"), larger),
        *custom_rules([("a over four", F.col("a") > 4)]),
        BatchRule("y", ("word",), has_y),
        BatchRule("b over a", ("b", "a"), larger),
    ]
    got = {r.word: r.error_message for r in validate.validate_rows(df, rules=rules).collect()}
    assert got == {"x": "b over a", "y": "y", "z": "a over four", None: "a over b, a over four"}
    assert validate.validate_rows(df.limit(0), rules=rules).count() == 0 and not seen
