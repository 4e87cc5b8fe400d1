import tempfile
import uuid

from gridtide import fixed
from gridtide.plans import catalog
from gridtide.streaming import stateless_checks


def test_stateless_checks_match_batch_on_a_stream(spark):
    cfg = catalog.TELEMETRY
    batch = catalog._validated(spark, "/root/testdata/sf0.001")
    keep = [cfg.key, cfg.time, *cfg.counters, cfg.capacity, *cfg.deltas]
    src = tempfile.mkdtemp(prefix="gridtide-stream-")
    batch.select(*keep).write.mode("overwrite").parquet(src + "/in")
    stream = spark.readStream.schema(batch.select(*keep).schema).parquet(src + "/in")
    name = "checks_" + uuid.uuid4().hex[:8]
    q = stateless_checks(stream, cfg).drop(fixed.VALIDATION_RESULT).writeStream.format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    got = spark.table(name)
    want = batch.drop(fixed.VALIDATION_RESULT).select(*got.columns)
    assert got.count() == want.count() == 1000
    assert got.exceptAll(want).count() == 0
