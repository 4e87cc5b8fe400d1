"""Token counts kept by deltas (operator 6).

A rollup maintains totals by source, language and tokenizer version. A batch of
changes (inserted, deleted and revised documents) becomes one signed delta per
key. Committing it writes the deltas to a folder of their own and then creates
the batch's marker, which names that folder and a digest of the deltas; a marker
is created, never replaced, so of two writers of a batch one commits and the
other finds it done. A batch whose writer died before the marker is
invisible and may be written anew. Committing a committed batch again changes
nothing; other deltas under its number are refused.

Every ``COMPACT_EVERY`` batches the totals so far are written as a snapshot with
the numbers of the batches it holds. A read adds the deltas of the later
batches to the last snapshot, so its cost doesn't grow with the history.

Defined results: null sources, languages and versions are keys like any other;
null or empty texts count 0 tokens; null counts in changes count as 0; a batch
without rows commits and changes nothing; repeated rows count each; keys whose
documents, tokens and characters have all gone are left out of the totals; an
empty table gives no key; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import util
from gridtide.session import checkpoint_dir

KEYS = ["source", "lang", "version"]
SUMS = ["n_docs", "n_tokens", "n_chars"]
_DELTAS = "source string, lang string, version string, n_docs long, n_tokens long, n_chars long"

#: Batches after which the totals are written anew.
COMPACT_EVERY = 16

#: Tokenizer versions: the pattern of a token.
VERSIONS = {
    "blank-1": r"[^\x20\x09-\x0D]+",
    "word-2": r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]",
}


def token_count(text: Column, version: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def change(rows: DataFrame, version: str, sign: int, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One signed change per row: +1 adds the document at this tokenizer version, -1 takes it away; ``keep`` stays."""
    return rows.select(
        *keep,
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.lit(version).alias("version"),
        F.lit(sign).cast("long").alias("n_docs"),
        (token_count(F.col(text), version) * sign).alias("n_tokens"),
        (F.coalesce(F.length(text), F.lit(0)).cast("long") * sign).alias("n_chars"),
    )


class Rollup:
    """Totals, deltas and markers of one rollup in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        if not self._fs.exists(self._path(folder)):
            return []
        return [f.getPath().getName() for f in self._fs.listStatus(self._path(folder)) if f.isFile()]

    def _create(self, name: str, text: str) -> bool:
        """Create a small file; False if there is one of this name."""
        try:
            out = self._fs.create(self._path(name), False)
        except Py4JJavaError:
            if self._fs.exists(self._path(name)):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _content(self, name: str) -> list[str]:
        stream = self._fs.open(self._path(name))
        try:
            text = self.spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
        finally:
            stream.close()
        if not text:
            raise RuntimeError(f"{name} is being written: try again")
        return bytes(text).decode().split()

    def _read(self, folder: str) -> DataFrame:
        return self.spark.read.schema(_DELTAS).parquet(f"{self.path}/{folder}")

    def committed(self) -> list[int]:
        """The numbers of the committed batches."""
        return sorted(map(int, self._names("commits")))

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Fold a batch of changes (KEYS and signed SUMS) into the rollup; False if it was committed before."""
        batch = int(batch)
        sums = [F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long").alias(c) for c in SUMS]
        delta = changes.groupBy(*KEYS).agg(*sums).where(" or ".join(f"{c} <> 0" for c in SUMS))
        folder = f"deltas/{batch}-{uuid.uuid4().hex}"
        delta.write.parquet(f"{self.path}/{folder}")
        rows = F.xxhash64(*KEYS, *SUMS)
        digest = self._read(folder).agg(F.count("*"), F.bit_xor(rows), F.sum(rows.cast("decimal(38,0)"))).first()
        digest = "-".join(str(x) for x in digest)
        if self._create(f"commits/{batch}", f"{folder} {digest}"):
            if len(self._later()) >= COMPACT_EVERY:
                self.compact()
            return True
        self._fs.delete(self._path(folder), True)
        if self._content(f"commits/{batch}")[1] != digest:
            raise ValueError(f"batch {batch} was committed with other changes")
        return False

    def _snapshot(self) -> tuple[str | None, set[int]]:
        """The folder of the last snapshot and the batches it holds."""
        names = self._names("snapshots")
        if not names:
            return None, set()
        folder, *batches = self._content(f"snapshots/{max(names, key=int)}")
        return folder, set(map(int, batches))

    def _later(self) -> list[int]:
        held = self._snapshot()[1]
        return [b for b in self.committed() if b not in held]

    def _sums(self) -> tuple[DataFrame, list[int]]:
        snapshot, held = self._snapshot()
        batches = self.committed()
        parts = [snapshot] * (snapshot is not None) + [self._content(f"commits/{b}")[0] for b in batches if b not in held]
        if not parts:
            return self.spark.createDataFrame([], _DELTAS), batches
        every = self.spark.read.schema(_DELTAS).parquet(*[f"{self.path}/{p}" for p in parts])
        return every.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]), batches

    def totals(self) -> DataFrame:
        """The maintained sums of all committed batches, for keys of which something is left."""
        return self._sums()[0].where(" or ".join(f"{c} <> 0" for c in SUMS))

    def compact(self) -> None:
        """Write the totals as a snapshot; reads begin there. Batches stay committed, their deltas aren't read again."""
        number = max(map(int, self._names("snapshots")), default=0) + 1
        sums, batches = self._sums()
        folder = f"totals/{number}-{uuid.uuid4().hex}"
        sums.write.parquet(f"{self.path}/{folder}")
        if not self._create(f"snapshots/{number}", " ".join([folder, *map(str, batches)])):
            self._fs.delete(self._path(folder), True)  # another writer's snapshot stands


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents arrive; those labelled toxic are deleted, those of low quality counted anew; two batches come twice."""
    docs = util.table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    labels = util.table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    # every text is read and counted once, at both versions; the batches are made of the counts
    both = docs.select(
        "doc_id", "source", "lang", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
        *[token_count(F.col("text"), version).alias(version) for version in VERSIONS],
    )
    counted = util.stored(both.join(labels, "doc_id", "left"), "rollup-counts")

    def of(which: str, version: str, sign: int) -> DataFrame:
        return counted.where(which).select(
            "source", "lang", F.lit(version).alias("version"), F.lit(sign).cast("long").alias("n_docs"),
            (F.col(version) * sign).alias("n_tokens"), (F.col("n_chars") * sign).alias("n_chars"),
        )

    toxic, revised = "toxic = 1", "toxic = 0 and quality = 0"
    rollup = Rollup(spark, f"{checkpoint_dir(spark).rstrip('/')}/rollup-{uuid.uuid4().hex}")
    rollup.commit(1, of("true", "blank-1", 1))
    rollup.commit(2, of(toxic, "blank-1", -1))
    rollup.commit(3, of(revised, "blank-1", -1).union(of(revised, "word-2", 1)))
    rollup.commit(2, of(toxic, "blank-1", -1))
    rollup.commit(1, of("true", "blank-1", 1))
    return rollup.totals()


OP6_SQL = r"""
WITH marks AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id),
kept AS (
  SELECT d.source, d.lang, coalesce(d.text, '') AS text,
         CASE WHEN m.toxic = 0 AND m.quality = 0 THEN 'word-2' ELSE 'blank-1' END AS version
  FROM documents d LEFT JOIN marks m ON d.doc_id = m.doc_id
  WHERE coalesce(m.toxic, 0) <> 1
)
SELECT source, lang, version, count(*)::BIGINT AS n_docs,
       sum(CASE WHEN version = 'word-2' THEN len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]'))
                ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END)::BIGINT AS n_tokens,
       sum(length(text))::BIGINT AS n_chars
FROM kept GROUP BY source, lang, version
"""
