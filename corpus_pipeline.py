"""The corpus pipeline: language ID, near-dedup, decontamination, secret masking, BPE ids.

Each stage takes the documents that its predecessor kept and returns the same
columns, but for the last, which returns ids and decoded texts. ``run`` writes
every stage as Parquet under the shared checkpoint folder and reads it again,
so that a lost executor never recomputes more than one stage.

Defined results: null and empty texts leave at the language stage (no language);
a stage that is given them anyway keeps them as its operator defines. Of rows
that tie in a class of near-duplicates the one with the smallest id stays (then
the smallest text hash); rows that repeat in all columns count as one there. A
null id is an id like any other. An empty table passes every stage and gives an
empty table. Extra columns, whatever their names, are passed through up to the
last stage, which returns its own columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import codec, decontaminate, language, secrets, simhash, util

#: A document is rejected if its language is unknown or its calibrated probability is below this.
MIN_LANGUAGE_SCORE = 0.4


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; learned from the labelled rows of ``docs`` that are not held out."""
    model = language.train(docs.where(~language.held_out()))
    lang, score = util.fresh(docs, "lang_pred"), util.fresh(docs, "lang_score")
    judged = language.predict(docs, model, "text", lang, score)
    return judged.where((F.col(lang) != language.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one of the smallest doc_id."""
    return simhash.keep_one(docs, words=simhash.WORDS, max_bits=simhash.MAX_BITS).select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, util.table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return secrets.redact(docs, secrets.word_ranks(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, ids (binary, little-endian unsigned 32-bit) and n_tokens; each text decodes to itself."""
    lexicon = codec.build_lexicon(docs, public_tokenizers.path("byte_bpe_50k.json"))
    encoded = codec.encode(docs.select("doc_id", "source", "lang", "text"), lexicon)
    checked = codec.decode(encoded, lexicon)
    same = F.coalesce(F.col("text"), F.lit("")) == F.col("decoded")
    return checked.select(
        "doc_id", "source", "lang", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), same.alias("round_trip")
    )


STAGES = [
    ("language_id", keep_known_languages),
    ("simhash_dedup", keep_one_of_each),
    ("decontamination", drop_benchmark),
    ("secret_scan", mask_secrets),
    ("bpe_encode", encode),
]

#: The stages train models and run tokenizers, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    docs = util.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = util.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
