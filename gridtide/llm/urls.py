"""URL filtering by mined association rules (operator 7), DataFrame functions only.

Given rules (a host with its subdomains, a path prefix, a verdict) decide the
urls they fit; the longest rule wins. The urls they decide are the labelled
examples for the rest: each url is a set of tokens (host labels, path segments,
query keys), Spark's FP-growth mines the frequent sets that hold a verdict, and
the association rules "tokens -> verdict" of at least ``MIN_CONFIDENCE`` and
``MIN_SUPPORT`` that no shorter rule already implies are kept. Tokens that occur
in the very same examples are one *class* while rules are mined (every subset of
them would be as frequent); a url has the class if it has one of its tokens,
just as if there were a rule for each of them. An inverted
index -- each rule under its rarest class -- finds the candidates for a url, the
other classes are verified, and the most confident rule decides.

Defined results: null urls and urls without ``://`` have an empty host and path,
fit no rule and are allowed; without labelled urls nothing is mined and the
default verdict stands; ties between mined rules go to higher support, then
longer rules, then block; repeated pages are judged alike; an empty table gives
an empty table; other columns of the pages, whatever their names, are passed
through (those named like a result, in any case, are replaced).
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import util

# The given rules as (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT = "allow"
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*+", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*+", 0)
    return F.translate(raw, _UPPER, _UPPER.lower()), path


def fitting(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        found = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a url: host labels, top and second level, path segments, query keys."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    segment = F.filter(F.split(path, "/"), lambda s: s != "")
    steps = F.transform(
        segment, lambda s: F.concat(F.lit("path="), F.regexp_replace(F.regexp_replace(s, "[0-9]+", "0"), r"^0(?=\.|$)", "number"))
    )
    labels = F.transform(F.split(host, r"\."), lambda s: F.concat(F.lit("host="), s))
    top = F.array(F.concat(F.lit("top="), F.substring_index(host, ".", -1)), F.concat(F.lit("site="), F.substring_index(host, ".", -2)))
    keys = F.transform(
        F.filter(F.split(query, "&"), lambda s: s != ""), lambda s: F.concat(F.lit("query="), F.substring_index(s, "=", 1))
    )
    return F.array_distinct(F.concat(labels, top, steps, keys))


def classes(examples: DataFrame, least: int) -> DataFrame:
    """(item, class): the tokens of at least ``least`` examples (id, items); those of the same examples share a class.

    The examples of a token are compared by their number, the exclusive or and the sum of their
    hashes. There are at most (tokens of an example) / (support) such tokens, whatever the number of examples.
    """
    each = examples.select("id", F.explode("items").alias("item"))
    same = each.groupBy("item").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("id")).alias("a"),
        F.sum(F.xxhash64(F.lit("sum"), "id").cast("decimal(38,0)")).alias("b"),
    )
    same = same.where(F.col("n") >= least)
    names = same.groupBy("n", "a", "b").agg(F.min("item").alias("class"))
    return util.stored(same.join(names, ["n", "a", "b"]).select("item", "class"), "url-classes")


def in_classes(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(key, items): the classes of each row's tokens; rows without a known token are left out."""
    each = rows.select(key, F.explode("items").alias("item")).join(F.broadcast(known), "item")
    return each.groupBy(key).agg(F.collect_set("class").alias("items"))


def mine(labelled: DataFrame, support: float = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Rules (items, verdict, confidence, support) that no shorter kept rule implies, and the classes (item, class)
    that their items stand for, from rows (items, verdict)."""
    spark = labelled.sparkSession
    mark = "verdict="
    examples = util.stored(labelled.withColumn("id", F.monotonically_increasing_id()), "url-examples")
    total = examples.count()
    if not total:
        empty = "items array<string>, verdict string, confidence double, support double"
        return spark.createDataFrame([], empty), spark.createDataFrame([], "item string, class string")
    known = classes(examples, max(1, math.ceil(support * total)))
    verdict = F.array(F.concat(F.lit(mark), "verdict"))
    # examples without a frequent token still count for the support
    baskets = examples.join(in_classes(examples, known, "id").withColumnRenamed("items", "have"), "id", "left")
    baskets = baskets.select(F.concat(F.coalesce("have", F.array().cast("array<string>")), verdict).alias("items"))
    rules = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets).associationRules
    said = F.element_at("consequent", 1)
    rules = rules.where(F.startswith(said, F.lit(mark)) & ~F.exists("antecedent", lambda i: F.startswith(i, F.lit(mark))))
    rules = util.stored(
        rules.select(
            F.array_sort("antecedent").alias("items"),
            F.substring(said, len(mark) + 1, 100).alias("verdict"), "confidence", "support",
        ),
        "url-rules",
    )
    # a rule is redundant if leaving one of its classes out gives a rule for the same verdict that is as confident
    shorter = rules.select(F.col("items").alias("part"), "verdict", F.col("confidence").alias("other"))
    parts = rules.select(
        "items", "verdict", "confidence", F.explode("items").alias("one")
    ).select("items", "verdict", "confidence", F.array_remove("items", F.col("one")).alias("part"))
    implied = parts.join(shorter, ["part", "verdict"]).where("other >= confidence").select("items", "verdict").distinct()
    return util.stored(rules.join(implied, ["items", "verdict"], "left_anti"), "url-rules-kept"), known


def judge(pages: DataFrame, url: str = "url", rules=RULES, default: str = DEFAULT) -> DataFrame:
    """``pages`` with host, path, rule and verdict (columns of these names are replaced)."""
    names = ("host", "path", "rule", "verdict")
    passed = [c for c in pages.columns if c.lower() not in names]
    row = F.struct(*[F.col(c) for c in passed]) if passed else F.struct(F.lit(0).alias("none"))
    host, path = host_path(pages[url])
    base = pages.select(row.alias("row"), pages[url].alias("url"), host.alias("host"), path.alias("path"))
    base = base.withColumn("fit", fitting(F.col("host"), F.col("path"), rules))
    items = tokens(F.col("url"), F.col("host"), F.col("path")).alias("items")
    kept, known = mine(base.where("fit is not null").select(items, F.col("fit.verdict").alias("verdict")))
    # the rest: each distinct url once
    rest = base.where("fit is null and url is not null").select("url", "host", "path").distinct()
    rest = in_classes(rest.select("url", items), known, "url").withColumnRenamed("items", "have")
    held = kept.select(F.explode("items").alias("item"), "items", "verdict", "confidence", "support")
    often = held.groupBy("item").agg(F.count("*").alias("n"))
    index = (
        held.join(often, "item")
        .groupBy("items", "verdict", "confidence", "support")
        .agg(F.min_by("item", F.struct("n", "item")).alias("item"))
    )
    index = util.stored(index, "url-index")
    found = rest.select("url", "have", F.explode("have").alias("item")).join(index, "item")
    found = found.where(F.size(F.array_except("items", "have")) == 0)
    strength = F.struct("confidence", "support", F.size("items"), "verdict")
    mined = util.stored(found.groupBy("url").agg(F.max_by("verdict", strength).alias("mined")), "url-verdicts")
    out = base.join(mined, "url", "left")
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in passed],
        "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "mined", F.lit(default)).alias("verdict"),
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    pages = util.table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")
