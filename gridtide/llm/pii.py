"""Personal data by weak supervision (operator 5), DataFrame functions only.

Fixed patterns find e-mail addresses, IP addresses, payment cards and phone
numbers. Beside them, broad candidates (numbers in groups, titled names) are
voted on by labelers -- shapes (regular expressions), word lists (gazetteers)
and context -- that may abstain. Expectation-maximisation over the counts of
vote patterns (at most 3 to the number of labelers, however large the corpus)
estimates each labeler's reliability and every pattern's probability; with
these as soft labels a logistic regression over span features is trained, the
final classifier that adds spans of kind ``span``.

Positions come from the text between matches: the pieces of a split and the
matches alternate, so running sums of their lengths are the spans. Patterns
repeat possessively, so a run of any length is read once and never by recursion.

Defined results: a null text is an empty text without spans; spans of different
kinds may overlap, added spans overlap no base span; without candidates nothing
is trained or added, and an empty table gives no row; repeated rows are handled
each; ties of probability don't matter, as a span is added by a threshold alone;
columns of the input that
clash with working names are not touched, since only the id and the text are used.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import util

# Kinds in order and their patterns. Each is written so that it matches what the plain
# greedy pattern matches: repeats of a class that excludes what follows are possessive, and a match
# may begin only where its first run begins or right after the last match (\G).
KINDS = ("email", "ip", "card", "phone", "span")
BASE = KINDS[:4]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain to be searched for a kind (a quick test).
HINTS = {"email": "@", "ip": ".", "phone": "+"}
_IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

LEAST_DIGITS, MOST_DIGITS = 7, 19

# Candidates of digits. One separator joins two digits: a point, a dash (with a blank on both sides or none), a blank, or
# the bracket of a short group. A phone or identity number that stands by itself between blanks is a candidate, whatever
# numbers stand beside it; else a run of LEAST_DIGITS to MOST_DIGITS digits is one, and of a longer run its blank-free
# parts, or the shapes that a longer blank-free run begins with. A match ends at its last digit.
_OPEN, _CLOSE = r"(?:\((?=[0-9]{1,6}\)))", r"(?:(?<=\([0-9]{1,6})\))"
_JOIN = rf"{_CLOSE}?(?:\x20-\x20|[\x20.-])?{_OPEN}?"
_TIGHT = rf"{_CLOSE}?[.-]?{_OPEN}?"
_SHAPE = r"(?:(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4})"
_STOP = r"(?![A-Za-z0-9@]|[.-][0-9]|-[A-Za-z])"
_START = r"(?<![A-Za-z0-9+.-])"
_MORE = LEAST_DIGITS - 1, MOST_DIGITS - 1
_APART = rf"(?!{_CLOSE}?\x20{_SHAPE}{_STOP})"  # the next number is a shape by itself
_FIRST = r"(?:(?<![0-9]\x20)|(?<=\G\x20)(?<=[0-9]{3}[\x20.-][0-9]{4}\x20|-[0-9]{2}-[0-9]{4}\x20))"  # of its run, or after a shape
CANDIDATE = (
    rf"{_START}{_SHAPE}{_STOP}"
    rf"|{_START}{_FIRST}{_OPEN}?[0-9](?:{_APART}{_JOIN}[0-9]){{{_MORE[0]},{_MORE[1]}}}+{_STOP}(?!{_APART}{_JOIN}[0-9])"
    rf"|{_START}{_OPEN}?[0-9](?:{_TIGHT}[0-9]){{{_MORE[0]},{_MORE[1]}}}+{_STOP}"
    rf"|{_START}(?={_OPEN}?[0-9](?:{_TIGHT}[0-9]){{{MOST_DIGITS}}}){_SHAPE}(?=[.-][0-9])"
    rf"|(?<=\G[.-])(?<=[0-9]{{4}}[.-]){_SHAPE}(?:(?=[.-][0-9])|{_STOP})"
    r"|\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sr|Sra)\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?"
)
CUES = ("phone", "tel", "call", "mobile", "fax", "ssn", "passport", "account", "iban", "dob", "born", "id", "name")
NOT_CUES = ("version", "page", "section", "chapter", "license", "licence", "isbn", "commit", "line", "item", "total")
EM_ROUNDS = 30
KEEP = 0.5


_SPAN = "array<struct<kind:string,start:bigint,end:bigint,hit:string,before:string>>"
_RUN = 64


def _zipped(text: Column, matches: Column, pattern: str) -> Column:
    """Array of (piece, hit): each match with the text between it and the match before."""
    pieces = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    zipped = F.arrays_zip(pieces.alias("piece"), matches.alias("hit"))
    return F.when(F.size(matches) > 0, zipped).otherwise(F.lit([]).cast("array<struct<piece:string,hit:string>>"))


def _pairs(zipped: Column, kind: str) -> Column:
    """Array of (kind, start, end, hit, before): running sums of the lengths of pieces and hits.

    The matches go in runs, whose places are summed first, since appending to
    one array for each of many matches would cost their square. ``zipped`` is a
    stored column (it is read several times).
    """

    def size(x):
        return (F.length(x["piece"]) + F.length(x["hit"])).cast("bigint")

    def add(acc, x):
        start, end = acc["at"] + F.length(x["piece"]), acc["at"] + size(x)
        span = F.struct(
            F.lit(kind).alias("kind"), start.cast("bigint").alias("start"), end.cast("bigint").alias("end"),
            x["hit"].alias("hit"), F.lower(F.right(x["piece"], F.lit(24))).alias("before"),
        )
        return F.struct(end.cast("bigint").alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    zero = F.lit(0).cast("bigint")
    runs = F.transform(F.sequence(F.lit(0), F.size(zipped) - 1, F.lit(_RUN)), lambda i: F.slice(zipped, i + 1, _RUN))
    totals = F.transform(runs, lambda run: F.aggregate(run, zero, lambda a, x: a + size(x)))
    bases = F.aggregate(
        totals,
        F.struct(zero.alias("at"), F.lit([]).cast("array<bigint>").alias("out")),
        lambda a, t: F.struct((a["at"] + t).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
        lambda a: a["out"],
    )
    placed = F.zip_with(
        runs,
        bases,
        lambda run, base: F.aggregate(
            run, F.struct(base.alias("at"), F.lit([]).cast(_SPAN).alias("out")), add, lambda a: a["out"]
        ),
    )
    return F.when(F.size(zipped) > 0, F.flatten(placed)).otherwise(F.lit([]).cast(_SPAN))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    def one(c, i):
        d = c.cast("int") * (F.lit(1) + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    figures = F.transform(F.split(F.reverse(_digits(hit)), ""), one)
    return F.aggregate(figures, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    """The test a match must pass, beyond its pattern."""
    if kind == "ip":
        return hit.rlike(f"^{_IP_PART}(?:\\.{_IP_PART}){{3}}$")
    if kind == "card":
        n = F.length(_digits(hit))
        return F.when(n.between(14, 19), _luhn(hit)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(True)


def located(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, candidates): the valid fixed-pattern spans and the candidates of every whole text."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    none = F.lit([]).cast("array<string>")
    digit = body.rlike("[0-9]")
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body"), digit.alias("digit"))
    found = []
    for kind in BASE:
        has = F.contains("body", F.lit(HINTS[kind])) if kind in HINTS else F.lit(True)
        if kind != "email":
            has = has & F.col("digit")
        found.append(F.when(has, F.regexp_extract_all("body", F.lit(PATTERNS[kind]), F.lit(0))).otherwise(none).alias(kind))
    found.append(F.regexp_extract_all("body", F.lit(CANDIDATE), F.lit(0)).alias("wide"))
    rows = rows.select("doc_id", "body", *found)
    zipped = [_zipped(F.col("body"), F.col(k), PATTERNS[k]).alias(k) for k in BASE]
    rows = rows.select("doc_id", *zipped, _zipped(F.col("body"), F.col("wide"), CANDIDATE).alias("wide"))
    spans = [F.filter(_pairs(F.col(k), k), _checked(k)).alias(k) for k in BASE]
    rows = rows.select("doc_id", *spans, _pairs(F.col("wide"), "span").alias("wide"))
    return rows.select("doc_id", F.concat(*BASE).alias("base"), "wide").select(
        "doc_id", "base", F.filter("wide", lambda s: _eligible(s, F.col("base"))).alias("candidates")
    )


def _checked(kind: str):
    return lambda s: _valid(kind, s["hit"])


def _eligible(s: Column, base: Column) -> Column:
    n = F.length(_digits(s["hit"]))
    clear = ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return ((n == 0) | n.between(LEAST_DIGITS, MOST_DIGITS)) & clear


def features(s: Column) -> dict[str, Column]:
    """Small integers that describe a span; their combinations are few."""
    hit, before = s["hit"], s["before"]
    n = F.length(_digits(hit))
    flag = lambda c: F.when(c, 1).otherwise(0)
    return {
        "digits": n,
        "groups": F.least(F.size(F.split(F.regexp_replace(hit, "^[^0-9]+|[^0-9]+$", ""), "[^0-9]+")), F.lit(6)),
        "paren": flag(hit.contains("(")),
        "dash": flag(hit.contains("-")),
        "dots": flag(hit.contains(".")),
        "phone_shape": flag(hit.rlike(r"^\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}$")),
        "id_shape": flag(hit.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$")),
        "luhn": flag(F.when(n.between(14, 19), _luhn(hit)).otherwise(False)),
        "titled": flag(n == 0),
        "cue": flag(before.rlike(r"\b(?:" + "|".join(CUES) + r")\b[^a-z0-9]{0,4}$")),
        "not_cue": flag(before.rlike(r"\b(?:" + "|".join(NOT_CUES) + r")\b[^a-z0-9]{0,4}$")),
    }


def votes(f: dict[str, Column]) -> dict[str, Column]:
    """The labelers: 1 personal, 0 not, -1 no opinion, from a span's features."""

    def vote(yes, no=None):
        c = F.when(yes, 1)
        return (c if no is None else c.when(no, 0)).otherwise(-1)

    plain = (f["titled"] == 0) & (f["groups"] == 1)
    return {
        "shape_phone": vote((f["phone_shape"] == 1) & (f["groups"] == 3), plain),
        "shape_id": vote(f["id_shape"] == 1, plain & (f["luhn"] == 0)),
        "checksum": vote(f["luhn"] == 1, f["digits"].between(14, 19) & (f["luhn"] == 0)),
        "titles": vote(f["titled"] == 1),
        "cue_words": vote(f["cue"] == 1, f["not_cue"] == 1),
        "number": vote(F.lit(False), (f["dots"] == 1) & (f["dash"] == 0) & (f["phone_shape"] == 0)),
    }


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = EM_ROUNDS):
    """EM over (votes, count): the prior, per labeler P(vote 1 | class 0 and 1), and each pattern's P(class 1)."""
    k = len(patterns[0][0])
    prior, yes = 0.5, [[0.2, 0.8] for _ in range(k)]
    post: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for p, _n in patterns:
            odds = math.log(prior) - math.log(1 - prior)
            for (no_rate, yes_rate), v in zip(yes, p, strict=True):
                if v >= 0:
                    odds += math.log(yes_rate if v else 1 - yes_rate) - math.log(no_rate if v else 1 - no_rate)
            post[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        total = sum(n for _, n in patterns)
        prior = min(0.99, max(0.01, sum(post[p] * n for p, n in patterns) / total))
        for j in range(k):
            # two imaginary votes a class keep a labeler better than chance and its rates inside (0, 1)
            for c in (0, 1):
                weight = [(n * (post[p] if c else 1 - post[p]), p[j]) for p, n in patterns if p[j] >= 0]
                got = sum(w for w, v in weight if v == 1) + (1.6 if c else 0.4)
                yes[j][c] = min(0.99, max(0.01, got / (sum(w for w, _ in weight) + 2)))
    return prior, yes, post


class Classifier:
    """The trained span classifier as a column expression."""

    def __init__(self, names: list[str], weights: list[float], bias: float, post, yes):
        self.names, self.weights, self.bias, self.post, self.reliability = names, weights, bias, post, yes

    def probability(self, s: Column) -> Column:
        f = features(s)
        score = F.lit(self.bias)
        for name, w in zip(self.names, self.weights, strict=True):
            score = score + f[name] * F.lit(w)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def train(found: DataFrame) -> Classifier | None:
    """From the candidates of ``located``: labelers vote, EM weighs them, the classifier learns. None without candidates."""
    spans = found.select(F.explode("candidates").alias("s"))
    described = spans.select(*[c.alias(n) for n, c in features(F.col("s")).items()])
    names = described.columns
    # all that is learned from: how often each combination of features occurs
    described = util.cut(described.groupBy(*names).agg(F.count("*").alias("n")))
    cast = votes({n: F.col(n) for n in names})
    voters = list(cast)
    voted = described.select("*", *[c.alias(v) for v, c in cast.items()])
    patterns = [
        (tuple(r[v] for v in voters), r["n"]) for r in voted.groupBy(*voters).agg(F.sum("n").alias("n")).collect()
    ]
    if not patterns:
        return None
    _, yes, post = reliabilities(patterns)
    key = F.concat_ws(",", *[F.col(v).cast("string") for v in voters])
    table = F.create_map(*[x for p, q in post.items() for x in (F.lit(",".join(map(str, p))), F.lit(q))])
    soft = voted.withColumn("p", table[key])
    rows = soft.select(*names, F.lit(1.0).alias("label"), (F.col("p") * F.col("n")).alias("weight")).union(
        soft.select(*names, F.lit(0.0), (1 - F.col("p")) * F.col("n"))
    )
    ready = VectorAssembler(inputCols=names, outputCol="x").transform(rows)
    fit = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", regParam=0.001, maxIter=40).fit(ready)
    return Classifier(names, [float(w) for w in fit.coefficients], float(fit.intercept), post, yes)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) of every row: spans (start, rank of the kind, kind, end, hit) in order."""
    found = util.stored(located(docs, doc_id, text), "pii")
    model = train(found)
    added = F.filter("candidates", lambda s: model.probability(s) >= KEEP) if model else F.slice("candidates", 1, 0)
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])

    def ordered(s):
        return F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"), s["hit"].alias("hit"))

    return found.select("doc_id", F.array_sort(F.transform(F.concat("base", added), ordered)).alias("spans"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the personal data in every document."""
    found = find(util.table(spark, sf_dir, "documents"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(k).__eq__)).cast("long").alias(f"n_{k}") for k in BASE]

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    base = F.filter("spans", lambda s: s["kind"] != "span")
    return found.select(
        "doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )
