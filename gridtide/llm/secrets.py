"""Secret scans with password guess costs (operator 2).

Fixed patterns find assignments, access keys and long hexadecimal runs. Beside
them every value in a credential context ("passphrase: ...", "pwd is ...") is
priced by dynamic programming: the cheapest segmentation into corpus words,
dates, repeats, keyboard walks and brute-force spans, in bits. Values that cost
``GUESS_BITS`` or more are secrets (kind ``guess``); placeholders made of words,
years and walks are cheap and stay.

Word costs come from the corpus: the ranks of the ``WORDS`` most frequent
words, counted over every document.

Defined results: a null text is an empty text and has no span; whole texts are
scanned however long; spans of different kinds may overlap and are all kept;
with an empty corpus every word costs brute force; extra columns pass through,
and a column named like an output is replaced; repeated rows are scanned each.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.llm import codec, util

# The base patterns, their kinds in order, and least lengths.
KINDS = ("assign", "access", "hex", "guess")
BASE = KINDS[:3]
_assign = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_access = re.compile(r"AKIA[A-Z0-9]+")
_hex = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ that have 16 or more
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

# A credential context: a keyword with the rest of its name, a sign and a value. Blanks and tabs are free around the
# sign, and one line break; a next line that is an assignment of its own is no value. All repeats are possessive.
_name = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)|pwd|secret|token|api[_\x20-]?key|credential|private[_\x20-]?key)[A-Za-z0-9_-]*+"""
    r"""(?:(?:(?<=api)|(?<=private))\x20key[A-Za-z0-9_-]*+)*+""",
    re.IGNORECASE | re.ASCII,
)
_sign, _gap, _line = r"(?:=>|[:=]|\bis\b)", r"[\x20\t]*+", r"(?:\r\n?|\n)"
_own = rf"""(?![A-Za-z_][A-Za-z0-9_.-]*+{_gap}(?::|=(?!=?(?:\s|$))))"""
_value = re.compile(
    rf"""["']?{_gap}(?:{_sign}{_gap}(?:{_line}{_gap}(?=["']|{_own}))?|{_line}{_gap}{_sign}{_gap})["']?([^\x20\x09-\x0D"'<>]{{6,}})""",
    re.IGNORECASE | re.ASCII,
)
_hints = ("passw", "secret", "token", "api", "pwd", "passphrase", "passcode", "credential", "private")

#: Bits from which a value in a credential context counts as a secret.
GUESS_BITS = 40.0
WORDS = 20_000
LONGEST_WORD = 24
#: The longest date (day, month and year with separators), and the least length of a repeat or a walk.
LONGEST_DATE, LEAST_RUN = 10, 3
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_walks = {(r[i], r[i + d]) for r in ROWS for d in (1, -1) for i in range(len(r)) if 0 <= i + d < len(r)}
_date = re.compile(r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)?\d\d")
_DATE_BITS = math.log2(365 * 120)
_YEAR_BITS = math.log2(120)

SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)


def _alphabet_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log2(26)
    return math.log2(33) if c < "\x7f" else math.log2(1000)


class _Starts:
    """The starts of a growing run (of one repeated character, or of a keyboard walk) that may still be the cheapest.

    A segment costs what stands before its start plus the logarithm of its
    length. The length counts ever less, so a start that an earlier one beats
    is beaten at every later end too, and is dropped.
    """

    def __init__(self):
        self.held: list[tuple[int, float]] = []

    def cheapest(self, end: int) -> float:
        least, kept = math.inf, []
        for start, cost in self.held:
            if (c := cost + math.log2(end - start)) < least:
                least = c
                kept.append((start, cost))
        self.held = kept
        return least


def guess_bits(value: str, ranks: dict[str, int]) -> float:
    """Bits of the cheapest segmentation of ``value``; each segment adds one bit for its kind.

    One pass over the ends of segments. Words and dates look back a bounded
    number of characters; repeats and walks may begin anywhere in their run.
    """
    low = "".join(x if len(x := c.lower()) == 1 else c for c in value)
    n = len(value)
    best = [0.0] + [math.inf] * n
    repeats, walks = _Starts(), _Starts()
    for end in range(1, n + 1):
        i = end - 1
        case = 1.0 if value[i] != low[i] else 0.0
        least = best[i] + _alphabet_bits(value[i]) + case
        if i and low[i] != low[i - 1]:
            repeats = _Starts()
        if i and (low[i - 1], low[i]) not in _walks:
            walks = _Starts()
        if (start := end - LEAST_RUN) >= 0:
            if low[start : end - 1] == low[start + 1 : end]:
                repeats.held.append((start, best[start] + 1 + _alphabet_bits(value[start])))
                least = min(least, repeats.cheapest(end))
            if all(pair in _walks for pair in zip(low[start : end - 1], low[start + 1 : end], strict=True)):
                walks.held.append((start, best[start] + 1 + math.log2(37 * 2)))
                least = min(least, walks.cheapest(end))
        if value[i].isdigit():
            for start in range(max(0, end - LONGEST_DATE), end - 3):
                if value[start].isdigit() and _date.fullmatch(value, start, end):
                    least = min(least, best[start] + 1 + (_YEAR_BITS if end - start == 4 else _DATE_BITS))
        for start in range(max(0, end - LONGEST_WORD), end - 2):
            rank = ranks.get(low[start:end])
            if rank is not None:
                word = value[start:end]
                cased = 0.0 if word == low[start:end] else (1.0 if word[1:] == low[start + 1 : end] else min(len(word), 6))
                least = min(least, best[start] + 1 + math.log2(rank + 1) + cased)
        best[end] = least
    return best[n]


def context_values(text: str) -> Iterator[tuple[int, int]]:
    """The spans of the values in credential contexts; a name or value is read once, so the time is linear."""
    at = 0
    while name := _name.search(text, at):
        value = _value.match(text, name.end())
        if value:
            yield value.span(1)
        at = value.end() if value else name.end()


def scan(text: str | None, ranks: dict[str, int]) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text, by start, then kind in order; code points, end exclusive."""
    if not text:
        return []
    out = [("hex", *m.span()) for m in _hex.finditer(text)]
    low = text.lower()
    if any(h in low for h in _hints):
        out += [("assign", *m.span()) for m in _assign.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
        out += [("guess", a, b) for a, b in context_values(text) if guess_bits(text[a:b], ranks) >= GUESS_BITS]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _access.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def word_ranks(docs: DataFrame, text: str = "text", words: int = WORDS) -> dict[str, int]:
    """Word -> rank (from 1) of the most frequent words of 3 to LONGEST_WORD letters that occur twice, over all texts; at most ``words``."""
    low = codec.word_counts(docs, text).select(F.lower("word").alias("word"), "n")
    counts = low.where(F.length("word").between(3, LONGEST_WORD)).groupBy("word").agg(F.sum("n").alias("n"))
    # letters seen once may be a secret's own
    return {word: i for i, (word, _) in enumerate(codec.frequent(counts.where("n > 1"), words), 1)}


def find(docs: DataFrame, ranks: dict[str, int], text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: kind, start and end of every secret in the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def make():
        return lambda texts: [[scan(t, shared.value) for t in texts]]

    return util.per_text(docs, text, [(spans, SPANS)], make)


def masked(text: str | None, ranks: dict[str, int], mask: str) -> str | None:
    """The text with each maximal run of overlapping secrets replaced by ``mask``."""
    out, done, end = [], 0, -1
    for _, a, b in scan(text, ranks):
        if a > end or end < 0:
            out += [text[done:a], mask]
            end = b
        else:
            end = max(end, b)
        done = end
    return text if not out else "".join(out) + text[done:]


def redact(docs: DataFrame, ranks: dict[str, int], text: str = "text", n_chars: str = "n_chars", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every secret masked in its text; ``n_chars``, where there is one, follows the changed texts."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    new = util.fresh(docs, "masked")

    def make():
        return lambda texts: [[masked(t, shared.value, mask) for t in texts]]

    done = util.per_text(docs, text, [(new, T.StringType())], make)
    changed = ~F.col(new).eqNullSafe(F.col(text))
    columns = []
    for f in docs.schema.fields:
        c = F.col(f.name)
        if f.name == text:
            c = F.col(new)
        elif f.name == n_chars:
            c = F.when(changed, F.length(new)).otherwise(c).cast(f.dataType)
        columns.append(c.alias(f.name))
    return done.select(*columns)


def digest(spans: Column, kinds) -> Column:
    """kind:start:end of the spans of the given kinds, comma-joined in their order."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the secrets of every document."""
    docs = util.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, word_ranks(docs)).select("doc_id", "spans")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(kind).__eq__)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select(
        "doc_id", *counts,
        F.sha2(digest(F.col("spans"), BASE).cast("binary"), 256).alias("base_sha256"),
        digest(F.col("spans"), KINDS).alias("spans"),
    )
