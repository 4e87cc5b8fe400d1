"""The methods of operators 2, 7 and 9 against brute force."""

import math
import random
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridtide.llm import codec, secrets, simhash, transducer, urls
from gridtide.llm.bpe import Merges

RANKS = {w: i for i, w in enumerate(["password", "business", "dragon", "the", "one", "hello", "qwerty", "monkey", "éclair", "ass", "sword"], 1)}


def brute_bits(value, ranks):
    """The cheapest of all segmentations, segment by segment."""
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    best = [0.0]
    for end in range(1, len(value) + 1):
        costs = [best[end - 1] + secrets._alphabet_bits(value[end - 1]) + (value[end - 1] != low[end - 1])]
        for a in range(end):
            part, n = low[a:end], end - a
            if n >= 3 and len(set(part)) == 1:
                costs.append(best[a] + 1 + secrets._alphabet_bits(value[a]) + math.log2(n))
            if n >= 3 and all(p in secrets._walks for p in zip(part, part[1:])):
                costs.append(best[a] + 1 + math.log2(37 * 2 * n))
            if secrets._date.fullmatch(value[a:end]):
                costs.append(best[a] + 1 + (secrets._YEAR_BITS if n == 4 else secrets._DATE_BITS))
            if 3 <= n <= secrets.LONGEST_WORD and part in ranks:
                word = value[a:end]
                cased = 0 if word == part else 1 if word[1:] == part[1:] else min(n, 6)
                costs.append(best[a] + 1 + math.log2(ranks[part] + 1) + cased)
        best.append(min(costs))
    return best[-1]


PARTS = st.one_of(
    st.sampled_from([*RANKS, "Password", "DRAGON", "Hello"]),
    st.builds(lambda c, n: c * n, st.sampled_from("sSn0!É1"), st.integers(1, 12)),
    st.builds(lambda r, a, n, back: (r[a : a + n][::-1] if back else r[a : a + n]), st.sampled_from(secrets.ROWS), st.integers(0, 5), st.integers(2, 8), st.booleans()),
    st.sampled_from(["2012-03-04", "20120304", "1999", "31.12.1999", "0102", "010299", "sSsS", "asdsa", "İ", "ß"]),
    st.text("abcXYZ019-_.!é", max_size=5),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=5).map("".join))
def test_segmentations_are_of_minimum_cost(value):
    assert secrets.guess_bits(value, RANKS) == pytest.approx(brute_bits(value, RANKS), abs=1e-9)


def test_starts_inside_runs():
    for value in ("Businessssss_dragonnnnnn", "passwordfghjk_businesssss", "passsssword", "aaaAAAaaa", "qwertytrewq"):
        assert secrets.guess_bits(value, RANKS) == pytest.approx(brute_bits(value, RANKS), abs=1e-9)
    assert secrets.guess_bits("Businessssss_dragonnnnnn", RANKS) < secrets.GUESS_BITS


def test_long_runs_stay_cheap():
    import time

    began = time.process_time()
    secrets.guess_bits("s" * 30_000 + "asdfghjkl" * 3000 + "password", RANKS)
    assert time.process_time() - began < 10


@pytest.fixture(scope="module")
def encoder():
    path = codec._default_path()
    merges = Merges(open(path, encoding="utf-8").read())
    some = [b" the", b"'s", b" a"]
    return codec.Encoder(merges, transducer.Transducer(data=transducer.build(list(zip(some, merges.encode(some))))))


def test_every_code_point_in_context(encoder):
    """All code points before and behind an ending, a letter, a digit and a blank give the library's ids."""
    library = Tokenizer.from_file(codec._default_path())
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for around in ("{}'s", "a{}1", "1{} x", " {}{}", "'{}s"):
        # some hundred at a time, with plain text between them
        texts = ["|a ".join(around.replace("{}", c) for c in points[i : i + 400]) for i in range(0, len(points), 400)]
        want = library.encode_batch_fast(texts, add_special_tokens=False)
        for ids, e in zip(encoder(texts), want):
            assert list(memoryview(ids).cast("I")) == e.ids


def test_fuzzed_texts_with_special_tokens(encoder):
    library = Tokenizer.from_file(codec._default_path())
    r = random.Random(6)
    signs = [*" " * 5, "'", "s", "re", "a", "Z", "1", "\n", ".", "é", "꟎", "<|endoftext|>", "<|endo", "\x1c", "\x85", "　", "🙂"]
    texts = ["".join(r.choices(signs, k=r.randint(0, 40))) for _ in range(3000)] + [None, "", "<|endoftext|>" * 3]
    for t, ids in zip(texts, encoder(texts)):
        assert list(memoryview(ids).cast("I")) == library.encode(t or "", add_special_tokens=False).ids, t


# ---- operator 7 ---------------------------------------------------------------------------------
def brute_rules(rows, support, confidence):
    """All rules (tokens -> verdict) counted one by one, without those that a shorter one implies; by token set."""
    n, found = len(rows), {}
    items = sorted({i for have, _ in rows for i in have})
    for size in range(1, 4):
        for some in combinations(items, size):
            have = [v for h, v in rows if set(some) <= set(h)]
            for verdict in set(have):
                k = have.count(verdict)
                if k >= math.ceil(support * n) and k / len(have) >= confidence:
                    found[some, verdict] = (k / len(have), k / n)
    return {
        key: v for key, v in found.items()
        if not any((tuple(x for x in key[0] if x != one), key[1]) in found and found[tuple(x for x in key[0] if x != one), key[1]][0] >= v[0] for one in key[0])
    }


def test_mined_rules_have_the_counted_confidence_and_support(spark):
    r = random.Random(12)
    rows = []
    for _ in range(120):
        have = sorted(x for x in "abcdef" if r.random() < 0.4)
        have += [f"{x}{x}" for x in have if x in "ab"]  # always together with another token
        rows.append((sorted(have), "block" if ("a" in have and "c" in have) or r.random() < 0.1 else "allow"))
    df = spark.createDataFrame(rows, "items array<string>, verdict string")
    kept, known = urls.mine(df, 0.05, 0.8)
    stands = {}
    for row in known.collect():
        stands.setdefault(row["class"], []).append(row["item"])
    assert sorted(stands["a"]) == ["a", "aa"] and sorted(stands["b"]) == ["b", "bb"]
    one = {x: min(group) for group in stands.values() for x in group}
    got = {(tuple(sorted(x.items)), x.verdict): (x.confidence, x.support) for x in kept.select(F.col("items").alias("items"), "verdict", "confidence", "support").collect() if False}
    got = {(tuple(sorted(x["items"])), x["verdict"]): (round(x["confidence"], 9), round(x["support"], 9)) for x in kept.collect() if len(x["items"]) <= 3}
    merged = [(sorted({one[i] for i in have}), v) for have, v in rows]
    want = {k: (round(c, 9), round(s, 9)) for k, (c, s) in brute_rules(merged, 0.05, 0.8).items()}
    assert got == want and len(want) >= 3


def test_tokens_that_always_occur_together_are_mined_in_seconds(spark):
    """Twenty path segments that always stand together, and urls that have one of them."""
    long = "/".join(f"seg{chr(97 + i)}" for i in range(20))
    pages = [(i, f"http://www.x{i % 3}.net/es/{long}/p{i}") for i in range(200)] + [(900 + i, f"http://a.com/ok/{i}") for i in range(200)]
    asked = [(2000, "http://z.org/segc/1"), (2001, "http://z.org/other"), (2002, None), (2003, "no scheme"), (2004, "http://b.org/ok/7")]
    df = spark.createDataFrame(pages + asked, "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge(df).collect()}
    assert got[2000] == "block" and got[2001] == got[2002] == got[2003] == got[2004] == "allow"
    assert len(got) == len(pages) + len(asked)


def test_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.net/es/x", "h", "f", 3), (1, "http://a.net/es/x", "h", "f", 3)], "page_id long, url string, Host string, __fit string, row long")
    got = urls.judge(df)
    assert got.columns == ["page_id", "url", "__fit", "row", "host", "path", "rule", "verdict"]
    assert [tuple(r) for r in got.collect()] == [(1, "http://a.net/es/x", "f", 3, "a.net", "/es/x", "net/es/", "block")] * 2
    assert urls.judge(df.limit(0)).collect() == []
    docs = spark.createDataFrame([(1, "one two three four five", "i", "k", 9)] * 2 + [(2, "other words are here now", "i", "k", 9)], "doc_id long, text string, __id string, __key string, __n long")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert secrets.redact(docs.limit(0), {}).collect() == [] and secrets.find(docs, {}).columns[-1] == "spans"


# ---- operator 10 --------------------------------------------------------------------------------
def test_words_cut_in_bulk_have_the_librarys_ids():
    from gridtide.llm import wavelet

    path = wavelet._default_path()
    encoder, library = wavelet.WordEncoder(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    r = random.Random(3)
    signs = [*" " * 6, "'", "s", "re", "S", "a", "Z", "ll", "1", "23", "\n", "\t", ".", ",", "!?", "é", "É", "é", "Σ", "İ", "ı", "ß", "中", "й",
             "й", "…", "–", "<|endoftext|>", "<|endo", "_", "#", "\xa0", "\x85", "🙂", "ǅ", " 's", "'S", " 'T", "ª", "²", "\x1c"]
    texts = ["".join(r.choices(signs, k=r.randint(0, 30))) for _ in range(3000)] + [None, "", "a " * 50_000]
    points = [chr(c) for c in [*range(0x530), *range(0x2000, 0x2100)]]
    texts += [w.replace("{}", c) for c in points for w in ("a{}b", "{}'s", "1{}1", ". {}!", "A{} {}x")]
    for t, ids in zip(texts, encoder(texts)):
        assert list(memoryview(ids).cast("I")) == library.encode(t or "", add_special_tokens=False).ids, t
    assert sum(encoder._lowered(t or "") is not None for t in texts) > len(texts) / 3


class _Counting:
    """A library that notes the words it is given."""

    def __init__(self, library, seen):
        self.library, self.seen = library, seen

    def encode_batch_fast(self, texts, **options):
        self.seen.extend(w for t in texts for w in t.split())
        return self.library.encode_batch_fast(texts, **options)


def test_a_full_word_cache_keeps_the_words_in_use(monkeypatch):
    from gridtide.llm import wavelet

    monkeypatch.setattr(wavelet, "CACHE", 300)
    path = wavelet._default_path()
    encoder, library = wavelet.WordEncoder(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    seen = []
    for name in ("library", "plain"):
        if hasattr(encoder, name):
            setattr(encoder, name, _Counting(getattr(encoder, name), seen))
    # ten rounds: the same 100 words and, each time, 100 others
    letters = str.maketrans("0123456789", "abcdefghij")
    word = lambda n: f"w{n}q".translate(letters)
    for k in range(10):
        texts = [" ".join(word(n) for n in [*range(100), *range(1000 + 100 * k, 1100 + 100 * k)]), None, "", "\n", "A 1!"]
        for t, ids in zip(texts, encoder(texts), strict=True):
            assert list(memoryview(ids).cast("I")) == library.encode(t or "", add_special_tokens=False).ids
        assert len(encoder.known) <= 300
    assert max(sum(w == word(n) for w in seen) for n in range(100)) == 1
    # a single call with more words than the cache may hold
    text = " ".join(map(word, range(5000, 6000)))
    assert [list(memoryview(x).cast("I")) for x in encoder([text, text])] == [library.encode(text, add_special_tokens=False).ids] * 2
    assert len(encoder.known) == 1


def test_word_lookups_are_shared_by_a_group_of_texts(monkeypatch):
    import pyarrow as pa

    from gridtide.llm import util, wavelet

    rows = [(1, "ab"), (None, None), (3, ""), (4, "x" * 50), (5, "c d"), (6, "e")]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in rows[i : i + 2]], "text": pa.array([t for _, t in rows[i : i + 2]], pa.string())}) for i in (0, 2, 4)]
    flat = lambda group: [(r["doc_id"], r["text"]) for piece in group for r in piece.to_pylist()]
    assert [flat(g) for g in wavelet._groups(iter(batches))] == [rows]
    assert list(wavelet._groups(iter([]))) == []
    # a text longer than a group stands alone; rows keep their order
    monkeypatch.setattr(wavelet, "GROUP_BYTES", 20)
    monkeypatch.setattr(wavelet, "ROW_BYTES", 1)
    monkeypatch.setattr(util.slices, "__defaults__", (5,))
    groups = [flat(g) for g in wavelet._groups(iter(batches))]
    assert [r for g in groups for r in g] == rows
    assert len(groups) > 1 and all(sum(len(t or "") + 1 for _, t in g) <= 20 or len(g) == 1 for g in groups)
    # documents without text count too
    monkeypatch.setattr(wavelet, "ROW_BYTES", 10)
    empty = [pa.RecordBatch.from_pydict({"doc_id": [i], "text": pa.array([None], pa.string())}) for i in range(9)]
    assert [len(g) for g in wavelet._groups(iter(empty))] == [2, 2, 2, 2, 1]


def test_long_texts_in_parts_have_the_librarys_ids(monkeypatch):
    from gridtide.llm import pieces, util, wavelet

    monkeypatch.setattr(pieces.parts, "__defaults__", (20,))
    monkeypatch.setattr(util, "SLICE_BYTES", 400)
    path = wavelet._default_path()
    encoder, library = wavelet.WordEncoder(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    r = random.Random(5)
    words = ["the", "it's", "été", "<|endoftext|>", "中文", "1234", "!?", "\n", "", "Z", "straße", "and'", "of"]
    texts = [" ".join(r.choices(words, k=r.randint(0, 40))) for _ in range(300)] + ["", None, "the " * 100, "a b"]
    for _ in range(2):  # the second time every word is known
        for t, ids in zip(texts, encoder(iter(texts)), strict=True):
            assert list(memoryview(ids).cast("I")) == library.encode(t or "", add_special_tokens=False).ids, t
