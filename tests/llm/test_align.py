import hashlib
import itertools
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gridtide.llm import align
from gridtide.llm.bpe import byte_symbols

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    back = {c: b for b, c in byte_symbols().items()}
    a_bytes = {i: bytes(back.get(c, 0) for c in t) for t, i in a.get_vocab().items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    b_bytes = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in range(b.get_piece_size())
    ]
    return a, a_bytes, b, b_bytes


def brute(libraries, docs):
    a, a_bytes, b, b_bytes = libraries
    aligned = []
    for _, text in docs:
        groups = []
        if text:
            x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            raw = (" " + text).encode()
            if b"".join(a_bytes[i] for i in x) == raw == b"".join(b_bytes[i] for i in y):
                ends = list(itertools.accumulate(len(a_bytes[i]) for i in x)), list(itertools.accumulate(len(b_bytes[i]) for i in y))
                both = set(ends[0]) & set(ends[1])
                ga, gb = [[]], [[]]
                for side, tokens, places in ((ga, x, ends[0]), (gb, y, ends[1])):
                    for t, e in zip(tokens, places):
                        side[-1].append(t)
                        if e in both:
                            side.append([])
                groups = list(zip(ga[:-1], gb[:-1]))
        aligned.append(groups)
    count = Counter()
    for groups in aligned:
        count.update({(x, y) for ga, gb in groups for x in ga for y in gb})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = []
    for (doc_id, _), groups in zip(docs, aligned):
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        spelled = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        rows.append(
            (
                doc_id, sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups), len(links),
                sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                hashlib.sha256(spelled.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(rows, key=str)


def fuzz(n, seed=3):
    r = random.Random(seed)
    signs = " " * 6 + "'''" + "strevmlda1\n\t.,é一́　\xa0 ٣🙂\x00\x1f​" + "İſ"
    return ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(n)]


WORDS = "the international unbelievable tokenization of naïve Ünïcödé words 中文字 привет мир don't it's 1234567 zzxqj kkkkkkkk".split()


def texts(n, seed=8):
    r = random.Random(seed)
    return [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 40))) for _ in range(n)]


def test_equals_brute_force(spark, folder, libraries):
    odd = [None, "", " ", "   ", "a▁b", "▁", "<s> </s> <unk> <0x41>", "<|endoftext|>", "\n", "a  b ", " lead", "trail ", "q" * 3000, "▁ x"]
    every = [*odd, *fuzz(200), *texts(150)]
    docs = [(i, t, "en", "s", 1) for i, t in enumerate(every)] + [(None, "the words", "en", "s", 1), (9, "the words", "en", "s", 1)]
    at = folder("documents", docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = align.op11(spark, at)
    assert got.columns == ["doc_id", *NAMES]
    assert sorted(map(tuple, got.collect()), key=str) == brute(libraries, [d[:2] for d in docs])


def test_large_groups_and_many_blocks(spark, libraries, monkeypatch):
    """Groups counted by their distinct ids, pairs spelled out a few at a time, and blocks of a few documents give the same."""
    docs = [(i, t) for i, t in enumerate([*fuzz(60, 5), *texts(60, 6)])]
    v = align.Vocabularies(open(A, encoding="utf-8").read(), open(B, "rb").read())
    whole = align.Aligned(v, [t for _, t in docs]).links()
    monkeypatch.setattr(align, "_LARGE", 2)
    monkeypatch.setattr(align, "_PAIRS", 3)
    small = align.Aligned(v, [t for _, t in docs]).links()
    assert [x.tolist() for x in whole] == [x.tolist() for x in small]
    df = align.util.stored(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    got = align.align(df, A, B)
    assert sorted(map(tuple, got.collect()), key=str) == brute(libraries, docs)


def test_clashing_columns_and_empty_table(spark, libraries):
    df = spark.createDataFrame([(1, "the words", "x", 5, 6, "y")], "doc_id long, text string, block string, no long, N_A long, row string")
    got = align.align(df, A, B)
    assert got.columns == ["doc_id", "block", "no", "row", *NAMES]
    r = got.first()
    assert (r.block, r.no, r.row) == ("x", 5, "y") and r.n_a == brute(libraries, [(1, "the words")])[0][1]
    assert align.align(df.limit(0), A, B).collect() == []
