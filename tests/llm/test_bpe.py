import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridtide.llm import codec, transducer, wavelet
from gridtide.llm.bpe import Merges
from tests.llm.conftest import DOCS

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    (1, "Hello world, it's 2024!", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0),
    (4, "x" * 3000 + " " + "ab" * 2000, "en", "a", 1), (5, "  two  blanks \n\n and\tmore ", "en", "a", 1),
    (6, "été 中文 😀 <|endoftext|> <|startoftext|>x", "fr", "b", 1), (7, "Hello world, it's 2024!", "en", "a", 1),
    (8, "́e á Σας ŉ Ǆ", "el", "b", 1), (9, " ", "en", "a", 1), (10, "a\x85b\x1cc​d　e", "en", "a", 1),
]


@pytest.fixture(scope="module")
def merges():
    return Merges(open(BYTE, encoding="utf-8").read())


def test_merging_equals_the_library(merges):
    library = Tokenizer.from_file(BYTE)
    words = ["a", "hello", "é", "x" * 33, "ab" * 700, "tion" * 12, "Zürich", "0123456789"]
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert [np.frombuffer(x, "<u4").tolist() for x in merges.encode([w.encode() for w in words])] == want
    assert merges.merge_long(b"hello") == library.encode("hello").ids


def test_transducer_holds_exactly_its_words(merges):
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choices("abcé", k=rnd.randint(1, 7))).encode() for _ in range(900)})
    entries = list(zip(words, merges.encode(words), strict=True))
    found = transducer.Transducer(data=transducer.build(entries))
    assert found.lookup(words) == [x for _, x in entries]
    assert found.places(words).tolist() == list(range(len(words)))
    assert found.lookup([b"zz", b"", b"abca" * 5]) == [None] * 3
    # shared suffixes: far fewer states than letters
    assert len(found.final) < sum(map(len, words)) / 2
    assert transducer.Transducer(data=transducer.build([])).lookup([b"a"]) == [None]


def test_encoder_equals_the_library_on_random_texts(merges):
    library = Tokenizer.from_file(BYTE)
    encoder = codec.Encoder(merges, transducer.Transducer(data=transducer.build([(b" the", merges.encode([b" the"])[0])])))
    rnd = random.Random(2)
    parts = [*"ab Z09 .,'\n\té中😀-_", "<|endoftext|>", "  ", " \n", "the", " the", "'s", "　", "\x85", "\x1c"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(3000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)] == want


def test_all_words_and_pieces_are_counted(spark):
    from collections import Counter

    import regex

    rnd = random.Random(4)
    parts = [*"ab Z09 .,'\"\n\té中-_", "  ", " \n", "the", " the", "'s", "　", "\x85", "\x1c", "one\ntwo\tthree", "end."]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(800)] + [t for _, t, *_ in ODD]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    for counts, pattern in ((codec.word_counts, r"\p{L}+"), (codec.piece_counts, codec.SPLIT)):
        want = Counter(w for t in texts if t for w in regex.findall(pattern, t))
        assert {r["word"]: r["n"] for r in counts(docs).collect()} == want


def test_frequent_fills_the_limit(spark):
    rnd = random.Random(5)
    rows = [(f"w{i:04d}", 7) for i in range(500)] + [(f"é{i}", rnd.choice([1, 2, 1000, 1001, 1005, 1006])) for i in range(300)]
    rnd.shuffle(rows)
    counts = spark.createDataFrame(rows, "word string, n long").repartition(5)
    want = sorted(rows, key=lambda x: (-x[1], x[0]))
    for words in (0, 1, 150, 400, 799, 800, 900):
        assert codec.frequent(counts, words) == want[:words]
    assert codec.frequent(counts.where("n = 7"), 20) == [(f"w{i:04d}", 7) for i in range(20)]
    assert codec.frequent(counts.limit(0), 20) == []


def test_op9_equals_the_library(spark, folder):
    sf = folder("documents", ODD, DOCS)
    got = {r["doc_id"]: r for r in codec.op9(spark, sf).collect()}
    library = Tokenizer.from_file(BYTE)
    assert len(got) == len(ODD)
    for doc_id, text, *_ in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_encode_replaces_clashing_columns_and_keeps_others(spark):
    docs = spark.createDataFrame([("old", "a b", 7)], "ids string, text string, extra int")
    lexicon = codec.build_lexicon(docs, BYTE)
    row = codec.decode(codec.encode(docs, lexicon), lexicon).first()
    assert (row["text"], row["extra"], row["decoded"]) == ("a b", 7, "a b")
    assert bytes(row["ids"]) == np.array(Tokenizer.from_file(BYTE).encode("a b").ids, "<u4").tobytes()


def test_frequent_words_are_the_most_frequent(spark):
    counts = spark.createDataFrame([(f"w{i}", 1 + i) for i in range(300)], "word string, n long")
    found = codec.frequent(counts, 50)
    assert 40 <= len(found) <= 50 and found == sorted(((f"w{i}", 1 + i) for i in range(300)), key=lambda x: -x[1])[: len(found)]
    assert codec.frequent(counts.where("n < 0"), 50) == []


def test_wavelet_answers_from_the_blob():
    rnd = random.Random(3)
    ids = rnd.choices(range(0, 50000, 7), k=2500) + [5] * 700
    shard = wavelet.Shard(wavelet.Shard.pack(np.array(ids)))
    assert shard.unpack().tolist() == ids
    assert [shard[i] for i in range(0, len(ids), 11)] == ids[::11]
    for token in (ids[0], ids[999], 5, 49999, 3):
        places = [i for i, x in enumerate(ids) if x == token]
        assert shard.count(token) == len(places) and shard.count(token, 100, 2600) == sum(100 <= i < 2600 for i in places)
        assert [shard.occurrence(token, k) for k in range(len(places))] == places
        assert shard.occurrence(token, len(places)) == -1
    for few in ([], [9], [9, 9, 9]):
        assert wavelet.Shard(wavelet.Shard.pack(np.array(few, np.uint32))).unpack().tolist() == few


def test_op10_equals_the_library(spark, folder, tmp_path):
    sf = folder("documents", ODD[::-1], DOCS)
    got = {r["doc_id"]: r for r in wavelet.op10(spark, sf).collect()}
    library = Tokenizer.from_file(WORD)
    start = 0
    for doc_id, text, *_ in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert (got[doc_id]["start"], got[doc_id]["n_tokens"]) == (start, len(ids))
        assert got[doc_id]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    # small shards give the same documents
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wavelet.write_shards(docs, str(tmp_path / "shards"), WORD, shard_tokens=5)
    again = {r["doc_id"]: (r["start"], len(r["ids"]) // 4) for r in wavelet.read_documents(spark, str(tmp_path / "shards")).collect()}
    assert again == {k: (r["start"], r["n_tokens"]) for k, r in got.items()}


def test_empty_tables(spark, folder):
    sf = folder("documents", [], DOCS)
    assert codec.op9(spark, sf).count() == 0
    assert wavelet.op10(spark, sf).count() == 0
