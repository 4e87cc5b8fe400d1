import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from gridtide.llm import blocks, pieces, wordwise

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(library, docs):
    rows = []
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        data = np.array(ids, "<u4").tobytes()
        rows.append((doc_id, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(rows, key=str)


def fuzz(n, seed=3):
    r = random.Random(seed)
    signs = " " * 6 + "'''" + "strevmlda1\n\t.,é一́　\xa0 ٣🙂\x00\x1f​꟎" + "İſ"
    return ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_equals_the_library(spark, folder, library):
    texts = [None, "", " ", "  \n ", "<|endoftext|>", "it's 'll''s", "x" * 5000, "no blanks" * 300, *fuzz(400)]
    docs = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(None, "a b", None, None, None), (3, "a b", "en", "s", 1)] * 2
    at = folder("documents", docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = wordwise.op12(spark, at).collect()
    assert sorted(map(tuple, got), key=str) == expected(library, [d[:2] for d in docs])


def test_every_code_point_is_cut_as_the_library_cuts(library):
    """All code points have the library's class; texts with many of them are cut and encoded as by the library."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    one = {bytes([b]): b for b in range(256)}
    for pattern, kind in ((r"\p{L}", "L"), (r"\p{N}", "N"), (r"\s", "s")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=one, special_tokens={})
        mine = re.compile(f"[{pieces.character_class(kind)}]")
        assert bytes(probe.encode_ordinary("".join(points))).decode() == "".join(filter(mine.match, points))
    sample = random.Random(5).sample(points, 20_000)
    for around in ("{}'s", "a{}1", "1{} x", " {}{}", "'{}s"):
        texts = [around.replace("{}", c) for c in sample]
        found = pieces.cut(texts)
        words = found.words.to_pylist()
        ids = [library.encode_ordinary(w) for w in words]
        flat = [x for i in found.index.tolist() for x in ids[i]]
        assert flat == [x for t in texts for x in library.encode_ordinary(t)]


def test_many_blocks_wide_numbers_and_clashing_columns(spark, library, monkeypatch):
    """Blocks of a few documents; columns with the operator's own names and with the output's name."""
    numbers = np.array([0, 5, 65534, 65535, 65536, 1 << 20, 3], np.int64)
    assert blocks.unpack(blocks.pack(numbers)).tolist() == numbers.tolist()
    assert blocks.unpack(blocks.pack(numbers[:0])).tolist() == []
    texts = fuzz(200, 9)
    rows = [(i, t, f"b{i}", i * 2, "old") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "no long, text string, block string, row long, IDS string").repartition(3, "no").sortWithinPartitions("no")
    stored = wordwise.util.stored(df)
    made = wordwise.decode(wordwise.encode(stored, PATH), PATH)
    assert made.columns == ["no", "block", "row", "ids", "decoded"]
    for r in made.collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(texts[r.no])
        assert bytes(r.decoded).decode() == texts[r.no] and r.block == f"b{r.no}" and r.row == 2 * r.no


def test_blocks_close_by_text_and_words(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(blocks, "BLOCK_CHARS", 40)
    batch = pa.RecordBatch.from_pydict({"text": ["a b c " * 5, None, "x " * 30, "", "q"], "row": [1, 2, 3, 4, 5]})
    monkeypatch.setattr(blocks.util, "slices", lambda b, c, limit=0: (b.slice(i, 1) for i in range(b.num_rows)))
    found = list(blocks.blocks(iter([batch]), pieces.cut))
    assert [pa.concat_arrays(b.rows).to_pylist() for b in found] == [[1, 2, 3], [4, 5]]
    words, index, counts = found[0].numbered()
    assert counts.tolist() == [16, 0, 31] and [words[i].as_py() for i in index[:3]] == ["a", " b", " c"]


def test_long_texts_are_cut_between_plain_words(monkeypatch):
    text = "it's  one\n\nlong text, of 12 words 's and  more " * 40
    whole = pieces.cut([text])
    parts = [p for owners, some in pieces.parts([None, text, ""], 30) for o, p in zip(owners, some) if o == 1]
    assert len(parts) > 20 and "".join(parts) == text
    found = pieces.cut(parts)
    assert [found.words[i].as_py() for i in found.index] == [whole.words[i].as_py() for i in whole.index]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert wordwise.digests(none, PATH).collect() == []


def test_words_of_another_order_are_never_joined():
    """Documents whose block is not the one the words came from find no words: an error, not wrong ids."""
    block = wordwise._Block([])
    with pytest.raises(RuntimeError, match="store them first"):
        block._group(blocks.pack(np.array([0, 1])))
    block._group(blocks.pack(np.array([], np.int64)))
