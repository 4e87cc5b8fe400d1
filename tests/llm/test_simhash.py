import random
import re

import xxhash
from pyspark.sql import functions as F

from gridtide.llm import links, simhash
from tests.llm.conftest import DOCS


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(ids, pairs):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        if a == b:
            continue
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_equal_brute_force(spark):
    rnd = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 900)]
    pairs += [(rnd.randint(1000, 1400), rnd.randint(1000, 1400)) for _ in range(250)] + [(7, 7), (-5, -9)]
    want = roots({x for p in pairs if p[0] != p[1] for x in p}, pairs)
    got = links.components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == want


def test_groups_let_all_members_meet(spark):
    members = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 1)] + [(3, 1), (3, 2)], "k int, m long")
    found = links.groups(members, "k", "m", 8, F.col("m")).collect()
    lists = {(r["k"], r["gi"], r["gj"]): set(r["members"]) for r in found}
    assert {k[0] for k in lists} == {1, 3} and max(map(len, lists.values())) < 50
    met = {(a, b) for g in lists.values() for a in g for b in g}
    assert all((a, b) in met for a in range(50) for b in range(50))


def test_fingerprints_near_links_within_four_bits(spark):
    rnd = random.Random(6)
    base = [rnd.getrandbits(64) for _ in range(40)]
    values = set(base)
    for b in base[:20]:
        for _ in range(30):
            values.add(b ^ sum(1 << k for k in rnd.sample(range(64), rnd.randint(1, 6))))
    values = [v - (1 << 64) if v >> 63 else v for v in values] + [0]
    pairs = [(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    found = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long"))
    got = [(r["a"], r["b"]) for r in found.collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in got)
    assert roots(values, got) == roots(values, pairs)


def test_op3_equals_brute_force(spark, folder):
    long = " ".join(f"w{i}" for i in range(3000))
    texts = [None, "", "  ", "One two", "one TWO", "a b c d e f", "a b c d e f", long, long + " tail", "Ünicode ÀB c d e", "x" * 50000]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    sf = folder("documents", rows, DOCS)
    got = {r["doc_id"]: r for r in simhash.op3(spark, sf).collect()}
    fp = {i: brute(t) for i, t in enumerate(texts)}
    pairs = [(i, j) for i in fp for j in fp if i < j and (fp[i] ^ fp[j]).bit_count() <= 4]
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{f:016x}" for i, f in fp.items()}
    assert {i: r["component_id"] for i, r in got.items()} == roots(fp, pairs)


def test_keep_one_keeps_columns_and_one_row_of_each_class(spark):
    rows = [(3, "a b c d e", "x"), (1, "a b c d e", "y"), (1, "a b c d e", "y"), (9, "q r s t u v", "z"), (None, "k l m n o p", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(
        map(str, docs.where("doc_id = 9 or doc_id is null").union(docs.where("doc_id = 1").limit(1)).collect())
    )
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_keep_one_keeps_a_row_of_every_class_of_a_null_or_repeated_id(spark):
    rows = [
        (None, "a b c d e", 1), (None, "q r s t u v", 2), (None, "q r s t u v", 3), (None, None, 4), (None, "", 5),
        (7, "one two three four five six", 6), (7, "eleven twelve thirteen fourteen", 7),
        (8, "eleven twelve thirteen fourteen", 8), (8, "red green blue white black", 9), (None, "red green blue white black", 10),
        (9, "one two three four five six", 11), (9, "k l m n o p", 12),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    kept = [(r["doc_id"], r["text"] or None) for r in simhash.keep_one(docs).collect()]
    assert sorted(map(str, kept)) == sorted(
        map(
            str,
            [
                (None, "a b c d e"), (None, "q r s t u v"), (None, None), (7, "one two three four five six"),
                (7, "eleven twelve thirteen fourteen"), (8, "red green blue white black"), (9, "k l m n o p"),
            ],
        )
    )
