"""Retrieval of contained items against a brute force over all pairs, with templated items and any size of shards."""

import random
from itertools import combinations

import numpy as np
import pytest

from gridtide.llm import decontaminate as d

PLAIN = [f"word{i}" for i in range(300)]


def contained(text, item):
    """The overlap test alone, on any document and item."""
    ws = d.words(text)
    q, a = d.question_answer(item)
    if not q or not ws:
        return False

    def share(parts):
        size = len(next(iter(parts)))
        return len(parts & d.shingles(ws, size)), len(parts)

    (fq, nq), (fa, na), (fw, nw) = (share(d.shingles(x)) for x in (q, a, d.words(item)))
    return min(fq / nq, len(set(a) & set(ws)) / len(set(a)), max((fq + fa) / (nq + na), fw / nw)) >= d.OVERLAP


def noise(r, n):
    return " ".join(r.choice(PLAIN) for _ in range(n))


def templated(r, n):
    """Items of one template with a few rare words, and free items."""
    items = []
    for i in range(n):
        rare = [f"rare{i}x{k}" for k in range(4)]
        if i % 3:
            text = (
                f"In the year {rare[0]} which of the following towns named {rare[1]} was the first to open a public library for all of "
                f"its people, and what did the mayor {rare[2]} say about it at the time? The answer is {rare[3]} and the reason was given"
            )
        else:
            text = f"{noise(r, r.randint(5, 70))}? {noise(r, r.randint(1, 12))}"
        items.append((i, text))
    return items


def damaged(r, text):
    """A copy with a few words changed, dropped or added."""
    ws = text.split(" ")
    for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
        at = r.randrange(len(ws))
        ws[at : at + 1] = r.choice([["changed"], [], [ws[at], "added"]])
    return " ".join(ws)


@pytest.mark.parametrize("n", [2, 20, 600])
def test_every_contained_item_is_found(n):
    r = random.Random(n)
    items = templated(r, n)
    index = d.Index(items)
    found = total = 0
    for _ in range(60):
        some = [r.choice(items) for _ in range(r.randint(0, 3))]
        text = noise(r, r.randint(0, 200))
        for _, item in some:
            text += " . " + damaged(r, item) + " . " + noise(r, r.randint(0, 150))
        want = {i for i, item in items if contained(text, item)}
        got = {h[0] for h in index.hits(text)}
        assert got == want
        found, total = found + len(got), total + len(some)
    assert found > total / 4


def test_a_question_and_its_answer_far_apart():
    items = templated(random.Random(1), 50)
    r = random.Random(2)
    for i, item in items:
        if len(d.question_answer(item)[0]) >= 5:
            question, answer = item.split("? ", 1) if "? " in item else (item, "")
            text = f"{noise(r, 90)}. {question}? {noise(r, 400)}. {answer}. {noise(r, 50)}"
            assert (i in {h[0] for h in d.Index(items).hits(text)}) == contained(text, item)


def test_the_greatest_loss_against_all_choices():
    r = random.Random(9)
    for _ in range(150):
        n = r.randint(1, 11)
        impacts = [r.choice([0.0, r.random(), 5 * r.random()]) for _ in range(n)]
        weight = np.array([r.choice([0, 1, 1]) for _ in range(n)])
        budget = r.randint(0, 6)

        def cost(lost):
            return sum(w for s, w in enumerate(weight) if any(s <= p < s + d.SHINGLE for p in lost))

        best = max(sum(impacts[p] for p in lost) for k in range(n + 1) for lost in combinations(range(n), k) if cost(lost) <= budget)
        assert d.most_lost(impacts, weight, budget) == pytest.approx(best)


def test_the_size_of_shards_changes_nothing(spark, monkeypatch):
    r = random.Random(4)
    items = templated(r, 60) + [(7, "repeated item of a few words? yes"), (7, "repeated item of a few words? yes"), (None, None), (61, "")]
    docs = [(i, noise(r, 30) + " " + damaged(r, r.choice(items[:60])[1])) for i in range(80)] + [(200, None), (201, ""), (202, "repeated item of a few words? yes")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")

    def run():
        return sorted((x.doc_id, sorted((h.item_id, round(h.score, 9)) for h in x.hits)) for x in d.find(df, bench).collect())

    whole = run()
    assert sum(len(h) for _, h in whole) > 40 and dict(whole)[202] == [(7, dict(dict(whole)[202])[7])] * 2
    monkeypatch.setattr(d, "SHARD_WORDS", 300)
    assert run() == whole
    assert d.find(df.limit(0), bench).collect() == [] and all(x.hits == [] for x in d.find(df, bench.limit(0)).collect())
