import numpy as np

from gridtide.llm import embeddings


def test_links_equal_brute_force(spark, folder):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 16))
    rows = []
    for i in range(400):
        v = base[i % 60] + rng.standard_normal(16) * 0.06 * (i >= 60)
        rows.append((i, v.tolist(), i % 3))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(5)]
    rows += [
        (2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [1.0, None] * 8, 1),
        (2004, [float("nan")] * 16, 1), (2005, [float("inf")] * 16, 1), (2006, rows[5][1], None),
        (2007, rows[5][1], rows[5][2] + 1), (2008, [1.0, 2.0], 1), (2009, [2.0, 4.0], 1),
    ]
    sf = folder("embeddings", rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in embeddings.op1(spark, sf).collect()}
    table = {r["vec_id"]: (r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    usable = {
        i: np.array(v, float) / np.linalg.norm(v)
        for i, (v, label) in table.items()
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v)
    }
    links = {i: 0 for i in table}
    root = {i: i for i in table}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in usable:
        for j in usable:
            if i < j and table[i][1] == table[j][1] and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= 0.98:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert len(got) == len(rows)
    found, want = sum(r["n_links"] for r in got.values()), sum(links.values())
    assert want > 200 and found == want
    assert {i: r["n_links"] for i, r in got.items()} == links
    assert {i: r["component_id"] for i, r in got.items()} == {i: find(i) for i in table}
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_empty_table_and_clashing_columns(spark):
    rows = [(1, [1.0, 2.0], 3, 9, 9), (2, [2.0, 4.0], 3, 9, 9), (3, [2.0, -4.0], 3, 9, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, component long, rep long")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.classes(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}
    assert embeddings.classes(df.limit(0)).collect() == []
