"""The remaining operators on nulls, empty texts, repeats, empty tables and clashing columns."""

import hashlib
import re

import duckdb
import pytest

import corpus_pipeline
from gridtide.llm import decontaminate, language, pii, rollup, secrets, urls
from tests.llm.conftest import DOCS

EN = "the quick brown fox jumps over the lazy dog and runs into the deep forest again "
DE = "der schnelle braune Fuchs springt über den faulen Hund und läuft wieder in den Wald "
ITEM = "What is the tallest hill of the western range? It is called mount example by all locals there."
ROWS = (
    [(i, EN * (1 + i % 3) + f"number{i}", "en", "s", 9) for i in range(24)]
    + [(100 + i, DE * (1 + i % 3) + f"zahl{i}", "de", "s", 9) for i in range(24)]
    + [
        (500, None, "en", None, None), (501, "", None, "s", 0), (502, "123 456", "en", "s", 7),
        (503, EN + ITEM + " " + EN, "en", "t", 9), (504, EN + 'token = "0123456789abcdef0123"', "en", "t", 9),
        (505, "mail a.b@c.example.org or +1 (555) 123-4567, card 4111 1111 1111 1111, at 10.0.0.255", "en", "t", 9),
        (505, "mail a.b@c.example.org or +1 (555) 123-4567, card 4111 1111 1111 1111, at 10.0.0.255", "en", "t", 9),
    ]
)


@pytest.fixture(scope="module")
def sf(folder):
    path = folder("documents", ROWS, DOCS)
    folder("benchmark", [(1, ITEM), (2, None), (3, "")], "item_id long, text string", path)
    folder("labels", [(0, 1, 1), (1, 0, 0), (1, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int", path)
    return path


def test_secret_spans(spark, sf):
    got = {r["doc_id"]: r for r in secrets.op2(spark, sf).collect()}
    for doc_id, text, *_ in ROWS:
        base = [("assign", *m.span()) for m in re.finditer(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or "") if len(m[2]) >= 12]
        base += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 16]
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(base, key=lambda s: (s[1], s[0])))
        assert got[doc_id]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert "guess" in got[504]["spans"] and got[500]["spans"] == ""


def test_guess_costs_order_values():
    ranks = {"password": 1, "dragon": 50}
    cheap = ["password123", "qwertyuiop", "aaaaaaaaaaaa", "dragon19990101", ""]
    assert max(secrets.guess_bits(v, ranks) for v in cheap) < secrets.GUESS_BITS < secrets.guess_bits("Xk9$Lq2!vB7z", ranks)


@pytest.mark.parametrize(
    "before, after",
    [
        ('password          = "', '"'), ("pwd:     ", ""), ("pwd:\t", ""), ("pwd\t\t=\t", "\n"), ('{"password":\n    "', '"}'),
        ("secret_key = ", " x"), ("DB_PASSWORD_PROD=", ""), ("api_key-v2 => ", ""), ("passphrase:\r\n\t", ""),
        ("secret_api key: ", ""), ("the passwords is ", " now"), ("token\n  = ", ""),
    ],
)
def test_values_in_credential_contexts(before, after):
    text = f"é {before}Xk9$Lq2!vB7z{after}"
    at = len(before) + 2
    assert secrets.scan(text, {}) == [("guess", at, at + 12)] and secrets.masked(text, {}, "*") == f"é {before}*{after}"


def test_credential_contexts_end():
    for text in ("DB_PASSWORD=\nDB_HOST=Xk9$Lq2!vB7z", "pwd:\n\nXk9$Lq2!vB7z", "pwd Xk9$Lq2!vB7z", "pwd\n:\nXk9$Lq2!vB7z"):
        assert secrets.scan(text, {}) == []
    assert len(secrets.scan("pwd:\n c2VjcmV0IGtleSBvZg==", {})) == 1
    n = 200_000
    for text in ("token" * n, "token:" * n, "pwd" + " " * n, "pwd:" + "\t" * n, "api key" * n, "pwd =\n" * n, "pwd:\n" + "a" * n + " =" * n):
        list(secrets.context_values(text))


def test_benchmark_items_are_found(spark, sf):
    got = [(r["doc_id"], r["item_id"]) for r in decontaminate.op4(spark, sf).collect()]
    assert got == [(503, 1)]
    docs = spark.createDataFrame([(1, ITEM, "x")], "doc_id long, text string, hits string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontaminate.clean(docs, bench).count() == 0 and decontaminate.clean(docs, bench.limit(0)).columns == docs.columns


Q3 = decontaminate.Index([(3, "name two towns on the river\nDeep red blue old bar")])


def test_items_with_something_between_question_and_answer():
    index = decontaminate.Index([(1, ITEM), (2, "Name a colour of the old flag\nDeep red with a blue bar")])
    question, answer = ITEM.split("? ")
    for text in (f"{question}? Answer: {answer}", f"{question}?\nthis line stands between the two\n{answer}", f"Q: {question}? (2 points) A: {answer}"):
        assert [(h[0], h[2], h[3]) for h in index.hits(EN + text + " " + EN)] == [(1, 1.0, 1.0)]
    assert [h[0] for h in index.hits("Name a colour of the old flag. Answer: deep red with a blue bar")] == [2]
    # still found by the whole item's shingles: the answer lacks its last word, which is a fifth of its own
    assert [h[0] for h in Q3.hits("name two towns on the river Deep red blue old green")] == [3]
    assert index.hits(EN + question + "? " + EN) == []


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_pii_base_spans(spark, sf, folder):
    import random

    rnd = random.Random(3)
    parts = [*"aZ09.-+@ (_%", "1.2.3.4", "a@b.c", "4111 1111 1111 1111", "+1 (555) 123-4567", "é", "😀", "Dr. Smith", "phone "]
    texts = [r[1] for r in ROWS] + ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(1500)]
    path = folder("documents", [(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.op5(spark, path).collect()}

    def valid(kind, hit):
        d = re.sub("[^0-9]", "", hit)
        if kind == "card":
            sums = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
            return 14 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in sums) % 10 == 0
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in hit.split(".")), "phone": 10 <= len(d) <= 15}[kind]

    for i, t in enumerate(texts):
        spans = sorted(
            (m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PII.items()) for m in re.finditer(p, t or "") if valid(kind, m[0])
        )
        want = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (t, got[i]["spans"])


def test_pii_candidates(spark):
    shaped = "555-123-4567", "555-765-4321", "123-45-6780", "(555) 123-4567", "555.123.4567", "555 123 4567"
    cases = [(f"{b}{x}{a}", [x]) for x in shaped for b, a in (("", ". Then"), ("at 2025 ", " (home)"), ("12 ", "  "), ("(", ")"), ("", "."), ("", "\n"))]
    cases += [(f"{x} {y}", [x, y]) for x in shaped for y in shaped] + [(f"{x}, {x}. {x}  {x}\n{x}", [x] * 5) for x in shaped]
    cases += [
        ("1234567 7654321 1111111 ", ["1234567", "7654321", "1111111"]), ("12345678 555-123-4567", ["12345678", "555-123-4567"]),
        ("555-123-4567 1234 5678 9012.", ["555-123-4567", "1234 5678 9012"]), ("4111 1111 1111 1112.", ["4111 1111 1111 1112"]),
        ("555-123-4567-555-765-4321", ["555-123-4567", "555-765-4321"]), ("1-555-123-4567 x", ["1-555-123-4567"]),
        ("555 - 123 - 4567", ["555 - 123 - 4567"]), ("(020) 7946 0958 ", ["(020) 7946 0958"]), ("(see 1234567) 89", ["1234567"]),
        ("12 34 56", []), ("555-123-4567a 1.5", []), ("555-123-4567-x", []), ("v555-123-4567", []), ("Dr. Smith 5551234567. ", ["Dr. Smith", "5551234567"]),
        ("1 " * 3000, []), ("1" * 30000, []), ("12-" * 3000, []), ("555-123-4567 " * 300, ["555-123-4567"] * 300),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r["candidates"] for r in pii.located(docs).collect()}
    assert [(t, w, h) for i, (t, w) in enumerate(cases) if (h := [s["hit"] for s in got[i]]) != w] == []
    for i, (text, _) in enumerate(cases):
        assert all(text[s["start"] : s["end"]] == s["hit"] for s in got[i])
    shape = spark.createDataFrame([(x,) for x in shaped], "hit string").selectExpr("struct(hit, '' as before) as s")
    described = [r for r in shape.select(*[c.alias(n) for n, c in pii.features(shape["s"]).items()]).collect()]
    assert all(r["phone_shape"] + r["id_shape"] == 1 for r in described)


def test_rollup_equals_sql_and_batches_are_idempotent(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet/*.parquet')")
    assert {tuple(r) for r in rollup.op6(spark, sf).collect()} == set(con.execute(rollup.OP6_SQL).fetchall())


def test_url_rules(spark, folder):
    rows = [
        (1, "https://www.Example.com/en/1"), (2, "http://a.example.com/en/2"), (3, "http://x.net/es/1?q=1"), (4, None),
        (5, "no scheme"), (6, "ftp://b.org"), (7, "http://x.net/es"), (7, "http://x.net/es"), (8, "http://q.com"), (9, ""),
    ]
    path = folder("pages", rows, "page_id long, url string")
    got = {r["page_id"]: r for r in urls.op7(spark, path).collect()}
    assert {k: r["rule"] for k, r in got.items()} == {
        1: "www.example.com/en/", 2: "example.com/en/", 3: "net/es/", 4: None, 5: None, 6: None, 7: None, 8: None, 9: None,
    }
    assert got[1]["host"] == "www.example.com" and (got[4]["host"], got[5]["path"], got[3]["path"]) == ("", "", "/es/1")
    assert got[2]["verdict"] == "block" and {r["verdict"] for r in got.values()} <= {"allow", "block"}


def test_languages(spark, sf):
    got = {r["doc_id"]: r for r in language.op8(spark, sf).collect()}
    assert all(got[i]["lang_pred"] == "en" and got[100 + i]["lang_pred"] == "de" for i in range(24))
    assert {got[i]["lang_pred"] for i in (500, 501, 502)} == {"und"} and got[500]["score"] == 0
    empty = language.train(spark.createDataFrame([], DOCS))
    assert empty.predict("the fox") == ("und", 0.0)


def test_pipeline(spark, sf):
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert not {500, 501, 502, 503} & set(got) and {504, 505} <= set(got)
    assert all(r["round_trip"] for r in got.values()) and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    masked = {r["doc_id"]: r for r in corpus_pipeline.mask_secrets(spark, docs, sf).collect()}
    assert masked[504]["text"] == EN + '[secret]"' and masked[504]["n_chars"] == len(EN) + 9 and masked[500]["text"] is None
