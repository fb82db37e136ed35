"""Exact search over several shards and blocks; entropy spans by brute force; odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftlink.llm import exact_topk, secrets


def by_hand(rows, k=5, every=50):
    """query_id, rank, vec_id, score by all pairs, with whole numbers of any size."""
    held = lambda x: max(-(2**63), min(2**63 - 1, x))
    q = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q.append((i, tuple(held(math.floor(256 * x)) if math.isfinite(256 * x) else (2**63 - 1 if x > 0 else -(2**63)) for x in v)))
    out = set()
    for i in {i for i, _ in q if i % every == 0}:
        found = []
        for v in {v for j, v in q if j == i}:
            for j, u in q:
                if j != i and len(u) == len(v):
                    found.append((-max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(v, u, strict=True)))), j))
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(found)[:k])}
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, dim int, shard string").repartition(4)
    return {tuple(r) for r in exact_topk.top_k(exact_topk.quantised(df), F.col("vec_id") % 50 == 0, 5).collect()}


def test_shards_blocks_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "SHARD", 60)
    monkeypatch.setattr(exact_topk, "QUERIES", 3)
    rnd = np.random.default_rng(5)
    rows = [(i, (rnd.normal(size=6) * (1 + i % 3)).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # equal vectors, more than a leaf holds
    rows += [(2000, None), (2050, [None] * 6), (2100, [float("nan")] * 6), (2150, [float("inf"), *[0.0] * 5]), (None, rows[0][1]), (50, rows[3][1]), (100, rows[100][1])]
    rows += [(3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (4000, []), (4001, []), (5000, [0.5] * 3)]
    assert run(spark, rows) == by_hand(rows)


def test_components_of_any_size(spark):
    rows = [(i, [x, -x, 1.0]) for i, x in enumerate([1e300, -1e300, 1e17, 3e16, -2e16, 1e9, 5.5, 0.0, -0.1])]
    rows += [(50, [1e12, 1e12, -1e12]), (100, [1e308, 1.0, 0.0])]
    assert run(spark, rows) == by_hand(rows)


def test_empty_tables(spark):
    assert run(spark, [(50, [1.0])])  == set()
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert exact_topk.top_k(exact_topk.quantised(empty), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_trees_have_tight_boxes_and_prune():
    rnd = np.random.default_rng(2)
    x = np.concatenate([rnd.normal(c, 3, (300, 4)) for c in (-300, 0, 300)]).astype(np.int64)
    t = exact_topk.build(x, 20)
    assert sorted(t.order.tolist()) == list(range(len(x)))
    for n in range(len(t.left)):
        part = x[t.order[t.begin[n] : t.end[n]]]
        assert (part.min(0) == t.low[n]).all() and (part.max(0) == t.high[n]).all()
        if t.left[n] < 0:
            assert len(part) <= 20
        else:
            assert t.begin[t.left[n]] == t.begin[n] and t.end[t.left[n]] == t.begin[t.right[n]] and t.end[t.right[n]] == t.end[n]
    seen = []
    compare = exact_topk._compare
    try:
        exact_topk._compare = lambda rows, span, *a: (seen.append(span), compare(rows, span, *a))
        q = np.array([[1, 1, 1, 1]])
        scores, ids = exact_topk.search(q, np.array([-1]), np.array([exact_topk.NONE]), t.order, x[t.order], t, 3)
    finally:
        exact_topk._compare = compare
    best = np.lexsort((np.arange(len(x)), -(x @ q[0])))[:3]
    assert ids[0].tolist() == best.tolist() and len(seen) < (t.left < 0).sum() / 2


def entropy(s):
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def test_window_entropies_by_brute_force():
    rnd = random.Random(1)
    for _ in range(200):
        s = "".join(rnd.choices("abcdEF0123+/", k=rnd.randint(0, 60)))
        width = rnd.randint(1, 70)
        w = min(width, len(s))
        want = [entropy(s[i : i + w]) for i in range(len(s) - w + 1)] if s else []
        assert list(secrets.window_entropies(s, width)) == pytest.approx(want, abs=1e-9)


def test_added_spans_by_brute_force():
    """Which candidates are spans: by the whole definition, written out."""
    rnd = random.Random(4)
    kinds = [("0123456789ABCDEF", 40), ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 24), ("abcdefghij+/_=-KLMNOP0123456789", 30), ("abc", 30), ("01", 25), ("abcdefghijklmnopqrstuvwxyz", 28)]
    names = dict(zip(("hex", "alnum", "base64"), ("0123456789abcdefABCDEF", "", "+/_=-"), strict=True))
    for _ in range(300):
        chars, n = rnd.choice(kinds)
        s = "".join(rnd.choices(chars, k=n))
        allowed = any(a.fullmatch(s) for a in secrets.ALLOW)
        kind = "hex" if set(s) <= set(names["hex"]) else "base64" if set(s) & set(names["base64"]) else "alnum"
        width, bits = next((w, b) for k, _, w, b in secrets.CLASSES if k == kind)
        want = not allowed and max(entropy(s[i : i + width]) for i in range(len(s) - width + 1)) >= bits - 1e-12
        text = f"see {s} here"
        got = [x for x in secrets.find_spans(text) if x[2] == "entropy"]
        base = [x for x in secrets.find_spans(text) if x[2] != "entropy"]
        assert got == ([(4, 4 + n, "entropy")] if want and not base else [])


@pytest.mark.parametrize(
    ("s", "found"),
    [
        ("aB3dE5gH7jK9mN1pQ3sT5", True), ("zXcVbNmQwErTyUiOpAsDf", True), ("Donaudampfschifffahrtsgesellschaft", False), ("getElementsWithClassNamesAndTypes", False),
        ("2024-01-02-2025-03-04-5", False), ("123e4567-e89b-12d3-a456-426614174000", False), ("some/long/path/to/a/file", False), ("aaaaaaaaaaaaaaaaaaaaaaaaaaa1", False), ("abcdefghijklmnopqrstuvw", False),
    ],
)
def test_candidates_and_the_allow_list(s, found):
    assert secrets.high_entropy(s) is found


def test_base_spans_stay_and_odd_rows(spark):
    base = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]
    rnd = random.Random(8)
    parts = ["password", " = ", ":", '"', "secret", "TOKEN", "apikey", "api_key", "abcdef", "x" * 5, "0123456789abcdef" * 2, "AKIA", "ABCDEFGHIJKLMNOP", "é", "\n", "ſecret=abcdefgh", " ", "aB3dE5gH7jK9mN1pQ3sT5uV7"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(400)] + [None, "", "é" * 9 + "password=abcdef", "w " * 300_000 + "AKIA" + "Z" * 16]
    schema = "doc_id long, text string, n_chars int, __before string, spans string, n_hex string"
    rows = [(i, t, -1, "b", "s", "h") for i, t in enumerate(texts)] + [(None, "token=abcdef1", -1, "b", "s", "h")] * 2
    docs = spark.createDataFrame(rows, schema)
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs).collect()}
    for i, t in enumerate(texts):
        want = [(m.start(), n, m.end(), k) for n, (k, p, ok) in enumerate(base) for m in p.finditer(t or "") if ok(m)]
        spans = [x.split(":") for x in got[i].split(",")] if got[i] else []
        assert [x for x in spans if x[0] != "entropy"] == [[k, str(a), str(b)] for a, _, b, k in sorted(want)]
    clean = secrets.remove_secrets(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    for r in clean.collect():
        t = texts[r["doc_id"]] if r["doc_id"] is not None else "token=abcdef1"
        spans = [x.split(":") for x in got[r["doc_id"]].split(",") if x]
        assert tuple(r)[3:] == ("b", "s", "h")
        if not spans:
            assert (r["text"], r["n_chars"]) == (t, -1)
            continue
        hidden = [any(int(a) <= i < int(b) for _, a, b in spans) for i in range(len(t))]
        rest = re.sub(r"\[(?:ASSIGN|ACCESS|HEX|ENTROPY)\]", "", r["text"])
        assert rest == "".join(c for c, h in zip(t, hidden, strict=True) if not h) and r["n_chars"] == len(r["text"])
    assert secrets.scan(docs.limit(0)).count() == secrets.remove_secrets(docs.limit(0)).count() == 0
    wordy = secrets.remove_secrets(docs.withColumn("n_chars", F.lit("many")))
    assert {r["n_chars"] for r in wordy.collect()} == {"many"}


def test_spans_agree_with_sql():
    """The SQL finds places by what stands between matches, and entropies window by window."""
    duckdb = pytest.importorskip("duckdb")
    import hashlib

    import pyarrow as pa

    from weftlink.llm.queries import oracle_sql

    rnd = random.Random(3)
    parts = ["password", " = ", ":", '"', "secret", "TOKEN", "apikey", "abcdef", "x" * 5, "0123456789abcdef" * 2, "AKIA", "ABCDEFGHIJKLMNOP", "é", "\n", " ", "aB3dE5gH7jK9mN1pQ3sT5uV7", "zXcVbNmQwErTyUiOpAsDf", "some/long/path/to/a/file/here", "f00-" * 9]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(200)] + [None]
    documents = pa.table({"doc_id": list(range(len(texts))), "text": texts})  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    cur = con.execute(oracle_sql()["op10_secret_scan"])
    names = [x[0] for x in cur.description]
    got = {r["doc_id"]: r for r in (dict(zip(names, x, strict=True)) for x in cur.fetchall())}
    added = 0
    for i, t in enumerate(texts):
        spans = secrets.find_spans(t or "")
        added += sum(s[2] == "entropy" for s in spans)
        assert got[i]["spans"] == secrets._joined(spans)
        assert got[i]["base_sha256"] == hashlib.sha256(secrets._joined([s for s in spans if s[2] != "entropy"]).encode()).hexdigest()
    assert added > 20
