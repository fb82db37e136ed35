"""Near-duplicate classes against all pairs, with large buckets, blocks and hot texts; components against a plain search."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftlink.llm import near_dedup


def shingles(text, k=5):
    w = [x for x in near_dedup_words(text)]
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])


def near_dedup_words(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [x for x in text.split(" ") if x]


def classes(rows):
    """Class of each row of (id, text) by all pairs: equal texts and texts of similarity 0.8."""
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    g = {i: shingles(t) for i, t in rows}
    pairs = 0
    for i, t in rows:
        for j, u in rows:
            if i < j and t is not None and u is not None:
                if t != u:
                    both, either = sum((g[i] & g[j]).values()), sum((g[i] | g[j]).values())
                    if not either or both / either < 0.8:
                        continue
                    pairs += 1
                parent[max(top(i), top(j))] = min(top(i), top(j))
    return {i: top(i) for i, _ in rows}, pairs


def edited(rnd, text, n):
    w = text.split()
    for i in rnd.sample(range(len(w)), n):
        w[i] = f"x{rnd.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("small", [False, True])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, small):
    if small:  # stars, blocks and parts even on few rows
        for name, value in (("PAIRWISE", 2), ("BLOCK", 3), ("MANY", 2), ("SALTS", 3), ("PER_TASK", 5)):
            monkeypatch.setattr(near_dedup, name, value)
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rnd.choices(words, k=60))  # which texts that aren't near share
    origin = " ".join(rnd.choices(words, k=120))
    texts = [origin] * 5 + [edited(rnd, origin, 1) for _ in range(25)] + [edited(rnd, origin, 2) for _ in range(10)]
    texts += [f"{' '.join(rnd.choices(words, k=30))} {passage}" for _ in range(15)] + [f"{passage} {' '.join(rnd.choices(words, k=8))}" for _ in range(12)]
    texts += [None, None, "", "", "  \n", "one two", "one two", "one two three four five", "a " * 40, "a " * 41]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want, _ = classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == want


def test_links_at_scale_of_the_small_table(spark):
    """Of the pairs at 0.8 or above, among all documents of sf0.01, at least 0.95 are in one class; no class holds texts that no chain of such pairs joins."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    posting, g = {}, {i: shingles(t) for i, t in rows}
    for i, c in g.items():
        for s in c:
            posting.setdefault(s, []).append(i)
    shared = Counter()
    for ids in posting.values():
        for a in range(len(ids)):
            for b in range(a + 1, len(ids)):
                shared[ids[a], ids[b]] += 1
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    n = kept = 0
    for i, j in shared:
        both, either = sum((g[i] & g[j]).values()), sum((g[i] | g[j]).values())
        if both / either >= 0.8:
            n += 1
            kept += got[i] == got[j]
            parent[max(top(i), top(j))] = min(top(i), top(j))
    assert n > 50 and kept >= 0.95 * n
    assert all(top(i) == top(got[i]) for i, t in rows if t)


def test_components_of_paths_stars_and_cycles(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "PER_TASK", 10)
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(300, 301), (301, 300)]
    rnd.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["label"] for r in near_dedup.components(df).collect()}
    want = {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 150), 100), **dict.fromkeys(range(200, 209), 200), 300: 300, 301: 300}
    assert got == want
    assert near_dedup.components(df.limit(0)).count() == 0


def test_alignment_against_a_full_table():
    rnd = np.random.default_rng(1)
    for _ in range(150):
        a = rnd.permutation(30)[: rnd.integers(1, 20)].astype(np.uint64)
        b = np.concatenate([a[rnd.random(len(a)) < 0.95], 100 + np.arange(rnd.integers(0, 2))]).astype(np.uint64)
        if rnd.random() < 0.3:
            rnd.shuffle(b)
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        m = table[-1, -1]
        s = m / (len(a) + len(b) - m) if len(a) + len(b) > m else 0
        got = near_dedup.aligned(a, b)
        assert got == pytest.approx(s) if s >= 0.8 else got == 0


def test_order_counts_in_a_sketch():
    k = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ends = np.array([0, len(k)])
    same = near_dedup.sketch(k, ends)[1][0]
    near = near_dedup.sketch(np.delete(k, [50, 51, 52]), np.array([0, len(k) - 3]))[1][0]
    turned = near_dedup.sketch(np.concatenate([k[200:], k[:200]]), ends)[1][0]
    assert (same == near).mean() > 0.7 > (same == turned).mean()


def test_one_row_of_each_class_stays(spark):
    schema = "doc_id long, text string, tkey string, one string, row string, entries string, h string"
    t = " ".join(f"w{i}" for i in range(50))
    rows = [(3, t), (1, t), (1, t), (None, t), (2, t.replace("w49", "z")), (4, None), (4, None), (5, ""), (6, ""), (None, "solo"), (None, None)]
    docs = spark.createDataFrame([(i, x, "a", "b", "c", "d", "e") for i, x in rows], schema)
    got = near_dedup.keep_first(docs)
    assert got.columns == docs.columns and got.filter("tkey != 'a' or one != 'b' or row != 'c'").count() == 0
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=key) == sorted([(1, t), (4, None), (4, None), (5, ""), (None, "solo"), (None, None)], key=key)
    assert near_dedup.keep_first(docs.limit(0)).count() == 0
    assert near_dedup.near_duplicates(docs.filter(F.col("text").isNull())).count() == 3
