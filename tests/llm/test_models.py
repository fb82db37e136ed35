"""Language and toxicity networks: passes against plain loops, gradients against differences, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftlink.llm import language_id, queries, toxicity
from weftlink.llm.textkit import text_bytes

DATA = "/root/testdata/sf0.01"


def lang_net(classes=("aa", "bb", "cc"), seed=1):
    rng = np.random.default_rng(seed)
    n = len(language_id.WIDTHS) * language_id.FILTERS
    return language_id.ByteConv(
        list(classes), [rng.normal(size=(w, 256, language_id.FILTERS)).astype(np.float32) for w in language_id.WIDTHS],
        rng.normal(size=n).astype(np.float32), rng.normal(size=(n, len(classes))).astype(np.float32), rng.normal(size=len(classes)).astype(np.float32),
    )


def test_byte_network_against_plain_loops():
    net = lang_net()
    x = np.random.default_rng(2).integers(0, 256, (3, 40)).astype(np.uint8)
    best, place = net.responses(x)
    probabilities = net.head(best)
    for i, row in enumerate(x):
        z = net.shift.astype(float).copy()
        k = 0
        for f in net.filters:
            w = len(f)
            for u in range(f.shape[2]):
                sums = [sum(float(f[j, row[p + j], u]) for j in range(w)) for p in range(len(row) - w + 1)]
                assert place[i, k] == int(np.argmax(sums))
                z += max(max(sums) + float(net.bias[k]), 0) * net.dense[k]
                k += 1
        e = np.exp(z - z.max())
        assert np.allclose(probabilities[i], e / e.sum(), atol=1e-4)


def test_fast_pass_equals_the_plain_one():
    net = lang_net()
    net.filters = [np.where(np.arange(256)[None, :, None] < 97, 0, f).astype(np.float32) for f in net.filters]
    kind, tables = net.pair_tables()
    x = np.random.default_rng(3).integers(90, 120, (5, language_id.WINDOW))
    fast = language_id._fast(kind[x].T.copy(), tables, int(kind.max()) + 1) + net.bias
    assert np.allclose(fast, net.responses(x)[0], atol=1e-5)


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = queries.op2_language_id(spark, DATA)
    seen = got.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null and lang_pred != 'und'")
    n, right = seen.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 200 and right >= 0.97 * n
    assert got.count() == docs.count() and got.filter("score < 0 or score > 1").count() == 0


def test_language_of_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, held_out string, score int, lang_pred int, spot int"
    rows = [(i, "die der das und ist nicht " * 20 if i % 2 else "the and of to is was that " * 20, "de" if i % 2 else "en", "s", "x", 1, 1, 1) for i in range(40)]
    odd = [(100, None), (101, ""), (102, "½ ² 12 !?"), (103, "der"), (104, "the and that " * 30_000), (None, "und"), (105, "the"), (105, "the")]
    docs = spark.createDataFrame(rows + [(i, t, None, None, None, None, None, None) for i, t in odd], schema)
    got = {}
    for r in language_id.identify(docs, F.lit(False), F.lit(True)).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert [got[i] for i in (100, 101, 102)] == [[("und", 0.0)]] * 3
    assert got[104][0][0] == "en" and len(got[105]) == 2 and got[105][0] == got[105][1]
    assert language_id.identify(docs.limit(0), F.lit(False), F.lit(True)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, F.lit(True), F.lit(False)).collect()} == {"und"}
    assert not language_id.has_letter("½²①_") and language_id.has_letter("1 ß")


def test_sample_is_whole_texts_and_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), 400).alias("text"), F.lit("en").alias("lang"))
    got = language_id.sample(docs, F.lit(True), 50)
    assert len(got) == 50 and set(got.text.str.len()) == {1200}


@pytest.fixture(scope="module")
def words():
    import pyarrow as pa

    texts = ["you are a stupid clown " * 9, "a fine day to walk", "", None, "x" * 50 + " é ü", "one"]
    raw, offsets = text_bytes(pa.array(texts))
    return raw, offsets, toxicity.read_words(raw, offsets)


def test_words_in_chunks_are_the_words(words, monkeypatch):
    raw, offsets, whole = words
    monkeypatch.setattr(toxicity, "LEARN_CHUNK", 30)
    parts = toxicity.read_all(raw, offsets)
    assert (parts.key[parts.word] == whole.key[whole.word]).all() and (parts.row == whole.row).all() and (parts.slots == whole.slots).all()
    for (a, x), (b, y) in zip(parts.grams, whole.grams, strict=True):
        assert sorted(zip(a, x, strict=True)) == sorted(zip(b, y, strict=True))


def test_recurrent_pass_against_plain_loops(words):
    raw, offsets, w = words
    net = toxicity.Network(4)
    at, of = toxicity.windows(w.row, len(offsets) - 1)
    z = net.logits(w, at)
    v, p, h = net.inputs(w), net.p, toxicity.HIDDEN
    sig = lambda x: 1 / (1 + np.exp(-x))
    for i, window in enumerate(at):
        seq = [v[w.word[j]].astype(float) for j in window if j >= 0]
        states = []
        for side, order in ((0, seq), (1, seq[::-1])):
            s, out = np.zeros(h), []
            for x in order:
                a, g = x @ p["w"][side] + p["b"][side, 0], s @ p["u"][side]
                keep, reset = sig(a[:h] + g[:h]), sig(a[h : 2 * h] + g[h : 2 * h])
                s = keep * s + (1 - keep) * np.tanh(a[2 * h :] + reset * g[2 * h :])
                out.append(s)
            states.append(out if side == 0 else out[::-1])
        both = np.array([np.concatenate(x) for x in zip(*states, strict=True)])
        e = np.exp(np.tanh(both @ p["a"] + p["ab"]) @ p["av"])
        want = (e / e.sum()) @ both @ p["o"] + p["ob"][0]
        assert abs(want - z[i]) < 1e-3


def test_every_word_is_in_a_window():
    for n in (1, 23, 24, 25, 40, 41, 100):
        at, _ = toxicity.windows(np.zeros(n, np.int64), 1)
        assert set(at[at >= 0].tolist()) == set(range(n))


def test_gradients_against_differences(words):
    _, offsets, w = words
    net = toxicity.Network(6)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    at, _ = toxicity.windows(w.row, len(offsets) - 1)
    mask = (at >= 0).astype(np.float64).T
    token = np.where(at >= 0, w.word[at], 0).T
    y, weight = np.arange(len(at)) % 2.0, np.ones(len(at))
    v = net.inputs(w).astype(np.float64)

    def loss(v):
        proj = net.project(v)
        z = net.run(np.stack([proj[0][token], proj[1][token[::-1]]]).astype(np.float64), mask)
        return np.mean(np.logaddexp(0, z) - y * z)

    g, dv = net.gradients(v, token, mask, y, weight)
    rng = np.random.default_rng(0)
    for name in ("w", "u", "b", "a", "ab", "av", "o", "ob"):
        flat = net.p[name].reshape(-1)
        for i in rng.integers(0, flat.size, 3):
            old, flat[i] = flat[i], flat[i] + 1e-3
            up = loss(v)
            flat[i] = old - 1e-3
            down = loss(v)
            flat[i] = old
            assert abs((up - down) / 2e-3 - np.asarray(g[name]).reshape(-1)[i]) < 2e-3, name
    i = token[0, 0]
    step = np.zeros_like(v)
    step[i, 2] = 1e-3
    assert abs((loss(v + step) - loss(v - step)) / 2e-3 - dv[i, 2]) < 2e-3


def test_toxicity_of_held_out_texts(spark):
    d = "/root/testdata/sf0.1"
    seen = queries.op4_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("held_out")
    yes, found, no, marked = seen.agg(
        *[F.expr(f"count_if({x})") for x in ("toxic = 1", "toxic = 1 and predicted = 1", "toxic = 0", "toxic = 0 and predicted = 1")]
    ).first()
    assert yes > 50 and found >= 0.85 * yes and marked <= 0.06 * no


def test_toxicity_of_odd_rows(spark):
    schema = "doc_id long, text string, y int, spot string, score string, predicted string"
    rows = [(i, ("you stupid clown go away " if i % 2 else "a calm walk in the green park ") * 6, 0, "", "", "") for i in range(60)]
    odd = [(None, "stupid"), (100, None), (101, ""), (102, "..."), (103, "calm park " * 50_000 + "you stupid clown go away " * 9), (104, "calm walk"), (104, "calm walk")]
    docs = spark.createDataFrame(rows + [(i, t, None, None, None, None) for i, t in odd], schema)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(60)] + [(None, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    got = [tuple(r) for r in toxicity.score(docs, labels, F.lit(False), F.lit(True)).collect()]
    by = {r[0]: r[2:] for r in got}
    assert len(got) == len(rows) + len(odd) and all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.5) for r in got)
    assert [by[i] for i in (100, 101, 102)] == [(0.0, 0)] * 3 and by[103][1] == 1 and by[104][1] == 0
    assert toxicity.score(docs.limit(0), labels, F.lit(False), F.lit(True)).count() == 0
    assert {r[2] for r in toxicity.score(docs, labels.limit(0), F.lit(False), F.lit(True)).select("doc_id", "held_out", "score").collect()} == {0.0}
