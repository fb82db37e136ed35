"""Packing against a full dynamic programme and the tokenizer; mixing against plain Python; odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftlink.llm import packing, queries, source_mix


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.sampled_from([0.0, 1.0, 6.0])), min_size=1, max_size=40))
def test_cuts_cost_least(steps):
    length = 16
    position = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    price = np.array([0.0, *[p for _, p in steps]])
    waste = lambda n: 0 if n & (n - 1) == 0 else length - n
    best = [0.0]
    for j in range(1, len(position)):
        best.append(price[j] + min(best[i] + waste(int(position[j] - position[i])) for i in range(j) if position[j] - position[i] <= length))
    chosen = packing.choose_cuts(position, price, length)
    sizes = [int(position[b] - position[a]) for a, b in zip(chosen[:-1], chosen[1:], strict=True)]
    assert chosen[0] == 0 and chosen[-1] == len(position) - 1 and max(sizes) <= length
    assert sum(map(waste, sizes)) + sum(price[j] for j in chosen[1:]) == pytest.approx(best[-1])


@pytest.fixture(scope="module")
def encoders():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    return Tokenizer.from_file(path), packing.Encoder(path)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([" ", "\n", "  ", "\t", "'s", "é", "\x85", "\xa0", "1", "²", "<|endoftext|>", "日本", "शर्मा", "😀"]), st.text(max_size=5)), max_size=20).map("".join))
def test_ids_are_those_of_the_tokenizer(encoders, text):
    whole, own = encoders
    assert own.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_pieces_of_odd_rows(spark, encoders):
    whole, _ = encoders
    rnd = random.Random(1)
    texts = [None, "", "  ", "a<|endoftext|>b", "x" * 9000, "日本 " * 700, "One two. Three!\nFour? " * 4000] + [" ".join(rnd.choices(["a", "bee", "sea."], k=rnd.randint(1, 900))) for _ in range(30)]
    rows = [(i, t, 1, 2) for i, t in enumerate(texts)] + [(None, "no id", 1, 2), (50, "twice", 1, 2), (50, "twice", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, start int").repartition(3)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack_documents(docs, queries.tokenizer_path()).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t, *_ in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, packing.END]
        assert {r["doc_tokens"] for r in pieces[i]} == {len(ids)}
        mine = sorted(pieces[i], key=lambda r: r["start"])
        mine = mine[::2] if i == 50 else mine
        assert [r["start"] for r in mine] == [sum(r["length"] for r in mine[:k]) for k in range(len(mine))] and sum(r["length"] for r in mine) == len(ids)
        for r in mine:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert 0 < at <= packing.LENGTH
    total = sum(x for s in sequences.values() for _, x in s)
    padded = sum(n if n & (n - 1) == 0 else packing.LENGTH for n in (sum(x for _, x in s) for s in sequences.values()))
    assert padded - total < 0.1 * total
    assert packing.pack_documents(docs.limit(0), queries.tokenizer_path()).count() == 0


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(9)
    names = ["pass", "__rkey", "__tokens", "rkey", "row", "cuts", "whole", "nth", "size", "times"]
    schema = "doc_id long, text string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in names)
    rows = []
    for i in range(300):
        source = rnd.choice(["a", "a", "a", "b", "c", None, "", "é"])
        text = rnd.choice([None, "", " ", "\n".join(f"d{i}w{j}" for j in range(rnd.randint(1, 200))), "  ".join(f"d{i}w{j}" for j in range(rnd.randint(1, 90)))])
        rows.append((i, text, source, 5))
    rows += [rows[3]] * 3 + [(None, "no id at all " * 30, "b", 1), (7, "other text " * 50, "a", 1)]
    return spark.createDataFrame([(*r, *names) for r in rows], schema)


def test_mixed_rows_hold_the_words_taken(corpus):
    taken = Counter()
    for r in source_mix.mix(corpus).collect():
        taken[r["doc_id"], r["source"]] += r["taken"]
    mixed = source_mix.mixed_rows(corpus)
    assert mixed.columns == corpus.columns
    texts = defaultdict(list)
    for r in corpus.collect():
        texts[r["doc_id"], r["source"]].append(words(r["text"]))
    got = Counter()
    for r in mixed.collect():
        w = words(r["text"])
        assert w and r["n_chars"] == len(r["text"]) and tuple(r)[4:] == tuple(mixed.columns[4:])
        got[r["doc_id"], r["source"]] += len(w)
        here = [iter(t) for t in texts[r["doc_id"], r["source"]]]
        assert any(all(x in t for x in w) for t in here)  # words of the text, in its order
    assert got == Counter({k: n for k, n in taken.items() if n})
    assert source_mix.mixed_rows(corpus.limit(0)).count() == source_mix.mix(corpus.limit(0)).count() == 0
    assert source_mix.mixed_rows(corpus.filter("text is null")).count() == 0


def test_many_sources_and_few(corpus, monkeypatch, spark):
    few = sorted(map(str, source_mix.mix(corpus).collect()))
    from weftlink.llm import common

    monkeypatch.setattr(common, "FEW", 0)  # as if there were too many sources to broadcast
    assert sorted(map(str, source_mix.mix(corpus).collect())) == few
    each = spark.range(500).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(id % 7 as int))").alias("text"), F.col("id").cast("string").alias("source"))
    rows = source_mix.mix(each).collect()
    assert len(rows) == 500 and all(r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] + 1e-9 for r in rows)


def test_targets_by_resharing(spark):
    """Targets against the sharing done step by step."""
    for sizes in ([100, 0, 3, 50], [1, 1000, 1000], [5], [10, 10, 10, 10, 10], [0, 0]):
        rows = [(f"s{i:02}" if i else None, n) for i, n in enumerate(sizes)]
        order = sorted(rows, key=lambda r: (r[0] is None, r[0] or ""))
        weight = {s: source_mix.WEIGHTS[i % 3] for i, (s, _) in enumerate(order)}
        target, total = {}, 1.5 * sum(sizes)
        while True:
            free = [s for s, _ in order if s not in target]
            left = total - sum(target.values())
            share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            over = [s for s, n in order if s in share and share[s] > 2 * n]
            if not over:
                target |= share
                break
            target |= {s: 2.0 * n for s, n in order if s in over}
            if len(target) == len(order):
                break
        got = {r["source"]: r["target"] for r in source_mix.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
        assert got == pytest.approx(target)


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1000])
def test_permutations_are_permutations(spark, n):
    df = source_mix.permuted(spark.range(n).select(F.col("id").alias("x"), F.lit(n).cast("long").alias("n")), "x", "n", F.lit(77), 1)
    got = [r["x"] for r in df.collect()]
    assert sorted(got) == list(range(n)) and (n < 100 or got != list(range(n)))


def test_tokens_are_found_once(corpus):
    plan = source_mix.mixed_rows(corpus)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
