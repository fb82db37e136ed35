"""Each stage of the corpus pipeline against plain Python on its own input, and the whole chain."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from weftlink.llm import queries, secrets

from .test_near_dedup import classes
from .test_rules import by_hand

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out.append(docs.collect())
    return out


def test_quality(spark, stages):
    marks = defaultdict(set)
    for r in spark.read.parquet(f"{DATA}/labels.parquet").collect():
        if r["quality"] is not None:
            marks[r["doc_id"]].add(r["quality"])
    rows = [(r["doc_id"], r["text"] or "", r["lang"], 0, 0, int(marks.get(r["doc_id"]) == {1})) for r in stages[0]]
    _, kept = by_hand(rows)
    want = []
    for r in stages[0]:
        w = words(r["text"])
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        if r["doc_id"] in kept and len(w) >= 10 and 100 * len(covered) <= 20 * len(w):
            want.append(tuple(r))
    assert sorted(map(tuple, stages[1])) == sorted(want) and 0 < len(want) < len(stages[0])


def test_near_duplicates(stages):
    of, _ = classes([(r["doc_id"], r["text"]) for r in stages[1]])
    assert sorted(map(tuple, stages[2])) == sorted(tuple(r) for r in stages[1] if of[r["doc_id"]] == r["doc_id"])
    assert len(stages[2]) < len(stages[1])


def test_secrets(stages):
    before = {r["doc_id"]: r for r in stages[2]}
    assert len(stages[3]) == len(stages[2])
    for r in stages[3]:
        old = before[r["doc_id"]]
        spans = secrets.find_spans(old["text"])
        assert (r["lang"], r["source"]) == (old["lang"], old["source"])
        if spans:
            hidden = {i for a, b, _ in spans for i in range(a, b)}
            assert re.sub(r"\[(?:ASSIGN|ACCESS|HEX|ENTROPY)\]", "", r["text"]) == "".join(c for i, c in enumerate(old["text"]) if i not in hidden)
            assert r["n_chars"] == len(r["text"]) and not secrets.find_spans(r["text"])
        else:
            assert r == old


def test_mix(spark, stages, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    spark.createDataFrame(stages[3], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "docs"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/docs/*.parquet')")
    want = {r[0]: r[4] for r in con.execute(queries.oracle_sql()["op8_source_mix"]).fetchall() if r[4]}
    texts = {r["doc_id"]: words(r["text"]) for r in stages[3]}
    got = Counter()
    for r in stages[4]:
        rest = iter(texts[r["doc_id"]])
        w = words(r["text"])
        assert w and all(x in rest for x in w) and r["n_chars"] == len(r["text"])
        got[r["doc_id"]] += len(w)
    assert got == want


def test_packing(stages):
    t = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter()
    for r in stages[4]:
        ids = [*t.encode(r["text"], add_special_tokens=False).ids, 0]
        want[r["doc_id"], len(ids)] += len(ids)
    pieces = defaultdict(list)
    got = Counter()
    for r in stages[5]:
        got[r["doc_id"], r["doc_tokens"]] += r["length"]
        pieces[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for s in pieces.values():
        s.sort()
        assert [a for a, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))] and sum(n for _, n in s) <= 1024
    by_crc = {r["ids_crc32"] for r in stages[5] if r["start"] == 0 and r["length"] == r["doc_tokens"]}
    known = {zlib.crc32(np.array([*t.encode(r["text"], add_special_tokens=False).ids, 0], "<u4").tobytes()) for r in stages[4]}
    assert by_crc <= known


def test_columns(spark, stages):
    for rows in stages[1:5]:
        assert rows[0].__fields__ == COLUMNS


def test_run_gives_the_stages_rows_and_leaves_no_folder(spark, stages):
    import os

    got = corpus_pipeline.run(spark, DATA)
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in got.collect()).keys() == Counter((r["doc_id"], r["doc_tokens"]) for r in stages[5]).keys()
    assert sum(r["length"] for r in got.collect()) == sum(key(r)[2] for r in stages[5])
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert not [x for x in os.listdir(root) if x.startswith(("pipeline-", "components-", "warc-"))]


def test_odd_documents(spark, tmp_path):
    """Nulls everywhere, repeated rows, extra columns with names that stages use, and no rows at all."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, text + " x", None, None), (None, text.replace("w", "v"), None, "b"), (3, None, None, None), (4, "", "", ""), (5, "z " * 50_000, "en", "a"), (6, " ".join(f"q{i}" for i in range(3000)), "en", "a")]
    names = ["pass", "q_w", "q_words", "__one", "__tkey", "__before", "__rkey", "row", "rkey", "tkey", "stratum", "label", "salt"]
    docs = spark.createDataFrame([(*r, 0, *names) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in names))
    for k, frame in enumerate((docs, docs.limit(0))):
        at = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, at, DATA)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
                assert all(tuple(r)[5:] == tuple(names) for r in out.collect())
            out.write.parquet(f"{tmp_path}/{k}-{name}")
            at = spark.read.parquet(f"{tmp_path}/{k}-{name}")
        assert (at.count() > 0) == (k == 0)
