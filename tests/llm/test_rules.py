"""Quality rules: counts, certified cutoffs and verdicts against plain Python; plans; odd rows."""

import re
from math import comb

import pytest
from pyspark.sql import functions as F

from weftlink.llm import quality_rules as qr


def labelled(spark, n=1200):
    """Texts of 20 words; every 40th good one has many symbols, every bad one too; language xx has few rows."""
    rows = []
    for i in range(n):
        good = i % 3 != 0
        lang = "xx" if i % 50 == 7 else None if i % 2 else "en"
        words = [f"word{i}x{j}" for j in range(20)]
        if not good or i % 400 == 1:
            words = [w + "####" for w in words]
        rows.append((i, " ".join(words), lang, "s", 1, int(good)))
    docs = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame([(r[0], r[5], 0) for r in rows], "doc_id long, quality int, toxic int"), rows


def by_hand(rows):
    """Kept ids by plain Python."""
    tail = lambda k, n: 1.0 if k >= n * qr.RISK else sum(comb(n, i) * qr.RISK**i * (1 - qr.RISK) ** (n - i) for i in range(k + 1))
    counts = {}
    for i, text, lang, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        counts[i] = {"n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "word_chars": sum(map(len, w)), "n_dup_lines": 0, "n_lines": 1, "n_capitals": len(re.findall("[A-Z]", text)), "stratum": lang}
    good = [counts[r[0]] for r in rows if r[5]]
    strata = {c["stratum"] for c in good}
    found = {}
    for s in strata:
        mine = [c for c in good if c["stratum"] == s]
        for rule, (a, b, cuts) in qr.RULES.items():
            for c in cuts:
                k = sum(100 * x[a] > c * x[b] for x in mine)
                if tail(k, len(mine)) > qr.CONFIDENCE_LEFT / (len(strata) * len(qr.RULES)):
                    break
                found[s, rule] = c
    rejected = {i for i, c in counts.items() for rule, (a, b, _) in qr.RULES.items() if (c["stratum"], rule) in found and 100 * c[a] > found[c["stratum"], rule] * c[b]}
    return found, set(counts) - rejected


def test_certified_rules_reject_and_spare(spark):
    docs, labels, rows = labelled(spark, 4800)
    found, kept = by_hand(rows)
    assert found and len(kept) < len(rows) and not any(s == "xx" for s, _ in found)
    assert {r["doc_id"] for r in qr.judge(docs, labels).filter("kept").collect()} == kept
    assert {r["doc_id"] for r in qr.keep_good(docs, labels).collect()} == kept


def test_false_rejection_is_within_the_risk(spark):
    """Over repeated holdouts of a rule that rejects good rows at just over the risk, certification is rare."""
    rnd = __import__("random").Random(4)
    rows = [(f"s{t}", sum(rnd.random() < qr.RISK * 1.05 for _ in range(1500)), 1500) for t in range(400)]
    df = spark.createDataFrame(rows, "s string, k long, n long")
    passed = df.filter(qr.binomial_tail(F.col("k"), F.col("n"), qr.RISK) <= qr.CONFIDENCE_LEFT).count()
    assert passed <= 0.08 * len(rows)


def test_plan_holds_each_count_once(spark):
    docs, labels, _ = labelled(spark, 60)
    plan = qr.keep_good(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2 and plan.count("xxhash64") == 1


def test_odd_rows_and_names(spark):
    names = ["q_w", "q_l", "q_words", "q_symbols", "row", "stratum", "good", "pass", "cutoff"]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in names)
    ok = " ".join(f"w{i}" for i in range(30))
    texts = [(1, ok, None), (1, ok, None), (2, None, "en"), (3, "", ""), (None, ok, ""), (4, "w " * 200_000, "en"), (5, "\n\n\t", None), (6, ok + "\x0b" + ok, "en")]
    docs = spark.createDataFrame([(*t, *names) for t in texts], schema)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    got = qr.keep_good(docs, labels)
    assert got.columns == docs.columns and all(tuple(r)[3:] == tuple(names) for r in got.collect())
    assert sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 1, 1]
    judged = qr.judge(docs, labels)
    assert judged.count() == len(texts) and judged.filter("kept and base_failed").count() == 0
    assert qr.judge(docs.limit(0), labels).count() == qr.keep_good(docs.limit(0), labels).count() == 0
    assert qr.judge(docs, labels.limit(0)).filter("kept").count() == 3


@pytest.mark.parametrize("text", ["a b c d e a b c d e", "a a a a a a a", "x\ty\nz  x y z x y z", "é " * 12, "one"])
def test_repeat_words(spark, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
    r = qr.signals(spark.createDataFrame([(text,)], "text string")).first()
    assert (r["q_repeat_words"], r["q_words"], r["q_word_chars"]) == (len(covered), len(w), sum(map(len, w)))
