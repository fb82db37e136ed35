"""Golden rows, similarities against plain definitions, and queries against their SQL."""

import glob
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftlink.functions import normalize as normalize_module
from weftlink.functions import similarity
from weftlink.functions.normalize import normalize
from weftlink.operators import assign, blocking, evaluate, scoring
from weftlink.plans import catalogue
from weftlink.plans.pipeline import match
from weftlink.sources import tsv

DATA = "/root/testdata/sf0.001"


def test_golden_names_and_addresses(spark):
    cases = [
        ("a", "https://www.Acme.co.in", "12bis Rd"), ("b", None, "0034 Oak St"), ("c", "Group Ltd", "No. 5 Main"), ("d", "The Blue Anvil", "numero 6"),
        ("e", "The", "1 st de la"), ("f", "", "null"), ("g", "réd Ärger ß", "000"),
    ]
    df = spark.createDataFrame(cases, "entity_id string, business_name string, business_address string")
    got = {r["entity_id"]: r for r in normalize(df).collect()}
    assert got["a"]["clean_name"] == "acme" and got["a"]["clean_addr"] == "12 bis road"
    assert (got["b"]["clean_name"], got["b"]["core_name"], got["b"]["nums"], got["b"]["primary_num"]) == ("", "", ["34"], "34")
    assert got["c"]["core_name"] == "group ltd" and got["c"]["nums"] == ["5"]
    assert got["d"]["core_name"] == "blue anvil" and got["d"]["nums"] == ["6"]
    assert got["e"]["core_name"] == "the" and got["e"]["clean_addr"] == "1 saint delaware louisiana"
    assert got["f"]["clean_addr"] == "" and got["f"]["primary_num"] is None
    assert got["g"]["clean_name"] == "red arger ss" and got["g"]["nums"] == ["0"]


@pytest.mark.parametrize(("ktype", "n", "kept"), [("n1", 250, True), ("n1", 251, False), ("sort_n", 100, True), ("sort_n", 101, False), ("addr_pair", 101, False), ("name_num", 250, True)])
def test_key_limits(spark, ktype, n, kept):
    keys = spark.range(n).selectExpr("cast(id as string) entity_id", "'x' country", f"'{ktype}' ktype", "'v' kval")
    assert (blocking.active_keys(keys).count() == n) is kept


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def plain_jaro_winkler(a, b):
    if not a or not b:
        return 0.0
    window = max(max(len(a), len(b)) // 2 - 1, 0)
    used, left = set(), []
    for i, c in enumerate(a):
        for j in range(max(0, i - window), min(len(b), i + window + 1)):
            if j not in used and b[j] == c:
                used.add(j)
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    swapped = sum(x != b[j] for x, j in zip(left, sorted(used), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    same = len(os.path.commonprefix([a[:4], b[:4]]))
    return jaro + same * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def plain_ratio(a, b):
    return 2 * plain_lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def plain_token_set(a, b):
    sa, sb = set(a.split()), set(b.split())
    if not sa or not sb:
        return 0.0
    both, ra, rb = " ".join(sorted(sa & sb)), " ".join(sorted(sa - sb)), " ".join(sorted(sb - sa))
    if both and (not ra or not rb):
        return 1.0
    # the parts that differ are compared; what is shared stands before both
    wa, wb = len(both) + bool(both) + len(ra), len(both) + bool(both) + len(rb)
    best = [1 - (len(ra) + len(rb) - 2 * plain_lcs(ra, rb)) / (wa + wb)]
    if both:
        best += [plain_ratio(both, f"{both} {ra}"), plain_ratio(both, f"{both} {rb}")]
    return max(best)


def test_string_kernels():
    rnd = random.Random(1)
    a = ["".join(rnd.choices("abcé ", k=rnd.choice([0, 1, 5, 30, 63, 64, 65, 140]))) for _ in range(400)]
    b = ["".join(c for c in x if rnd.random() < 0.8) + "".join(rnd.choices("abx", k=rnd.randint(0, 5))) for x in a]
    x, y = np.array(a, object), np.array(b, object)
    assert similarity.lcs_lengths(x, y).tolist() == [plain_lcs(*p) for p in zip(a, b, strict=True)]
    assert np.allclose(similarity.jaro_winkler(x, y), [plain_jaro_winkler(*p) for p in zip(a, b, strict=True)])
    assert abs(similarity.jaro_winkler(np.array(["martha"]), np.array(["marhta"]))[0] - 0.9611111) < 1e-6
    assert len(similarity.lcs_lengths(x[:0], y[:0])) == 0


def test_fuzzy_columns(spark):
    rnd = random.Random(2)
    word = lambda: rnd.choice(["oak", "mill", "st", "road", "12", "a", "bakery", "bakeri"])
    rows = [(" ".join(word() for _ in range(rnd.randint(0, 5))), " ".join(word() for _ in range(rnd.randint(0, 5)))) for _ in range(300)] + [(None, "a"), ("", ""), ("a", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    for r in similarity.with_fuzzy(df, "f", F.col("a"), F.col("b")).collect():
        a, b = r["a"] or "", r["b"] or ""
        want = (plain_jaro_winkler(a, b), plain_ratio(*(" ".join(sorted(x.split())) for x in (a, b))) if a and b else 0.0, plain_token_set(a, b))
        assert tuple(r["f"]) == pytest.approx(want), (a, b)


@pytest.mark.parametrize(
    ("text", "cleaned"),
    [
        ("L’Oréal", "l oreal"), ("foo–bar", "foo bar"), ("foo—bar", "foo bar"), ("a\xa0b", "a b"), ("“Quoted” Ltd…", "quoted ltd"), ("Łódź", "lodz"), ("Þór", "thor"),
        ("Straße", "strasse"), ("Œuvre", "oeuvre"), ("Ærø", "aero"), ("Ñandú", "nandu"), ("ħal Għargħur", "hal gharghur"), ("Đorđe", "dorde"), ("İzmir ı", "izmir i"),
        ("शर्मा Stores", "shrmaa stores"), ("राम", "raam"), ("ऑफिस १२", "onphis 12"), ("Москва", "moskva"), ("Щука", "shchuka"), ("Αθήνα", "athena"), ("ＡＢＣ１", "abc1"),
        ("5 °C", "5 degc"), ("½ pint", "1 2 pint"), ("a😀b", "ab"), ("漢字 x", "x"), ("No. 5 Main", "5 main"), ("№ 7", "7"), ("null", ""), ("", ""), (None, ""),
    ],
)
def test_cleaned_text(spark, text, cleaned):
    assert spark.createDataFrame([(text,)], "t string").select(normalize_module.clean(F.col("t"))).first()[0] == cleaned


def test_sorted_address(spark):
    got = spark.createDataFrame([("12 rd za x",)], "t string").select(normalize_module.token_sorted_address(F.col("t"))).first()[0]
    assert got == "12 road x zone activite"


def test_single_precision_thresholds(spark):
    rows = [("x", "a", f"S2-{i}", 0, p) for i, p in enumerate([0.70, 0.7000001, 0.75])]
    scores = spark.createDataFrame(rows, "country string, s1_id string, tid string, s1_ordinal long, prob double")
    kept = assign.above_threshold(scores.withColumn("prob", scoring.single(F.col("prob"))), 0.70, 0.75)
    assert sorted(r["tid"] for r in kept.collect()) == ["S2-1", "S2-2"]


def test_skewed_keys(spark, monkeypatch):
    monkeypatch.setattr(blocking, "HEAVY", 3)
    monkeypatch.setattr(blocking, "TOGETHER", 4)
    key = lambda name, k, v: [(f"{name}{i}", "x", "n1", v) for i in range(k)]
    schema = "entity_id string, country string, ktype string, kval string"
    s1 = spark.createDataFrame(key("a", 40, "hot") + key("b", 2, "cold") + key("c", 9, "gone"), schema)
    targets = spark.createDataFrame(key("t", 5, "hot") + key("u", 3, "cold") + key("v", 300, "gone") + key("w", 251, "too") + key("x", 260, "toos") + key("y", 255, "much") + key("z", 290, "many"), schema)
    active = blocking.active_keys(targets)
    assert active.count() == 8
    pairs = blocking.candidate_pairs(s1, active)
    assert sorted(map(str, pairs.collect())) == sorted(map(str, blocking.candidate_pairs(s1, active, 4).collect()))
    assert pairs.count() == 40 * 5 + 2 * 3 and pairs.filter("shared_keys != 1").count() == 0


def test_assignment_ties_and_thresholds(spark):
    rows = [("x", "b", "S2-1", 0, 0.9), ("x", "a", "S2-1", 1, 0.9), ("x", "a", "S3-1", 1, 0.74), ("x", "a", "Q-1", 1, 0.76)]
    scores = spark.createDataFrame(rows, "country string, s1_id string, tid string, s1_ordinal long, prob double")
    got = {(r["s1_id"], r["tid"]) for r in assign.assign_targets(scores, 0.70, 0.75).collect()}
    assert got == {("b", "S2-1"), ("a", "Q-1")}


def test_metrics_of_nothing(spark):
    s1 = spark.createDataFrame([("a",), ("b",)], "entity_id string")
    links = spark.createDataFrame([("b", "S2-1")], "s1_id string, tid string")
    none = links.limit(0)
    m = evaluate.metrics(evaluate.entity_counts(s1, none, none)).first()
    assert (m["macro_f05"], m["precision"], m["recall"], m["singleton_accuracy"]) == (1.0, 1.0, 0.0, 1.0)
    m = evaluate.metrics(evaluate.entity_counts(s1, none, links)).first()
    assert (m["macro_f05"], m["fp"], m["singletons_correct"]) == (0.5, 1, 1)


def test_record_files(spark, tmp_path):
    (tmp_path / "r.tsv").write_text('id\tn\ta\tc\ne1\tA "q"\t1 Rd\tFR\n\ne2\tB\n   \ne1\tC\t\tUS\textra\n')
    rows = tsv.read_records(spark, str(tmp_path / "r.tsv"))
    in_order = lambda x: [tuple(r)[:4] for r in x.orderBy("ordinal").collect()]
    assert in_order(rows) == [("e1", 'A "q"', "1 Rd", "FR"), ("e2", "B", "", ""), ("   ", "", "", ""), ("e1", "C", "", "US")]
    assert tsv.last_of_each(rows).filter("entity_id = 'e1'").first()["country"] == "US"
    (tmp_path / "many").mkdir()
    for i in range(3):  # a folder of files, each with a header; larger than one split each
        (tmp_path / "many" / f"p{i}.tsv").write_text("id\tn\ta\tc\n" + "".join(f"f{i}-{j}\tn\ta\tc\n" for j in range(400 - 100 * i)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert [r[0] for r in in_order(tsv.read_records(spark, str(tmp_path / "many")))] == [f"f{i}-{j}" for i in range(3) for j in range(400 - 100 * i)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "t.tsv").write_text("id\tm\na\tx,y,x\nb\t\nc\n")
    assert {r["s1_id"]: sorted(r["matched"]) for r in tsv.read_truth(spark, str(tmp_path / "t.tsv")).collect()} == {"a": ["x", "y"], "b": [], "c": []}
    matched = spark.createDataFrame([("b", 1, ""), ("a", 0, "x,y")], "s1_id string, ordinal long, matched string")
    tsv.write_lists(matched, str(tmp_path / "out"), "matched", "matched_entity_ids")
    lines = [x for f in sorted(glob.glob(f"{tmp_path}/out/part-*")) for x in open(f).read().splitlines()]
    assert lines == ["source1_entity_id\tmatched_entity_ids", "a\tx,y", "b\t"]


def test_empty_tables_match_nothing(spark):
    schema = "entity_id string, business_name string, business_address string, country string, ordinal long"
    some = spark.createDataFrame([("S1-1", "Acme", "1 Rd", "x", 0)], schema)
    assert [tuple(r) for r in match(some, some.limit(0)).collect()] == [("S1-1", 0, "")]


@pytest.mark.parametrize("name", ["normalize_name", "blocking_keys_all", "candidate_topk", "features_all", "sim_token_ratios", "matching_results", "evaluation_metrics", "grid_global", "run_totals", "tsv_targets", "tsv_truth"])
def test_queries_agree_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    want = con.execute(catalogue.ORACLES[name]).df()
    got = catalogue.QUERIES[name](spark, DATA).toPandas()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    plain = lambda d: sorted(tuple(round(float(x), 6) if isinstance(x, (int, float)) or hasattr(x, "dtype") else str(x) for x in r) for r in d[cols].itertuples(index=False, name=None))
    assert plain(got) == plain(want)


def test_common_grams_in_python_are_the_builtin_ones(spark):
    from weftlink.functions.normalize import char_ngrams
    from weftlink.functions.similarity import gram_share
    from weftlink.operators.features import _jaccard

    words = ["", "a", "ab", "abc", "abcd", "aaaa", "aaaaaa", "abab", "ababab", "acme tools", "acme tool", "tools acme", "é中😀", "é中😀é中😀", "x" * 70, "xy" * 40]
    rows = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    rows = rows.select("a", "b", gram_share(F.col("a"), F.col("b")).alias("got"), _jaccard(char_ngrams(F.col("a")), char_ngrams(F.col("b"))).alias("want"))
    assert [r for r in rows.collect() if r["got"] != r["want"]] == []
