"""Boosted trees, the run over record files, its reports and its checks."""

import json
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftlink import __main__ as command
from weftlink.operators import boosting, features
from weftlink.operators.scoring import PRESETS, Matcher
from weftlink.plans import catalogue, job, pipeline, stages
from weftlink.sources import fixtures, reports, tsv

DATA = "/root/testdata/sf0.001"


def table(n=1500, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6)).astype(np.float32)
    x[:, 3:] = np.round(x[:, 3:])
    return x, ((x[:, 0] + x[:, 1] * x[:, 3]) > 0.3).astype(float)


def test_first_division_is_the_best_one():
    x, y = table(300)
    s = boosting.Settings(rounds=1, depth=1, rate=1.0, rows=1.0, columns=1.0)
    f = boosting.fit(x, y, None, s)
    best = (0.0, None)
    g, h = 0.5 - y, np.full(len(y), 0.25)
    score = lambda a, b: a**2 / (b + 1)
    for column in range(6):
        for t in np.unique(x[:, column])[:-1]:
            low = x[:, column] <= t
            gain = score(g[low].sum(), h[low].sum()) + score(g[~low].sum(), h[~low].sum()) - score(g.sum(), h.sum())
            if min(h[low].sum(), h[~low].sum()) >= 1 and gain > best[0] + 1e-9:
                best = (gain, (column, t))
    if len(np.unique(x[:, best[1][0]])) <= boosting.BINS:
        assert (f.feature[0], pytest.approx(f.threshold[0])) == best[1]
    low = x[:, f.feature[0]] <= f.threshold[0]
    want = np.where(low, -g[low].sum() / (h[low].sum() + 1), -g[~low].sum() / (h[~low].sum() + 1))
    assert np.allclose(f.margins(x), want)


@pytest.mark.parametrize("kind", sorted(PRESETS))
def test_presets_learn_repeat_and_obey_limits(kind):
    from dataclasses import replace

    x, y = table()
    s = replace(PRESETS[kind], rounds=60, rate=0.1)
    f = boosting.fit(x[:1000], y[:1000], None, s)
    assert ((f.probabilities(x[1000:]) > 0.5) == y[1000:]).mean() > 0.9
    again = boosting.fit(x[:1000], y[:1000], None, s)
    assert (f.threshold == again.threshold).all() and (f.value == again.value).all()
    ends = np.append(f.roots, len(f.feature))
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        assert not s.leaves or (f.feature[a:b] < 0).sum() <= s.leaves
    assert f.probabilities(x).dtype == np.float32
    rows = np.arange(1000)
    if s.least_rows > 1:  # without row sampling every leaf holds enough rows
        for root in f.roots[:5]:
            node = np.full(1000, root)
            for _ in range(s.depth):
                inner = f.feature[node] >= 0
                go = np.where(x[rows, f.feature[node]] <= f.threshold[node], f.left[node], f.right[node])
                node = np.where(inner, go, node)
            assert np.unique(node, return_counts=True)[1].min() >= s.least_rows


def test_weights_and_one_class():
    x, y = table(200)  # so few that every value is a bin of its own
    s = boosting.Settings(rounds=5, rows=1.0, columns=1.0)
    double = boosting.fit(np.concatenate([x, x[y == 1]]), np.concatenate([y, y[y == 1]]), None, s)
    weighted = boosting.fit(x, y, np.where(y == 1, 2.0, 1.0), s)
    assert np.allclose(double.margins(x), weighted.margins(x), atol=1e-6)
    assert boosting.fit(x, np.zeros(len(y)), None, s).probabilities(x).max() < 0.5
    assert boosting.fit(x[:1], y[:1], None, PRESETS["lightgbm"]).margins(x).std() == 0


@pytest.fixture(scope="module")
def pairs(spark):
    s1, t = pipeline.normalized(*fixtures.sources(spark, DATA))
    truth = fixtures.truth(spark, DATA).withColumn("label", F.lit(1.0))
    return stages.kept(pipeline.pair_features(s1, t, python=True).join(truth, ["s1_id", "tid"], "left").fillna(0.0, ["label"]))


def test_model_types_save_and_load(spark, pairs, tmp_path):
    with pytest.raises(ValueError, match="Unknown model type"):
        Matcher("forest")
    with pytest.raises(ValueError):
        Matcher().score(pairs)
    for kind in ("xgb", "xgboost", "xgb_gpu", "xgboost_gpu", "lightgbm"):
        assert Matcher(kind, rounds=3).settings.rounds == 3
    m = Matcher("lightgbm", rounds=20).fit(pairs)
    m.save(spark, str(tmp_path / "m"))
    got, want = (sorted((r["s1_id"], r["tid"], r["prob"]) for r in x.score(pairs).collect()) for x in (Matcher.load(spark, str(tmp_path / "m")), m))
    assert got == want and Matcher.load(spark, str(tmp_path / "m")).model_type == "lightgbm"
    assert m.score(pairs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        Matcher().fit(pairs.limit(0))


def test_a_score_returns_what_is_asked_for(spark, pairs):
    m = Matcher("xgboost", rounds=3).fit(pairs)
    few, every = m.score(pairs, ["s1_id", "tid", "name_exact_core"]), m.score(pairs)
    assert few.columns == ["s1_id", "tid", "name_exact_core", "prob"] and every.columns == [*pairs.columns, "prob"]
    assert sorted(few.collect()) == sorted(every.select(few.columns).collect())


def test_boosted_metrics_on_other_records(spark):
    m = catalogue.QUERIES["gbt_metrics"](spark, DATA).first()
    assert m["macro_f05"] > 0.9 and m["precision"] > 0.9


def test_a_model_is_fitted_on_all_rows(spark):
    names = features.FEATURES
    rows = spark.range(30_000).select("id", *[(F.col("id") % (i + 2) if i else F.col("id")).cast("float").alias(c) for i, c in enumerate(names)], (F.col("id") % 1000 < 337).cast("double").alias("label"))
    x, y = np.arange(30_000), (np.arange(30_000) % 1000 < 337).astype(float)
    m = Matcher("lightgbm", rounds=0).fit(rows)
    assert m.forest.base == pytest.approx(np.log(0.337 / 0.663), abs=1e-8)
    s = replace(PRESETS["xgboost"], rounds=4, rows=1.0)
    want = boosting.fit(np.stack([x if i == 0 else x % (i + 2) for i in range(len(names))], 1).astype(np.float32), y, None, s)
    for parts, dealt in ((1, rows), (3, rows.repartition(7, "id"))):
        got = Matcher("xgboost", rounds=4, rows=1.0).fit(dealt, parts=parts).forest
        assert got.as_dict() == want.as_dict()
    drawn = [Matcher("lightgbm", rounds=3, rows=0.5).fit(df, key=["id"], parts=parts).forest.as_dict() for parts, df in ((2, rows), (4, rows.orderBy(F.desc("id"))))]
    assert drawn[0] == drawn[1]


def test_bins_come_from_all_values():
    rng = np.random.default_rng(1)
    few = rng.integers(0, 200, 9000) / np.float32(7)
    close = np.float32(1) + rng.integers(0, 400, 9000).astype(np.float32) * np.float32(2**-23)
    x = np.stack([rng.normal(size=9000), few, close, np.where(rng.random(9000) < 0.9, 0.0, rng.normal(size=9000)), np.full(9000, -0.0), -few], 1).astype(np.float32)

    def count(bits, left, opened):
        tables = [np.zeros(len(o) << bits, np.int64) for o in opened]
        assert max(map(len, tables)) <= 1 << 16
        for part in np.array_split(x, 4):
            boosting.counted(part, bits, left, opened, tables)
        found = [np.flatnonzero(t) for t in tables]
        return [(o[i >> bits] << bits | i & ((1 << bits) - 1), t[i]) for o, i, t in zip(opened, found, tables, strict=True)]

    for column, edges in zip(x.T, boosting.bin_edges(count, len(x), 6), strict=True):
        every = np.unique(column)
        assert np.array_equal(edges, every if len(every) <= 256 else np.unique(np.quantile(column, np.linspace(0, 1, 257)[1:], method="higher")))


def write_files(spark, folder, model):
    s1, targets = fixtures.sources(spark, DATA)
    for name, rows in (("test_source1", s1), ("test_source2", targets.filter("entity_id like 'S2-%'")), ("test_source3", targets.filter("entity_id like 'S3-%'"))):
        lines = ["\t".join([r["entity_id"], r["business_name"], r["business_address"], r["country"]]) for r in rows.orderBy(F.desc("ordinal")).collect()]
        (folder / f"{name}.tsv").write_text("\n".join(["entity_id\tname\taddress\tcountry", *lines]) + "\n", encoding="utf-8")
    model.save(spark, str(folder / "model"))
    (folder / "meta.json").write_text(json.dumps({"optimal_s2_threshold": 0.6, "validation_f05": 0.94}))
    return job.Paths(str(folder), str(folder / "model"), str(folder / "meta.json"), str(folder / "out"))


@pytest.mark.parametrize("merge", [True, False])
def test_run_over_files(spark, pairs, tmp_path, merge):
    model = Matcher("xgboost", rounds=40, rate=0.2).fit(pairs)
    paths = write_files(spark, tmp_path, model)
    sections = job.run(spark, paths, top_k=5, merge=merge)
    assert job.violations(spark, paths, 5).collect() == []
    ids = [x.split("\t")[0] for x in (tmp_path / "test_source1.tsv").read_text().splitlines()[1:]]
    for name, header in (("matching_results.tsv", "matched_entity_ids"), ("candidate_pairs.tsv", "candidate_entity_ids")):
        files = [tmp_path / "out" / name] if merge else sorted((tmp_path / "out" / name).glob("part-*"))
        lines = [x for f in files for x in f.read_text().splitlines()]
        assert lines[0] == f"source1_entity_id\t{header}" and [x.split("\t")[0] for x in lines[1:]] == ids
    # the same as the job on tables, with the file's order
    scored = model.score(pairs)
    assert sections["Model Configuration"]["Optimal S2 Threshold"] == 0.6 and sections["Model Configuration"]["Optimal S3 Threshold"] == 0.75
    assert sections["Validation Performance"]["Validation Macro F0.5"] == 0.94 and sections["Validation Performance"]["Candidate Recall"] == "N/A"
    assert scored.count() > 0
    text = (tmp_path / "out" / "final_report.txt").read_text()
    assert text == (tmp_path / "out" / "metrics_summary.txt").read_text()
    assert f"  {'Total Source 1 Entities':<30}: {len(ids)}" in text and "    total_s1                 : " in text
    assert sum(c["total_s1"] for c in sections["Country Breakdown"].values()) == len(ids)


def test_checks_find_what_is_broken(spark, pairs, tmp_path):
    paths = write_files(spark, tmp_path, Matcher("xgboost", rounds=10, rate=0.3).fit(pairs))
    job.run(spark, paths, top_k=3)
    f, c = tmp_path / "out" / "matching_results.tsv", tmp_path / "out" / "candidate_pairs.tsv"
    for x in (f, c):
        (x.parent / f".{x.name}.crc").unlink()
    lines = f.read_text().splitlines()
    first = next(i for i, x in enumerate(lines) if x.split("\t")[1:] != [""] and i)
    lines[first] += ",S2-none"
    f.write_text("\n".join([*lines[:-1], lines[first]]) + "\n")
    c.write_text("\n".join(x + ",S2-1,S2-2,S2-3,S2-4" if i == 5 else x for i, x in enumerate(c.read_text().splitlines())) + "\n")
    found = {r["check"] for r in job.violations(spark, paths, 3).collect()}
    assert found >= {"a line per reference record in the matches", "matched ids exist", "matches are candidates", "a target at most once a country", "no more candidates than asked for"}


def test_missing_target_file(spark, pairs, tmp_path):
    paths = write_files(spark, tmp_path, Matcher("xgboost", rounds=5, rate=0.3).fit(pairs))
    (tmp_path / "test_source3.tsv").unlink()
    assert job.run(spark, paths)["Test Inference Results"]["Total S3 Matches"] == "0"


def test_command(spark, pairs, tmp_path, capsys, monkeypatch):
    paths = write_files(spark, tmp_path, Matcher("xgboost", rounds=5, rate=0.3).fit(pairs))
    args = ["--test-dir", paths.test_dir, "--model-path", paths.model, "--meta-path", paths.metadata, "--output-dir", paths.output, "--top-k", "4"]
    assert command.main(args) == 0 and "VALIDATION STATUS: PASS" in capsys.readouterr().out
    assert command.main([*args, "--no-validate", "--no-merge"]) == 0 and "VALIDATION" not in capsys.readouterr().out
    monkeypatch.chdir(tmp_path)
    assert command.default_folder() == "dataset/test"
    (tmp_path / "student_resource/dataset/test").mkdir(parents=True)
    assert command.default_folder() == "student_resource/dataset/test" == command.parser().parse_args([]).test_dir


def test_last_target_of_an_id_counts(spark):
    schema = "entity_id string, business_name string, business_address string, country string, ordinal long"
    s1 = spark.createDataFrame([("S1-1", "Blue Anvil", "1 Oak Road", "x", 0)], schema)
    old, new = ("S2-1", "Blue Anvil", "1 Oak Road", "x", 0), ("S2-1", "Red Kite", "7 Elm Lane", "x", 1)
    matched = lambda *t: pipeline.match(s1, spark.createDataFrame(list(t), schema)).first()["matched"]
    assert matched(old) == "S2-1" == matched((*new[:4], 0), (*old[:4], 1)) and matched(old, new) == ""


def test_report_forms():
    text = reports.final_report({"A": {"k": 1}, "B": ["x", "y"], "C": "plain"})
    assert "[A]\n  k                             : 1\n\n[B]\n  - x\n  - y\n\n[C]\n  plain\n" in text
    assert "  g:\n    a                        : 2\n" in reports.metrics_report({"A": {"g": {"a": 2}}})


def test_forms_of_ids(spark):
    df = spark.createDataFrame([(["b", "a", "b", None], "  b,a ", 3)], "a array<string>, t string, n long")
    assert df.select(*[tsv.joined_ids(df, c).alias(c) for c in df.columns]).first() == ("a,b", "b,a", "")
