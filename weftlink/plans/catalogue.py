"""Registered queries over the derived companies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as nm
from ..functions.similarity import lev_sim, with_fuzzy
from ..operators import assign, blocking, evaluate, features, scoring
from ..sources import fixtures, tsv
from . import job, pipeline, stages
from .oracles import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
S2, S3 = 0.70, 0.75


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _records(spark, d):
    s1, t = fixtures.sources(spark, d)
    return s1.unionByName(t)


def _sides(spark, d):
    return pipeline.normalized(*fixtures.sources(spark, d))


def _scores(spark, d):
    return pipeline.scored(*_sides(spark, d))


def _rounded(df, *names):
    return df.select(*names[:2], *[F.round(F.col(c).cast("double"), 6).alias(c) for c in names[2:]])


@query
def record_scan(spark, d):
    return _records(spark, d).select(*tsv.FIELDS)


@query
def clean_string(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", nm.clean(F.col("text")).alias("cleaned"))


@query
def normalize_name(spark, d):
    return nm.normalize(_records(spark, d)).select("entity_id", "clean_name", "core_name", nm.token_sorted(F.col("clean_name")).alias("sorted_name"))


@query
def normalize_address(spark, d):
    return nm.normalize(_records(spark, d)).select("entity_id", "clean_addr")


@query
def extract_numbers(spark, d):
    return nm.normalize(_records(spark, d)).select("entity_id", F.array_join("nums", ",").alias("nums"), "primary_num")


@query
def char_ngrams(spark, d):
    return nm.normalize(_records(spark, d)).select("entity_id", F.array_join(F.array_sort(nm.char_ngrams(F.col("core_name"))), ",").alias("grams"))


@query
def country_share(spark, d):
    return tsv.country_share(fixtures.sources(spark, d)[0])


@query
def distinct_countries(spark, d):
    return tsv.countries(fixtures.sources(spark, d)[0])


@query
def ground_truth_links(spark, d):
    return fixtures.truth(spark, d)


@query
def blocking_keys_name(spark, d):
    return blocking.blocking_keys(nm.normalize(_records(spark, d)), address=False)


@query
def blocking_keys_address(spark, d):
    return blocking.blocking_keys(nm.normalize(_records(spark, d)), name=False)


@query
def blocking_keys_all(spark, d):
    return blocking.blocking_keys(nm.normalize(_records(spark, d)))


@query
def key_frequency(spark, d):
    return blocking.key_frequency(blocking.blocking_keys(_sides(spark, d)[1]))


@query
def active_keys(spark, d):
    return blocking.active_keys(blocking.blocking_keys(_sides(spark, d)[1])).select("entity_id", "country", "ktype", "kval")


@query
def candidate_pairs(spark, d):
    s1, t = _sides(spark, d)
    return blocking.candidate_pairs(blocking.blocking_keys(s1), blocking.active_keys(blocking.blocking_keys(t)))


@query
def candidate_topk(spark, d):
    return pipeline.candidates(*_sides(spark, d)).select("country", "s1_id", "tid", "shared_keys", "rank")


@query
def candidate_list(spark, d):
    s1, t = _sides(spark, d)
    return blocking.candidate_lists(s1, pipeline.candidates(s1, t))


@query
def candidate_recall(spark, d):
    return blocking.candidate_recall(fixtures.truth(spark, d), pipeline.candidates(*_sides(spark, d)))


def _pairs(spark, d):
    return pipeline.pairs(*_sides(spark, d))


def _fuzzy(spark, d):
    return with_fuzzy(_pairs(spark, d), "f", F.col("clean_name1"), F.col("clean_name2"))


@query
def sim_levenshtein(spark, d):
    return _pairs(spark, d).select("s1_id", "tid", F.round(lev_sim(F.col("clean_name1"), F.col("clean_name2")), 6).alias("sim"))


@query
def sim_jaro_winkler(spark, d):
    return _fuzzy(spark, d).select("s1_id", "tid", F.round("f.jw", 6).alias("sim"))


@query
def sim_token_ratios(spark, d):
    return _fuzzy(spark, d).select("s1_id", "tid", F.round("f.tsort", 6).alias("token_sort"), F.round("f.tset", 6).alias("token_set"))


@query
def features_native(spark, d):
    """The features that stay in the JVM."""
    return _rounded(pipeline.pair_features(*_sides(spark, d)), "s1_id", "tid", *[f for f in features.FEATURES if f not in features.PYTHON])


@query
def features_all(spark, d):
    return _rounded(pipeline.pair_features(*_sides(spark, d), python=True), "s1_id", "tid", *features.FEATURES)


@query
def score_linear(spark, d):
    return _rounded(scoring.linear(pipeline.pair_features(*_sides(spark, d))), "s1_id", "tid", "prob")


@query
def number_penalty(spark, d):
    return _rounded(_scores(spark, d), "s1_id", "tid", "prob")


@query
def threshold_filter(spark, d):
    return _rounded(assign.above_threshold(_scores(spark, d), S2, S3), "s1_id", "tid", "prob")


@query
def target_assignment(spark, d):
    return _rounded(assign.assign_targets(_scores(spark, d), S2, S3), "s1_id", "tid", "prob")


@query
def matching_results(spark, d):
    return pipeline.match(*fixtures.sources(spark, d), S2, S3, unique=True).select("s1_id", "matched")


@query
def singletons(spark, d):
    return pipeline.match(*fixtures.sources(spark, d), S2, S3, unique=True).filter("matched = ''").select("s1_id")


def _counts(spark, d):
    s1, _ = fixtures.sources(spark, d)
    return evaluate.entity_counts(s1, fixtures.truth(spark, d), assign.assign_targets(_scores(spark, d), S2, S3))


@query
def entity_f05(spark, d):
    return _counts(spark, d).select("s1_id", F.round(evaluate.f05(F.col("tp"), F.col("n_true"), F.col("n_pred")), 6).alias("f05"))


@query
def evaluation_metrics(spark, d):
    return evaluate.metrics(_counts(spark, d))


@query
def country_stats(spark, d):
    s1, t = fixtures.sources(spark, d)
    matched = assign.assign_targets(pipeline.scored(*pipeline.normalized(s1, t)), S2, S3).groupBy("s1_id").agg(F.count("*").alias("n"))
    rows = s1.select("country", F.col("entity_id").alias("s1_id")).join(matched, "s1_id", "left")
    out = rows.groupBy("country").agg(F.count("*").alias("total_s1"), F.count_if(F.col("n").isNull()).alias("singletons"), F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("matched_links"))
    return out.withColumns({"singleton_pct": F.round(100 * F.col("singletons") / F.col("total_s1"), 6), "avg_matches": F.round(F.col("matched_links") / F.col("total_s1"), 6)})


@query
def run_totals(spark, d):
    s1, t = _sides(spark, d)
    pairs = pipeline.pairs(s1, t)
    scores = scoring.number_penalty(scoring.linear(features.features(pairs, False))).select("country", "s1_id", "tid", "s1_ordinal", "prob")
    links = assign.assign_targets(scores, S2, S3)
    return job.totals(s1, links, pairs)


@query
def grid_global(spark, d):
    return evaluate.best_global(fixtures.sources(spark, d)[0], fixtures.truth(spark, d), stages.kept(_scores(spark, d)))


@query
def grid_source(spark, d):
    return evaluate.best_by_source(fixtures.sources(spark, d)[0], fixtures.truth(spark, d), stages.kept(_scores(spark, d)))


def _learn(c: str = "s1_id"):
    """Records whose pairs a model may learn from: half of them."""
    return F.crc32(F.col(c)) % 2 == 0


def _boosted(spark, d, kind):
    """All candidates scored by a model of the whole preset, fitted on all pairs of the records of _learn.

    The features of all candidates are computed once: they are kept, for the fit and the scores.
    """
    s1, t = _sides(spark, d)
    true = fixtures.truth(spark, d).filter(_learn()).groupBy(F.col("s1_id").alias("entity_id")).agg(F.collect_set("tid").alias("true"))
    sides = features.pair_sides(pipeline.candidates(s1, t), s1, t)
    read = ["country", "s1_id", "tid", "s1_ordinal", "primary_num1", "primary_num2"]
    rows = stages.kept(features.features(sides).select(*read, *[F.col(c).cast("float").alias(c) for c in features.FEATURES]))
    learnt = rows.filter(_learn()).join(true.withColumnRenamed("entity_id", "s1_id"), "s1_id", "left")
    learnt = learnt.withColumn("label", F.coalesce(F.array_contains("true", F.col("tid")), F.lit(False)).cast("double"))
    model = scoring.Matcher(kind).fit(learnt, key=["s1_id", "tid"])
    return scoring.number_penalty(model.score(rows, [*read, "name_exact_core"]))


@query
def gbt_scores(spark, d):
    """Boosted scores of all candidates."""
    return _boosted(spark, d, "xgboost").select("s1_id", "tid", F.round("prob", 6).alias("prob"), _learn().alias("learnt"))


@query
def gbt_matches(spark, d):
    return assign.assign_targets(_boosted(spark, d, "xgboost"), S2, S3).select("s1_id", "tid")


@query
def lgbm_preset_scores(spark, d):
    return _boosted(spark, d, "lightgbm").select("s1_id", "tid", F.round("prob", 6).alias("prob"), _learn().alias("learnt"))


@query
def gbt_metrics(spark, d):
    """Metrics on the records that the model didn't learn from, whose targets may go to any record."""
    links = stages.kept(assign.assign_targets(_boosted(spark, d, "xgboost"), S2, S3)).filter(~_learn())
    s1 = fixtures.sources(spark, d)[0].filter(~_learn("entity_id"))
    return evaluate.metrics(evaluate.entity_counts(s1, fixtures.truth(spark, d).filter(~_learn()), links))


def _files(spark, d, rows):
    """The rows as a record file, written into the folder that the cluster shares and read back."""
    path = stages.shared_path(spark, "records")
    body = rows.select(F.concat_ws("\t", *tsv.FIELDS).alias("value"), F.lit(1).alias("part"), "ordinal")
    head = spark.range(1).select(F.lit("\t".join(tsv.FIELDS)).alias("value"), F.lit(0).alias("part"), F.lit(None).cast("long").alias("ordinal"))
    body.union(head).repartitionByRange("part", "ordinal").sortWithinPartitions("part", "ordinal").select("value").write.text(f"{path}.parts")
    tsv.merge_parts(spark, f"{path}.parts", path)
    return path


@query
def tsv_scan(spark, d):
    """All records, by way of a file."""
    path = _files(spark, d, _records(spark, d))
    out = stages.kept(tsv.read_records(spark, path).select(*tsv.FIELDS))
    stages.remove(spark, path)
    return out


@query
def tsv_country(spark, d):
    """The records of one country, by way of a file."""
    path = _files(spark, d, _records(spark, d))
    out = stages.kept(tsv.read_records(spark, path, "ASIA").select(*tsv.FIELDS))
    stages.remove(spark, path)
    return out


@query
def tsv_targets(spark, d):
    """The last record of each target id, by way of two files of which the second repeats the ids with names in capitals, and one that isn't there."""
    targets = fixtures.sources(spark, d)[1]
    paths = [_files(spark, d, targets), stages.shared_path(spark, "absent"), _files(spark, d, targets.withColumn("business_name", F.upper("business_name")))]
    out = stages.kept(tsv.last_of_each(tsv.read_targets(spark, paths), tsv.IN_COUNTRY).select(*tsv.FIELDS))
    for path in paths:
        stages.remove(spark, path)
    return out


@query
def tsv_truth(spark, d):
    """The true links as written and read: a line per record that has any."""
    path = stages.shared_path(spark, "truth")
    rows = fixtures.truth(spark, d).groupBy("s1_id").agg(F.collect_list("tid").alias("ids")).withColumn("ordinal", F.col("s1_id"))
    tsv.write_lists(rows, path, "ids", "matched_entity_ids")
    tsv.merge_parts(spark, path, f"{path}.tsv")
    out = stages.kept(tsv.read_truth(spark, f"{path}.tsv").select("s1_id", F.array_join(F.array_sort("matched"), ",").alias("matched")))
    stages.remove(spark, f"{path}.tsv")
    return out


@query
def sorted_address(spark, d):
    return _records(spark, d).select("entity_id", nm.token_sorted_address(nm.clean(F.col("business_address"))).alias("sorted_addr"))


@query
def near_copy_documents(spark, d):
    """Documents by the first 40 characters of their cleaned text, as a blocking key: how many share it, and the first of them; over-frequent keys go."""
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.substring(nm.clean(F.col("text")), 1, 40).alias("kval")).filter("kval != ''")
    keys = stages.kept(blocking.active_keys(docs.select(F.col("doc_id").alias("entity_id"), F.lit("").alias("country"), F.lit("n_head").alias("ktype"), "kval")))
    shared = keys.groupBy("kval").agg(F.count("*").alias("postings"), F.min("entity_id").alias("first_doc"))
    return keys.join(shared, "kval").select(F.col("entity_id").alias("doc_id"), "postings", "first_doc")
