"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Each rule compares 100 * part with cutoff * whole, in integers. The labelled rows
are the holdout: nothing else is fitted on them. For each stratum (language) and
rule the cutoffs are tested from the loosest to the strictest; a cutoff is certified
if the exact binomial probability of so few falsely rejected good rows, were the
true rate RISK, is at most CONFIDENCE_LEFT / (strata * rules). Testing in a fixed
order needs no further correction inside a rule, and the division over strata and
rules is Bonferroni's. The last certified cutoff before the first failure is used;
a stratum or rule without one rejects nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .common import SEPARATOR, WORD, cut, packed, settled, unpacked

RISK = 0.01
CONFIDENCE_LEFT = 0.05
#: Cutoffs in percent, loosest first: characters that are symbols, of word characters; repeated lines, of lines with a word; capitals A to Z, of word characters.
RULES: dict[str, tuple[str, str, tuple[int, ...]]] = {
    "symbols": ("n_symbols", "word_chars", (40, 30, 25, 20, 15, 10, 8, 6)),
    "lines": ("n_dup_lines", "n_lines", (90, 80, 70, 60, 50)),
    "capitals": ("n_capitals", "word_chars", (60, 50, 40, 30, 25)),
}
#: Words in a window that n_repeat_words looks for.
SPAN = 5
BASE_WORDS = 10
BASE_REPEAT = 20


#: The names of what signals adds.
SIGNALS = ("q_words", "q_word_chars", "q_symbols", "q_dup_lines", "q_lines", "q_capitals", "q_repeat_words")


def signals(docs: DataFrame, repeats: bool = True) -> DataFrame:
    """docs (any columns but those named q_...) with SIGNALS; without q_repeat_words unless repeats. Null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumns({"q_parts": F.split(text, SEPARATOR), "q_l": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))})
    out = out.withColumns({
        "q_w": F.array_remove("q_parts", ""),
        "q_word_chars": (F.length(text) - F.size("q_parts") + 1).cast("long"),
        "q_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "q_capitals": F.regexp_count(text, F.lit("[A-Z]")).cast("long"),
        "q_lines": F.size("q_l").cast("long"),
        "q_dup_lines": (F.size("q_l") - F.size(F.array_distinct("q_l"))).cast("long"),
    }).drop("q_parts", "q_l")
    out = out.withColumn("q_words", F.size("q_w").cast("long"))
    if repeats:
        n = F.greatest(F.size("q_w") - (SPAN - 1), F.lit(0))
        windows = F.arrays_zip(*[F.slice("q_w", i + 1, n).alias(f"w{i}") for i in range(SPAN)])
        out = out.withColumn("q_h", F.transform(windows, lambda w: F.xxhash64(w)))
        out = out.withColumn("q_some", F.size(F.array_distinct("q_h")) < F.size("q_h"))
        # places of the windows in order of their hashes: equal ones are neighbours
        out = out.withColumn("q_s", F.when(F.col("q_some"), F.array_sort(F.transform("q_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        size = F.size("q_s")
        before = F.slice(F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.col("q_s")), 1, size)
        out = out.withColumn("q_n", F.when(F.col("q_some"), F.arrays_zip(F.col("q_s").alias("a"), before.alias("b"), F.slice("q_s", 2, size).alias("c"))))
        twice = F.filter("q_n", lambda x: x["a"]["h"].eqNullSafe(x["b"]["h"]) | x["a"]["h"].eqNullSafe(x["c"]["h"]))
        out = out.withColumn("q_p", F.when(F.col("q_some"), F.array_sort(F.transform(twice, lambda x: x["a"]["i"]))))
        gaps = F.arrays_zip(F.col("q_p").alias("a"), F.slice("q_p", 2, F.size("q_p")).alias("b"))
        covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, x: acc + F.least(F.lit(SPAN), F.coalesce(x["b"] - x["a"], F.lit(SPAN))))
        out = out.withColumn("q_repeat_words", F.when(F.col("q_some"), covered).otherwise(F.lit(0).cast("long")))
        out = out.drop("q_h", "q_some", "q_s", "q_n", "q_p")
    return out.drop("q_w")


PARTS = {"n_symbols": "q_symbols", "word_chars": "q_word_chars", "n_dup_lines": "q_dup_lines", "n_lines": "q_lines", "n_capitals": "q_capitals"}


def _log_gamma(x: Column) -> Column:
    """ln of gamma for x >= 1: Stirling's series at x + 8, brought back by the recurrence."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5)))
    return series - F.log(x * (x + 1) * (x + 2) * (x + 3)) - F.log((x + 4) * (x + 5) * (x + 6) * (x + 7))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), by exact terms from k downward while they can still matter.

    Below the mean a term is at most the one above it; beyond 40 standard deviations
    under k the rest is under a double's last place, so the sum grows as sqrt(n) only.
    """
    k, n = k.cast("double"), n.cast("double")
    top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    terms = F.least(k, F.ceil(40 * F.sqrt(n * (p * (1 - p)))) + 100).cast("int")
    ratio = (1 - p) / p
    steps = F.sequence(F.lit(0), terms)
    start = F.struct(F.lit(0.0).alias("s"), F.lit(1.0).alias("t"))
    total = F.aggregate(steps, start, lambda a, j: F.struct((a["s"] + a["t"]).alias("s"), (a["t"] * (k - j) / (n - k + j + 1) * ratio).alias("t")))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * total["s"]))


def cutoffs(rows: DataFrame, risk: float = RISK, left: float = CONFIDENCE_LEFT) -> DataFrame:
    """(stratum, rule, step, cutoff, n_good, rejected, tail, certified) for rows with signals, stratum and good.

    A row per stratum, rule and cutoff; step counts from 1, the loosest.
    """
    good = rows.filter("good")
    tests = [
        F.sum(F.when(100 * F.col(PARTS[a]) > c * F.col(PARTS[b]), 1).otherwise(0)).alias(f"{rule}_{i}")
        for rule, (a, b, cuts) in RULES.items() for i, c in enumerate(cuts, 1)
    ]
    counts = good.groupBy("stratum").agg(F.count("*").alias("n_good"), *tests)
    cells = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"), F.col(f"{rule}_{i}").alias("rejected"))
        for rule, (_, _, cuts) in RULES.items() for i, c in enumerate(cuts, 1)
    ])
    counts = cut(counts)  # a row per stratum
    strata = counts.count()
    each = counts.select("stratum", "n_good", F.inline(cells))
    each = each.withColumn("tail", binomial_tail(F.col("rejected"), F.col("n_good"), risk))
    return each.withColumn("certified", F.col("tail") <= left / (max(1, strata) * len(RULES)))


def certify(rows: DataFrame, risk: float = RISK, left: float = CONFIDENCE_LEFT) -> list[Row]:
    """(stratum, rule, cutoff) of what is certified: the strictest step before the first failure.

    Few rows whatever the input: a stratum needs hundreds of labelled good rows to certify anything.
    """
    each = cutoffs(rows, risk, left)
    steps = F.sort_array(F.collect_list(F.struct("step", "cutoff", "certified")))
    passed = each.groupBy("stratum", "rule").agg(steps.alias("s"))
    failed = F.filter("s", lambda x: ~x["certified"])
    count = F.when(F.size(failed) > 0, F.element_at(failed, 1)["step"] - 1).otherwise(F.size("s"))
    return passed.withColumn("count", count).filter("count > 0").select("stratum", "rule", F.expr("s[count - 1].cutoff").alias("cutoff")).collect()


def verdict(stratum: Column, found: list[Row]) -> Column:
    """Whether no certified rule rejects the row."""
    by: dict[tuple[str, int], list[str]] = {}
    for x in found:
        by.setdefault((x["rule"], x["cutoff"]), []).append(x["stratum"])
    rejects = [
        stratum.isin(strata) & (100 * F.col(PARTS[RULES[rule][0]]) > c * F.col(PARTS[RULES[rule][1]]))
        for (rule, c), strata in sorted(by.items())
    ]
    return ~reduce(lambda a, b: a | b, rejects, F.lit(False))


def stratum_of(docs: DataFrame) -> Column:
    """The language; null is a stratum of its own, apart from every text."""
    return F.when(F.col("lang").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("lang")))


def base_failed() -> Column:
    return (F.col("q_words") < BASE_WORDS) | (100 * F.col("q_repeat_words") > BASE_REPEAT * F.col("q_words"))


def good_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, good): an id is good if no row of labels gives it a quality other than 1; ids without any known quality are left out."""
    return labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("a"), (F.max("quality") == 1).alias("b")).select("doc_id", (F.col("a") & F.col("b")).alias("good"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, base_failed, kept) for every row of docs.

    Null text counts as empty and so fails the base. A null lang is a stratum of its
    own. With no or few labels nothing is certified and kept is not base_failed. A
    share that equals a cutoff isn't rejected. Texts of any length are read whole.
    Repeated rows count once each; an empty table gives an empty result. Reads
    doc_id, text and lang, and doc_id and quality of labels, whatever else there is.
    """
    rows = cut(signals(docs.select("doc_id", "text", stratum_of(docs).alias("stratum"))).drop("text"))
    found = certify(rows.join(good_ids(labels), "doc_id"))
    failed = base_failed()
    return rows.select(
        "doc_id", F.col("q_words").alias("n_words"), F.col("q_word_chars").alias("word_chars"), F.col("q_symbols").alias("n_symbols"), F.col("q_dup_lines").alias("n_dup_lines"),
        F.col("q_repeat_words").alias("n_repeat_words"), F.col("q_lines").alias("n_lines"), F.col("q_capitals").alias("n_capitals"),
        failed.alias("base_failed"), (~failed & verdict(F.col("stratum"), found)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that judge keeps, with docs' columns, whatever they are called; repeated rows stay together or go together.

    Null and empty texts go, as they fail the base. The text is read twice rather
    than shuffled or kept twice: once for the counts that the rules are certified
    on, once for the verdict.
    """
    light = signals(docs.select("doc_id", "text", stratum_of(docs).alias("stratum")), repeats=False).drop("text")
    found = certify(light.join(good_ids(labels), "doc_id"))
    rows = settled(signals(packed(docs, text=F.col("text"), stratum=stratum_of(docs))).drop("text"), *SIGNALS)
    return unpacked(rows.filter(~base_failed() & verdict(F.col("stratum"), found)))
