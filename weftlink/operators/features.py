"""The 36 features of a candidate pair. Sides are 1 (reference) and 2 (target)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import char_ngrams, tokens
from ..functions.similarity import gram_share, lev_sim, with_fuzzy

NAME = ["name_exact_clean", "name_exact_core", "name_lev_sim", "name_jw_sim", "name_token_sort", "name_token_set", "name_token_jaccard", "name_token_overlap", "name_len_diff", "name_len_ratio", "name_prefix_match", "name_char_3gram", "name_first_token_match", "name_first_token_conflict"]
ADDRESS = ["addr_has_val", "addr_exact_clean", "addr_lev_sim", "addr_jw_sim", "addr_token_sort", "addr_token_set", "addr_token_jaccard", "num_common_count", "num_has_match", "num_has_mismatch", "primary_num_match", "primary_num_mismatch", "primary_num_diff"]
CROSS = ["exact_core_no_addr", "cross_prod", "cross_sum", "cross_max", "cross_min", "name_high_but_num_conflict", "is_source2", "is_source3", "shared_keys_count"]
FEATURES = NAME + ADDRESS + CROSS
#: Features that need the Python similarities.
PYTHON = ["name_jw_sim", "name_token_sort", "name_token_set", "addr_jw_sim", "addr_token_sort", "addr_token_set", "cross_prod", "cross_sum", "cross_max", "cross_min", "name_high_but_num_conflict"]
SIDE = ["clean_name", "core_name", "clean_addr", "nums", "primary_num"]


def pair_sides(top: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Candidates with the normalised fields of both sides, suffixed 1 and 2."""
    left = s1.select("country", F.col("entity_id").alias("s1_id"), F.col("ordinal").alias("s1_ordinal"), *[F.col(c).alias(c + "1") for c in SIDE])
    right = targets.select("country", F.col("entity_id").alias("tid"), *[F.col(c).alias(c + "2") for c in SIDE])
    return top.join(left, ["s1_id", "country"]).join(right, ["tid", "country"])


def _flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def _jaccard(a: Column, b: Column) -> Column:
    """Of arrays without repeats."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(0.0)


def features(sides: DataFrame, python: bool = True) -> DataFrame:
    """sides with the feature columns; those of PYTHON only if asked for. Where Python runs, it counts the common 3-grams too."""
    c = F.col
    n1, n2, k1, k2, a1, a2 = (c(x) for x in ("clean_name1", "clean_name2", "core_name1", "core_name2", "clean_addr1", "clean_addr2"))
    out = sides.withColumns({"t1": F.array_distinct(tokens(k1)), "t2": F.array_distinct(tokens(k2)), "f1": F.substring_index(k1, " ", 1), "f2": F.substring_index(k2, " ", 1)})
    cores = (k1 != "") & (k2 != "")
    addr = (a1 != "") & (a2 != "")
    first = lev_sim(c("f1"), c("f2"))
    p1, p2 = c("primary_num1"), c("primary_num2")
    known = addr & p1.isNotNull() & p2.isNotNull()
    shared = F.size(F.array_intersect("nums1", "nums2"))
    on_addr = lambda x: F.when(addr, x).otherwise(0.0)
    long_len = F.greatest(F.length(n1), F.length(n2))
    as_number = lambda x: F.when(F.length(x) <= 38, x.try_cast("decimal(38,0)").cast("double")).otherwise(x.cast("double"))
    gap = F.when((F.length(p1) <= 17) & (F.length(p2) <= 17), F.abs(p1.cast("long") - p2.cast("long")).cast("double")).otherwise(F.abs(as_number(p1) - as_number(p2)))
    out = out.withColumns({
        "name_exact_clean": _flag((n1 == n2) & (n1 != "") & (n2 != "")),
        "name_exact_core": _flag((k1 == k2) & cores),
        "name_lev_sim": lev_sim(n1, n2),
        "name_token_jaccard": _jaccard(c("t1"), c("t2")),
        "name_token_overlap": F.when(cores, F.size(F.array_intersect("t1", "t2")) / F.least(F.size("t1"), F.size("t2"))).otherwise(0.0),
        "name_len_diff": F.abs(F.length(n1) - F.length(n2)).cast("double"),
        "name_len_ratio": F.when(long_len > 0, F.least(F.length(n1), F.length(n2)) / long_len).otherwise(0.0),
        "name_prefix_match": _flag((F.length(k1) >= 4) & (F.length(k2) >= 4) & (F.substring(k1, 1, 4) == F.substring(k2, 1, 4))),
        "name_char_3gram": gram_share(k1, k2) if python else _jaccard(char_ngrams(k1), char_ngrams(k2)),
        "name_first_token_match": _flag(cores & (first >= 0.80)),
        "name_first_token_conflict": _flag(cores & (first < 0.50)),
        "addr_has_val": _flag(a2 != ""),
        "addr_exact_clean": on_addr(_flag(a1 == a2)),
        "addr_lev_sim": on_addr(lev_sim(a1, a2)),
        "addr_token_jaccard": on_addr(_jaccard(F.array_distinct(tokens(a1)), F.array_distinct(tokens(a2)))),
        "num_common_count": on_addr(shared.cast("double")),
        "num_has_match": on_addr(_flag(shared > 0)),
        "num_has_mismatch": on_addr(_flag((shared == 0) & (F.size("nums1") > 0) & (F.size("nums2") > 0))),
        "primary_num_match": _flag(known & (p1 == p2)),
        "primary_num_mismatch": _flag(known & (p1 != p2)),
        "primary_num_diff": F.when(known, F.log1p(gap)).otherwise(0.0),
        "exact_core_no_addr": _flag((a2 == "") & (k1 == k2) & cores),
        "is_source2": _flag(c("tid").startswith("S2-")),
        "is_source3": _flag(c("tid").startswith("S3-")),
        "shared_keys_count": c("shared_keys").cast("double"),
    }).drop("t1", "t2", "f1", "f2")
    if not python:
        return out
    out = with_fuzzy(with_fuzzy(out, "nf", n1, n2), "af", F.when(addr, a1).otherwise(""), F.when(addr, a2).otherwise(""))
    ns = c("nf.tsort")
    eff = F.when(a2 != "", c("af.tsort")).otherwise(ns)
    out = out.withColumns({
        "name_jw_sim": c("nf.jw"), "name_token_sort": ns, "name_token_set": c("nf.tset"),
        "addr_jw_sim": c("af.jw"), "addr_token_sort": c("af.tsort"), "addr_token_set": c("af.tset"),
        "cross_prod": ns * eff, "cross_sum": ns + eff, "cross_max": F.greatest(ns, eff), "cross_min": F.least(ns, eff),
        "name_high_but_num_conflict": _flag((ns >= 0.75) & (c("primary_num_mismatch") == 1.0)),
    })
    return out.drop("nf", "af")
