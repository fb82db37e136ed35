"""The linkage job: normalise, block, score, assign. Normalised records and pairs are computed once; the other steps are lazy."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..functions.normalize import normalize
from ..operators import assign, blocking, features, scoring
from ..sources.tsv import IN_COUNTRY, last_of_each
from .stages import kept


def normalized(s1_records: DataFrame, target_records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides normalised once: blocking, features and assignment read them again."""
    return kept(normalize(s1_records)), kept(normalize(target_records))


def pairs(s1: DataFrame, targets: DataFrame, k: int = blocking.TOP_K) -> DataFrame:
    """Top candidates with both sides' fields. Kept, so the feature expressions aren't planned anew after each shuffle."""
    return kept(features.pair_sides(candidates(s1, targets, k), s1, targets))


def candidates(s1: DataFrame, targets: DataFrame, k: int = blocking.TOP_K) -> DataFrame:
    """Top candidates of normalised records among normalised targets."""
    active = blocking.active_keys(blocking.blocking_keys(targets))
    return blocking.top_candidates(blocking.candidate_pairs(blocking.blocking_keys(s1), active, s1.count()), k)


def pair_features(s1: DataFrame, targets: DataFrame, python: bool = False, k: int = blocking.TOP_K) -> DataFrame:
    return features.features(pairs(s1, targets, k), python)


def scored(s1: DataFrame, targets: DataFrame, scorer: Callable[[DataFrame], DataFrame] = scoring.linear, python: bool = False) -> DataFrame:
    """(country, s1_id, tid, s1_ordinal, prob) of all candidates, after the street-number penalty."""
    out = scoring.number_penalty(scorer(pair_features(s1, targets, python)))
    return out.select("country", "s1_id", "tid", "s1_ordinal", "prob")


def match(s1_records: DataFrame, target_records: DataFrame, s2: float = 0.70, s3: float = 0.75, scorer: Callable[[DataFrame], DataFrame] = scoring.linear, python: bool = False, unique: bool = False) -> DataFrame:
    """(s1_id, ordinal, matched) for every reference record. Of targets that repeat an id in a country the last one counts; unique says that none does."""
    s1, targets = normalized(s1_records, target_records if unique else last_of_each(target_records, IN_COUNTRY))
    return assign.match_lists(s1, assign.assign_targets(scored(s1, targets, scorer, python), s2, s3))
