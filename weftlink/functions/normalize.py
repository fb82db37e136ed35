"""Names and addresses in a form that compares: Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicon as lx
from .transliterate import ascii_text


def listed(t: Column, words) -> Column:
    """Whether the word is in a fixed list; one look into a hash set, however long the list is."""
    return t.isin(*sorted(set(words)))


def clean(c: Column) -> Column:
    """Lower-case ASCII words of a name or address; '' for null and the word null. Other scripts are spelt in ASCII."""
    s = F.lower(ascii_text(F.when(c.isNull() | (c == "null"), "").otherwise(c)))
    for pattern, new in lx.CLEANING:
        s = F.regexp_replace(s, pattern, new.replace("\\", "$"))
    return F.trim(s)


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def core_name(cleaned: Column) -> Column:
    """The name without legal words (unless nothing else is left) and without one leading article."""
    every = tokens(cleaned)
    kept = F.filter(every, lambda t: ~listed(t, lx.LEGAL_SUFFIXES))
    kept = F.when(F.size(kept) > 0, kept).otherwise(every)
    drop = (F.size(kept) > 1) & listed(F.element_at(kept, 1), lx.ARTICLES)
    return F.array_join(F.when(drop, F.slice(kept, 2, F.greatest(F.size(kept), F.lit(1)))).otherwise(kept), " ")


def expand_address(cleaned: Column) -> Column:
    """The cleaned address's words with abbreviations and state codes written out; an array."""
    words = F.str_to_map(F.lit(",".join(f"{a}:{b}" for a, b in lx.EXPANSIONS.items())), F.lit(","), F.lit(":"))
    return F.transform(tokens(cleaned), lambda t: F.when(listed(t, lx.EXPANSIONS), F.try_element_at(words, t)).otherwise(t))


def numbers(cleaned: Column) -> Column:
    """Whole numbers of the text in order, without leading zeros."""
    found = F.regexp_extract_all(cleaned, F.lit(r"\b(\d+)\b"), F.lit(1))
    return F.transform(found, lambda x: F.when(F.ltrim(x, F.lit("0")) == "", "0").otherwise(F.ltrim(x, F.lit("0"))))


def char_ngrams(c: Column, n: int = 3) -> Column:
    """Distinct n-grams; a shorter text is its own only one; '' has none."""
    at = F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1)))
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(at, lambda i: F.substring(c, i, F.lit(n)))))


def token_sorted(c: Column) -> Column:
    return F.array_join(F.array_sort(tokens(c)), " ")


def token_sorted_address(cleaned: Column) -> Column:
    """The expanded words in order; an abbreviation that stands for two words is one."""
    return F.array_join(F.array_sort(expand_address(cleaned)), " ")


def normalize(records: DataFrame) -> DataFrame:
    """records (entity_id, business_name, business_address, ...) with clean_name, core_name, clean_addr, nums and primary_num."""
    out = records.withColumns({"clean_name": clean(F.col("business_name")), "__addr": clean(F.col("business_address"))})
    out = out.withColumns({"core_name": core_name(F.col("clean_name")), "clean_addr": F.array_join(expand_address(F.col("__addr")), " "), "__nums": numbers(F.col("__addr"))})
    return out.withColumns({"nums": F.array_distinct("__nums"), "primary_num": F.try_element_at("__nums", F.lit(1))}).drop("__addr", "__nums")
