"""Blocking: keys of a record, removal of over-frequent keys, and the candidates that share most keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions.normalize import listed, tokens
from ..plans.stages import kept

#: Postings that a key may have among the targets of a country: by the key type's first letters, else the other limit.
NAME_LIMIT, OTHER_LIMIT = 250, 100
NAME_TYPES = "^(n|core|compact)"
TOP_K = 20
KEY = ["country", "ktype", "kval"]
#: Keys that are sent to every task at most, and records of a key that stay together.
HEAVY = 10_000
TOGETHER = 100_000
NONE = "array<struct<ktype:string,kval:string>>"


def _keys(kind: str, values: Column, when: Column) -> Column:
    """Keys of one type from an array of values."""
    made = F.transform(values, lambda v: F.struct(F.lit(kind).alias("ktype"), v.alias("kval")))
    return F.when(when, made).otherwise(F.array().cast(NONE))


def _tied(a: Column, b: Column) -> Column:
    return F.concat_ws("_", a, b)


def name_keys(n: Column, core: Column) -> list[Column]:
    """Keys of the core name; n is the array of its words."""
    joined = F.array_join(n, "")
    get = lambda i: F.try_element_at(n, F.lit(i))
    return [
        _keys("compact_n", F.array(joined), F.length(joined) >= 4),
        _keys("compact_sort_n", F.array(F.array_join(F.array_sort(n), "")), F.length(joined) >= 4),
        _keys("core_n", F.array(core), F.length(core) >= 3),
        _keys("n2", F.array(_tied(get(1), get(2))), F.size(n) >= 2),
        _keys("sort_n", F.array(F.array_join(F.array_sort(n), " ")), F.size(n) >= 2),
        _keys("n1", F.array(get(1)), (F.size(n) == 1) & (F.length(get(1)) >= 3)),
        _keys("n_tok", F.filter(n, lambda t: (F.length(t) >= 4) & ~listed(t, lx.LEGAL_SUFFIXES + lx.ARTICLES)), F.lit(True)),
    ]


def rare_words(a: Column) -> Column:
    """The address words that aren't common, short or numbers."""
    return F.filter(a, lambda t: ~listed(t, lx.COMMON_ADDRESS_WORDS) & (F.length(t) >= 3) & ~t.rlike("^[0-9]+$"))


def address_keys(n: Column, a: Column, rare: Column, nums: Column) -> list[Column]:
    """Keys that use the expanded address's words a, the rare ones of them, and numbers, some with the name's first words."""
    last, second = F.try_element_at(a, F.lit(-1)), F.try_element_at(a, F.lit(-2))
    one, two = F.try_element_at(n, F.lit(1)), F.try_element_at(n, F.lit(2))
    has = F.size(nums) > 0
    by_num = lambda f: F.transform(nums, f)
    streets = F.flatten(F.transform(nums, lambda x: F.transform(F.slice(rare, 1, 3), lambda w: _tied(x, w))))
    pairs = F.filter(
        F.array(*[
            F.when(F.size(rare) >= j, F.array_join(F.array_sort(F.array(F.try_element_at(rare, F.lit(i)), F.try_element_at(rare, F.lit(j)))), "_"))
            for i in range(1, 4) for j in range(i + 1, 5)
        ]),
        lambda x: x.isNotNull(),
    )
    return [
        _keys("num_city1", by_num(lambda x: _tied(x, last)), has & (F.size(a) >= 1)),
        _keys("num_city2", by_num(lambda x: _tied(x, second)), has & (F.size(a) >= 2)),
        _keys("num_street", streets, has),
        _keys("name_num", by_num(lambda x: _tied(one, x)), F.size(n) >= 1),
        _keys("name_num2", by_num(lambda x: _tied(two, x)), F.size(n) >= 2),
        _keys("name_city", F.array(_tied(one, last)), (F.size(n) >= 1) & (F.size(a) >= 1)),
        _keys("name_city2", F.array(_tied(one, second)), (F.size(n) >= 1) & (F.size(a) >= 2)),
        _keys("addr_pair", pairs, F.lit(True)),
    ]


def blocking_keys(normalized: DataFrame, name: bool = True, address: bool = True) -> DataFrame:
    """(entity_id, country, ktype, kval): the distinct keys of each normalised record."""
    rows = normalized.select("entity_id", "country", "core_name", tokens(F.col("core_name")).alias("n"), tokens(F.col("clean_addr")).alias("a"), "nums")
    # a column of its own: the keys name it some twenty times
    rows = rows.withColumn("rare", rare_words(F.col("a")))
    made = (name_keys(F.col("n"), F.col("core_name")) if name else []) + (address_keys(F.col("n"), F.col("a"), F.col("rare"), F.col("nums")) if address else [])
    return rows.select("entity_id", "country", F.inline(F.array_distinct(F.concat(*made))))


def key_limit(name_limit: int = NAME_LIMIT, other_limit: int = OTHER_LIMIT) -> Column:
    return F.when(F.col("ktype").rlike(NAME_TYPES), name_limit).otherwise(other_limit)


def key_frequency(target_keys: DataFrame) -> DataFrame:
    """(country, ktype, kval, postings): counted with partial sums, so a key in a third of all rows is no burden."""
    return target_keys.groupBy(*KEY).agg(F.count("*").alias("postings"))


def heaviest(counts: DataFrame, column: str, most: int = HEAVY) -> DataFrame:
    """The ``most`` keys with the largest counts. Every other key has at most one in ``most`` of all rows, however the data lie."""
    return counts.orderBy(F.desc(column), *KEY).limit(most)


def active_keys(target_keys: DataFrame, name_limit: int = NAME_LIMIT, other_limit: int = OTHER_LIMIT) -> DataFrame:
    """Target keys less those with more postings than their limit.

    Over-frequent keys are counted first. Up to HEAVY of them go by a broadcast; of
    more, the heaviest do, so that their rows meet in no task, and the others by an
    ordinary anti join.
    """
    hot = kept(key_frequency(target_keys).filter(F.col("postings") > key_limit(name_limit, other_limit)))
    if hot.count() <= HEAVY:
        return target_keys.join(F.broadcast(hot.select(*KEY)), KEY, "left_anti")
    rest = target_keys.join(F.broadcast(heaviest(hot, "postings").select(*KEY)), KEY, "left_anti")
    return rest.join(hot.select(*KEY), KEY, "left_anti")


def candidate_pairs(s1_keys: DataFrame, active: DataFrame, records: int | None = None) -> DataFrame:
    """(country, s1_id, tid, shared_keys) for records and targets that share an active key.

    An active key has few targets but may have any number of records. Unless there are
    at most TOGETHER records in all, the rows of the heaviest keys are dealt over parts
    of about that many, and the targets repeated in each.
    """
    left, right = s1_keys.withColumnRenamed("entity_id", "s1_id"), active.withColumnRenamed("entity_id", "tid")
    key = KEY[::-1]  # rows are sorted by the first, which tells most apart
    if records is None or records > TOGETHER:
        counts = left.groupBy(*KEY).agg(F.count("*").alias("n")).filter(F.col("n") > TOGETHER)
        parts = F.broadcast(heaviest(counts, "n").select(*KEY, F.ceil(F.col("n") / TOGETHER).cast("int").alias("parts")))
        n, key = F.coalesce("parts", F.lit(1)), [*key, "part"]
        left = left.join(parts, KEY, "left").withColumn("part", F.pmod(F.hash("s1_id"), n)).drop("parts")
        right = right.join(parts, KEY, "left").withColumn("part", F.explode(F.sequence(F.lit(0), n - 1))).drop("parts")
    # dealt by record at once: counting and ranking need no further exchange, and few pairs would meet before one
    return left.join(right, key).select("country", "s1_id", "tid").repartition("s1_id", "country").groupBy("country", "s1_id", "tid").agg(F.count("*").alias("shared_keys"))


def top_candidates(pairs: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k targets of each record with most shared keys, ties by tid; rank counts from 1."""
    order = Window.partitionBy("s1_id", "country").orderBy(F.desc("shared_keys"), "tid")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def candidate_lists(s1: DataFrame, top: DataFrame) -> DataFrame:
    """(s1_id, candidates): comma-joined in rank order; '' for records without any."""
    lists = top.groupBy("s1_id").agg(F.array_sort(F.collect_list(F.struct("rank", "tid"))).alias("c"))
    return s1.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left").select("s1_id", F.coalesce(F.array_join("c.tid", ","), F.lit("")).alias("candidates"))


def candidate_recall(truth: DataFrame, top: DataFrame) -> DataFrame:
    """Share of true links among the candidates."""
    hit = truth.join(top.select("s1_id", "tid").withColumn("hit", F.lit(1)), ["s1_id", "tid"], "left")
    return hit.agg(F.count("*").alias("true_links"), F.count("hit").alias("found_links"), F.round(F.count("hit") / F.count("*"), 6).alias("candidate_recall"))
