"""Mixing sources to target weights, in DataFrame operations only.

Each source's documents, in a hashed order, are one stream of words cut into blocks
of BLOCK words. A mix has as many slots as the targets need blocks. Output shards
hold SHARD slots; the number of a shard's slots that go to each source is a
multinomial draw, taken from an urn that holds each source's slots, so that the
draws of all shards add up to the targets (independent draws would miss small
sources by several percent and could exceed twice a source). A source's slots are
numbered over the shards; slot q reads block perm_e(q mod n), e = q div n, where
perm_e is the source's pseudorandom permutation of its n blocks in pass e. Slots
and blocks are joined by source and block index.

Permutations are swap-or-not networks: a round swaps x with (key - x) mod n or not,
by a bit that is the same for both, and so is exact for every n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import SPACE, WORD, beside, cut, packed, setting, unpacked, word_count

BLOCK = 32
SHARD = 4096
#: Slots or blocks that one row stands for before it is spread out.
RUN = 8192
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
ROUNDS = 8
PRIME = 998244353
#: Rows of a source that are numbered together, about.
BUCKET = 2048
#: Ranges into which many sources are dealt to be numbered, at most.
RANGES = 1024


def _round_numbers(r: int, lane: int) -> tuple[int, int, int, int]:
    """Four numbers under PRIME for a round of a lane, from a Lehmer sequence."""
    x = (16807 * (r + 1) + 48271 * (lane + 1)) % PRIME
    out = []
    for _ in range(4):
        for _ in range(3):
            x = x * 48271 % 2147483647
        out.append(x % PRIME)
    return tuple(out)


def permuted(df: DataFrame, x: str, n: str, key: Column, lane: int) -> DataFrame:
    """df with column x (0 to n - 1) replaced by its image; key (a number under 2**30) chooses the permutation."""
    df = df.withColumn("__key", key.cast("long"))
    for r in range(ROUNDS):
        a, b, c, d = _round_numbers(r, lane)
        turn = F.expr(f"((__key % {PRIME}) * {a % 100003} + {b}) % {PRIME} % {n}")
        df = df.withColumn("__other", F.pmod(turn - F.col(x), F.col(n)))
        df = df.withColumn("__top", F.greatest(F.col(x), F.col("__other")))
        df = df.withColumn("__t", F.expr(f"((__top % 1000003) * {c % 1000003} + (__top div 1000003) * {d % 1000003} + (__key % 1000003) * {a % 1000003} + {b}) % {PRIME}"))
        df = df.withColumn(x, F.when(F.expr(f"(__t * __t) % {PRIME} % 2 = 1"), F.col("__other")).otherwise(F.col(x)))
    return df.drop("__key", "__other", "__top", "__t")


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], count: int) -> DataFrame:
    """df (count rows) with a column for each of sums: its total over the rows that come before in the order, which must be strict.

    A few rows are one task's. More are dealt by ranges of the order, whose totals, one
    row a range, are added up first.
    """
    zero = lambda c: F.coalesce(c, F.lit(0))
    if count <= common.FEW:
        before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({k: zero(F.sum(c).over(before)) for k, c in sums.items()})
    dealt = df.withColumns({f"__own_{k}": c for k, c in sums.items()}).repartitionByRange(min(RANGES, 1 + count // max(1, common.FEW)), *order)
    dealt = cut(dealt.withColumn("__range", F.spark_partition_id()))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("__range").agg(*[F.sum(f"__own_{k}").alias(k) for k in sums])
    totals = totals.select("__range", *[zero(F.sum(k).over(before)).alias(f"__all_{k}") for k in sums])
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.withColumns({k: zero(F.sum(f"__own_{k}").over(inside)) for k in sums}).join(F.broadcast(totals), "__range")
    return out.withColumns({k: F.col(k) + F.col(f"__all_{k}") for k in sums}).drop("__range", *[f"__{x}_{k}" for k in sums for x in ("own", "all")])


def targets(sources: DataFrame) -> DataFrame:
    """sources (source, size) with weight, target and sidx, the place by code point, null last.

    The share of all sizes is dealt by weight, no source getting over MOST times its
    size; what is over goes to the others by weight, until none is above.
    """
    n = sources.count()
    out = running(sources, [F.col("source").asc_nulls_last()], {"sidx": F.lit(1)}, n).withColumn("sidx", F.col("sidx").cast("long"))
    out = out.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("sidx") % len(WEIGHTS) + 1).cast("int")).cast("long"))
    out = cut(out.withColumn("most", MOST * F.col("size")))
    total, weights = out.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    # sources meet their bound in order of size / weight; level is the share of one weight among those from here on
    ratio = F.col("most") / F.col("weight")
    out = running(out, [ratio.asc(), F.col("sidx").asc()], {"given": F.col("most"), "gone": F.col("weight")}, n)
    out = cut(out.withColumn("level", (F.lit(total) * SHARE - F.col("given")) / (F.lit(weights) - F.col("gone"))))
    first = out.filter(F.col("level") * F.col("weight") <= F.col("most")).agg(F.min(F.struct(ratio.alias("ratio"), "sidx", "level"))["level"]).first()[0]
    most = F.col("most").cast("double")
    target = most if first is None else F.least(F.lit(first) * F.col("weight"), most)
    return out.withColumn("target", target).select("source", "size", "sidx", "weight", "target")


def source_key(c: Column | str = "source") -> Column:
    """An equal-joinable form of a nullable source."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.when(c.isNull(), F.lit("n")).otherwise(F.lit("s")), F.coalesce(c, F.lit("")))


def text_key(docs: DataFrame) -> Column:
    """A digest of a row's id, source and text: rows that agree in it are copies of one row."""
    return F.md5(F.concat_ws("\x1f", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), source_key(), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-"))).cast("binary"))


def stream(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their place in their source's stream of words, and the sources with their targets and numbers of blocks and slots.

    Rows: rkey, nth (copies of a row count from 1), doc_id, source, size, sidx, at. A
    source's order is by the row's digest. Copies are one row until they are placed,
    so neither a repeated row nor a repeated id is one task's.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), text_key(docs).alias("rkey"))
    rows = cut(rows.groupBy("rkey").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("source").alias("source"), F.any_value("size").alias("size"), F.count("*").alias("copies")))
    sums = cut(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).cast("long").alias("size")))
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    slots = F.least(MOST * blocks, F.when(F.col("size") > 0, F.round(F.col("target") / F.col("size") * blocks)).otherwise(F.lit(0))).cast("long")
    sources = cut(targets(sums).withColumn("blocks", blocks).withColumn("slots", slots))
    n_sources, all_slots = sources.agg(F.count("*"), F.coalesce(F.sum("slots"), F.lit(0))).first()
    sources = running(sources, [F.col("sidx").asc()], {"urn": F.col("slots")}, n_sources).withColumn("all_slots", F.lit(all_slots).cast("long"))
    sources = cut(sources.withColumn("urn", F.col("urn").cast("long")).withColumnRenamed("size", "source_size"))
    bits = max(0, (rows.count() // BUCKET).bit_length())
    rows = rows.withColumns({"skey": source_key(), "words": F.col("size") * F.col("copies")})
    rows = beside(rows, sources.select(source_key().alias("skey"), "sidx"), n_sources, "skey", F.col("rkey")).drop("skey")
    spot = F.conv(F.substring("rkey", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("bucket", F.shiftright(spot, 32 - bits) if bits else F.lit(0).cast("long"))
    ahead = rows.groupBy("sidx", "bucket").agg(F.sum("words").alias("n")).withColumn(
        "ahead", F.coalesce(F.sum("n").over(Window.partitionBy("sidx").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("n")
    inside = Window.partitionBy("sidx", "bucket").orderBy("rkey").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0))).join(ahead, ["sidx", "bucket"])
    rows = rows.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    at = F.col("ahead") + F.col("inside") + (F.col("nth") - 1) * F.col("size")
    return cut(rows.select("rkey", "nth", "doc_id", "source", "size", "sidx", at.cast("long").alias("at"))), sources


def _spread(df: DataFrame, count: str, out: str, total: int) -> DataFrame:
    """df with a row for each number 0 to count - 1, total of them in all, by runs that are dealt out before they are spread.

    The number of parts follows the rows that will be made, not those that are dealt,
    which are too few and small for a size-based choice.
    """
    parts = min(max(1, total >> 16), max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), total >> 22))
    runs = df.filter(F.col(count) > 0).withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / RUN))))
    runs = runs.repartition(parts, F.col("sidx"), F.col("__run"), *([F.col("shard")] if "shard" in df.columns else []))
    return runs.withColumn(out, F.explode(F.sequence(F.col("__run") * RUN, F.least(F.col(count), (F.col("__run") + 1) * RUN) - 1))).drop("__run")


def shard_counts(sources: DataFrame) -> DataFrame:
    """(sidx, shard, n): the multinomial draw of each output shard's slots among the sources, conditioned on the targets."""
    total = sources.agg(F.max("all_slots")).first()[0] or 0
    urn = _spread(sources.select("sidx", "slots", "urn", "all_slots"), "slots", "i", total).withColumn("x", F.col("urn") + F.col("i"))
    drawn = permuted(urn, "x", "all_slots", F.lit(12345), 0)
    return drawn.groupBy("sidx", F.expr(f"x div {SHARD}").alias("shard")).agg(F.count("*").alias("n"))


def slots(sources: DataFrame) -> DataFrame:
    """(shard, sidx, q, block): what each slot of each output shard reads."""
    counts = shard_counts(sources)
    first = F.coalesce(F.sum("n").over(Window.partitionBy("sidx").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    # joined before the spread: its rows grow with the input, but their estimate doesn't, and a broadcast of them would follow
    counts = counts.withColumn("first", first).join(sources.select("sidx", "blocks"), "sidx")
    each = _spread(counts, "n", "i", sources.agg(F.max("all_slots")).first()[0] or 0).withColumn("q", F.col("first") + F.col("i"))
    each = each.withColumn("block", F.col("q") % F.col("blocks"))
    return permuted(each, "block", "blocks", F.col("sidx") * 7919 + F.expr("q div blocks") * 104729 + 17, 1).select("shard", "sidx", "q", "block")


def pieces(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows as of stream, sources, and (rkey, nth, start, words, times): the parts of rows that lie in a block and how often the mix takes them."""
    rows, sources = stream(docs)
    low, high = F.expr(f"at div {BLOCK}"), F.expr(f"(at + size - 1) div {BLOCK}")
    parts = rows.filter("size > 0").withColumn("block", F.explode(F.sequence(low, high)))
    start = F.greatest(F.col("block") * BLOCK, F.col("at"))
    parts = parts.select("rkey", "nth", "sidx", "block", (start - F.col("at")).alias("start"), (F.least((F.col("block") + 1) * BLOCK, F.col("at") + F.col("size")) - start).alias("words"))
    # the rounds of a permutation are a chain of aliases, over which inferring constraints grows exponentially
    with setting(docs.sparkSession, "spark.sql.constraintPropagation.enabled", "false"):
        taken = cut(slots(sources).groupBy("sidx", "block").agg(F.count("*").alias("times")))
    return rows, sources, parts.join(taken.hint("merge"), ["sidx", "block"]).select("rkey", "nth", "start", "words", "times")


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of docs.

    size counts words, 0 for null text; taken counts the words that the mix takes,
    repeats too. A source without words has target 0; a null source is one, after all
    others. Rows that agree in id, source and text are copies, each with its own place.
    Texts of any length are counted whole; an empty table gives an empty result.
    Depends on the rows alone, so reruns agree. Other columns aren't read.
    """
    rows, sources, parts = pieces(docs)
    taken = parts.groupBy("rkey", "nth").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = rows.join(taken.hint("merge"), ["rkey", "nth"], "left")
    out = beside(out, sources.select("sidx", "source_size", "target"), sources.count(), "sidx", F.col("rkey"))
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mix as rows of docs: a row for each pass in which the mix takes words of it, its text cut to them, n_chars counted anew.

    A row that is taken whole keeps its text as it is; otherwise what stands between
    the words taken goes with the word before it. Rows of which nothing is taken go,
    as do null and empty texts. Copies of a row are taken each on its own. Columns may
    have any names.
    """
    rows, _, parts = pieces(docs)
    passes = parts.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    cuts = passes.groupBy("rkey", "nth", "pass").agg(F.sort_array(F.collect_list(F.struct("start", "words"))).alias("cuts"), F.sum("words").alias("words"))
    cuts = cuts.join(rows.select("rkey", "nth", "size"), ["rkey", "nth"]).select("rkey", "cuts", (F.col("words") == F.col("size")).alias("whole"))
    # dealt by the key of the join first, so that the text is shuffled and sorted once
    marked = packed(docs, rkey=text_key(docs)).repartition("rkey").dropDuplicates(["rkey"])
    joined = marked.join(cuts.hint("merge"), "rkey")
    tokens = F.regexp_extract_all(F.col("row.text"), F.lit(f"({WORD}(?:{SPACE})?)"), F.lit(1))
    # the tokens are bound to x once a row; named inside the inner function, they would be found anew for every cut
    bound = F.array(F.struct(tokens.alias("t"), F.col("cuts").alias("c")))
    part = F.transform(bound, lambda x: F.array_join(F.flatten(F.transform(x["c"], lambda c: F.slice(x["t"], (c["start"] + 1).cast("int"), c["words"].cast("int")))), ""))[0]
    out = joined.withColumn("text", F.when(F.col("whole"), F.col("row.text")).otherwise(part))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])
