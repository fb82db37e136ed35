"""Near-duplicate classes by Order MinHash, verified by banded alignment.

A document is the sequence of its five-word shingles (k-mers of words), each
labelled with its occurrence number, so that every element is unique. An Order
MinHash entry takes the ``depth`` smallest elements under one hash and keeps them
in text order; documents that agree in an entry are candidates. The probability
of agreement falls with both the shared share of the shingles and disorder, which
makes it sensitive to edit similarity rather than to the set alone.

A candidate pair is linked when aligned / (n_a + n_b - aligned) >= 0.8, where
``aligned`` is the longest common subsequence of the two labelled sequences inside
the diagonal band outside which no such alignment can run. Classes are the
connected components of the links. Exact copies are one node.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, drop_folder, packed, shared_folder, unpacked, written
from .textkit import BLANKS, U64, mix, row_chunks, span_hash, spans, text_bytes

WORDS = 5
SIMILARITY = 0.8
ENTRIES = 20
DEPTH = 3
#: Buckets of at most so many distinct texts are compared pair by pair; larger ones by leader, then in blocks.
PAIRWISE = 12
#: Texts in a block of the exact pass over large buckets.
BLOCK = 256
#: Parts into which the rows of one bucket, text or class are dealt, and the bucket size from which a pair counts as one of many of its leader.
SALTS = 32
MANY = 1024
#: Links that a task of the component search holds, about.
PER_TASK = 50_000
CHUNK = 1 << 20


def shingles(raw: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Labelled shingle hashes of all rows, and the offsets of the rows in them.

    A row with fewer words has one shingle of all of them; one without words has none.
    """
    starts, ends, row = spans(raw, offsets, BLANKS)
    n = len(offsets) - 1
    h = span_hash(raw, starts, ends)
    count = np.bincount(row, minlength=n).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    sizes = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    out = np.concatenate([[0], np.cumsum(sizes)])
    if not out[-1]:
        return np.zeros(0, U64), out
    rows = np.repeat(np.arange(n), sizes)
    at = np.arange(out[-1]) - out[rows] + first[rows]
    length = np.minimum(count[rows], words)
    with np.errstate(over="ignore"):
        k = length.astype(U64)
        for i in range(words):
            k = np.where(i < length, mix(k * U64(0x2545F4914F6CDD1D) + h[np.minimum(at + i, len(h) - 1)]), k)
        # occurrence numbers: equal shingles of a row, in text order
        apart = k + mix(rows.astype(U64) + U64(1))
        order = np.argsort(apart, kind="stable")
        ranked = apart[order]
        new = np.empty(len(k), bool)
        new[0] = True
        new[1:] = ranked[1:] != ranked[:-1]
        if not new.all():
            run = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
            nth = np.empty(len(k), np.int64)
            nth[order] = np.arange(len(k)) - run
            k = np.where(nth > 0, mix(k + nth.astype(U64) * U64(0xD1342543DE82EF95)), k)
    return k, out


def sketch(k: np.ndarray, offsets: np.ndarray, entries: int = ENTRIES, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and their entries as a matrix of 64-bit hashes.

    A row with fewer than ``depth`` shingles has the hash of all of them in each entry.
    """
    sizes = np.diff(offsets)
    kept = np.flatnonzero(sizes > 0)
    out = np.zeros((len(kept), entries), U64)
    if not len(kept):
        return kept, out
    seeds = mix(np.arange(1, entries + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    begin = offsets[:-1][kept]
    short = sizes[kept] < depth
    doc = np.repeat(np.arange(len(kept)), sizes[kept])
    top = U64(0xFFFFFFFFFFFFFFFF)
    with np.errstate(over="ignore"):
        for t in range(entries):
            v = (k ^ seeds[t]) * (seeds[(t + 1) % entries] | U64(1))
            v ^= v >> U64(32)
            found = []
            for _ in range(depth):
                low = np.minimum.reduceat(v, begin)
                hit = np.flatnonzero(v == low[doc])
                if len(hit) != len(kept):  # equal hashes, or rows that are used up: the first of each row
                    _, one = np.unique(doc[hit], return_index=True)
                    hit = hit[one]
                found.append(hit)
                v[hit] = top
            places = np.sort(np.stack(found), axis=0)
            e = np.full(len(kept), seeds[t], U64)
            for p in places:
                e = mix(e * U64(0x2545F4914F6CDD1D) + k[p])
            out[:, t] = e
        if short.any():
            for i in np.flatnonzero(short):
                e = seeds.copy()
                for x in k[begin[i] : begin[i] + sizes[kept][i]]:
                    e = mix(e * U64(0x2545F4914F6CDD1D) + x)
                out[i] = mix(e + U64(sizes[kept][i]))
    return kept, out


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw, offsets = text_bytes(b.column("text"))
        for low, high in row_chunks(offsets, CHUNK):
            part = raw[offsets[low] : offsets[high]]
            k, ends = shingles(part, offsets[low : high + 1] - offsets[low])
            kept, m = sketch(k, ends)
            has = np.zeros(high - low, bool)
            has[kept] = True
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(has * ENTRIES)]).astype(np.int32)), pa.array(m.view(np.int64).ravel())
            )
            yield pa.record_batch([b.column("doc_id").slice(low, high - low), b.column("tkey").slice(low, high - low), pa.array(np.diff(ends)), lists], ["doc_id", "tkey", "n", "entries"])


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Banded alignment similarity of two sequences without repeats; 0 as soon as it must stay below ``least``."""
    na, nb = len(a), len(b)
    if not na or not nb or min(na, nb) < least * max(na, nb):
        return 0.0
    need = least * (na + nb) / (1 + least)
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(ia) < need - 1e-9:
        return 0.0
    order = np.argsort(ia)
    ia, ib = ia[order], ib[order]
    band = max(na, nb) - need + 1e-9
    near = np.abs(ia - ib) <= band
    ib = ib[near]
    if np.all(ib[1:] > ib[:-1]):
        m = len(ib)
    else:
        tails: list[int] = []
        for x in ib.tolist():
            i = bisect_left(tails, x)
            if i == len(tails):
                tails.append(x)
            else:
                tails[i] = x
        m = len(tails)
    s = m / (na + nb - m)
    return s if s >= least else 0.0


def _sequence(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return shingles(raw, np.array([0, len(raw)], np.int64))[0]


class _Kept(OrderedDict):
    """The sequences of the texts used last, by key; bounded in elements."""

    held = 0

    def of(self, key: bytes, text: pa.Scalar) -> np.ndarray:
        got = self.get(key)
        if got is None:
            got = self[key] = _sequence(text.as_py())
            self.held += len(got)
            while self.held > 2_000_000 and len(self) > 1:
                self.held -= len(self.popitem(last=False)[1])
        else:
            self.move_to_end(key)
        return got


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = _Kept()
    for batch in batches:
        a, b, ta, tb = (batch.column(i) for i in range(4))
        hit = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist(), strict=True)):
            hit[i] = aligned(kept.of(x, ta[i]), kept.of(y, tb[i])) > 0
        at = pa.array(np.flatnonzero(hit))
        yield pa.record_batch([a.take(at), b.take(at)], ["a", "b"])


def _block_links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Links between the stragglers and the members of one block, found by counting shared shingles through posting lists."""
    rows = table.to_pydict()
    seqs = [_sequence(t) for t in rows["text"]]
    member = [i for i, r in enumerate(rows["role"]) if r == "m"]
    out: list[tuple[bytes, bytes]] = []
    if member:
        flat = np.concatenate([seqs[i] for i in member])
        owner = np.repeat(np.arange(len(member)), [len(seqs[i]) for i in member])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        size = np.array([len(seqs[i]) for i in member])
        for i, r in enumerate(rows["role"]):
            if r != "s":
                continue
            low, high = np.searchsorted(flat, seqs[i], "left"), np.searchsorted(flat, seqs[i], "right")
            n = high - low
            if not n.sum():
                continue
            at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            shared = np.bincount(owner[at], minlength=len(member))
            done = {rows["label"][i]}
            for j in np.flatnonzero(shared >= SIMILARITY * (size + len(seqs[i])) / (1 + SIMILARITY) - 1e-9):
                other = member[j]
                if rows["label"][other] not in done and aligned(seqs[i], seqs[other]) > 0:
                    done.add(rows["label"][other])  # one link joins the two classes
                    out.append((rows["tkey"][i], rows["tkey"][other]))
    return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})


def _salt(c: str) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")


def _salted(df: DataFrame) -> DataFrame:
    """df once for every salt: for sides of few rows only."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _part(rows: DataFrame, side: DataFrame, key: str, spread: str, how: str = "inner") -> DataFrame:
    """rows joined to side, which has one row per key, by the parts of a key's rows that occur."""
    dealt = rows.withColumn("salt", _salt(spread))
    parts = dealt.groupBy(key).agg(F.collect_set("salt").alias("salts")).join(side, key)
    return dealt.join(parts.withColumn("salt", F.explode("salts")).drop("salts"), [key, "salt"], how).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the ends of edges (a, b): the smallest node of each connected component.

    Each round takes the smallest label among the neighbours and then follows
    labels to their own labels, so paths shorten by at least half. A node with many
    edges, and a label of many nodes, is looked up by parts: each part that occurs
    gets the label, so no task has all rows of one node or class.
    """
    spark = edges.sparkSession
    parts = 1 + edges.count() // PER_TASK
    both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select("b", "a")).distinct().withColumn("salt", _salt("x"))
    both = cut(both.coalesce(parts))
    asked = cut(both.groupBy("y").agg(F.collect_set("salt").alias("salts")).coalesce(parts))
    # a written table has its true size; that of a checkpoint is guessed from its plan, and would grow exponentially with the rounds
    folder, n = shared_folder(spark, "components"), 0
    try:
        labels = written(asked.select(F.col("y").alias("node"), F.col("y").alias("label")).coalesce(parts), f"{folder}/{n}")
        while True:
            told = asked.join(labels.withColumnRenamed("node", "y"), "y").withColumn("salt", F.explode("salts"))
            seen = both.join(told, ["y", "salt"]).groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near"))
            n += 1
            step = written(labels.join(seen, "node").select("node", "label", F.least("label", "near").alias("down")).coalesce(parts), f"{folder}/{n}")
            jumped = _part(step, step.select(F.col("node").alias("down"), F.col("down").alias("jump")), "down", "node")
            new = jumped.select("node", F.least("down", "jump").alias("label"), (F.least("down", "jump") < F.col("label")).alias("moved"))
            new = written(new.coalesce(parts), f"{folder}/{n}-moved")
            if not new.filter("moved").limit(1).count():
                return cut(new.select("node", "label"))
            labels = new.select("node", "label")
    finally:
        drop_folder(spark, folder)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("tkey"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, label, class_id): one row per row of docs; tkey is the text's 128-bit digest, label the least one of the class.

    class_id is the smallest doc_id of the class. Equal texts, empty ones too, are
    one class; a text without words is otherwise near no other; a row with null
    text is a class of its own. Null ids get the smallest known id of their class,
    else null. Texts of any length are read whole; repeated rows give repeated results.
    An empty table gives an empty result. Other columns aren't read.

    A bucket, a leader's pairs and a class may each hold a large part of all rows:
    what is joined to them is joined by key and salt, a part of the key's rows.
    """
    keyed = _keyed(docs)
    rows = cut(keyed.mapInArrow(_sketches, "doc_id long, tkey binary, n long, entries array<long>"))
    texts = cut(rows.filter("tkey is not null").groupBy("tkey").agg(F.min("doc_id").alias("id"), F.any_value("n").alias("n"), F.any_value("entries").alias("entries")))
    entry = texts.filter("size(entries) > 0").select("tkey", F.explode("entries").alias("h"), _salt("tkey").alias("salt"))
    bucket = Window.partitionBy("h")  # over at most SALTS rows
    sizes = entry.groupBy("h", "salt").agg(F.count("*").alias("n")).withColumn("n", F.sum("n").over(bucket)).filter("n > 1")
    shared = cut(entry.join(sizes, ["h", "salt"]))

    # a text in large buckets is likely the origin of their members: buckets take the text with most company as leader
    company = shared.groupBy("tkey").agg(F.sum("n").alias("company"))
    large = shared.filter(F.col("n") > PAIRWISE)
    led = large.join(company, "tkey").groupBy("h", "salt").agg(F.max(F.struct("company", "tkey")).alias("top"))
    led = led.select("h", "salt", F.max("top").over(bucket)["tkey"].alias("leader"))
    star = large.join(led, ["h", "salt"]).filter("tkey != leader").select(F.least("tkey", "leader").alias("a"), F.greatest("tkey", "leader").alias("b"), (F.col("n") > MANY).alias("many"))
    small = shared.filter(F.col("n") <= PAIRWISE).select("h", "tkey")
    every = small.select("h", F.col("tkey").alias("a")).join(small.select("h", F.col("tkey").alias("b")), "h").filter("a < b").select("a", "b", F.lit(False))
    pairs = star.union(every).groupBy("a", "b").agg(F.max("many").alias("many"))
    by = lambda c: F.when(F.col("many"), _salt(c)).otherwise(F.lit(0))
    pairs = cut(pairs.select("a", "b", by("b").alias("sa"), by("a").alias("sb")))

    ends = pairs.select(F.col("a").alias("tkey")).union(pairs.select("b")).union(large.select("tkey")).distinct()
    chosen = ends.join(texts.select("tkey", "id"), "tkey").select("tkey", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("one"))
    # equal texts are dealt by their ids as well, so a large group of copies doesn't meet in one task
    body = (
        keyed.select("tkey", "text", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("one"))
        .join(chosen, ["tkey", "one"], "left_semi").dropDuplicates(["tkey"]).select("tkey", "text")
    )
    # texts rather than their shingles, whose hashes don't compress
    body = cut(body)
    side = lambda k, s, t: pairs.select(k, s).distinct().join(body.select(F.col("tkey").alias(k), F.col("text").alias(t)), k)
    tested = pairs.join(side("a", "sa", "ta"), ["a", "sa"]).join(side("b", "sb", "tb"), ["b", "sb"]).select("a", "b", "ta", "tb")
    links = cut(tested.mapInArrow(_verify, "a binary, b binary"))
    labels = components(links)

    # exact pass: large buckets that hold several classes
    big = cut(large.select("h", "salt", "tkey").join(labels.withColumnRenamed("node", "tkey"), "tkey", "left").withColumn("label", F.coalesce("label", "tkey")))
    part = big.groupBy("h", "salt").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    part = part.select("h", "salt", F.min("lo").over(bucket).alias("lo"), F.max("hi").over(bucket).alias("hi")).filter("lo != hi").select("h", "salt")
    most = big.groupBy("h", "label").agg(F.count("*").alias("n")).groupBy("h").agg(F.max(F.struct("n", "label"))["label"].alias("main"))
    strays = cut(big.join(part.join(most, "h"), ["h", "salt"]).filter("label != main").select("main", "tkey", "label").distinct())
    main = strays.select("main").distinct()
    members = labels.select(F.col("node").alias("tkey"), "label", _salt("node").alias("salt"))
    around = members.join(_salted(main.select(F.col("main").alias("label"))), ["label", "salt"]).select(F.col("label").alias("main"), "tkey", "label")
    around = around.union(strays).union(main.select("main", "main", "main")).distinct()
    # texts are near only if their lengths are of one class or of neighbouring ones: a member meets the strays of those
    lengths = texts.filter("n > 0").select("tkey", F.floor(F.log("n") / math.log(1 / SIMILARITY)).cast("int").alias("scale"))
    strays = cut(strays.join(lengths, "tkey"))
    k = strays.groupBy("main", "scale").agg(F.count("*").alias("strays"))
    around = around.join(lengths, "tkey").withColumn("scale", F.explode(F.array(*[F.col("scale") + i for i in (-1, 0, 1)])))
    around = cut(around.withColumn("salt", _salt("tkey")).join(_salted(k.select("main", "scale")), ["main", "scale", "salt"]))
    size = _salted(around.groupBy("main", "scale").agg(F.count("*").alias("members")).join(k, ["main", "scale"]).select(
        "main", "scale", F.ceil(F.col("members") / BLOCK).alias("mb"), F.ceil(F.col("strays") / BLOCK).alias("sb")
    ))
    sized = lambda df: df.withColumn("salt", _salt("tkey")).join(size, ["main", "scale", "salt"])
    spot, own = F.xxhash64("tkey"), ("main", "scale", "tkey", "label")
    m = sized(around).select(*own, F.lit("m").alias("role"), F.pmod(spot, "mb").alias("mi"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("sb") - 1)).alias("si"))
    s = sized(strays).select(*own, F.lit("s").alias("role"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1)).alias("mi"), F.pmod(spot, "sb").alias("si"))
    late = cut(m.unionByName(s).join(body, "tkey").groupBy("main", "scale", "mi", "si").applyInArrow(_block_links, "a binary, b binary"))
    if late.limit(1).count():
        # classes that a late link joins: components of the classes, few beside the texts
        ends = late.select(F.col("a").alias("node")).union(late.select("b")).distinct()
        labels = cut(labels.union(ends.join(labels, "node", "left_anti").select("node", "node")))
        of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}"))
        merged = components(late.join(of("a"), "a").join(of("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))
        labels = _part(labels, merged.select(F.col("node").alias("label"), F.col("label").alias("new")), "label", "node", "left").select("node", F.coalesce("new", "label").alias("label"))
        labels = cut(labels)

    known = texts.select("tkey", "id").join(labels.withColumnRenamed("node", "tkey"), "tkey", "left").select("tkey", "id", F.coalesce("label", "tkey").alias("label"))
    named = known.groupBy("label").agg(F.min("id").alias("class_id"))
    # a class of many texts, and a text of many copies, are looked up by parts too
    of_text = _part(known, named, "label", "tkey")
    known_rows = _part(rows.filter("tkey is not null").select("doc_id", "tkey"), of_text.select("tkey", "label", "class_id"), "tkey", "doc_id").select("doc_id", "tkey", "label", "class_id")
    return known_rows.union(rows.filter("tkey is null").select("doc_id", "tkey", F.col("tkey").alias("label"), F.col("doc_id").alias("class_id")))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs with one row left of each class: that with the smallest doc_id, then text digest.

    Rows with null text all stay; of rows that repeat both id and text one stays. An
    empty table stays empty. Columns are those of docs, whatever they are called.
    """
    classes = near_duplicates(docs).filter("tkey is not null")
    key = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    first = classes.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "tkey")).alias("x")).select(key(F.col("x.doc_id")).alias("one"), F.col("x.tkey").alias("tkey"))
    marked = packed(docs, one=key(F.col("doc_id")), tkey=F.unhex(F.md5(F.col("text").cast("binary"))))
    kept = marked.filter("tkey is not null").join(first, ["one", "tkey"], "left_semi").dropDuplicates(["one", "tkey"])
    return unpacked(kept.select("row").union(marked.filter("tkey is null").select("row")))
