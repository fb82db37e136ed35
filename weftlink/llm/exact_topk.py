"""Exact top-k by inner product: a KD-tree per shard with tight boxes, searched best first.

Candidates are dealt into regions by median splits that are found on a bounded sample,
and regions into shards of bounded size. Each shard's vectors are split at the median
of their widest component down to leaves of LEAF vectors, and every node, inner ones
too, keeps the tight bounding box of its own. The largest inner product of a query
with a box bounds those of its vectors. Each query keeps its open nodes in a heap by
bound: the best is opened next, a subtree whose bound is below the kth score is never
entered, and the kth score is carried on after every leaf.

A first pass searches the shard whose box promises each query most; its kth score is
where the second pass starts, which visits only shards whose box reaches it. Queries
are dealt in blocks; a unit of work is one block and one shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, setting

SHARD = 8192
QUERIES = 1024
LEAF = 128
#: Regions at most, and the documented bound of the vectors that their splits are found on. Every vector is dealt by them.
REGIONS = 1024
SAMPLE = 20_000
#: Shards whose boxes are looked at together.
PAGE = 512
SCALE = 256
#: Scores beyond a long's range are held at its ends; the least long means that there is none.
MOST = 2**63 - 1
NONE = -(2**63)


def quantised(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vec, dim): whole numbers floor(SCALE * x), held within a long's range.

    Rows without an id, a vector, or with a component that is null or not finite go. A
    vector without components stays; it scores 0 with its like.
    """
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vec = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")).cast("long"))
    return embeddings.filter(F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).withColumn("dim", F.size("vec"))


@dataclass
class Tree:
    """Nodes in the order in which they were split, the root first.

    left and right: children, -1 for a leaf; begin and end: its rows in order; low and
    high: its tight box.
    """

    order: np.ndarray
    left: np.ndarray
    right: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray


def build(x: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree of the rows of x, at least one. Equal vectors split by place, so leaves stay small."""
    order = np.arange(len(x))
    left, right, begin, end, low, high = [-1], [-1], [0], [len(x)], [x.min(axis=0)], [x.max(axis=0)]
    node = 0
    while node < len(left):
        a, b = begin[node], end[node]
        if b - a > leaf and x.shape[1]:
            wide = int(np.argmax(high[node] - low[node]))
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(x[order[a:b], wide], middle)]
            left[node], right[node] = len(left), len(left) + 1
            for start, stop in ((a, a + middle), (a + middle, b)):
                part = x[order[start:stop]]
                for column, value in ((left, -1), (right, -1), (begin, start), (end, stop), (low, part.min(axis=0)), (high, part.max(axis=0))):
                    column.append(value)
        node += 1
    return Tree(order, *map(np.array, (left, right, begin, end, low, high)))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, held within MOST: by floating point where no partial sum can pass 2**53, else by Python integers."""
    if q.size == 0 or x.size == 0:
        return np.zeros((len(q), len(x)), np.int64)
    if float(np.abs(q.astype(np.float64)).max()) * float(np.abs(x.astype(np.float64)).max()) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """No less than the score of a query with any vector in a box; rounding is made up for."""
    q, low, high = q.astype(np.float64), low.astype(np.float64), high.astype(np.float64)
    up = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    slack = (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T) * 1e-12
    return np.maximum(up + slack, -float(MOST))


def search(q: np.ndarray, q_id: np.ndarray, floor: np.ndarray, ids: np.ndarray, x: np.ndarray, tree: Tree, k: int):
    """(score, id) of the k best of the tree for each query, as arrays padded with (NONE, -1), equal scores by smaller id.

    x and ids are in the tree's order. floor is a score that k candidates are known to
    reach; nodes whose bound is below it, or below the kth score so far, aren't
    entered. All queries take a step at a time: each opens nodes until it comes to a
    leaf, and those that came to the same one are compared with it together.
    """
    n = len(q)
    scores, found = np.full((n, k), NONE), np.full((n, k), -1)
    if not n or not len(x):
        return scores, found
    up = bounds(q, tree.low, tree.high)
    left, right = tree.left.tolist(), tree.right.tolist()
    heaps = [[(-b, 0)] for b in up[:, 0].tolist()]
    active = range(n)
    while active:
        at_leaf: dict[int, list[int]] = {}
        for i in active:
            heap, kth, bound = heaps[i], max(scores[i, -1], floor[i]), up[i]
            while heap:
                b, node = heappop(heap)
                if -b < kth:
                    heap.clear()  # what is left is no better
                elif left[node] < 0:
                    at_leaf.setdefault(node, []).append(i)
                    break
                else:
                    for child in (left[node], right[node]):
                        if bound[child] >= kth:
                            heappush(heap, (-bound[child], child))
        for leaf, who in at_leaf.items():
            _compare(np.array(who), slice(tree.begin[leaf], tree.end[leaf]), q, q_id, ids, x, scores, found)
        active = sorted(i for who in at_leaf.values() for i in who if heaps[i])
    found[scores == NONE] = -1
    return scores, found


def _compare(rows: np.ndarray, span: slice, q: np.ndarray, q_id: np.ndarray, ids: np.ndarray, x: np.ndarray, scores: np.ndarray, found: np.ndarray) -> None:
    """Take the vectors of one leaf into the best of the given queries."""
    k = scores.shape[1]
    s = _products(q[rows], x[span])
    s[ids[span][None] == q_id[rows][:, None]] = NONE
    better = s.max(axis=1) >= np.maximum(scores[rows, -1], NONE + 1)
    if not better.any():
        return
    rows, s = rows[better], s[better]
    s = np.concatenate([scores[rows], s], axis=1)
    i = np.concatenate([found[rows], np.broadcast_to(ids[span], (len(rows), span.stop - span.start))], axis=1)
    if s.shape[1] > 4 * k:  # ties of the kth score stay in
        kth = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        keep = s >= kth[:, None]
    else:
        keep = np.ones(s.shape, bool)
    small = np.abs(s).max(initial=0, where=s != NONE) < 2**53
    best = np.lexsort((i, -s.astype(np.float64), ~keep), axis=1)[:, :k] if small else _sorted(s, i, k)
    scores[rows], found[rows] = np.take_along_axis(s, best, 1), np.take_along_axis(i, best, 1)


def _sorted(s: np.ndarray, i: np.ndarray, k: int) -> np.ndarray:
    return np.array([sorted(range(s.shape[1]), key=lambda c: (-int(s[r, c]), int(i[r, c])))[:k] for r in range(len(s))])


def _blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


NODES = ("left", "right", "begin", "end", "low", "high")
TREE = "dim int, shard long, ids binary, x binary, left binary, right binary, begin binary, end binary, low binary, high binary"
BLOCKS = "dim int, block long, qkey binary, q_id binary, q binary"
FOUND = "dim int, block long, place int, query_id long, vec_id long, score long"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def splits(x: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Component and threshold of the median splits of a complete tree of that depth; node n's children are 2n + 1 and 2n + 2, those above the threshold go to the latter."""
    component, threshold = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1, np.int64)
    parts = [x]
    for n in range(len(component)):
        part = parts[n]
        if len(part):
            component[n] = np.argmax(part.max(axis=0).astype(np.float64) - part.min(axis=0))
            threshold[n] = np.partition(part[:, component[n]], (len(part) - 1) // 2)[(len(part) - 1) // 2]
        above = part[:, component[n]] > threshold[n] if len(part) else np.zeros(0, bool)
        parts += [part[~above], part[above]]
    return component, threshold


def _assign(plan: dict[int, tuple[int, np.ndarray, np.ndarray]]):
    """vectors with the region that the splits of their dimension give."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            flat, ends = b.column("vec").flatten().to_numpy(), np.concatenate([[0], np.cumsum(dims)])
            region = np.zeros(len(dims), np.int32)
            for dim, (depth, component, threshold) in plan.items():
                rows = np.flatnonzero(dims == dim)
                node = np.zeros(len(rows), np.int64)
                for _ in range(depth):
                    node = 2 * node + 1 + (flat[ends[rows] + component[node]] > threshold[node])
                region[rows] = node - (2**depth - 1)
            yield pa.record_batch([*b.columns, pa.array(region)], [*b.schema.names, "region"])

    return run


def _trees(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    dim = table.column("dim")[0].as_py()
    x = np.array(table.column("vec").to_pylist(), np.int64).reshape(table.num_rows, dim)
    ids = table.column("vec_id").to_numpy()
    by_id = np.argsort(ids, kind="stable")
    ids, x = ids[by_id], x[by_id]
    tree = build(x)
    row = [dim, table.column("shard")[0].as_py(), _blob(ids[tree.order]), _blob(x[tree.order]), *(_blob(getattr(tree, c)) for c in NODES)]
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 8]
    return pa.table([pa.array([v], t) for v, t in zip(row, types, strict=True)], _names(TREE))


def _query_block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    dim = table.column("dim")[0].as_py()
    table = table.sort_by([("vec_id", "ascending"), ("qkey", "ascending")])
    q = np.array(table.column("vec").to_pylist(), np.int64).reshape(table.num_rows, dim)
    row = [dim, table.column("block")[0].as_py(), _blob(table.column("qkey").to_numpy()), _blob(table.column("vec_id").to_numpy()), _blob(q)]
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 3]
    return pa.table([pa.array([v], t) for v, t in zip(row, types, strict=True)], _names(BLOCKS))


def _column(b: pa.RecordBatch, name: str, r: int) -> np.ndarray:
    """A binary cell as whole numbers."""
    return np.frombuffer(b.column(name)[r].as_buffer(), np.int64)


def _boxes(b: pa.RecordBatch, r: int, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    boxes = b.column("boxes")[r].as_py()
    side = lambda c: np.frombuffer(b"".join(x[c] for x in boxes), np.int64).reshape(len(boxes), dim)
    return np.array([x["shard"] for x in boxes]), side("low"), side("high")


def _best_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each query of a block the shard of a page whose box has the largest bound."""
    for b in batches:
        for r in range(b.num_rows):
            dim, n = b.column("dim")[r].as_py(), len(_column(b, "q_id", r))
            shards, low, high = _boxes(b, r, dim)
            up = bounds(_column(b, "q", r).reshape(n, dim), low, high)
            best = up.argmax(axis=1)
            row = [np.full(n, dim, np.int32), np.full(n, b.column("block")[r].as_py()), np.arange(n, dtype=np.int32), up[np.arange(n), best], shards[best]]
            yield pa.record_batch([pa.array(x) for x in row], ["dim", "block", "place", "bound", "shard"])


def _open_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shards of a page whose boxes reach the floor of a query of the block, and those queries' places."""
    for b in batches:
        for r in range(b.num_rows):
            dim, floors = b.column("dim")[r].as_py(), _column(b, "floors", r)
            shards, low, high = _boxes(b, r, dim)
            reach = bounds(_column(b, "q", r).reshape(len(floors), dim), low, high) >= floors[:, None]
            some = np.flatnonzero(reach.any(axis=0))
            places = [np.flatnonzero(reach[:, i]).astype(np.int32) for i in some]
            row = [pa.array(np.full(len(some), dim, np.int32)), pa.array(np.full(len(some), b.column("block")[r].as_py())), pa.array(shards[some], pa.int64()), pa.array(places, pa.list_(pa.int32()))]
            yield pa.record_batch(row, ["dim", "block", "shard", "places"])


def _searcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                dim = b.column("dim")[r].as_py()
                q_id, ids, nodes = _column(b, "q_id", r), _column(b, "ids", r), len(_column(b, "left", r))
                places = np.sort(b.column("places")[r].values.to_numpy())
                floors = _column(b, "floors", r)[places] if "floors" in b.schema.names else np.full(len(places), NONE)
                boxes = (_column(b, c, r).reshape(nodes, dim) for c in NODES[4:])
                tree = Tree(np.arange(len(ids)), *(_column(b, c, r) for c in NODES[:4]), *boxes)
                scores, found = search(_column(b, "q", r).reshape(len(q_id), dim)[places], q_id[places], floors, ids, _column(b, "x", r).reshape(len(ids), dim), tree, k)
                who, col = np.nonzero((scores >= floors[:, None]) & (scores > NONE))
                row = [np.full(len(who), dim, np.int32), np.full(len(who), b.column("block")[r].as_py()), places[who].astype(np.int32), q_id[places[who]], found[who, col], scores[who, col]]
                yield pa.record_batch([pa.array(x) for x in row], _names(FOUND))

    return run


def _lay(k: int):
    """Floors of a block's queries by place: the least of k scores found, or none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for n, found in zip(b.column("n").to_pylist(), b.column("f").to_pylist(), strict=True):
                floors = np.full(n, NONE)
                for x in found:
                    if x["n"] >= k:
                        floors[x["place"]] = x["kth"]
                out.append(_blob(floors))
            yield pa.record_batch([b.column("dim"), b.column("block"), pa.array(out, pa.binary())], ["dim", "block", "floors"])

    return run


def _plan(vectors: DataFrame, sizes: dict[int, int]) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """For each dimension with more vectors than a shard holds: the depth of its splits, and the splits."""
    large = {d: n for d, n in sizes.items() if n > SHARD and d}
    if not large:
        return {}
    spot = F.xxhash64("vec_id", "vec", F.lit(3))
    share = (1.2 * SAMPLE + 200) / sum(large.values())
    rows = vectors.filter(F.col("dim").isin(*large)).withColumn("spot", spot)
    if share < 1:
        rows = rows.filter(F.col("spot") < int(-(2**63) + share * 2**64))
    sample = rows.orderBy("spot", "vec_id").limit(SAMPLE).select("dim", "vec").collect()
    out = {}
    for d, n in large.items():
        x = np.array([r["vec"] for r in sample if r["dim"] == d], np.int64).reshape(-1, d)
        depth = min((REGIONS - 1).bit_length(), (-(-n // SHARD) - 1).bit_length())
        out[d] = (depth, *splits(x, depth))
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best of all vectors but those of its own id, equal scores by smaller id.

    vectors as of quantised. Only vectors of a query's dimension are compared with
    it. A query id that occurs with several vectors is answered for each of them, in
    one ranking; equal rows are one query, but candidates of their own to others.
    Fewer candidates give fewer rows, an empty table none. Scores beyond a long's
    range are held at its ends, and are equal there. Other columns aren't read.
    """
    spark = vectors.sparkSession
    sizes = {r["dim"]: (r["n"], r["q"] or 0) for r in vectors.groupBy("dim").agg(F.count("*").alias("n"), F.sum(is_query.cast("int")).alias("q")).collect()}
    plan = _plan(vectors, {d: n for d, (n, _) in sizes.items()})
    dealt = cut(vectors.mapInArrow(_assign(plan), "vec_id long, vec array<bigint>, dim int, region int"))
    # few rows, REGIONS a dimension at most: a region's first shard and its number of shards
    places, number = [], dict.fromkeys(sizes, 0)
    for r in dealt.groupBy("dim", "region").agg(F.count("*").alias("n")).orderBy("dim", "region").collect():
        parts = -(-r["n"] // SHARD)
        places.append((r["dim"], r["region"], number[r["dim"]], parts))
        number[r["dim"]] += parts
    pages = max([1, *(-(-n // PAGE) for n in number.values())])
    blocks = max([1, *(-(-q // QUERIES) for _, q in sizes.values())])
    shard = (F.col("first") + F.pmod(F.xxhash64("vec_id", "vec"), F.col("parts"))).alias("shard")
    at = spark.createDataFrame(places, "dim int, region int, first long, parts long")
    trees = cut(dealt.join(F.broadcast(at), ["dim", "region"]).select("vec_id", "vec", "dim", shard).groupBy("dim", "shard").applyInArrow(_trees, TREE))
    # a shard's box is that of its root
    box = F.struct("shard", F.expr("substring(low, 1, dim * 8)").alias("low"), F.expr("substring(high, 1, dim * 8)").alias("high"))
    boxes = cut(trees.groupBy("dim", F.expr(f"shard div {PAGE}").alias("page")).agg(F.sort_array(F.collect_list(box)).alias("boxes")))
    asked = dealt.filter(is_query).withColumn("qkey", F.xxhash64("vec")).dropDuplicates(["vec_id", "qkey"]).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(blocks)))
    packed = cut(asked.select("vec_id", "vec", "dim", "qkey", "block").groupBy("dim", "block").applyInArrow(_query_block, BLOCKS))

    paged = lambda q: q.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pages - 1).cast("long")))).join(boxes, ["dim", "page"])
    units = lambda u, q: u.join(q, ["dim", "block"]).join(trees, ["dim", "shard"])
    # a row of work holds a whole block or shard, so a batch holds few rows
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "2"):
        near = paged(packed).mapInArrow(_best_shards, "dim int, block long, place int, bound double, shard long")
        first = near.groupBy("dim", "block", "place").agg(F.max(F.struct("bound", "shard"))["shard"].alias("shard"))
        first = units(first.groupBy("dim", "block", "shard").agg(F.collect_list("place").alias("places")), packed).mapInArrow(_searcher(k), FOUND)
        kth = first.groupBy("dim", "block", "place").agg(F.count("*").alias("n"), F.min("score").alias("kth")).groupBy("dim", "block").agg(F.collect_list(F.struct("place", "n", "kth")).alias("f"))
        some = packed.select("dim", "block", F.expr("octet_length(q_id) div 8").alias("n")).join(kth, ["dim", "block"], "left")
        floors = some.select("dim", "block", "n", F.coalesce("f", F.array().cast("array<struct<place:int,n:bigint,kth:bigint>>")).alias("f")).mapInArrow(_lay(k), "dim int, block long, floors binary")
        ready = cut(packed.join(floors, ["dim", "block"]))
        open_ = paged(ready).mapInArrow(_open_shards, "dim int, block long, shard long, places array<int>")
        found = cut(units(open_, ready).mapInArrow(_searcher(k), FOUND))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
