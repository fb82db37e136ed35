"""String similarities. Levenshtein and all that needs tokens is built in; three kernels run on Arrow batches, whole columns at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .normalize import tokens

#: Cells of a comparison table that a kernel holds at once.
CELLS = 1 << 22


def lev_sim(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 0 if either is empty."""
    return F.when((a != "") & (b != ""), 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))).otherwise(0.0)


def _codes(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Code points of the strings, one row each, padded with 0."""
    width = max(1, int(sizes.max(initial=0)))
    return x.astype(f"U{width}").view(np.uint32).reshape(len(x), width)


def _blocks(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, code points and lengths of both sides, in runs of rows of like length."""
    la, lb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    order = np.argsort(np.maximum(la, lb), kind="stable")
    at = 0
    while at < len(order):
        step, longest = len(order) - at, 0
        while step:  # fewer rows until the longest of them fits
            longest = max(la[order[at + step - 1]], lb[order[at + step - 1]], 1)
            fit = max(1, CELLS // int(longest * longest))
            if step <= fit:
                break
            step = max(fit, step // 2) if step // 2 > fit else fit
        rows = order[at : at + step]
        yield rows, _codes(a[rows], la[rows]), la[rows], _codes(b[rows], lb[rows]), lb[rows]
        at += step


def lcs_lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of the pairs of strings: a column of the table is the bits of 64-bit words."""
    out = np.zeros(len(a), np.int64)
    for rows, ca, la, cb, lb in _blocks(a, b):
        words = -(-ca.shape[1] // 64)
        valid = np.arange(ca.shape[1]) < la[:, None]
        every = _bits(valid, words)
        free = every.copy()
        for j in range(cb.shape[1]):
            m = _bits(valid & (ca == cb[:, j, None]) & (j < lb)[:, None], words)
            hit, rest = free & m, free & ~m
            carry = np.zeros(len(rows), np.uint64)
            for w in range(words):
                total = free[:, w] + hit[:, w]
                over = total < free[:, w]
                total += carry
                carry = (over | (total < carry)).astype(np.uint64)
                free[:, w] = total
            free = (free | rest) & every
        out[rows] = la - np.bitwise_count(free).sum(axis=1)
    return out


def _bits(flags: np.ndarray, words: int) -> np.ndarray:
    packed = np.packbits(flags, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, words * 8 - packed.shape[1]))).view(np.uint64)


def jaro_winkler(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarities of the pairs of strings; 0 where either is empty. The prefix counts above 0.7, up to four characters."""
    out = np.zeros(len(a))
    for rows, ca, la, cb, lb in _blocks(a, b):
        place = np.arange(cb.shape[1])
        window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
        used, left = np.zeros(cb.shape, bool), np.zeros(ca.shape, bool)
        inside = place < lb[:, None]
        for i in range(ca.shape[1]):
            free = (cb == ca[:, i, None]) & ~used & inside & (np.abs(place - i) <= window[:, None]) & (i < la)[:, None]
            hit = np.flatnonzero(free.any(axis=1))
            used[hit, free[hit].argmax(axis=1)] = True
            left[hit, i] = True
        m = left.sum(axis=1)
        first, second = (np.take_along_axis(c, np.argsort(~f, axis=1, kind="stable"), 1) for c, f in ((ca, left), (cb, used)))
        width = min(first.shape[1], second.shape[1])
        swapped = ((first[:, :width] != second[:, :width]) & (np.arange(width) < m[:, None])).sum(axis=1) // 2
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(m > 0, (m / la + m / lb + (m - swapped) / m) / 3, 0.0)
        k = min(4, width)
        same = np.cumprod((ca[:, :k] == cb[:, :k]) & (np.arange(k) < np.minimum(la, lb)[:, None]), axis=1).sum(axis=1)
        out[rows] = np.where(jaro > 0.7, jaro + same * 0.1 * (1 - jaro), jaro)
    return out


def _grams(c: np.ndarray, sizes: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 3-grams of each row, one number each in order, with ``none`` for the rest, and how many they are. A shorter text is its own only one."""
    wide = np.pad(c, ((0, 0), (0, 2))).astype(np.uint64)
    g = wide[:, :-2] | wide[:, 1:-1] << np.uint64(21) | wide[:, 2:] << np.uint64(42)
    g[np.arange(g.shape[1]) >= np.maximum(sizes - 2, 1)[:, None]] = none
    g.sort(axis=1)
    g[:, 1:][g[:, 1:] == g[:, :-1]] = none
    return g, (g != none).sum(axis=1)


def gram_jaccard(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shares of common 3-grams of the pairs of strings, none of which is empty."""
    out = np.zeros(len(a))
    for rows, ca, la, cb, lb in _blocks(a, b):
        (ga, na), (gb, nb) = _grams(ca, la, 2**64 - 1), _grams(cb, lb, 2**64 - 2)
        both = np.zeros(len(rows), np.int64)
        for j in range(gb.shape[1]):
            both += (ga == gb[:, j, None]).any(axis=1)
        out[rows] = both / (na + nb - both)
    return out


KERNELS = StructType([StructField("jw", DoubleType()), StructField("sorted", LongType()), StructField("rest", LongType())])


def _kernel(f, x: pd.Series, y: pd.Series, of_equal) -> np.ndarray:
    """f of the pairs. Equal and empty strings need no table."""
    x, y = x.to_numpy(), y.to_numpy()
    out = np.where(x == y, of_equal(x), 0.0)
    open_ = np.flatnonzero((x != y) & (x != "") & (y != ""))
    out[open_] = f(x[open_].astype(str), y[open_].astype(str))
    return out


@F.pandas_udf(DoubleType())
def gram_share(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of common 3-grams; 0 if either text is empty."""
    return pd.Series(_kernel(gram_jaccard, a, b, lambda x: (x != "").astype(float)))


@F.pandas_udf(KERNELS)
def _kernels(a: pd.Series, b: pd.Series, sa: pd.Series, sb: pd.Series, ra: pd.Series, rb: pd.Series) -> pd.DataFrame:
    """Jaro-Winkler of a and b, and common subsequences of the other two pairs."""
    length = lambda x: np.fromiter(map(len, x), np.float64, len(x))
    return pd.DataFrame({
        "jw": _kernel(jaro_winkler, a, b, lambda x: (x != "").astype(float)),
        "sorted": _kernel(lcs_lengths, sa, sb, length).astype(np.int64),
        "rest": _kernel(lcs_lengths, ra, rb, length).astype(np.int64),
    })


def with_fuzzy(df: DataFrame, out: str, a: Column, b: Column) -> DataFrame:
    """df with the struct column out: jw, tsort and tset, the Jaro-Winkler, sorted-token and token-set similarities of two texts; 0 where either is empty."""
    none = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    df = df.withColumn("__f", F.struct(none[0].alias("a"), none[1].alias("b"), F.array_sort(tokens(none[0])).alias("ta"), F.array_sort(tokens(none[1])).alias("tb")))
    f = lambda x: F.col(f"__f.{x}")
    joined = lambda c: F.array_join(c, " ")
    df = df.withColumn("__g", F.struct(
        joined(f("ta")).alias("sa"), joined(f("tb")).alias("sb"), joined(F.array_intersect(f("ta"), f("tb"))).alias("both"),
        joined(F.array_except(f("ta"), f("tb"))).alias("ra"), joined(F.array_except(f("tb"), f("ta"))).alias("rb"),
    ))
    g = lambda x: F.col(f"__g.{x}")
    df = df.withColumn("__k", _kernels(f("a"), f("b"), g("sa"), g("sb"), g("ra"), g("rb")))
    ls, lr = F.length(g("sa")) + F.length(g("sb")), F.length(g("both"))
    la, lb = F.length(g("ra")), F.length(g("rb"))
    gap = F.when(lr > 0, 1).otherwise(0)
    # the best of three: the two rests with the shared words before them, and the shared words with each
    wa, wb = lr + gap + la, lr + gap + lb
    rests = 1 - (la + lb - 2 * F.col("__k.rest")) / (wa + wb)
    best = F.when(lr == 0, rests).otherwise(F.greatest(rests, 1 - (1 + la) / (lr + wa), 1 - (1 + lb) / (lr + wb)))
    some = (F.size(f("ta")) > 0) & (F.size(f("tb")) > 0)
    tset = F.when(~some, 0.0).when((lr > 0) & ((la == 0) | (lb == 0)), 1.0).otherwise(best)
    tsort = F.when((f("a") == "") | (f("b") == ""), 0.0).when(ls == 0, 1.0).otherwise(1 - (ls - 2 * F.col("__k.sorted")) / ls)
    return df.withColumn(out, F.struct(F.col("__k.jw").alias("jw"), tsort.alias("tsort"), tset.alias("tset"))).drop("__f", "__g", "__k")
