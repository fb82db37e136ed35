"""Language identification by a byte convolutional network trained in numpy.

One-hot bytes feed filters of several widths; each filter's largest response over
a fixed-length window passes a rectifier, and a softmax layer reads all of them. A
text is cut into consecutive windows of WINDOW bytes; the class probabilities of
all windows, weighted by their bytes, make the text's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import row_chunks, text_bytes

WIDTHS = (2, 3, 4)
FILTERS = 8
WINDOW = 128
#: Rows of training text at most: the documented bound of the training sample. Their texts are whole.
TRAIN_ROWS = 2000
#: Windows that training looks at, drawn from all windows of the sample.
LOOKS = 64_000
CHUNK = 1 << 18


@dataclass
class ByteConv:
    """filters[w]: (w, 256, FILTERS); byte 0 stands for padding."""

    classes: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    shift: np.ndarray

    def responses(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter over the windows x (n, WINDOW), and its place."""
        best, place = [], []
        for f in self.filters:
            w = len(f)
            r = f[0][x[:, : x.shape[1] - w + 1]]
            for k in range(1, w):
                r += f[k][x[:, k : x.shape[1] - w + 1 + k]]
            at = r.argmax(axis=1)
            place.append(at)
            best.append(np.take_along_axis(r, at[:, None, :], 1)[:, 0])
        return np.concatenate(best, 1) + self.bias, np.concatenate(place, 1)

    def head(self, best: np.ndarray) -> np.ndarray:
        z = np.maximum(best, 0) @ self.dense + self.shift
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)

    def pair_tables(self) -> tuple[np.ndarray, list[list[np.ndarray]]]:
        """Byte classes of at most 128 kinds, and per width the tables of class pairs and of a last single class.

        Bytes whose weights no training text has touched are one class.
        """
        moved = np.flatnonzero(np.any(np.concatenate([np.abs(f).sum(axis=2) for f in self.filters]) > 0, axis=0))
        kind = np.zeros(256, np.int32)
        kind[moved] = np.arange(1, len(moved) + 1)
        rep = np.concatenate([[np.setdiff1d(np.arange(256), moved)[0] if len(moved) < 256 else 0], moved])
        tables = []
        for f in self.filters:
            own = []
            for k in range(0, len(f) - 1, 2):
                own.append(np.ascontiguousarray((f[k][rep][:, None] + f[k + 1][rep][None]).reshape(-1, f.shape[2])))
            if len(f) % 2:
                own.append(np.ascontiguousarray(f[-1][rep]))
            tables.append(own)
        return kind, tables


def train(texts: list[str], langs: list[str], seed: int = 7) -> ByteConv | None:
    """Fit on windows of the texts, with Adam. Every language weighs the same. None without a language."""
    classes = sorted(set(langs))
    if not classes:
        return None
    rng = np.random.default_rng(seed)
    y_of = {c: i for i, c in enumerate(classes)}
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in parts])]).astype(np.int64)
    raw = np.frombuffer(b"".join(parts), np.uint8)
    # windows of all texts; a rest shorter than half a window counts only where it is the whole text
    count = np.diff(offsets) // WINDOW
    rest = np.diff(offsets) % WINDOW
    count += (rest >= WINDOW // 2) | ((count == 0) & (rest > 0))
    owner = np.repeat(np.arange(len(parts)), count)
    begin = offsets[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    length = np.minimum(begin + WINDOW, offsets[1:][owner]) - begin
    y = np.array([y_of[c] for c in langs], np.int64)[owner]
    net = ByteConv(
        classes,
        [np.zeros((w, 256, FILTERS), np.float32) for w in WIDTHS],
        np.zeros(len(WIDTHS) * FILTERS, np.float32),
        rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32),
        np.zeros(len(classes), np.float32),
    )
    if len(classes) == 1 or not len(owner):
        net.dense[:] = 0
        return net
    padded = np.concatenate([raw, np.zeros(WINDOW, np.uint8)])
    used = np.flatnonzero(np.bincount(raw, minlength=256) + (np.arange(256) == 0))
    for f in net.filters:
        f[:, used] = rng.normal(0, 0.3, (len(f), len(used), FILTERS))
    weight = (len(y) / (len(classes) * np.bincount(y, minlength=len(classes)).clip(1))).astype(np.float32)
    params = [*net.filters, net.bias, net.dense, net.shift]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    size = 128
    steps = LOOKS // size
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        while len(order) < size:  # every window once before any comes again
            order = np.concatenate([order, rng.permutation(len(owner))])
        i, order = order[:size], order[size:]
        # a quarter of the windows are shortened, so that short texts are known too
        short = np.where(rng.random(size) < 0.25, rng.integers(6, WINDOW, size), WINDOW)
        x = padded[begin[i][:, None] + np.arange(WINDOW)]
        x = np.where(np.arange(WINDOW) < np.minimum(short, length[i])[:, None], x, 0)
        best, place = net.responses(x)
        g = net.head(best)
        g[np.arange(size), y[i]] -= 1
        g *= (weight[y[i]] / size)[:, None]
        hidden = np.maximum(best, 0)
        back = (g @ net.dense.T) * (best > 0)
        grads = []
        for n, f in enumerate(net.filters):
            cols = slice(n * FILTERS, (n + 1) * FILTERS)
            df, at, gb = np.zeros_like(f), place[:, cols], back[:, cols]
            unit = np.broadcast_to(np.arange(FILTERS), at.shape)
            for k in range(len(f)):
                np.add.at(df[k], (x[np.arange(size)[:, None], at + k], unit), gb)
            grads.append(df)
        grads += [back.sum(0), hidden.T @ g, g.sum(0)]
        rate = 0.01 * (1 - 0.9 * step / steps)
        for q, (w, d) in enumerate(zip(params, grads, strict=True)):
            first[q] += 0.1 * (d - first[q])
            second[q] += 0.01 * (d * d - second[q])
            w -= rate * (first[q] / (1 - 0.9**step)) / (np.sqrt(second[q] / (1 - 0.99**step)) + 1e-7)
    return net


def sample(docs: DataFrame, usable: Column, rows: int = TRAIN_ROWS) -> pd.DataFrame:
    """At most ``rows`` labelled rows with their whole texts: those with the smallest hashes of id and text.

    A first count over the narrow columns gives a bound on the hash, so that little
    more than ``rows`` texts leave the executors, however many rows there are.
    """
    marked = docs.filter(usable & F.col("lang").isNotNull())
    picked = marked.filter(F.length("text") > 0).select(F.xxhash64("doc_id", "text").alias("spot"), "text", "lang")
    share = (1.2 * rows + 200) / max(1, marked.count())
    if share < 1:
        picked = picked.filter(F.col("spot") < int(-(2**63) + share * 2**64))
    return picked.orderBy("spot", "text", "lang").limit(rows).toPandas()


def has_letter(text: str | None) -> bool:
    """Whether a character of the text is of a Unicode letter category."""
    return text is not None and any(map(str.isalpha, text))


def _scorer(net: ByteConv | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if net is not None:
            kind, tables = net.pair_tables()
            many = int(kind.max()) + 1
        for b in batches:
            names, scores = [], []
            raw, offsets = text_bytes(b.column("text"))
            has = [has_letter(t) for t in b.column("text").to_pylist()]
            for low, high in row_chunks(offsets, CHUNK):
                part, at = raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                if net is None:
                    names += ["und"] * (high - low)
                    scores += [0.0] * (high - low)
                    continue
                n = -(-np.diff(at) // WINDOW)
                row = np.repeat(np.arange(high - low), n)
                begin = at[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
                weight = np.minimum(begin + WINDOW, at[1:][row]) - begin
                total = np.zeros((high - low, len(net.classes)))
                codes = np.concatenate([kind[part], np.zeros(WINDOW, np.int32)])
                for w0 in range(0, len(row), 96):
                    pick = slice(w0, w0 + 96)
                    x = codes[begin[pick] + np.arange(WINDOW)[:, None]]
                    if weight[pick].min() < WINDOW:
                        x[np.arange(WINDOW)[:, None] >= weight[pick]] = kind[0]
                    p = net.head(_fast(x, tables, many) + net.bias)
                    np.add.at(total, row[pick], p * weight[pick, None])
                total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-30)
                best = total.argmax(axis=1)
                for i in range(high - low):
                    names.append(net.classes[best[i]] if has[low + i] else "und")
                    scores.append(float(min(1.0, total[i, best[i]])) if has[low + i] else 0.0)
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def _fast(x: np.ndarray, tables: list[list[np.ndarray]], many: int) -> np.ndarray:
    """The responses of ByteConv.responses without the bias, from the tables of class pairs; x is (WINDOW, n)."""
    places, n = x.shape
    pair = x[:-1] * many + x[1:]
    out = []
    for width, own in zip(WIDTHS, tables, strict=True):
        m = places - width + 1
        r = own[0].take(pair[:m].ravel(), axis=0, mode="clip")
        if width == 3:
            r += own[1].take(x[2 : 2 + m].ravel(), axis=0, mode="clip")
        elif width == 4:
            r += own[1].take(pair[2 : 2 + m].ravel(), axis=0, mode="clip")
        out.append(r.reshape(m, -1).max(axis=0).reshape(n, -1))
    return np.concatenate(out, 1)


def identify(docs: DataFrame, held_out: Column, usable: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of docs; learns from rows where usable holds.

    A text that is null or has no letter is ``und`` with score 0, as is every text
    if no row can be learnt from. Texts of any length are read whole, window by
    window. Repeated rows give repeated results, an empty table gives none, equal
    class scores go to the language that sorts first. Reads doc_id, text and, of rows
    to learn from, lang; no other column, whatever its name.
    """
    learn = sample(docs, usable)
    net = train(learn["text"].tolist(), learn["lang"].tolist())
    wide = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return wide.mapInArrow(_scorer(net), "doc_id long, held_out boolean, lang_pred string, score double")
