"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is the sequence of its words (runs of ASCII letters, digits and bytes above
127, ASCII upper case folded). Each step of the network reads two inputs: a hashed
word embedding and the mean of hashed embeddings of the 3-, 5- and 7-grams of its bytes
with edge marks. All windows of WINDOW words, each overlapping the next by a third, are scored; attention over a window's states gives the vector that a logistic unit
reads. The text's score is that of its worst window, moved so that 0.5 divides the
training texts best.

Labels say only that a text is toxic somewhere. Windows to learn from are found by
document counts of hashed words and n-grams: a window of a toxic text teaches
toxicity if it holds one that toxic texts have far more often than others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import U64, distinct, mix, row_chunks, span_hash, spans, sum_rows, text_bytes

WINDOW = 24
STRIDE = 16
HIDDEN = 8
WORD_DIM = 8
GRAM_DIM = 8
WORD_SLOTS = 1 << 14
GRAM_SLOTS = 1 << 17
#: A word of one letter and its edge marks is one 3-gram, so every word has some.
GRAMS = (3, 5, 7)
#: The documented bound of the training sample: rows of each label. Their texts are whole.
TRAIN_ROWS = 1000
#: Log odds from which a window shows that its text is toxic.
CLEAR = 1.5
#: Toxic texts that must be among those kept back from training.
ENOUGH = 20
#: Bytes that are read at once when scoring, and when learning on the driver.
CHUNK = 1 << 21
LEARN_CHUNK = 1 << 19

SEPARATOR = np.ones(256, bool)
SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


@dataclass
class Words:
    """The words of some rows: which distinct word stands where, the distinct words' slots, and their n-grams.

    key: the distinct words' hashes, increasing. grams: of each n-gram length, the
    slots in order of the word, and the owning words.
    """

    row: np.ndarray
    word: np.ndarray
    key: np.ndarray
    slots: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray]]

    def pick(self, own: np.ndarray) -> Words:
        """The given distinct words only (sorted), renumbered."""
        grams = []
        for slots, owner in self.grams:
            low, high = np.searchsorted(owner, own, "left"), np.searchsorted(owner, own, "right")
            n = high - low
            grams.append((slots[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)], np.repeat(np.arange(len(own)), n)))
        return Words(self.row[:0], self.word[:0], self.key[own], self.slots[own], grams)


def read_words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    raw = FOLD[raw]
    starts, ends, row = spans(raw, offsets, SEPARATOR)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return Words(none, none, np.zeros(0, U64), none, [(none, none)] * len(GRAMS))
    h = span_hash(raw, starts, ends)
    order = np.argsort(h)
    ranked = h[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    word = np.empty(len(h), np.int64)
    word[order] = np.cumsum(new) - 1
    own, first = ranked[new], order[new]
    s, n = starts[first], ends[first] - starts[first]
    # the distinct words' bytes with a mark at either end
    total = n + 2
    at = np.concatenate([[0], np.cumsum(total)])
    owner = np.repeat(np.arange(len(own)), total)
    place = np.arange(at[-1]) - at[owner]
    marked = np.full(at[-1] + max(GRAMS), 1, np.uint8)
    inner = np.flatnonzero((place > 0) & (place <= n[owner]))
    marked[inner] = raw[(s[owner] + place - 1)[inner]]
    left = total[owner] - place
    grams = []
    with np.errstate(over="ignore"):
        code = np.zeros(at[-1], U64)
        for k in range(max(GRAMS)):
            code = code * U64(257) + marked[k : k + at[-1]] + U64(1)
            if k + 1 in GRAMS:
                ok = np.flatnonzero(left >= k + 1)
                grams.append(((mix(code[ok]) >> U64(64 - 17)).astype(np.int64), owner[ok]))
    return Words(row, word, own, (own >> U64(64 - 14)).astype(np.int64), grams)


def read_all(raw: np.ndarray, offsets: np.ndarray) -> Words:
    """read_words of many rows, a chunk at a time, so that memory follows the chunk and the words rather than the bytes."""
    lows, parts = [], []
    for low, high in row_chunks(offsets, LEARN_CHUNK):
        lows.append(low)
        parts.append(read_words(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]))
    if len(parts) < 2:
        return parts[0] if parts else read_words(raw, offsets)
    key, first, place = np.unique(np.concatenate([p.key for p in parts]), return_index=True, return_inverse=True)
    at = np.concatenate([[0], np.cumsum([len(p.key) for p in parts])])
    grams: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in GRAMS]
    for i, p in enumerate(parts):  # a word's n-grams are those of the chunk where it first occurs
        mine = np.flatnonzero((first >= at[i]) & (first < at[i + 1]))
        mine = mine[np.argsort(first[mine], kind="stable")]
        for k, (slots, owner) in enumerate(p.pick(first[mine] - at[i]).grams):
            grams[k].append((slots, mine[owner]))
    joined = []
    for each in grams:
        slots, owner = (np.concatenate(x) for x in zip(*each, strict=True))
        order = np.argsort(owner, kind="stable")
        joined.append((slots[order], owner[order]))
    row = np.concatenate([p.row + low for low, p in zip(lows, parts, strict=True)])
    word = np.concatenate([place[at[i] + p.word] for i, p in enumerate(parts)])
    return Words(row, word, key, (key >> U64(64 - 14)).astype(np.int64), joined)


def windows(row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all rows: places of their words (n, WINDOW), -1 where there is none, and the row of each."""
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    n = np.where(count == 0, 0, 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE)))
    of = np.repeat(np.arange(n_rows), n)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    at = (nth * STRIDE)[:, None] + np.arange(WINDOW)
    return np.where(at < count[of][:, None], at + first[of][:, None], -1), of


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters, forward pass and gradients. Both directions run side by side on a leading axis of 2."""

    def __init__(self, seed: int = 3) -> None:
        r = np.random.default_rng(seed)
        d, h = WORD_DIM + GRAM_DIM, HIDDEN
        n = lambda scale, *shape: r.normal(0, scale, shape).astype(np.float32)
        self.p = {
            "word": n(0.1, WORD_SLOTS, WORD_DIM),
            "gram": n(0.1, GRAM_SLOTS, GRAM_DIM),
            "w": n(0.35, 2, d, 3 * h),
            "u": n(0.3, 2, h, 3 * h),
            "b": np.zeros((2, 1, 3 * h), np.float32),
            "a": n(0.3, 2 * h, h),
            "ab": np.zeros(h, np.float32),
            "av": n(0.3, h),
            "o": n(0.3, 2 * h),
            "ob": np.zeros(1, np.float32),
        }
        self.move = 0.0

    def inputs(self, w: Words) -> np.ndarray:
        """The input vector of each distinct word."""
        n = len(w.slots)
        total, count = np.zeros((n, GRAM_DIM), np.float32), np.zeros(n, np.float32)
        for slots, owner in w.grams:
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
            if len(first):
                total[owner[first]] += np.add.reduceat(self.p["gram"].take(slots, axis=0), first, axis=0)
                count += np.bincount(owner, minlength=n)
        return np.concatenate([self.p["word"].take(w.slots, axis=0), total / np.sqrt(count)[:, None]], axis=1)

    def run(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """x: (2, T, n, 3h) projected inputs, the second direction reversed in time; mask (T, n). Gives the logits."""
        p, h = self.p, HIDDEN
        _, t_max, n, _ = x.shape
        s = np.zeros((2, n, h), np.float32)
        states = np.empty((2, t_max, n, h), np.float32)
        tape = []
        for t in range(t_max):
            m = np.stack([mask[t], mask[t_max - 1 - t]])[:, :, None]
            g = s @ p["u"]
            zr = _sigmoid(x[:, t, :, : 2 * h] + g[:, :, : 2 * h])
            c = np.tanh(x[:, t, :, 2 * h :] + zr[:, :, h:] * g[:, :, 2 * h :])
            new = s + (1 - zr[:, :, :h]) * (c - s)
            new = s + m * (new - s)
            if keep:
                tape.append((s, g, zr, c, m))
            s = new
            states[0, t] = s[0]
            states[1, t_max - 1 - t] = s[1]
        both = np.concatenate([states[0], states[1]], axis=2)
        k = np.tanh(both @ p["a"] + p["ab"])
        e = k @ p["av"] + (mask - 1) * np.float32(30)
        e = np.exp(e - e.max(axis=0))
        e /= e.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", e, both)
        z = pooled @ p["o"] + p["ob"][0]
        return (z, tape, both, k, e, pooled) if keep else z

    def project(self, v: np.ndarray) -> np.ndarray:
        """Both directions' projections of input vectors: (2, n, 3h)."""
        return v @ self.p["w"] + self.p["b"]

    def logits(self, w: Words, at: np.ndarray, batch: int = 768) -> np.ndarray:
        """The same pass as run without a tape, for windows whose words stand at the places ``at``; whole windows need no mask."""
        p, h = self.p, HIDDEN
        half = np.concatenate([np.full(2 * h, 0.5, np.float32), np.ones(h, np.float32)])  # gates by tanh of half their input
        proj = self.project(self.inputs(w)) * half
        proj = np.concatenate([proj, np.zeros((2, 1, 3 * h), np.float32)], axis=1)
        u = p["u"] * half
        word = np.concatenate([w.word, [len(w.slots)]])
        out = np.empty(len(at), np.float32)
        whole = (at >= 0).all(axis=1)
        for group in (np.flatnonzero(whole), np.flatnonzero(~whole)):
            for low in range(0, len(group), batch):
                pick = group[low : low + batch]
                i = at[pick].T
                token = word[i]
                n, masked = len(pick), not whole[pick[0]]
                mask = (i >= 0).astype(np.float32)
                s = np.zeros((2, n, h), np.float32)
                both = np.empty((WINDOW, n, 2 * h), np.float32)
                g, x = np.empty((2, n, 3 * h), np.float32), np.empty((2, n, 3 * h), np.float32)
                for t in range(WINDOW):
                    back = WINDOW - 1 - t
                    proj[0].take(token[t], axis=0, out=x[0], mode="clip")
                    proj[1].take(token[back], axis=0, out=x[1], mode="clip")
                    np.matmul(s, u, out=g)
                    gate = x[:, :, : 2 * h] + g[:, :, : 2 * h]
                    np.tanh(gate, out=gate)
                    gate *= 0.5
                    gate += 0.5
                    c = gate[:, :, h:] * g[:, :, 2 * h :]
                    c += x[:, :, 2 * h :]
                    np.tanh(c, out=c)
                    c -= s
                    c *= 1 - gate[:, :, :h]
                    if masked:
                        c[0] *= mask[t][:, None]
                        c[1] *= mask[back][:, None]
                    s += c
                    both[t, :, :h] = s[0]
                    both[back, :, h:] = s[1]
                e = np.tanh(both.reshape(-1, 2 * h) @ p["a"] + p["ab"]) @ p["av"]
                e = e.reshape(WINDOW, n) + (mask - 1) * np.float32(30)
                e = np.exp(e - e.max(axis=0))
                e /= e.sum(axis=0)
                out[pick] = (e * (both.reshape(-1, 2 * h) @ p["o"]).reshape(WINDOW, n)).sum(axis=0) + p["ob"][0]
        return out

    def gradients(self, v: np.ndarray, token: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """Gradients of the weighted logistic loss; v: input vectors, token (T, n) which of them stands where."""
        p, h = self.p, HIDDEN
        t_max, n = token.shape
        proj = self.project(v)
        x = np.stack([proj[0][token], proj[1][token[::-1]]])
        z, tape, both, k, e, pooled = self.run(x, mask, keep=True)
        dz = ((_sigmoid(z) - y) * weight / n).astype(np.float32)
        g = {"o": pooled.T @ dz, "ob": dz.sum(keepdims=True)}
        dpool = dz[:, None] * p["o"]
        dboth = e[:, :, None] * dpool
        de = np.einsum("nh,tnh->tn", dpool, both)
        de = e * (de - (e * de).sum(axis=0))
        g["av"] = np.einsum("tn,tnh->h", de, k)
        dk = de[:, :, None] * p["av"] * (1 - k * k)
        g["a"], g["ab"] = np.einsum("tni,tnj->ij", both, dk), dk.sum(axis=(0, 1))
        dboth = dboth + dk @ p["a"].T
        g["u"] = np.zeros_like(p["u"])
        dx = np.empty_like(x)
        ds = np.zeros((2, n, h), np.float32)
        for t in reversed(range(t_max)):
            s, gs, zr, c, m = tape[t]
            ds = ds + np.stack([dboth[t, :, :h], dboth[t_max - 1 - t, :, h:]])
            dn = ds * m
            zt, rt = zr[:, :, :h], zr[:, :, h:]
            dc = dn * (1 - zt) * (1 - c * c)
            dzt = dn * (s - c) * zt * (1 - zt)
            drt = dc * gs[:, :, 2 * h :] * rt * (1 - rt)
            dgate = np.concatenate([dzt, drt], axis=2)
            dg = np.concatenate([dgate, dc * rt], axis=2)
            dx[:, t] = np.concatenate([dgate, dc], axis=2)
            g["u"] += s.transpose(0, 2, 1) @ dg
            ds = ds * (1 - m) + dn * zt + dg @ p["u"].transpose(0, 2, 1)
        dproj = np.zeros_like(proj)
        for side, order in ((0, token), (1, token[::-1])):
            dproj[side] = sum_rows(order.ravel(), dx[side].reshape(-1, 3 * h), proj.shape[1])
        g["b"] = dproj.sum(axis=1, keepdims=True)
        g["w"] = v.T @ dproj
        dv = (dproj @ p["w"].transpose(0, 2, 1)).sum(axis=0)
        return g, dv


def _evidence(w: Words, y: np.ndarray) -> np.ndarray:
    """Of each word's place, the largest log odds of its n-grams' document counts, less a standard error; a last entry stands for no word.

    Without the standard error, some n-gram of two toxic texts by chance would do.
    """
    each = np.zeros(len(w.slots))
    pairs = distinct(w.word * len(y) + w.row)
    word, row = pairs // len(y), pairs % len(y)
    for slots, owner in w.grams:
        n = np.bincount(owner, minlength=len(w.slots))
        starts = np.cumsum(n) - n
        m = n[word]
        gram = slots[np.repeat(starts[word], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)]
        doc = distinct(gram * len(y) + np.repeat(row, m))
        gram, toxic = doc // len(y), y[doc % len(y)]
        bad, good = np.bincount(gram, weights=toxic, minlength=GRAM_SLOTS), np.bincount(gram, weights=1 - toxic, minlength=GRAM_SLOTS)
        odds = np.log((bad + 0.1) / (good + 0.4) * max(1, (1 - y).sum()) / max(1, y.sum())) - np.sqrt(1 / (bad + 0.1) + 1 / (good + 0.4))
        odds[bad < 2] = 0
        np.maximum.at(each, owner, odds[slots])
    return np.concatenate([each[w.word], [-9.0]])


def train(texts: list[str], toxic: list[int], seed: int = 5, steps: int = 220, batch: int = 96) -> Network | None:
    """Fit with Adam on mined windows, half of each batch from toxic texts. None unless both labels occur."""
    y = np.array(toxic, np.float64)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    b = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw, offsets = np.frombuffer(b"".join(b), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in b])]).astype(np.int64)
    w = read_all(raw, offsets)
    if not len(w.word):
        return None
    at, of = windows(w.row, len(y))
    each = _evidence(w, y)
    clue = each[at].max(axis=1)
    top = np.full(len(y), -9.0)
    np.maximum.at(top, of, clue)
    # a quarter of the texts is kept back to find where to divide, if that leaves enough toxic ones
    back = rng.random(len(y)) < 0.25
    if y[back].sum() < ENOUGH:
        back[:] = False
    # texts without a clear window teach nothing, as their labels may be wrong, unless too few have one
    clear = clue >= CLEAR
    if len(np.unique(of[clear & (y[of] == 1) & ~back[of]])) < ENOUGH // 4:
        clear = (clue >= np.minimum(CLEAR, top[of])) & (clue > 0.7)
    yes = np.flatnonzero((y[of] == 1) & ~back[of] & clear)
    no = np.flatnonzero((y[of] == 0) & ~back[of])
    if not len(yes) or not len(no):
        return None
    net = Network(seed)
    kept = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        half = batch // 2
        i = np.concatenate([rng.choice(yes, half), rng.choice(no, batch - half)])
        pick = at[i]
        if step % 4 == 0:  # windows may lack a beginning that tells nothing, so that short texts are known too
            low = rng.integers(0, WINDOW - 8, batch)[:, None]
            pick = np.where((np.arange(WINDOW) < low) & (each[pick] < 2), -1, pick)
        mask = (pick >= 0).astype(np.float32).T
        mask[-1] = np.where(mask.sum(axis=0) == 0, 1, mask[-1])
        token = np.where(pick >= 0, w.word[pick], 0).T
        own = distinct(token.ravel())
        token = np.searchsorted(own, token)
        sub = w.pick(own)
        v = net.inputs(sub)
        label = y[of[i]]
        g, dv = net.gradients(v, token, mask, label, np.ones(batch))
        rate = 0.02 * min(1, step / 20) * (1 - 0.9 * step / steps)
        for k, d in g.items():
            _adam(net.p[k], d, *kept[k], rate, step, slice(None))
        slot = distinct(sub.slots)
        _adam(net.p["word"], sum_rows(np.searchsorted(slot, sub.slots), dv[:, :WORD_DIM], len(slot)), *kept["word"], rate, step, slot)
        all_slots, owner = np.concatenate([g for g, _ in sub.grams]), np.concatenate([o for _, o in sub.grams])
        slot = distinct(all_slots)
        d = (dv[:, WORD_DIM:] / np.sqrt(np.bincount(owner, minlength=len(own)))[:, None].astype(np.float32))[owner]
        _adam(net.p["gram"], sum_rows(np.searchsorted(slot, all_slots), d, len(slot)), *kept["gram"], rate, step, slot)
        if step in (steps // 2, 3 * steps // 4):  # the worst windows of clean texts teach more
            some = rng.choice(no, min(len(no), 6000), replace=False)
            z = net.logits(w, at[some])
            hard = some[np.argsort(-z)[: max(1, len(some) // 20)]]
            no = np.concatenate([no, np.repeat(hard, max(1, len(no) // (3 * len(hard))))])
    # where to divide: the worst windows of the texts kept back, or of all
    part = back[of] if back.any() else np.ones(len(of), bool)
    z = net.logits(w, at[part])
    worst = np.full(len(y), np.nan)
    for r, x in zip(of[part], z, strict=True):
        worst[r] = x if np.isnan(worst[r]) else max(worst[r], x)
    net.move = _divide(worst[(y == 1) & ~np.isnan(worst)], worst[(y == 0) & ~np.isnan(worst)])
    return net


def _adam(p: np.ndarray, d: np.ndarray, m: np.ndarray, v: np.ndarray, rate: float, step: int, at) -> None:
    m[at] = 0.9 * m[at] + 0.1 * d
    v[at] = 0.99 * v[at] + 0.01 * d * d
    p[at] -= (rate * (m[at] / (1 - 0.9**step)) / (np.sqrt(v[at] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)


def _divide(bad: np.ndarray, good: np.ndarray) -> float:
    """The logit between the classes with the fewest errors, a clean text's counting twice; the middle of the best gap."""
    if not len(bad) or not len(good):
        return 0.0
    cuts = np.unique(np.concatenate([bad, good]))
    cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
    errors = np.searchsorted(np.sort(bad), cuts) / len(bad) + 2 * (len(good) - np.searchsorted(np.sort(good), cuts)) / len(good)
    least = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float((cuts[least[0]] + cuts[least[-1]]) / 2)


def sample(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = TRAIN_ROWS) -> pd.DataFrame:
    """At most ``rows`` rows of each label with their whole texts: those with the smallest id hashes."""
    marked = labels.filter(usable & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").alias("y"), F.xxhash64("doc_id", F.lit(23)).alias("spot"))
    ids = None
    for y in (0, 1):
        part = marked.filter(F.col("y") == y).orderBy("spot", "doc_id").limit(rows)
        ids = part if ids is None else ids.union(part)
    # at most 2 * rows ids: few enough to send to every task
    got = docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(ids.distinct()), "doc_id")
    return got.select("spot", "y", "text").orderBy("spot", "y", "text").limit(2 * rows).toPandas()


def _scorer(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = np.zeros(len(b.column("text")))
            if net is not None:
                raw, offsets = text_bytes(b.column("text"))
                for low, high in row_chunks(offsets, CHUNK):
                    w = read_words(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                    if not len(w.word):
                        continue
                    at, of = windows(w.row, high - low)
                    best = np.full(high - low, -np.inf)
                    np.maximum.at(best, of, net.logits(w, at))
                    scores[low:high] = np.where(np.isfinite(best), _sigmoid(np.clip(best - net.move, -40, 40)), 0.0)
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def score(docs: DataFrame, labels: DataFrame, held_out: Column, usable: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs; learns from labels where usable holds.

    A text that is null or has no word scores 0, as do all texts if the labels to
    learn from lack one of the classes. Texts of any length are scored whole, by
    their worst window. Repeated rows give repeated results, an empty table gives
    none. Reads doc_id and text, and doc_id and toxic of labels; other columns don't
    matter, whatever their names.
    """
    learn = sample(docs, labels, usable)
    net = train(learn["text"].tolist(), learn["y"].tolist())
    return docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text").mapInArrow(_scorer(net), "doc_id long, held_out boolean, score double, predicted int")
