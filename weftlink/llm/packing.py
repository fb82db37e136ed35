"""Packing documents into sequences by order-preserving dynamic programming.

Documents keep their order. The tokens of a run of documents are cut into windows of
at most LENGTH; cuts lie at document or sentence ends, or, at a higher price, at
every GRID-th token. The windows chosen minimise padding plus the price of cutting a
document. A window is padded to LENGTH unless its length is a power of two. Over the
windows that are padded the best predecessor of a cut is the minimum of
cost + position in a sliding range, which a monotone queue keeps; the few
predecessors at a power of two are looked at besides.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

LENGTH = 1024
SENTENCE_PRICE = 1.0
INNER_PRICE = 6.0
GRID = 128
#: Tokens that are packed at once; a sequence doesn't cross from one run to the next.
RUN = 1 << 19
END = 0


class Encoder:
    """Byte-level BPE ids of whole texts, as tokenizers gives them without special tokens added.

    A text of Latin letters (below U+0250) is encoded by the same ranks in tiktoken,
    which is faster; any other by tokenizers, whose tables of letters may differ
    beyond. A special token's string inside a text is that token, as tokenizers has
    it by default, unless ``plain`` makes it ordinary text.
    """

    def __init__(self, path: str, plain: bool = False) -> None:
        import json

        import tiktoken

        self.path, self.plain = path, plain
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = {c: b for b, c in _byte_letters().items()}
        special = {x["content"] for x in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
        self.latin = tiktoken.Encoding("latin", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.tokens = {v: k for k, v in ranks.items()}
        self.special = [] if plain else sorted(special)

    @cached_property
    def whole(self):
        """The tokenizer itself; loaded by the first text that needs it."""
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.encode_special_tokens = self.plain
        return out

    def ends(self) -> np.ndarray:
        """Of each id, whether a sentence may end behind it."""
        out = np.zeros(max(self.tokens) + 2, bool)
        for i, t in self.tokens.items():
            out[i] = t.rstrip(b" \"')").endswith((b".", b"!", b"?", b"\n"))
        return out

    def ids(self, text: str) -> np.ndarray:
        if (text.isascii() or not BEYOND.search(text)) and not any(s in text for s in self.special):
            return np.array(self.latin._core_bpe.encode_ordinary(text), np.uint32)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)


BEYOND = re.compile("[^\0-\u024f]")
#: Fixed value: the pre-tokenisation pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[int, str]:
    """The printable letter by which a byte-level vocabulary file writes each byte: itself if printable, else the next from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(shown))
    return out


def choose_cuts(position: np.ndarray, price: np.ndarray, length: int = LENGTH) -> list[int]:
    """The cheapest windows over increasing positions (the first 0, steps at most length): indices of the chosen cuts, first and last included.

    price[j] is paid by a cut at position[j]; a window of n pays length - n unless n
    is a power of two. On equal cost the earliest predecessor found stays.
    """
    n = len(position)
    pos = position.tolist()
    cost, prev = [0.0] * n, [0] * n
    # predecessors at a power of two, as (j, i) in order of j
    js, at = [], []
    size = 1
    while size <= length:
        i = np.searchsorted(position, position - size)
        ok = np.flatnonzero((position >= size) & (position[np.minimum(i, n - 1)] == position - size))
        js.append(ok)
        at.append(i[ok])
        size *= 2
    js, at = np.concatenate(js), np.concatenate(at)
    order = np.argsort(js, kind="stable")
    js, at = js[order].tolist() + [n], at[order].tolist()
    fee = price.tolist()
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])
    k = 0
    for j in range(1, n):
        p = pos[j]
        while queue[0][1] < p - length:
            queue.popleft()
        key, _, i = queue[0]
        best = key + length - p
        while js[k] == j:
            if cost[at[k]] < best:
                best, i = cost[at[k]], at[k]
            k += 1
        best += fee[j]
        cost[j], prev[j] = best, i
        key = best + p
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, p, j))
    out = [n - 1]
    while out[-1]:
        out.append(prev[out[-1]])
    return out[::-1]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _packer(path: str, plain: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, plain)
        ends = encoder.ends()
        sequence = TaskContext.get().partitionId() << 33
        held: list[tuple[int | None, int, np.ndarray, int]] = []  # doc_id, ids before these, ids, ids of the document
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence, held, tokens
            out, used = pack(held, ends)
            columns = [pa.array([r[i] + sequence if i == 5 else r[i] for r in out], pa.int64()) for i in range(7)]
            sequence += used
            held, tokens = [], 0
            return pa.record_batch(columns, [x.split()[0] for x in PIECES.split(", ")])

        for b in batches:
            ids_of = b.column("doc_id").to_pylist()
            column = b.column("text")
            for doc, value in zip(ids_of, column, strict=True):
                ids = np.append(encoder.ids(value.as_py() or ""), np.uint32(END))
                at = 0
                while at < len(ids):
                    part = ids[at : at + RUN - tokens]
                    held.append((doc, at, part, len(ids)))
                    at += len(part)
                    tokens += len(part)
                    if tokens >= RUN:
                        yield flush()
        if held:
            yield flush()

    return run


def pack(docs: list[tuple[int | None, int, np.ndarray, int]], ends: np.ndarray, length: int = LENGTH) -> tuple[list[tuple], int]:
    """Pieces (as in PIECES, sequences counted from 0) of consecutive runs of documents' ids, and the number of sequences."""
    sizes = np.array([len(x[2]) for x in docs])
    stop = np.cumsum(sizes)
    ids = np.concatenate([x[2] for x in docs])
    total = int(stop[-1])
    price = np.full(total + 1, np.inf)
    price[0 : total + 1 : GRID] = INNER_PRICE
    price[1:][ends[np.minimum(ids, len(ends) - 1)]] = SENTENCE_PRICE
    price[stop] = 0.0
    price[0] = 0.0
    position = np.flatnonzero(np.isfinite(price))
    chosen = position[choose_cuts(position, price[position], length)]
    edges = np.union1d(chosen, np.concatenate([[0], stop]))
    begin, end = edges[:-1], edges[1:]
    doc = np.searchsorted(stop, begin, "right")
    seq = np.searchsorted(chosen, begin, "right") - 1
    first = stop - sizes
    raw = ids.astype("<u4")
    out = [
        (docs[d][0], docs[d][1] + b - int(first[d]), e - b, zlib.crc32(raw[b:e].tobytes()), docs[d][3], s, b - int(chosen[s]))
        for d, s, b, e in zip(doc.tolist(), seq.tolist(), begin.tolist(), end.tolist(), strict=True)
    ]
    return out, len(chosen) - 1


def pack_documents(docs: DataFrame, tokenizer: str, plain: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and END; null or empty text has END only, an empty table no
    pieces. Each partition of docs is packed on its own in its order, so nothing is
    shuffled, and numbers its sequences from its partition's number times 2**33. A
    document longer than RUN is packed in several runs. Rows that repeat an id are
    packed as often as they occur. Only doc_id and text are read, whatever else there
    is. tokenizer is a path that every executor has; with plain, special tokens'
    strings inside texts are ordinary text.
    """
    return docs.select("doc_id", "text").mapInArrow(_packer(tokenizer, plain), PIECES)
