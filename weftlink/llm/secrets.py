"""Secret spans: fixed patterns, and sliding-window entropy over candidate strings.

The base patterns find assignments, access keys and hexadecimal runs. The method
adds spans: a candidate is a run of token characters; it is scored by the Shannon
entropy of every window of a character class's length, kept up by adding the counts
of the character that enters and taking off those of the one that leaves. Candidates
on the allow-list, and those that touch a base span, add nothing.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Class, its characters, window length, and the bits a character that a window must reach.
CLASSES = (
    ("hex", re.compile(r"[0-9A-Fa-f]+"), 20, 3.0),
    ("alnum", re.compile(r"[A-Za-z0-9]+"), 20, 3.6),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 20, 3.8),
)
#: Candidates that are no secrets: words and runs of capitalised words, numbers and dates, paths and slugs of words, uuids, and words with a number.
ALLOW = tuple(
    re.compile(x)
    for x in (
        r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,})+[A-Z]?[a-z]?",
        r"[0-9+/_=-]+",
        r"(?:[A-Za-z]+|[0-9]{1,8})(?:[+/_=-]+(?:[A-Za-z]+|[0-9]{1,8}))+[+/_=-]*",
        r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
        r"[A-Za-z]+[0-9]{1,6}",
    )
)
#: c * log2(c) of small counts.
TERM = [0.0] + [c * math.log2(c) for c in range(1, 65)]


def window_entropies(s: str, width: int) -> Iterator[float]:
    """Entropy in bits a character of every window of s, or of s as a whole if it is shorter; by incremental counts."""
    width = min(width, len(s))
    if not width:
        return
    term = TERM if width < len(TERM) else [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        total += term[n + 1] - term[n]
        counts[c] = n + 1
        if i >= width:
            old = s[i - width]
            n = counts[old]
            total += term[n - 1] - term[n]
            counts[old] = n - 1
        if i >= width - 1:
            yield math.log2(width) - total / width


def high_entropy(s: str) -> bool:
    """Whether a window of the narrowest class that holds the whole candidate reaches that class's bits."""
    if any(a.fullmatch(s) for a in ALLOW):
        return False
    for _, chars, width, bits in CLASSES:
        if chars.fullmatch(s):
            return any(e >= bits for e in window_entropies(s, width))
    return False


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind in the order of KINDS. Places count code points, the end exclusive."""
    found: list[tuple[int, int, str]] = []
    low = text.lower()
    if "password" in low or "passwd" in low or "secret" in low or "token" in low or "api" in low:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    base = sorted((a, b) for a, b, _ in found)
    at, reach = 0, -1
    for m in CANDIDATE.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][1])
            at += 1
        if reach <= m.start() and high_entropy(m[0]):
            found.append((m.start(), m.end(), "entropy"))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each maximal union of spans replaced by a mark of the first one's kind."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][1])
        out += [text[at:start], f"[{kind.upper()}]"]
        at, i = end, i + 1
    return "".join([*out, text[at:]])


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


FOUND = "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty = hashlib.sha256(b"").hexdigest()
    for b in batches:
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        shas, joined = [], []
        for value in b.column("text"):
            spans = find_spans(value.as_py() or "")
            base = [s for s in spans if s[2] != "entropy"]
            for k in KINDS:
                counts[k].append(sum(s[2] == k for s in spans) if spans else 0)
            shas.append(hashlib.sha256(_joined(base).encode()).hexdigest() if base else empty)
            joined.append(_joined(spans))
        yield pa.record_batch([b.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(shas, pa.string()), pa.array(joined, pa.string())], [x.split()[0] for x in FOUND.split(", ")])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans) for every row.

    Null text is empty and has no spans; texts of any length are searched whole;
    repeated rows give repeated results, an empty table none. Other columns aren't read.
    """
    return docs.select("doc_id", "text").mapInArrow(_scan, FOUND)


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counted = "n_chars" in b.schema.names and pa.types.is_integer(b.schema.field("n_chars").type)
        out, sizes = [], b.column("n_chars").to_pylist() if counted else None
        for r, value in enumerate(b.column("text")):
            t = value.as_py()
            spans = find_spans(t) if t else []
            out.append(redact(t, spans) if spans else t)
            if spans and sizes is not None:
                sizes[r] = len(out[r])
        for name, column in (("text", out), ("n_chars", sizes)):
            if column is not None:
                b = b.set_column(b.schema.get_field_index(name), name, pa.array(column, b.schema.field(name).type))
        yield b


def remove_secrets(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by a mark, and n_chars, if there is such a number, counted anew where text changed.

    No row is dropped: null and empty texts stay as they are, repeated rows are
    changed alike, an empty table stays empty. Columns may have any names.
    """
    return docs.mapInArrow(_redact, docs.schema)
