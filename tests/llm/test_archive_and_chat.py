"""Archives and chat text: exact round trips, broken input, hostile texts, odd rows."""

import base64
import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftlink.llm import chat_format as cf
from weftlink.llm import warc

PAGES = "page_id long, url string, html string, salt string, digest string, top string, copies int"


def archive(spark, rows, path, **more):
    df = spark.createDataFrame([(*r, "a", "b", "c", 1) for r in rows], PAGES)
    warc.write_archive(df, str(path), **more)
    return warc.read_archive(spark, str(path))


def test_archive_round_trip_of_odd_rows(spark, tmp_path):
    long = "".join(random.Random(1).choices("abcdefgh é\r\n0", k=50_000))
    rows = [
        (1, "http://a/ b", long), (2, None, long), (3, "http://c\n", ""), (4, "u", None), (5, "u", "x"), (5, "u", "x"), (5, "v", "x"), (4, "u", "x"),
        (None, "n", "x"), (None, None, "only"), (None, None, "only"), (6, "u", "0\r\n\r\nWARC/1.1\r\n"), (7, "u", "y" * 8192),
    ]
    got = sorted(archive(spark, rows, tmp_path / "a").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "segments").collect(), key=str)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "").encode() == body and j is not None]
        target = max(ids) if ids else None
        revisit = target is not None and i != target
        size = len(warc.frame(body)) + 97 if not revisit else 0
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", target if revisit else None, size))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted((w[:5] for w in want), key=str)
    assert max(r["segments"] for r in got) > 6
    assert archive(spark, rows, tmp_path / "b", least_bytes=2).filter("payload_bytes < 2 and record_type = 'revisit'").count() == 0
    assert archive(spark, rows[:0], tmp_path / "c").count() == 0


def test_records_are_members_that_name_each_other(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "same" * 5000 if i % 2 else f"own {i}") for i in range(20)]
    archive(spark, rows, tmp_path / "a")
    ids, refers, n = set(), set(), 0
    for f in (tmp_path / "a").glob("part-*"):
        data = f.read_bytes()
        at = 0
        while at < len(data):  # any gzip reader gets along with it
            d = zlib.decompressobj(31)
            (fields, _), *rest = warc.parse(d.decompress(data[at:]))
            assert d.eof and not rest
            at = len(data) - len(d.unused_data)
            assert fields["warc-record-id"] not in ids
            ids.add(fields["warc-record-id"])
            refers |= {fields[k] for k in ("warc-refers-to", "warc-segment-origin-id") if k in fields}
            n += 1
    assert n > 20 and refers and refers <= ids


def put(spark, path, records):
    blob = b"".join(warc.member(r) + warc.LAST.encode() for r in records)
    path.mkdir()
    (path / "part-0").write_bytes(blob)
    return warc.read_archive(spark, str(path))


def test_segments_may_come_in_any_order(spark, tmp_path):
    made = list(warc.records(1, "u", b"z" * 30_000))
    random.Random(1).shuffle(made)
    assert put(spark, tmp_path / "x", made).first()["payload_bytes"] == 30_000


@pytest.mark.parametrize("harm", ["missing first", "missing middle", "missing last", "twice", "total", "digest", "chunk"])
def test_broken_segments_end_the_read(spark, tmp_path, harm):
    made = list(warc.records(1, "u", b"z" * 30_000))
    match harm:
        case "missing first":
            made = made[1:]
        case "missing middle":
            made = [made[0], *made[2:]]
        case "missing last":
            made = made[:-1]
        case "twice":
            made = [*made, made[1]]
        case "total":
            made[-1] = made[-1].replace(b"Total-Length: 30", b"Total-Length: 31")
        case "digest":
            made[0] = made[0].replace(b"sha1:", b"sha1:A")
        case "chunk":
            made[0] = made[0].replace(b"1000\r\nz", b"1001\r\nz", 1)
    with pytest.raises(Exception, match="(?i)segment|payload|chunk|record"):
        put(spark, tmp_path / "x", made).collect()


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunk_framing(body, size):
    framed = warc.frame(body, size)
    assert warc.unframe(framed) == body
    for cut in range(0, len(framed) - 2, 7):
        with pytest.raises(ValueError):
            warc.unframe(framed[:cut])


def test_members_cut_short():
    m = warc.member(b"abc") + warc.LAST.encode()
    assert list(warc.members(m * 3, 5)) == [b"abc\r\n\r\n"] * 3
    with pytest.raises(ValueError):
        list(warc.members(m[:-3]))


ROLES = st.sampled_from(["system", "user", "assistant", "tool", "other: ", None, "", 'a"b\\'])
PARTS = st.lists(st.sampled_from(["\\", "### ", "</turn>", " </turn>\n", "Assistant", ": ", "\n", " ", "é", "x", "<", "\\### "]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLES, PARTS), max_size=5))
def test_formatted_text_splits_into_its_turns(turns):
    t = cf.Template()
    formatted = "".join(t.open(r) + t.escape(x) + t.closing for r, x in turns)
    assert cf.split_text(formatted) == turns
    for cut in range(1, len(formatted)):  # a part of it is an error or an earlier end, never another reading
        try:
            assert cf.split_text(formatted[:cut]) == turns[: len(cf.split_text(formatted[:cut]))]
        except ValueError:
            pass


def allowed(roles):
    """The order of roles by hand."""
    before = None
    for r in roles:
        ok = {None: r in ("system", "user"), "system": r == "user", "user": r == "assistant", "assistant": r in ("user", "tool"), "tool": r in ("assistant", "tool")}
        if not ok.get(before, False):
            return False
        before = r
    return True


def test_conversations_of_odd_rows(spark):
    schema = "conv_id long, turn int, role string, text string, seg string, part string, loss string, order_ok string"
    rnd = random.Random(3)
    rows = [(c, i, rnd.choice(["system", "user", "assistant", "tool"]), rnd.choice([None, "", "hi", "</turn>", "\\"])) for c in range(40) for i in range(rnd.randint(1, 5))]
    rows += [(100, 0, "user", "q"), (100, 1, "assistant", "a\n### User: x"), (100, 2, "user", "q"), (100, 3, "assistant", "</turn>")]
    rows += [(None, 0, "user", "n"), (None, 1, None, "x"), (101, None, "weird", "w"), (102, 0, "user", "z" * 300_000), (103, 0, "user", "s"), (103, 0, "user", "s")]
    df = spark.createDataFrame([(*r, "", "", "", "") for r in rows], schema)
    segments = cf.format_conversations(df)
    got = {r["conv_id"]: r for r in cf.digests(segments).collect()}
    said = {}
    for r in sorted(rows, key=lambda r: (r[1] if r[1] is not None else -1, r[2] or "", r[3] or "")):
        said.setdefault(r[0], []).append((r[2], r[3] or ""))
    assert set(got) == set(said)
    t = cf.Template()
    for c, turns in said.items():
        r, loss = got[c], "".join(x for role, x in turns if role == "assistant")
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a or ''}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == sum(len(t.open(a) + t.escape(b) + t.closing) for a, b in turns)
        assert r["order_ok"] == allowed([a for a, _ in turns])
    whole = {}
    for r in sorted(segments.collect(), key=lambda r: (str(r["conv_id"]), r["seg"])):
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["text"]
    assert {c: cf.split_text(x) for c, x in whole.items()} == said
    assert cf.digests(cf.format_conversations(df.limit(0))).count() == 0


def test_reading_back_notices_changed_text(spark):
    rows = [(1, 0, "text", "### User: hi </turn> there </turn>\n", False, True)]
    with pytest.raises(Exception, match="mark inside"):
        cf.digests(spark.createDataFrame(rows, cf.SEGMENTS)).collect()
