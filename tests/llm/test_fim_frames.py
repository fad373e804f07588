"""Fill-in-middle over frame stores against plain Python on strings."""

import hashlib
import re

import pytest
import zstandard

from test_operators import docs_of
from duelframe.llm import fim_frames as fim

ROWS = [(1, "one\ntwo\n\nthree", "a"), (2, "no line end", "a"), (3, "", "b"), (4, None, "b"), (None, "x\ny\n", None), (5, "\n\n\n", "b"),
        (6, "a <S> b\nc", "c"), (7, "ü" * 70_000 + "\nmiddle\n" + "é\n" * 50_000, "c"), (8, "tail <", "c"), (9, "P>\n<P", "c"),
        (10, "x" * 3_000_000, "c"), (10, "x" * 3_000_000, "c"), (11, "\r\n  \x0b\n", "d"),
        *[(100 + i, "".join(f"line {k}\n" for k in range(i)), "e") for i in range(40)]]


def plain_python(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(units[a:b]) for a, b in ((0, i), (i, j), (j, n)))
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("frame_bytes", [1 << 16, 7])
def test_awkward_rows_equal_plain_python(spark, frame_bytes):
    rows = ROWS if frame_bytes > 100 else [r for r in ROWS if len(r[1] or "") < 10_000]
    store = fim.write_frames(docs_of(spark, rows).repartition(4), frame_bytes=frame_bytes)
    out = fim.fill_in_middle(store)
    got = sorted(map(str, fim.digests(out).collect()))
    want = []
    for i, t, _ in rows:
        n, form, p, m, text = plain_python(i, t)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (text, t or "")]
        want.append(f"Row(doc_id={i}, n={n}, form='{form}', prefix_chars={p}, middle_chars={m}, output_sha256='{sha[0]}', restored_sha256='{sha[1]}')")
    assert got == sorted(want)
    assert sorted((str(r.doc_id), r.text) for r in fim.texts(out).collect()) == sorted((str(i), plain_python(i, t)[4]) for i, t, _ in rows)


def test_rate_and_form(spark):
    docs = docs_of(spark, ROWS)
    store = fim.write_frames(docs)
    assert {r.form for r in fim.fill_in_middle(store, rate=0).collect()} == {"plain"}
    assert {r.form for r in fim.fill_in_middle(store, spm=100).collect()} == {"plain", "spm"}
    assert fim.digests(fim.fill_in_middle(fim.write_frames(docs.limit(0)))).count() == 0


def test_frames_are_independent_and_seekable():
    pack, unpack = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    text = "".join(f"{k} äö\n" for k in range(500))
    writer = fim.FrameWriter()
    writer.add_text(text.encode(), 64, pack)
    store = fim.Frames(*writer.row())
    assert len(store) > 50 and "".join(store.frame(f, unpack).decode() for f in range(len(store))) == text
    read = []

    class Watch:
        def decompress(self, data, **how):
            read.append(1)
            return unpack.decompress(data, **how)

    at, chars = store.place(250, Watch())
    assert len(read) == 1 and text.encode()[:at].decode() == "".join(text.splitlines(True)[:250]) and chars == len(text.encode()[:at].decode())
    out = fim.FrameWriter()
    out.section(store, at, store.size[-1], pack, unpack)                     # whole frames move as they are
    moved = fim.Frames(*out.row())
    assert bytes(moved.packed(len(moved) - 1)) == bytes(store.packed(len(store) - 1))
    assert b"".join(moved.read(0, moved.size[-1], unpack)) == text.encode()[at:]


def test_markers_across_frames_are_found():
    pack, unpack = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    writer = fim.FrameWriter()
    writer.add_text(b"<P>ab<S><S<M>", 2, pack)
    assert fim.sections(fim.Frames(*writer.row()), "psm", unpack) == [(3, 5), (13, 13), (8, 10)]


def test_markers_and_parts_of_a_small_text_are_one_frame(spark):
    store = fim.write_frames(docs_of(spark, [(i, "".join(f"line {k}\n" for k in range(i)), "e") for i in range(1, 30)]))
    assert {len(r.dfx_ends) for r in fim.fill_in_middle(store).collect()} == {1}
