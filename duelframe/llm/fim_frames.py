"""Fill-in-middle (13): texts as seekable compressed frames.

A text is stored as independent zstandard frames of at most ``frame_bytes``
bytes, cut between characters, beside a seek table: bytes, lines and
characters before each frame, and where its compressed bytes end.  A line is
``[^\\n]*\\n|[^\\n]+``.  Prefix, middle and suffix end after a number of lines;
the cumulative line counts name the frame of a cut, and only that frame is
decompressed to find its place.  The output is a frame store of its own:
whole frames of a section are taken over as they are, markers and the parts
of cut frames that meet are compressed anew, together.  Digests stream frames in
order, one frame in memory; restoring reads the sections from the output,
found by their markers, in the order of the text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import small_batches, text_chunks, tidy
from duelframe.session import scratch_path

#: fixed values: the markers of prefix, suffix and middle
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, RATE, SPM = 7, 100, 50
SEEK = ["dfx_bytes", "dfx_lines", "dfx_chars", "dfx_ends"]
STORE = "dfx_id long, dfx_marked boolean, dfx_bytes array<long>, dfx_lines array<long>, dfx_chars array<long>, dfx_ends array<long>, dfx_frames binary"
CUT = "n long, form string, prefix_chars long, middle_chars long"


def _characters(data: bytes) -> int:
    """Code points of a piece of UTF-8."""
    raw = np.frombuffer(data, np.uint8)
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


class Frames:
    """One stored text: the seek table (bytes, lines and characters before each frame, and in all) and the frames."""

    def __init__(self, size, lines, chars, ends, data):
        self.size, self.lines, self.chars, self.ends, self.data = size, lines, chars, ends, data

    def __len__(self) -> int:
        return len(self.ends)

    def packed(self, f: int):
        return self.data[self.ends[f - 1] if f else 0:self.ends[f]]

    def frame(self, f: int, zstd: zstandard.ZstdDecompressor) -> bytes:
        return zstd.decompress(self.packed(f), max_output_size=self.size[f + 1] - self.size[f])

    def n_lines(self, zstd) -> int:
        """All newlines, and the last line if none ends it."""
        if not len(self):
            return 0
        return self.lines[-1] + (not self.frame(len(self) - 1, zstd).endswith(b"\n"))

    def place(self, lines: int, zstd) -> tuple[int, int]:
        """(bytes, characters) before the end of line ``lines``; one frame at most is read."""
        if lines <= 0:
            return 0, 0
        if lines > self.lines[-1]:
            return self.size[-1], self.chars[-1]
        f = bisect_left(self.lines, lines) - 1
        data, at = self.frame(f, zstd), -1
        for _ in range(lines - self.lines[f]):
            at = data.index(b"\n", at + 1)
        return self.size[f] + at + 1, self.chars[f] + _characters(data[:at + 1])

    def read(self, start: int, end: int, zstd) -> Iterator[bytes]:
        """The bytes from ``start`` to ``end``, frame by frame."""
        f = max(bisect_right(self.size, start) - 1, 0)
        while start < end:
            lo, hi = self.size[f], self.size[f + 1]
            yield self.frame(f, zstd)[start - lo:end - lo]
            start, f = min(hi, end), f + 1


class FrameWriter:
    """Gathers frames and their seek table; pieces that meet are one frame of up to ``most`` bytes."""

    def __init__(self, most: int = 0):
        self.most, self.held = most, b""
        self.size, self.lines, self.chars, self.ends, self.parts = [0], [0], [0], [], []

    def take(self, packed, size: int, lines: int, chars: int) -> None:
        """A frame that is compressed already."""
        self.parts.append(packed)
        for held, more in ((self.size, size), (self.lines, lines), (self.chars, chars)):
            held.append(held[-1] + more)
        self.ends.append((self.ends[-1] if self.ends else 0) + len(packed))

    def add(self, data: bytes, zstd: zstandard.ZstdCompressor) -> None:
        if len(self.held) + len(data) > self.most:
            self.close(zstd)
        self.held += data

    def close(self, zstd: zstandard.ZstdCompressor) -> None:
        """Ends the frame of the pieces added last."""
        data, self.held = self.held, b""
        if data:
            self.take(zstd.compress(data), len(data), data.count(b"\n"), _characters(data))

    def add_text(self, data: bytes, frame_bytes: int, zstd) -> None:
        at = 0
        while at < len(data):
            to = min(at + frame_bytes, len(data))
            while to < len(data) and to > at + 1 and data[to] & 0xC0 == 0x80:      # not inside a character
                to -= 1
            self.add(data[at:to], zstd)
            at = to
        self.close(zstd)

    def section(self, store: Frames, start: int, end: int, pack, unpack) -> None:
        """Bytes of another store: whole frames as they are, cut ones anew."""
        f = max(bisect_right(store.size, start) - 1, 0)
        while start < end:
            lo, hi = store.size[f], store.size[f + 1]
            if start == lo and hi <= end and (hi - lo + len(self.held) > self.most or not self.held):
                self.close(pack)
                self.take(store.packed(f), hi - lo, store.lines[f + 1] - store.lines[f], store.chars[f + 1] - store.chars[f])
            else:
                self.add(store.frame(f, unpack)[start - lo:end - lo], pack)
            start, f = min(hi, end), f + 1

    def row(self) -> tuple:
        return self.size, self.lines, self.chars, self.ends, b"".join(self.parts)


def _batch(fields: str, columns: list[list]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    split = [f.rsplit(" ", 1) for f in fields.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, split)], names=[n for n, _ in split])


def write_frames(docs: DataFrame, folder: str | None = None, frame_bytes: int = 1 << 16, level: int = 3,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The frame store of every row's text, written to ``folder`` (scratch if none) and read back.

    Null texts count as empty; an empty text has no frame.  Rows that repeat
    an id or a text are stored as often as they come.  ``dfx_marked`` tells
    texts that hold a marker.  Only the id (read as a long) and the text are
    read, so further columns may have any name.  A text of any length takes
    frames of ``frame_bytes`` at most.  An empty table gives an empty store.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        zstd = zstandard.ZstdCompressor(level=level)
        for batch in batches:
            for part in text_chunks(batch, "dfx_text"):
                rows = []
                for i, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    writer = FrameWriter()
                    writer.add_text(data, frame_bytes, zstd)
                    rows.append((i, any(m in data for m in (PREFIX, SUFFIX, MIDDLE)), *writer.row()))
                yield _batch(STORE, [list(c) for c in zip(*rows)])
        tidy()

    cols = docs.select(F.col(id_col).cast("long").alias("dfx_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("dfx_text"))
    return _stored(cols.mapInArrow(run, STORE), folder or scratch_path(docs.sparkSession, "fim-text"))


def _stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(folder)                  # for the seek tables; frames stay as they are
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """The first four 32-bit numbers of SHA-256 of ``seed:id`` (a null id: nothing after the colon)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k:k + 4], "big") for k in range(0, 16, 4)]


def transformed(doc_id: int | None, store: Frames, marked: bool, pack, unpack, seed: int, rate: int, spm: int):
    """(n, form, prefix_chars, middle_chars) and the frames of the output."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    n = store.n_lines(unpack)
    out = FrameWriter(max(np.diff(store.size), default=0) + len(PREFIX + SUFFIX + MIDDLE))
    if not n or marked or h3 % 100 >= rate:
        out.section(store, 0, store.size[-1], pack, unpack)
        return (n, "plain", None, None), out
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_chars), (b, b_chars) = store.place(first, unpack), store.place(second, unpack)
    prefix, middle, suffix = (PREFIX, 0, a), (MIDDLE, a, b), (SUFFIX, b, store.size[-1])
    form = "spm" if h4 % 100 < spm else "psm"
    for marker, start, end in (suffix, prefix, middle) if form == "spm" else (prefix, suffix, middle):
        out.add(marker, pack)
        out.section(store, start, end, pack, unpack)
    out.close(pack)
    return (n, form, a_chars, b_chars - a_chars), out


def fill_in_middle(store: DataFrame, folder: str | None = None, seed: int = SEED, rate: int = RATE, spm: int = SPM,
                   level: int = 3) -> DataFrame:
    """The transformed texts of a frame store, written as a frame store with n, form, prefix_chars and middle_chars.

    ``n`` is the number of lines.  Empty texts, texts that hold a marker and
    those outside the ``rate`` (percent) stay as they are: form ``plain``,
    lengths null.  Of the others ``spm`` percent are suffix-first.
    """
    def run(batches):
        pack, unpack = zstandard.ZstdCompressor(level=level), zstandard.ZstdDecompressor()
        for batch in batches:
            for part in text_chunks(batch, "dfx_frames"):
                rows = []
                for i, marked, *table in zip(*(c.to_pylist() for c in part.columns)):
                    cut, out = transformed(i, Frames(*table), marked, pack, unpack, seed, rate, spm)
                    rows.append((i, marked, *out.row(), *cut))
                yield _batch(f"{STORE}, {CUT}", [list(c) for c in zip(*rows)])
        tidy()

    small_batches(store.sparkSession)
    out = store.select("dfx_id", "dfx_marked", *SEEK, "dfx_frames").mapInArrow(run, f"{STORE}, {CUT}")
    return _stored(out, folder or scratch_path(store.sparkSession, "fim-output"))


def _find(store: Frames, marker: bytes, start: int, zstd) -> int:
    """Where ``marker`` first is from byte ``start`` on; it may lie across frames."""
    at, tail = start, b""
    for data in store.read(start, store.size[-1], zstd):
        held = tail + data
        k = held.find(marker)
        if k >= 0:
            return at - len(tail) + k
        tail, at = held[len(held) - len(marker) + 1:], at + len(data)
    raise ValueError(f"no {marker.decode()} in a transformed text")


def sections(store: Frames, form: str, zstd) -> list[tuple[int, int]]:
    """(start, end) in the output of prefix, middle and suffix; of the whole for a plain text."""
    end = store.size[-1]
    if form == "plain":
        return [(0, end)]
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    if b"".join(store.read(0, len(first), zstd)) != first:
        raise ValueError(f"a text of form {form} starts with another marker")
    x = _find(store, second, len(first), zstd)
    y = _find(store, MIDDLE, x + len(second), zstd)
    one, two = (len(first), x), (x + len(second), y)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return [prefix, (y + len(MIDDLE), end), suffix]


def _sha(store: Frames, ranges: list[tuple[int, int]], zstd) -> str:
    digest = hashlib.sha256()
    for start, end in ranges:
        for data in store.read(start, end, zstd):
            digest.update(data)
    return digest.hexdigest()


def digests(out: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every row of a transformed store.

    The second digest is of the text put together again from the output and
    its form alone.
    """
    fields = f"dfx_id long, {CUT}, output_sha256 string, restored_sha256 string"
    names = ["dfx_id", *(f.split()[0] for f in CUT.split(", "))]

    def run(batches):
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in text_chunks(batch, "dfx_frames"):
                whole, again = [], []
                for form, *table in zip(*(part.column(c).to_pylist() for c in ("form", *SEEK, "dfx_frames"))):
                    store = Frames(*table)
                    whole.append(_sha(store, [(0, store.size[-1])], zstd))
                    again.append(_sha(store, sections(store, form, zstd), zstd))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(whole, pa.string()), pa.array(again, pa.string())],
                    names=[*names, "output_sha256", "restored_sha256"])
        tidy()

    small_batches(out.sparkSession)
    return out.mapInArrow(run, fields).withColumnRenamed("dfx_id", id_col)


def texts(store: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, text) of every row of a frame store."""
    def run(batches):
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in text_chunks(batch, "dfx_frames", 1 << 20):
                out = []
                for table in zip(*(part.column(c).to_pylist() for c in (*SEEK, "dfx_frames"))):
                    s = Frames(*table)
                    out.append(b"".join(s.read(0, s.size[-1], zstd)).decode())
                yield pa.RecordBatch.from_arrays([part.column("dfx_id"), pa.array(out, pa.string())], names=["dfx_id", "text"])

    small_batches(store.sparkSession)
    return store.mapInArrow(run, "dfx_id long, text string").withColumnRenamed("dfx_id", id_col)
