"""Source divergence audit (11): smoothed term distributions of sources, duplicate texts collapsed first.

Identical texts of a language are found by digest (SHA-256, length and a
64-bit hash); per text and source only a number of copies is kept.  One copy
of each text, compressed on its way, is then tokenized, and its term counts and document frequency
are added once for each source, times the copies there.  A text found in
many sources meets them in slots of SLOT sources.

A term stays if it is in ``min_docs`` documents of its language.  With count
c, the counts' sum N and V kept terms, p = 1 + floor(10^9 (c + 5) / (N + 5 V)).
Terms a source lacks all have its base value, so a pair of sources differs by
V |base - base'| plus, for the terms that at least one of them has, what
|p - p'| exceeds |base - base'|.  Those terms meet in blocks of terms x
sources x sources, one numpy matrix each; a block returns one partial sum per
pair of its sources, never a row per term and pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.common import small_batches, text_chunks, tidy, written
from duelframe.llm.shingles import arrow_bytes

MIN_DOCS, TOP = 30, 50
SLOT = 16                        # sources of one text in a row
SOURCES, TERMS = 256, 128        # of a block, about
KEY = ["lang", "dfx_sha", "dfx_len", "dfx_check"]
COUNTS = "lang string, source string, term string, n long, docs long"


def _fold() -> np.ndarray:
    """A-Z lower-cased, a-z and all bytes of non-ASCII characters as they are, the rest a space."""
    table = np.full(256, 0x20, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    table[0x61:0x7B] = table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


_FOLD = _fold()


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct terms, place of each occurrence among them, its text) of an Arrow column of texts."""
    data, offsets = arrow_bytes(column)
    plain = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(_FOLD[data]))
    words = pc.ascii_split_whitespace(plain)
    text = np.repeat(np.arange(len(column)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    flat = pc.list_flatten(words)
    there = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(there).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), text[there.to_numpy(zero_copy_only=False)]


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys, and each array's sums over them."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], *(np.add.reduceat(v[order], first) if len(key) else v[:0] for v in values)


def packed(texts: DataFrame) -> DataFrame:
    """KEY and the text (dfx_text) as a zstandard frame (dfx_packed)."""
    def run(batches):
        zstd = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in text_chunks(batch, "dfx_text"):
                frames = pa.array([zstd.compress(t) for t in part.column("dfx_text").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in KEY), frames], names=[*KEY, "dfx_packed"])
        tidy()

    small_batches(texts.sparkSession)
    cols = texts.select(*KEY, F.col("dfx_text").cast("binary").alias("dfx_text"))
    return cols.mapInArrow(run, "lang string, dfx_sha binary, dfx_len int, dfx_check long, dfx_packed binary")


def _unpacked(batches, limit: int):
    """(lang, text, copies) of about ``limit`` bytes of text at once, one row at least."""
    zstd = zstandard.ZstdDecompressor()
    held, size = [], 0

    def out():
        lang, texts, copies = (pa.concat_arrays([h[c] for h in held]) for c in range(3))
        return lang, pa.array([zstd.decompress(t) for t in texts.to_pylist()], pa.large_string()), copies

    for batch in batches:
        lengths, first = batch.column("dfx_len").to_pylist(), 0
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                held.append([batch.column(c).slice(first, i - first) for c in ("lang", "dfx_packed", "dfx_copies")])
                yield out()
                held, size, first = [], 0, i
            size += n
        held.append([batch.column(c).slice(first) for c in ("lang", "dfx_packed", "dfx_copies")])
    if size:
        yield out()


def counted(texts: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) from (lang, dfx_len, dfx_packed, dfx_copies: array of (source, n)), summed per batch only."""
    def run(batches):
        for langs, column, copies in _unpacked(batches, 6 << 20):
            names, code, text = terms_of(column)
            if not len(names):
                continue
            key, tf = _summed(text * len(names) + code, np.ones(len(code), np.int64))
            text, code = key // len(names), key % len(names)
            held = pc.list_flatten(copies)
            per_text = pc.list_value_length(copies).to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.concatenate([[0], np.cumsum(per_text)])
            lang = langs.dictionary_encode()
            source = held.field("source").dictionary_encode()
            n = held.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
            lang_of, source_of = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lang, source))
            grown = np.cumsum(per_text[text])
            at = 0
            while at < len(text):                                    # about a million rows at once
                to = max(at + 1, int(np.searchsorted(grown, (grown[at - 1] if at else 0) + (1 << 20), side="right")))
                t, size = text[at:to], per_text[text[at:to]]
                row = np.repeat(np.arange(at, to), size)
                copy = np.repeat(first[t], size) + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                group = lang_of[text[row]] * len(source.dictionary) + source_of[copy]
                key, total, docs = _summed(group * len(names) + code[row], tf[row] * n[copy], n[copy])
                group, word = key // len(names), key % len(names)
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(group // len(source.dictionary))).cast(pa.string()),
                     source.dictionary.take(pa.array(group % len(source.dictionary))).cast(pa.string()),
                     names.take(pa.array(word)).cast(pa.string()), pa.array(total), pa.array(docs)],
                    names=[f.split()[0] for f in COUNTS.split(", ")])
                at = to
        tidy()

    small_batches(texts.sparkSession)
    return texts.mapInArrow(run, COUNTS)


def collapsed(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> tuple[DataFrame, DataFrame]:
    """(copies, texts): number of copies per text and source; one row per text and slot of sources."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("dfx_text"))
    rows = rows.select("lang", "source", "dfx_text", F.unhex(F.sha2("dfx_text", 256)).alias("dfx_sha"),
                       F.octet_length("dfx_text").alias("dfx_len"), F.xxhash64("dfx_text").alias("dfx_check"))
    copies = written(rows.groupBy(*KEY, "source").agg(F.count(F.lit(1)).alias("n")), "divergence-copies")
    wide = copies.groupBy(*KEY).agg(F.ceil(F.count(F.lit(1)) / SLOT).alias("dfx_slots"))
    slots = copies.join(wide, KEY).withColumn("dfx_slot", F.pmod(F.xxhash64("source"), "dfx_slots"))
    slots = slots.groupBy(*KEY, "dfx_slot").agg(F.collect_list(F.struct("source", "n")).alias("dfx_copies"))
    texts = packed(rows.filter("dfx_len > 0")).dropDuplicates(KEY)
    return copies, texts.join(slots, KEY).select("lang", "dfx_len", "dfx_packed", "dfx_copies")


def _p(count: str, total: str, kept: str):
    """1 + floor(10^9 (count + 5) / (total + 5 kept)), exact."""
    return F.expr(f"1 + cast(10 as decimal(10,0)) * 100000000 * cast({count} + 5 as decimal(25,0)) div "
                  f"cast({total} + 5 * {kept} as decimal(25,0))")


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language."""
    most = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s"), F.max("kept").alias("v")).agg(F.max("s"), F.max("v")).first()
    wide, high = -(-(most[0] or 1) // SOURCES), -(-(most[1] or 1) // TERMS) or 1
    side = F.pmod(F.xxhash64("source"), F.lit(wide)).cast("int")
    block = F.pmod(F.xxhash64("term"), F.lit(high)).cast("int")
    rows = cells.select("lang", "source", "base", "kept", block.alias("dfx_t"), "term", "p")
    heads = groups.select("lang", "source", "base", "kept", F.explode(F.sequence(F.lit(0), F.lit(high - 1))).alias("dfx_t"),
                          F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"))
    others = F.explode(F.sequence(F.lit(0), F.lit(wide - 1)))
    rows = rows.unionByName(heads).withColumn("dfx_s", side).withColumn("dfx_o", others)
    rows = rows.select("lang", "source", "base", "kept", "dfx_t", "term", "p", "dfx_s", F.least("dfx_s", "dfx_o").alias("dfx_a"),
                       F.greatest("dfx_s", "dfx_o").alias("dfx_b"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        head = table.filter(pc.is_null(table["term"]))
        names, base = head["source"].combine_chunks(), head["base"].to_numpy()
        kept, side = head["kept"].to_numpy(), head["dfx_s"].to_numpy()
        cell = table.filter(pc.is_valid(table["term"]))
        row = pc.index_in(cell["source"], names).to_numpy()
        column = cell["term"].combine_chunks().dictionary_encode()
        values = np.repeat(base[:, None], len(column.dictionary), axis=1)
        values[row, column.indices.to_numpy(zero_copy_only=False)] = cell["p"].to_numpy()
        a, b = table["dfx_a"][0].as_py(), table["dfx_b"][0].as_py()
        left, right = np.flatnonzero(side == a), np.flatnonzero(side == b)
        whole = kept[0] if table["dfx_t"][0].as_py() == 0 else 0     # the terms that neither has, once
        out = [(g, h, np.abs(values[h] - values[g]).sum(axis=1) + (whole - values.shape[1]) * np.abs(base[h] - base[g]))
               for g, h in ((g, right[right != g]) for g in left)]
        g = np.concatenate([np.full(len(h), g) for g, h, _ in out] or [np.zeros(0, np.int64)])
        h = np.concatenate([h for _, h, _ in out] or [np.zeros(0, np.int64)])
        value = np.concatenate([v for *_, v in out] or [np.zeros(0, np.int64)])
        if a != b:
            g, h, value = np.concatenate([g, h]), np.concatenate([h, g]), np.concatenate([value, value])
        lang = pa.array([table["lang"][0].as_py()] * len(g), pa.string())
        return pa.table([lang, names.take(pa.array(g)), names.take(pa.array(h)), pa.array(value.astype(np.int64))],
                        names=["lang", "source", "item", "value"])

    parts = rows.groupBy("lang", "dfx_t", "dfx_a", "dfx_b").applyInArrow(run, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others of its language.

    Part ``pair``: every other source, by the sum over the kept terms of
    |p - p'| (0 without kept terms).  Part ``term``: the ``top`` kept terms
    the source has with p above the language's, by the difference.  Ranks
    run by value (largest first), then item in UTF-8 order.

    Null texts, languages and sources count as empty strings, which are a
    language and a source of their own; sources without terms are compared
    too.  Repeated rows count as often as they come.  Other columns are not
    read.  An empty table gives no row.
    """
    copies, texts = collapsed(docs, text_col, lang_col, source_col)
    counts = counted(texts).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = written(counts, "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = written(kept.filter(F.col("docs") >= min_docs).select("lang", "term", "lang_n"), "divergence-kept")
    cells = written(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "divergence-cells")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = copies.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "kept", "lang_total"]).withColumn(
        "base", F.when(F.col("kept") > 0, _p("0", "total", "kept")).otherwise(0))
    groups = written(groups, "divergence-groups")

    cells = cells.join(groups, ["lang", "source"]).withColumn("p", _p("n", "total", "kept"))
    pairs = _pairs(cells, groups)
    above = cells.withColumn("q", _p("lang_n", "lang_total", "kept")).filter("p > q")
    above = above.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    above = above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    both = pairs.withColumn("part", F.lit("pair")).unionByName(above.withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", "rank")
