"""MinHash near-dedup (6): fast similarity sketches, banding, exact verification.

Sketch: ``bins`` coordinates are filled in rounds.  In round i < bins every
shingle is thrown into a random bin with a random value, in round
bins + j every shingle goes into bin j; a bin keeps the smallest value of the
first round that reaches it.  All bins are full after 2*bins rounds at the
latest, after one or two for long texts, and the share of equal bins
estimates the similarity with the concentration of independent samples.

Banding: ``bands`` groups of ``bins / bands`` coordinates.  With 512 bins and
64 bands a pair at similarity 0.8 is missed with probability 8e-6 and a pair
at 0.3 is proposed with 4e-3.

Verification: documents with the same shingle set are one class.  Every band
bucket names one hub, the class with most bucket mates, and its members are
verified against it on their full shingle sets, which links m classes with
m - 1 comparisons; a second hub is taken from outside the first one's
component.  Buckets whose members all lie in one component are done.  In the
others a class x that failed against the first hub u may still be linked with
a member y of another component.  Let D be a set's symmetric difference with
u.  As x failed, such a link needs D(x) and D(y) to share at least
t = (|D(y)| + q * (|u| - |y|)) / 2 shingles, q = (100 - percent) / (100 + percent),
so the |D(y)| - t + 1 rarest shingles of D(y) must meet D(x).  Joining those
finds every remaining pair without listing the pairs of a group: copies that
differ from the hub each in their own way share no rare shingle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm import shingles as sh
from duelframe.llm.common import small_batches, text_chunks, tidy, written
from duelframe.llm.components import connected_components
from duelframe.llm.exact_dedup import kept_rows

_U = np.uint64
FULL = np.iinfo(np.uint64).max
#: candidate documents up to this number are broadcast as a filter (16 bytes each); beyond it they are joined
BROADCAST_IDS = 500_000
CLASS = ["dfx_d1", "dfx_d2", "dfx_n"]


def sketch(h: np.ndarray, bounds: np.ndarray, bins: int) -> np.ndarray:
    """(documents, bins) sketch of each document's distinct hashes; rows of empty sets stay FULL."""
    n_docs, log = len(bounds) - 1, int(bins).bit_length() - 1
    vals = np.full(n_docs * bins, FULL, np.uint64)
    grid = vals.reshape(n_docs, bins)
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(n_docs), sizes)
    shift, mask = _U(64 - log), _U((1 << (64 - log)) - 1)
    for i in range(2 * bins):
        seed = sh.mix(np.array([i + 1], np.uint64) * _U(0xC2B2AE3D27D4EB4F))[0]
        x = sh.mix(h ^ seed)
        key = doc * bins + ((x >> shift).astype(np.int64) if i < bins else i - bins)
        empty = vals[key] == FULL
        np.minimum.at(vals, key[empty], (x & mask)[empty])
        if i < 4 or i % 4 == 3:
            todo = (grid == FULL).any(axis=1) & (sizes > 0)
            if not todo.any():
                break
            stay = todo[doc]
            h, doc = h[stay], doc[stay]
    return grid


def band_keys(grid: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per document and band."""
    rows = grid.shape[1] // bands
    cells = grid.reshape(len(grid), bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * _U(0x9FB21C651E98DF25)
    key = np.repeat(key, len(grid), axis=0)
    for j in range(rows):
        key = sh.mix(key * _U(0xD6E8FEB86659FD93) + cells[:, :, j])
    return key.view(np.int64)


def _sets(column: pa.Array, width: int):
    data, offsets = sh.arrow_bytes(column.fill_null(""))
    hashes, counts = sh.words(data, offsets)
    h, doc = sh.shingles(hashes, counts, width)
    return sh.distinct(h, doc, len(counts))


def _digest(h: np.ndarray, bounds: np.ndarray):
    """Two 64-bit sums over each set: equal sets give equal sums."""
    out = []
    for seed in (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D):
        s = np.concatenate([[_U(0)], np.cumsum(sh.mix(h ^ _U(seed)), dtype=np.uint64)])
        out.append((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64))
    return out


def sketched(docs: DataFrame, id_col: str, text_col: str, width: int, bins: int, bands: int) -> DataFrame:
    """id, set size, set digest and band keys (null for an empty set) of every row."""
    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, "dfx_text", 1 << 20, 2048):
                h, bounds = _sets(part.column(1), width)
                d1, d2 = _digest(h, bounds)
                n = np.diff(bounds)
                keys = band_keys(sketch(h, bounds, bins), bands)
                at = np.arange(0, keys.size + 1, bands, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n), pa.array(d1), pa.array(d2), lists],
                    names=["dfx_id", "dfx_raw", "dfx_n", "dfx_d1", "dfx_d2", "dfx_keys"])
        tidy()

    cols = docs.select(F.col(id_col).cast("long").alias("dfx_id"), F.col(text_col).alias("dfx_text"),
                       F.xxhash64(text_col).alias("dfx_raw"))
    return cols.mapInArrow(run, "dfx_id long, dfx_raw long, dfx_n long, dfx_d1 long, dfx_d2 long, dfx_keys array<long>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """The digest and the sorted distinct shingle hashes of every row."""
    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, "dfx_text", 1 << 20, 2048):
                h, bounds = _sets(part.column(0), width)
                d1, d2 = _digest(h, bounds)
                lists = pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.diff(bounds)), pa.array(d1), pa.array(d2), lists.cast(pa.list_(pa.int64()))],
                    names=["dfx_n", "dfx_d1", "dfx_d2", "dfx_set"])
        tidy()

    cols = docs.select(F.col(text_col).alias("dfx_text"))
    return cols.mapInArrow(run, "dfx_n long, dfx_d1 long, dfx_d2 long, dfx_set array<long>")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v, ...) with the shingle sets su and sv."""
    a = sets.select(F.col("dfx_c").alias("u"), F.col("dfx_set").alias("su"))
    b = sets.select(F.col("dfx_c").alias("v"), F.col("dfx_set").alias("sv"))
    return pairs.join(b, "v").join(a, "u")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v, nu, nv, apart, linked): size of the symmetric difference and whether the pair is a link."""
    both = F.size(F.array_intersect("su", "sv")).cast("long")
    j = _with_sets(pairs.select("u", "v"), sets).select(
        "u", "v", F.size("su").cast("long").alias("nu"), F.size("sv").cast("long").alias("nv"), both.alias("both"))
    union = F.col("nu") + F.col("nv") - F.col("both")
    return j.select("u", "v", "nu", "nv", (union - F.col("both")).alias("apart"),
                    (F.lit(100) * F.col("both") >= F.lit(percent) * union).alias("linked"))


def _relabelled(live: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """Members of the buckets that still hold two components, with the labels of now."""
    live = live.drop("lab").join(labels, live["c"] == labels["id"], "left").withColumn(
        "lab", F.coalesce("lab", "c")).drop("id")
    mixed = live.groupBy("key").agg(F.min("lab").alias("lo"), F.max("lab").alias("hi")).filter("lo < hi")
    return written(live.join(mixed.select("key"), "key", "left_semi"), name)


def _by_difference(live: DataFrame, first: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that may still be links, by what sets them apart from their hub."""
    q = (100 - percent) / (100 + percent)
    group = live.select("hub", "c", "lab").distinct()
    rows = first.join(group, (first["u"] == group["hub"]) & (first["v"] == group["c"])).drop("hub", "c")
    apart = F.concat(F.array_except("su", "sv"), F.array_except("sv", "su"))
    cells = _with_sets(rows, sets).select(
        "u", "v", "nu", "nv", "apart", "linked", "lab", F.explode(apart).alias("e"))
    cells = written(cells, "near-apart")
    seen = cells.groupBy("u", "e").agg(F.count(F.lit(1)).alias("seen"))
    shared = F.ceil((F.col("apart") + q * (F.col("nu") - F.col("nv"))) / 2 - 1e-6)
    rarest = Window.partitionBy("u", "v").orderBy("seen", "e")
    ranked = cells.join(seen, ["u", "e"]).withColumn("rn", F.row_number().over(rarest)).filter("seen > 1")
    some = ranked.filter(F.col("rn") <= F.col("apart") - shared + 1).select(
        "u", "e", F.col("v").alias("y"), F.col("nv").alias("ny"), F.col("apart").alias("ay"), F.col("lab").alias("ly"),
        F.col("rn").alias("ry"))
    failed = ranked.filter(~F.col("linked")).select(
        "u", "e", F.col("v").alias("x"), F.col("nv").alias("nx"), F.col("apart").alias("ax"), F.col("lab").alias("lx"),
        F.col("rn").alias("rx"))
    # of ``need`` shared shingles the rarest has need - 1 after it on both sides
    need = F.ceil((F.col("ax") + F.col("ay") - q * (F.col("nx") + F.col("ny"))) / 2 - 1e-6)
    met = some.join(failed, ["u", "e"]).filter(
        (F.col("x") != F.col("y")) & (F.col("lx") != F.col("ly"))
        & (F.col("ry") <= F.col("ay") - need + 1) & (F.col("rx") <= F.col("ax") - need + 1))
    return met.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
               percent: int = 80, bins: int = 512, bands: int = 64) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, raw_hash (of the text as it was), kept.

    Null, empty and word-less texts have an empty set, are their own
    component and are linked with nothing.  ``component_id`` is the smallest
    id reachable (null ids count as the largest).  ``kept`` marks one row of
    each component: the smallest id, and of rows that repeat that id any one.
    Ids are read as longs; only the id and the text are read.
    """
    small_batches(docs.sparkSession)
    rows = sketched(docs, id_col, text_col, width, bins, bands)
    rows = written(rows.withColumn("dfx_uid", F.monotonically_increasing_id()), "near-sketch")
    some = rows.filter("dfx_n > 0")
    classes = some.groupBy(*CLASS).agg(
        F.min(F.struct(F.col("dfx_id").isNull(), "dfx_id", "dfx_uid")).alias("dfx_r"),
        F.min("dfx_uid").alias("dfx_c"), F.min_by("dfx_keys", "dfx_uid").alias("dfx_keys"))
    classes = written(classes, "near-classes")

    # buckets of two classes and more
    spread = classes.select(F.col("dfx_c").alias("c"), F.col("dfx_n").alias("n"),
                            F.explode("dfx_keys").alias("key"))
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = written(spread.join(shared, "key"), "near-members")
    central = members.groupBy("c").agg(F.sum("m").alias("w"))
    members = written(members.join(central, "c").select("key", "c", "n", "w"), "near-buckets")

    # full sets of the classes that share a bucket
    ids = (classes.join(central.select(F.col("c").alias("dfx_c")), "dfx_c", "left_semi"))
    cand = written(ids.select(*CLASS, "dfx_c", F.col("dfx_r.dfx_id").alias("dfx_id")), "near-cand")
    want = cand.select(F.col("dfx_id").alias("dfx_want")).distinct()
    if cand.count() <= BROADCAST_IDS:
        want = F.broadcast(want)
    texts = docs.select(F.col(id_col).cast("long").alias("dfx_id"), F.col(text_col).alias("dfx_text"))
    texts = texts.join(want, F.col("dfx_id").eqNullSafe(F.col("dfx_want")), "left_semi")
    sets = full_sets(texts, "dfx_id", "dfx_text", width).join(cand.drop("dfx_id"), CLASS)
    sets = written(sets.select("dfx_c", "dfx_set").dropDuplicates(["dfx_c"]), "near-sets")

    hubs = members.groupBy("key").agg(F.max_by("c", F.struct("w", F.negative("c"))).alias("hub"))
    live = members.join(hubs, "key").withColumn("lab", F.col("c"))
    pairs = live.filter("c <> hub").select(F.col("hub").alias("u"), F.col("c").alias("v")).distinct()
    first = written(_compared(pairs, sets, percent), "near-first")
    labels = connected_components(first.filter("linked"))

    live = _relabelled(live, labels, "near-live1")
    if not live.isEmpty():                                 # a second hub, from another component than the first
        near = live.join(labels.select(F.col("id").alias("hub"), F.col("lab").alias("hublab")), "hub", "left").withColumn(
            "hublab", F.coalesce("hublab", "hub"))
        second = near.filter("lab <> hublab").groupBy("key").agg(
            F.max_by(F.struct("c", "lab"), F.struct("w", F.negative("c"))).alias("h"))
        pairs = live.join(second, "key").filter("lab <> h.lab and c <> hub").select(
            F.col("h.c").alias("u"), F.col("c").alias("v")).distinct()
        found = written(_compared(pairs, sets, percent).filter("linked").select("u", "v"), "near-second")
        labels = connected_components(found, labels)
        live = _relabelled(live, labels, "near-live2")
    if not live.isEmpty():                                 # exactly the rest
        pairs = _by_difference(live, first, sets, percent)
        found = written(_compared(pairs, sets, percent).filter("linked").select("u", "v"), "near-rest")
        labels = connected_components(found, labels)
    return _result(rows, classes, labels, id_col)


def _result(rows: DataFrame, classes: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    comp = classes.join(labels, classes["dfx_c"] == labels["id"], "left").select(
        *CLASS, "dfx_r", F.coalesce("lab", "dfx_c").alias("dfx_comp"))
    heads = comp.groupBy("dfx_comp").agg(F.min("dfx_r").alias("dfx_head"))
    comp = comp.join(heads, "dfx_comp").select(*CLASS, "dfx_head")
    out = rows.drop("dfx_keys").join(comp, CLASS, "left")
    empty = F.col("dfx_n") == 0
    return out.select(
        F.col("dfx_id").alias(id_col), F.col("dfx_n").alias("n_shingles"),
        F.when(empty, F.col("dfx_id")).otherwise(F.col("dfx_head.dfx_id")).alias("component_id"),
        F.col("dfx_raw").alias("raw_hash"),
        (empty | (F.col("dfx_uid") == F.col("dfx_head.dfx_uid"))).alias("kept"))


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one of each component.

    A row is known by its id and the digest of its text; rows equal in both
    are one row.
    """
    found = near_dedup(docs, id_col, text_col, **how)
    found = written(found.select(F.col(id_col).alias("dfx_kid"), F.col("raw_hash").alias("dfx_kraw"), "kept"), "near-kept")
    rows = docs.withColumn("dfx_raw", F.xxhash64(F.col(text_col))).withColumn("dfx_long", F.col(id_col).cast("long"))
    return kept_rows(rows, found, [("dfx_long", "dfx_kid"), ("dfx_raw", "dfx_kraw")]).drop("dfx_raw", "dfx_long")
