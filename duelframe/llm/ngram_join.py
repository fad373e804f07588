"""N-gram Jaccard join (12): the product of the document by n-gram incidence matrix with its transpose, in blocks.

Rows are classes of documents with the same n-gram set, columns are n-grams,
an entry of the product is the overlap of two sets.  Two sets of n <= m
n-grams are linked when 100 * overlap >= percent * union; that bounds the
size of the larger by 100 n / percent, and the n-grams only one of them has
by n (100 - percent) / percent.

Column blocks.  Sets of similar size (a *band* of sizes) deal their n-grams
by hash into k column blocks.  A pair has at most ``d`` n-grams apart, so in
k - d blocks at least both rows are the same.  k is d + 1 and some more: if
a row has fewer than k - d empty blocks, a pair with it meets in a block with
entries; rows that have more (they are rare) name their empty blocks too.
So a pair that has no equal block is below the bound of its sizes and is
never counted, and no linked pair is lost.  A block's content is known by a
64-bit key; a frequent n-gram or passage alone makes no two blocks equal.

Product.  Each key names one *hub* row, the class that meets most others,
and the overlaps of the hub with the key's rows are counted: m classes need
m - 1 entries.  A key whose rows lie in one component is done.  What is left
is counted centred on the hub: with D(x) the n-grams apart between x and its hub u,
x and y are apart by |D(x)| + |D(y)| - 2 |D(x) & D(y)|, so only the sparse
product of the rows D is needed, and of D's entries only those that a pair
above the size-derived bound must share, rarest first.  Every pair found is
confirmed by the overlap of the full sets.

Rows of one key are dealt by (key, salt), facts about a key travel to its
rows by (key, salt) too, and a hub's row meets its partners by (hub, salt),
so no task holds all rows of a key or all partners of a hub.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm import shingles as sh
from duelframe.llm.common import small_batches, text_chunks, tidy, written
from duelframe.llm.components import connected_components

_U = np.uint64
GROWTH = 1.5                       # of the sizes of a band
CLASS = ["dfx_d1", "dfx_d2", "dfx_n"]


def bands(largest: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first size, column blocks, most n-grams apart) of every band up to ``largest``; no blocks where nothing can be apart."""
    first = [1]
    while first[-1] <= largest:
        first.append(max(first[-1] + 1, int(first[-1] * GROWTH)))
    lo, hi = np.array(first[:-1], np.int64), np.array(first[1:], np.int64)
    apart = (hi - 1) * (100 - percent) // percent
    return lo, np.where(apart > 0, apart + 2 + apart // 64, 0), apart


def block_keys(h: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the column blocks of each set (sorted distinct hashes between ``bounds``), and their bounds."""
    n = np.diff(bounds)
    lo, blocks, apart = bands(int(n.max(initial=1)), percent)
    low, high = np.searchsorted(lo, -(-n * percent // 100), side="right") - 1, np.searchsorted(lo, n, side="right") - 1
    found, owner = [], []
    for step in range(int((high - low).max(initial=0)) + 1):
        band = high - step
        rows = np.flatnonzero((n > 0) & (band >= low) & (band >= 0))
        rows = rows[blocks[band[rows]] > 0]
        if not len(rows):
            continue
        size, k, b = n[rows], blocks[band[rows]], band[rows]
        of = np.repeat(np.arange(len(rows)), size)
        g = h[np.repeat(bounds[rows] - np.cumsum(size) + size, size) + np.arange(len(of))]
        first = np.concatenate([[0], np.cumsum(k)])
        seed = sh.mix((b + 1).astype(np.uint64) * _U(0x9FB21C651E98DF25))
        cell = first[of] + (sh.mix(g ^ seed[of]) % k[of].astype(np.uint64)).astype(np.int64)
        held = np.bincount(cell, minlength=first[-1])
        total = np.zeros(first[-1], np.uint64)
        np.add.at(total, cell, sh.mix(g * _U(0xD6E8FEB86659FD93) + seed[of]))
        row = np.repeat(np.arange(len(rows)), k)
        empty = np.add.reduceat(held == 0, first[:-1])
        name = empty >= k - apart[b]                         # too many empty blocks: they are keys too
        place = (np.arange(first[-1]) - first[row]).astype(np.uint64)
        key = sh.mix(total + sh.mix(place * _U(0xC2B2AE3D27D4EB4F) + seed[row]))
        keep = (held > 0) | name[row]
        found.append(key[keep])
        owner.append(rows[row[keep]])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(n) + 1, np.int64)
    owner, key = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    return key[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(n)))])


def _sets(column: pa.Array, width: int):
    data, offsets = sh.arrow_bytes(column.fill_null(""))
    hashes, counts = sh.words(data, offsets)
    h, doc = sh.shingles(hashes, counts, width)
    return sh.distinct(h, doc, len(counts))


def _digest(h: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set: equal sets give equal sums."""
    out = []
    for seed in (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D):
        s = np.concatenate([[_U(0)], np.cumsum(sh.mix(h ^ _U(seed)), dtype=np.uint64)])
        out.append((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64))
    return out


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(values.view(np.int64))).cast(pa.list_(pa.int64()))


def rows_of(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, what: str) -> DataFrame:
    """id, set size and digest of every row, with its block keys (``what``: keys) or its sorted n-grams (set)."""
    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, "dfx_text", 1 << 20, 2048):
                h, bounds = _sets(part.column(1), width)
                d1, d2 = _digest(h, bounds)
                lists = _lists(*(block_keys(h, bounds, percent) if what == "keys" else (h, bounds)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(bounds)), pa.array(d1), pa.array(d2), lists],
                                                 names=["dfx_id", "dfx_n", "dfx_d1", "dfx_d2", "dfx_list"])
        tidy()

    cols = docs.select(F.col(id_col).cast("long").alias("dfx_id"), F.col(text_col).alias("dfx_text"))
    return cols.mapInArrow(run, "dfx_id long, dfx_n long, dfx_d1 long, dfx_d2 long, dfx_list array<long>")


def _salt(column: str, df: DataFrame):
    """As many salts as shuffle partitions, by a hash of a class."""
    return F.pmod(F.xxhash64(column), F.lit(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))).cast("int")


def _to_rows(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """``rows`` (with ``key`` and ``salt``) joined with one fact row per key, by (key, salt)."""
    there = rows.select(key, "salt").distinct().join(facts, key)
    return rows.join(there, [key, "salt"])


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v, ...) with their n-grams su and sv."""
    pairs = pairs.withColumn("salt", _salt("v", pairs))
    left = pairs.select("u", "salt").distinct().join(sets.select(F.col("dfx_c").alias("u"), F.col("dfx_set").alias("su")), "u")
    right = pairs.join(sets.select(F.col("dfx_c").alias("v"), F.col("dfx_set").alias("sv")), "v")
    return right.join(left, ["u", "salt"])


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v, nu, nv, both): sizes of the sets of each pair, and the product's entry."""
    both = F.size(F.array_intersect("su", "sv")).cast("long")
    return _with_sets(pairs, sets).select(
        "u", "v", F.size("su").cast("long").alias("nu"), F.size("sv").cast("long").alias("nv"), both.alias("both"))


def _linked(both: str, nu: str, nv: str, percent: int):
    return F.expr(f"100 * {both} >= {percent} * ({nu} + {nv} - {both})")


def _live(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, salt, c, u, lab) of the keys whose rows lie in more than one component."""
    now = members.join(labels.select(F.col("id").alias("c"), "lab"), "c", "left").withColumn("lab", F.coalesce("lab", "c"))
    ends = now.groupBy("key", "salt").agg(F.min("lab").alias("lo"), F.max("lab").alias("hi"))
    mixed = ends.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo < hi").select("key")
    return now.join(ends.select("key", "salt").join(mixed, "key"), ["key", "salt"])


def _differences(batches, percent: int):
    """(u, v, nu, nv, lab, linked, a, e) for each n-gram ``e`` that only one of the sets su and sv has; ``a`` counts them."""
    for batch in batches:
        left, right = batch.column("su"), batch.column("sv")
        nu, nv = (c.value_lengths().to_numpy().astype(np.int64) for c in (left, right))
        ends = np.cumsum(nu + nv)
        at = 0
        while at < batch.num_rows:                       # about a million n-grams at once
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), side="right")))
            k = to - at
            row = np.concatenate([np.repeat(np.arange(k), n[at:to]) for n in (nu, nv)])
            e = np.concatenate([c.slice(at, k).flatten().to_numpy() for c in (left, right)])
            order = np.lexsort((e, row))
            row, e = row[order], e[order]
            same = (row[1:] == row[:-1]) & (e[1:] == e[:-1])
            alone = np.ones(len(e), bool)
            alone[1:] &= ~same
            alone[:-1] &= ~same
            row, e = row[alone], e[alone]
            a = np.bincount(row, minlength=k)
            both = (nu[at:to] + nv[at:to] - a) // 2
            linked = 100 * both >= percent * (nu[at:to] + nv[at:to] - both)
            u, v, lab = (batch.column(c).to_numpy()[at:to][row] for c in ("u", "v", "lab"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (u, v, nu[at:to][row], nv[at:to][row], lab, linked[row], a[row], e)],
                names=["u", "v", "nu", "nv", "lab", "linked", "a", "e"])
            at = to


def _apart(star: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that may still be links, from (hub u, class v, lab): the sparse product of what sets the rows apart from their hub."""
    rows = _with_sets(star.select("u", "v", "lab"), sets).select("u", "v", "lab", "su", "sv")
    cells = rows.mapInArrow(lambda batches: _differences(batches, percent),
                            "u long, v long, nu long, nv long, lab long, linked boolean, a long, e long")
    cells = written(cells, "join-apart")
    seen = cells.groupBy("u", "e").agg(F.count(F.lit(1)).alias("seen"), (F.min("lab") < F.max("lab")).alias("mixed"))
    rank = F.row_number().over(Window.partitionBy("u", "v").orderBy("seen", "e"))
    ranked = cells.join(seen, ["u", "e"]).withColumn("r", rank).filter("mixed")
    more, less = 100 + percent, 100 - percent
    # linked with a row that fails against the hub: 2 * shared * more >= a * more + (nu - nv) * less
    least = F.expr(f"-floor(-(a * {more} + (nu - nv) * {less}) / {2 * more})")
    left = ranked.filter(F.col("r") <= F.col("a") - least + 1).select(
        "u", "e", F.col("v").alias("y"), F.col("nv").alias("ny"), F.col("a").alias("ay"), F.col("lab").alias("ly"), F.col("r").alias("ry"))
    right = ranked.filter(~F.col("linked")).select(
        "u", "e", F.col("v").alias("x"), F.col("nv").alias("nx"), F.col("a").alias("ax"), F.col("lab").alias("lx"), F.col("r").alias("rx"))
    need = F.expr(f"-floor(-((ax + ay) * {more} - (nx + ny) * {less}) / {2 * more})")
    met = left.join(right, ["u", "e"]).filter((F.col("lx") != F.col("ly")) & (F.col("ry") <= F.col("ay") - need + 1)
                                              & (F.col("rx") <= F.col("ax") - need + 1))
    return met.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Words are maximal runs of other bytes than space and \\x09-\\x0D, with
    A-Z lower-cased; a set holds the distinct runs of ``width`` words, of a
    shorter text the whole.  Null, empty and word-less texts have an empty
    set, are their own component and are linked with nothing.
    ``component_id`` is the smallest id reachable by links (null ids come
    last); copies of a set, also under one id, are one class and linked.
    Ids are read as longs; only the id and the text are read, so further
    columns may have any name.  Texts of any length are read whole.  An
    empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    rows = rows_of(docs, id_col, text_col, width, percent, "keys").withColumn("dfx_uid", F.monotonically_increasing_id())
    rows = written(rows.withColumn("dfx_run", F.spark_partition_id()), "join-rows")
    least = F.min(F.struct(F.col("dfx_id").isNull(), "dfx_id")).alias("dfx_r")
    runs = written(rows.filter("dfx_n > 0").groupBy(*CLASS, "dfx_run").agg(least, F.min("dfx_uid").alias("dfx_c")), "join-runs")
    classes = written(runs.groupBy(*CLASS).agg(F.min("dfx_r").alias("dfx_r"), F.min("dfx_c").alias("dfx_c")), "join-classes")

    # column blocks that two classes and more have in common
    spread = rows.select(F.col("dfx_uid").alias("c"), "dfx_list").join(classes.select(F.col("dfx_c").alias("c")), "c", "left_semi")
    spread = spread.select("c", F.explode("dfx_list").alias("key")).withColumn("salt", _salt("c", rows))
    here = spread.groupBy("key", "salt").agg(F.count(F.lit(1)).alias("k"))
    shared = here.groupBy("key").agg(F.sum("k").alias("m")).filter("m > 1")
    met = written(spread.join(here.join(shared, "key").drop("k"), ["key", "salt"]), "join-met")
    members = met.join(met.groupBy("c").agg(F.sum("m").alias("w")), "c").select("key", "salt", "c", "w")
    members = written(members, "join-members")

    # the sets of those classes
    cand = classes.join(members.select(F.col("c").alias("dfx_c")).distinct(), "dfx_c", "left_semi")
    cand = cand.select(*CLASS, "dfx_c", F.col("dfx_r.dfx_id").alias("dfx_want"))
    texts = docs.select(F.col(id_col).cast("long").alias("dfx_id"), F.col(text_col).alias("dfx_text"))
    texts = texts.join(cand.select("dfx_want").distinct(), F.col("dfx_id").eqNullSafe(F.col("dfx_want")), "left_semi")
    sets = rows_of(texts, "dfx_id", "dfx_text", width, percent, "set").withColumnRenamed("dfx_list", "dfx_set")
    sets = sets.join(cand.drop("dfx_want"), CLASS).select("dfx_c", "dfx_set").dropDuplicates(["dfx_c"])
    sets = written(sets, "join-sets")

    # the hub's row of the product
    best = F.max(F.struct("w", F.negative("c").alias("c"))).alias("h")
    hub = members.groupBy("key", "salt").agg(best).groupBy("key").agg(F.max("h").alias("h"))
    members = _to_rows(members.drop("w"), hub.select("key", F.negative("h.c").alias("u")), "key")
    members = written(members, "join-hubs")
    pairs = members.filter("c <> u").select("u", F.col("c").alias("v")).distinct()
    found = _overlaps(pairs, sets).filter(_linked("both", "nu", "nv", percent)).select("u", "v")
    labels = connected_components(written(found, "join-star"))

    # exactly the rest, centred on the hubs
    live = _live(members, labels).filter("c <> u")
    live = written(live.select("u", F.col("c").alias("v"), "lab").distinct(), "join-live")
    if not live.isEmpty():
        found = _overlaps(_apart(live, sets, percent), sets).filter(_linked("both", "nu", "nv", percent)).select("u", "v")
        labels = connected_components(written(found, "join-rest"), labels)

    # the smallest id of each component, back to the rows by (class, run)
    comp = classes.join(labels, classes["dfx_c"] == labels["id"], "left").select(
        *CLASS, "dfx_r", F.coalesce("lab", "dfx_c").alias("dfx_comp"))
    heads = comp.groupBy("dfx_comp").agg(F.min("dfx_r").alias("dfx_head"))
    down = runs.select(*CLASS, "dfx_run").join(comp.join(heads, "dfx_comp").select(*CLASS, "dfx_head"), CLASS)
    out = rows.select("dfx_id", *CLASS, "dfx_run").join(down, [*CLASS, "dfx_run"], "left")
    return out.select(F.col("dfx_id").alias(id_col), F.col("dfx_n").alias("n_shingles"),
                      F.when(F.col("dfx_n") == 0, F.col("dfx_id")).otherwise(F.col("dfx_head.dfx_id")).alias("component_id"))
