"""Joins J1-J13.

Dimension sides are broadcast only behind a size check (``broadcast_if_small``:
the optimizer's size estimate must be under a limit); otherwise the join is
left to the planner, where AQE can still switch to a broadcast at runtime
once the real size is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.functions.keys import normalize_name, pair_key, place_key
from duelframe.operators.names import threshold_pairs
from duelframe.operators.profiles import closest_profiles

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for the optimized plan (file sizes for scans)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 - no estimate -> treat as large
        return 1 << 62


def broadcast_if_small(df: DataFrame, limit_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` only when its estimated size is under ``limit_bytes``."""
    return F.broadcast(df) if estimated_bytes(df) <= limit_bytes else df


def _names(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def dedupe_first(df: DataFrame, key, order) -> DataFrame:
    """One row per ``key``, the first in ``order`` (deterministic).

    ``min_by(struct(*), struct(order))`` is a partial aggregate: a hot key is
    reduced map-side instead of being sorted in one task.
    """
    keys = _names(key)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in _names(order)]
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in payload]), F.struct(*order_cols)).alias("_first"))
    return best.select(*keys, *[F.col("_first")[c].alias(c) for c in payload]).select(*df.columns)


def pair_join(bouts: DataFrame, cards: DataFrame, bout_names: tuple[str, str] | str,
              card_names: tuple[str, str] | str, bout_date: str | None = None,
              card_date: str | None = None, how: str = "left",
              card_prefix: str = "sc_") -> DataFrame:
    """Join on the order-insensitive pair of normalised names (+ date).

    Card columns are prefixed (``sc_``) so that names differing only in case
    (``Winner``/``winner``) never collide.  One column instead of two names
    holds their key already.  The cards are hashed, so that the bouts are not
    sorted (nor spilled) for the join.
    """
    def key(names, prefix=""):
        if isinstance(names, str):
            return F.col(prefix + names)
        return pair_key(normalize_name(prefix + names[0]), normalize_name(prefix + names[1]))

    b = bouts.withColumn("_pair_key", key(bout_names))
    c = cards.toDF(*[card_prefix + x for x in cards.columns])
    c = c.withColumn("_pair_key", key(card_names, card_prefix)).hint("shuffle_hash")
    on = [b["_pair_key"] == c["_pair_key"]]
    if bout_date and card_date:
        on.append(b[bout_date] == c[card_prefix + card_date])
    return b.join(c, on, how).drop(c["_pair_key"])


def location_join(df: DataFrame, dim: DataFrame, df_loc: str, dim_loc: str,
                  dedupe: str = "none", dim_order=None) -> DataFrame:
    """Left join on the normalised place key.

    ``dedupe='none'`` keeps the reference's fan-out on duplicate keys (Q9);
    ``'first'`` keeps one dimension row per key (first in ``dim_order``).
    """
    d = dim.withColumn("_place_key", place_key(dim_loc)).drop(dim_loc)
    if dedupe == "first":
        d = dedupe_first(d, "_place_key", dim_order or d.columns)
    elif dedupe != "none":
        raise ValueError("dedupe must be 'none' or 'first'")
    left = df.withColumn("_place_key", place_key(df_loc))
    return left.join(broadcast_if_small(d), "_place_key", "left").drop("_place_key")


def lookup(df: DataFrame, dim: DataFrame, df_key: str, dim_key: str, value: str,
           as_: str, cast: str | None = None, dim_order=None) -> DataFrame:
    """Scalar lookup = left join on a dimension deduplicated on its key."""
    d = dedupe_first(dim.select(dim_key, value), dim_key, dim_order or [value])
    v = F.col("_lk_v").cast(cast) if cast else F.col("_lk_v")
    d = d.select(F.col(dim_key).alias("_lk_k"), F.col(value).alias("_lk_v"))
    out = df.join(broadcast_if_small(d), df[df_key] == d["_lk_k"], "left")
    return out.withColumn(as_, v).drop("_lk_k", "_lk_v")


def unmatched(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (left anti join)."""
    return left.join(right, on, "left_anti")


MAX_BROADCAST_DAYS = 1_000_000


def forward_date(left: DataFrame, right: DataFrame, left_date: str, right_date: str,
                 max_days: int = 1, as_: str = "match_date") -> DataFrame:
    """The same date if ``right`` has rows on it, else the next date with
    rows within ``max_days`` (checked day by day); NULL if none.

    Works on distinct dates only: a (left date -> match date) map is built
    from the distinct dates of both sides and joined back.  A date map has at
    most (last - first + 1) rows; that span is measured first and the map is
    broadcast only when the span is under ``MAX_BROADCAST_DAYS``.
    """
    ld = left.select(F.col(left_date).cast("date").alias("_ld")).distinct()
    rd = right.select(F.col(right_date).cast("date").alias("_d")).distinct()
    m = ld
    for k in range(max_days + 1):
        dk = rd.select(F.col("_d").alias(f"_d{k}"))
        m = m.join(dk, F.date_add("_ld", k) == F.col(f"_d{k}"), "left")
    m = m.select("_ld", F.coalesce(*[F.col(f"_d{k}") for k in range(max_days + 1)]).alias(as_))
    from duelframe.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(left.sparkSession)
    m = m.checkpoint(eager=True)   # one row per distinct day; reused by every consumer
    span = left.agg(F.datediff(F.max(F.col(left_date).cast("date")),
                               F.min(F.col(left_date).cast("date"))).alias("s")).first()["s"]
    if span is not None and span + 1 <= MAX_BROADCAST_DAYS:
        m = F.broadcast(m)
    out = left.withColumn("_ld", F.col(left_date).cast("date"))
    return out.join(m, "_ld", "left").drop("_ld")


forward_date_join = forward_date   # SURVEY name for J6


def best_match_join(left: DataFrame, right: DataFrame, left_id, right_id,
                    left_date: str, right_date: str,
                    left_names: tuple[str, str], right_names: tuple[str, str],
                    max_days: int = 1, max_cost: float | None = None,
                    right_cols: list[str] | None = None,
                    strategy: str = "auto", max_block_pairs: int = 1_000_000,
                    max_pairs: int = 10_000_000) -> DataFrame:
    """Per left row, the right row of the same block with the least mean
    edit distance of the two name pairs; ties -> smallest ``right_id``.

    The block is the left row's date, or the next date with right rows (J6).
    Only *distinct* name profiles are compared: right rows are first reduced
    to one representative (smallest id) per (date, name, name) and left rows
    to distinct (block, name, name); the best profile is joined back.

    ``strategy='bounds'`` compares the profiles of a block in groups of a
    bounded size, where bounds leave out most pairs (``operators.profiles``).
    ``strategy='rounds'`` joins on parts of the names: a candidate with
    cost <= t has a first-name distance <= 2t, so
    the exact segment join of ``operators.names`` (keyed by block) finds all
    of them; t = 1, 2, 4, ... is raised only for profiles still without a
    candidate, and the last round (2t >= longest name) admits the rest.
    ``strategy='profiles'`` compares all profile pairs of a block at once
    (cheaper when names in a block are all far apart).  ``'auto'`` measures
    the blocks (left profiles × right profiles, two small aggregates) and uses
    'profiles' when no block exceeds ``max_block_pairs`` and all of them together
    do not exceed ``max_pairs``, else 'bounds'.
    A row with a missing name has no cost and matches nothing, by any plan.
    Output: left columns + ``match_date``, ``match_cost`` and ``right_cols``
    of the chosen right row (NULL when no block has candidates).
    """
    from duelframe.session import ensure_checkpoint_dir

    lids, rids = _names(left_id), _names(right_id)
    right_cols = right_cols or [c for c in right.columns if c not in rids]
    lw, ll = left_names
    rw, rl = right_names
    blocked = forward_date(left, right, left_date, right_date, max_days, "match_date")
    payload = [c for c in right_cols if c not in rids]
    if "date" in payload or "cost" in payload:
        raise ValueError("rename right columns 'date' / 'cost': they would clash with "
                         "match_date / match_cost")
    rprof = (right.groupBy(F.col(right_date).cast("date").alias("_bd"),
                           F.col(rw).alias("_rw"), F.col(rl).alias("_rl"))
                  .agg(F.min(F.struct(*[F.col(c).alias(f"_rid_{c}") for c in rids],
                                      *[F.col(c).alias(f"match_{c}") for c in payload]))
                        .alias("_rrow"))).dropna(subset=["_rw", "_rl"])
    lprof = blocked.select(F.col("match_date").alias("_bd"), F.col(lw).alias("_lw"),
                           F.col(ll).alias("_ll")).dropna().distinct()
    cost = (F.levenshtein("_rw", "_lw") + F.levenshtein("_rl", "_ll")) / 2.0
    picked = [f"_rid_{c}" for c in rids] + [f"match_{c}" for c in payload]
    # both profile tables are used by the measurement and by the match: write them once
    ensure_checkpoint_dir(left.sparkSession)
    lprof = lprof.checkpoint(eager=True)
    rprof = rprof.checkpoint(eager=True)
    if strategy == "auto":
        lc = lprof.groupBy("_bd").agg(F.count(F.lit(1)).alias("_nl"))
        rc = rprof.groupBy("_bd").agg(F.count(F.lit(1)).alias("_nr"))
        pairs = F.col("_nl") * F.col("_nr").cast("double")
        worst, total = lc.join(rc, "_bd").agg(F.max(pairs), F.sum(pairs)).first()
        few = (worst or 0) <= max_block_pairs and (total or 0) <= max_pairs
        strategy = "profiles" if few else "bounds"

    def pick(pairs):
        return (pairs.groupBy("_bd", "_lw", "_ll")
                     .agg(F.min(F.struct("_cost", "_rrow")).alias("_b"))
                     .select("_bd", "_lw", "_ll", F.col("_b._cost").alias("match_cost"),
                             *[F.col("_b._rrow")[c].alias(c) for c in picked]))

    if strategy == "profiles":
        pairs = lprof.join(rprof, "_bd").withColumn("_cost", cost)
        if max_cost is not None:
            pairs = pairs.filter(F.col("_cost") <= max_cost)
        best = pick(pairs)
    elif strategy == "bounds":
        pairs = closest_profiles(lprof, rprof).withColumn("_cost", F.col("_cost2") / 2.0)
        if max_cost is not None:
            pairs = pairs.filter(F.col("_cost") <= max_cost)
        best = pick(pairs)
    elif strategy == "rounds":
        lens = lprof.agg(F.max(F.length("_lw"))).first()[0] or 0
        lens = max(lens, rprof.agg(F.max(F.length("_rw"))).first()[0] or 0)
        rnames = rprof.select("_bd", "_rw").distinct()
        todo, found, t = lprof, None, 1.0
        while True:
            final = 2 * t >= lens or (max_cost is not None and t >= max_cost)
            t1 = int(min(2 * t, lens))
            cand = threshold_pairs(todo.select("_bd", "_lw").distinct(), rnames, t1,
                                   x="_lw", y="_rw", block=["_bd"]).drop("score")
            pairs = (cand.join(todo, ["_bd", "_lw"]).join(rprof, ["_bd", "_rw"])
                         .withColumn("_cost", cost))
            limit = max_cost if (final and max_cost is not None) else (None if final else t)
            if limit is not None:
                pairs = pairs.filter(F.col("_cost") <= limit)
            got = pick(pairs).checkpoint(eager=True)
            found = got if found is None else found.unionByName(got)
            if final:
                break
            todo = todo.join(got.select("_bd", "_lw", "_ll"), ["_bd", "_lw", "_ll"],
                             "left_anti").checkpoint(eager=True)
            if todo.isEmpty():
                break
            t *= 2
        best = found
    else:
        raise ValueError("strategy must be 'bounds', 'rounds' or 'profiles'")
    out = blocked.join(best, (blocked["match_date"] == best["_bd"]) &
                       (blocked[lw].eqNullSafe(best["_lw"])) &
                       (blocked[ll].eqNullSafe(best["_ll"])), "left")
    out = out.drop("_bd", "_lw", "_ll")
    return out.withColumnsRenamed({f"_rid_{c}": f"match_{c}" for c in rids})


def update_from(df: DataFrame, patch: DataFrame, on, cols: list[str]) -> DataFrame:
    """Overwrite ``cols`` from ``patch`` where a row matches.

    A key that the patch holds more than once is taken once, by its smallest
    values, so rows never fan out.
    """
    keys = _names(on)
    p = patch.groupBy(*keys).agg(F.min(F.struct(*[F.col(c).alias(f"_p_{c}") for c in cols])).alias("_p"))
    p = p.select(*keys, "_p.*").withColumn("_p_hit", F.lit(True))
    out = df.join(p, keys, "left")
    for c in cols:
        out = out.withColumn(c, F.when(F.col("_p_hit"), F.col(f"_p_{c}")).otherwise(F.col(c)))
    return out.drop("_p_hit", *[f"_p_{c}" for c in cols]).select(*df.columns)


def upsert(df: DataFrame, patch: DataFrame, on) -> DataFrame:
    """Insert patch rows, replacing existing rows with the same key."""
    keys = _names(on)
    return df.join(patch.select(*keys), keys, "left_anti").unionByName(
        patch.select(*df.columns))


def zip_rows(a: DataFrame, b: DataFrame, a_order, b_order, how: str = "inner") -> DataFrame:
    """Positional zip of two tables (row i of ``a`` with row i of ``b``)."""
    from duelframe.operators.ordering import global_row_number

    ia = global_row_number(a, a_order, "_pos")
    ib = global_row_number(b, b_order, "_pos")
    return ia.join(ib, "_pos", how).withColumnRenamed("_pos", "position")


def reattach(df: DataFrame, labels: DataFrame, on, how: str = "inner") -> DataFrame:
    """Re-attach a label table by id."""
    return df.join(labels, _names(on), how)


def join_suffixed(left: DataFrame, right: DataFrame, on, how: str = "inner",
                  suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Join where equal non-key names get ``_x`` / ``_y`` suffixes."""
    keys = _names(on)
    common = (set(left.columns) & set(right.columns)) - set(keys)
    l2 = left.toDF(*[c + suffixes[0] if c in common else c for c in left.columns])
    r2 = right.toDF(*[c + suffixes[1] if c in common else c for c in right.columns])
    return l2.join(r2, keys, how)


def argmin(df: DataFrame, key, cost: str | Column, tie) -> DataFrame:
    """The row with the least ``cost`` per ``key``; ties -> smallest ``tie``."""
    keys = _names(key)
    c = F.col(cost) if isinstance(cost, str) else cost
    payload = [x for x in df.columns if x not in keys]
    best = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(x) for x in payload]),
                 F.struct(c, *[F.col(t) for t in _names(tie)])).alias("_b"))
    return best.select(*keys, *[F.col("_b")[x].alias(x) for x in payload])


__all__ = [n for n in dir() if not n.startswith("_")] + ["Window"]
