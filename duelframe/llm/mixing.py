"""Mixing (2): temperature weights by bisection, realised as budgeted block permutations.

Weights: source shares of the token count, each raised to an exponent
between 0 (uniform) and 1 (as they are) and normalised.  The exponent is
bisected: the largest whose weights reach a target entropy, or the smallest
that keeps every source within a repetition limit.  The bisection runs inside
one aggregate over the sources' totals, as an expression.

Realisation: every source is cut into ``blocks`` blocks by a hash of the id.
A source's quota is its weight times the budget; it is filled with whole
passes over the source and then with blocks, in the order of a permutation
drawn anew for every pass, up to the quota.  A source with a third of all
rows meets its plan in ``blocks`` pieces, never as a whole.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.common import written

BLOCKS = 256
STEPS = 60
#: drawn (source, block) cells up to this number are broadcast, beyond it they are joined by shuffle
BROADCAST_CELLS = 200_000
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """White-space separated words; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def hash32(*parts: Column) -> Column:
    """A 32-bit hash that any SQL engine can repeat: the first 8 hex digits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def exponent(totals: Column, entropy: float | None, repeats: float | None) -> Column:
    """The bisected exponent for an array of positive source totals.

    ``entropy``: the share of the largest possible entropy (log of the
    number of sources) that the weights must reach.  ``repeats``: how often
    the smallest source may be repeated if the largest is taken once.
    """
    top = F.array_max(totals)

    def good(a: Column) -> Column:
        power = F.transform(totals, lambda t: F.pow(t / top, a))
        if repeats is not None:                            # weight over share, smallest source against largest
            least = F.array_min(totals)
            return F.pow(least / top, a - 1) <= F.lit(float(repeats))
        whole = F.aggregate(power, F.lit(0.0), lambda s, p: s + p)
        # entropy of p/whole is log(whole) - sum(p log p) / whole
        plogp = F.aggregate(power, F.lit(0.0), lambda s, p: s + F.when(p > 0, p * F.ln(p)).otherwise(0.0))
        return F.ln(whole) - plogp / whole >= F.lit(float(entropy)) * F.ln(F.size(totals).cast("double"))

    def step(state: Column, _) -> Column:
        mid = (state["lo"] + state["hi"]) / 2
        ok = good(mid)
        if repeats is not None:                            # smallest exponent that is good
            return F.struct(F.when(ok, state["lo"]).otherwise(mid).alias("lo"), F.when(ok, mid).otherwise(state["hi"]).alias("hi"))
        return F.struct(F.when(ok, mid).otherwise(state["lo"]).alias("lo"), F.when(ok, state["hi"]).otherwise(mid).alias("hi"))

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)
    return end["hi"] if repeats is not None else F.when(good(F.lit(1.0)), F.lit(1.0)).otherwise(end["lo"])


def weights(sources: DataFrame, entropy: float | None, repeats: float | None, budget: float | None) -> DataFrame:
    """(source, tokens, weight, quota) from (source, tokens); sources without a token get weight 0.

    ``budget`` is in tokens; None takes the smallest budget that uses every
    source at least once.  One row per source meets in one aggregate.
    """
    live = sources.filter("tokens > 0")
    one = live.agg(F.sort_array(F.collect_list(F.col("tokens").cast("double"))).alias("t"))
    one = one.select("t", F.round(exponent(F.col("t"), entropy, repeats), 9).alias("alpha"), F.array_max("t").alias("top"))
    whole = F.aggregate("t", F.lit(0.0), lambda s, x: s + F.pow(x / F.col("top"), F.col("alpha")))
    got = one.filter(F.size("t") > 0).select("alpha", "top", whole.alias("whole")).first()      # three numbers
    alpha, top, whole = got if got else (1.0, 1.0, 1.0)
    w = F.pow(F.col("tokens") / F.lit(top), F.lit(alpha)) / F.lit(whole)
    total = float(budget) if budget is not None else top * whole
    some = F.col("tokens") > 0
    return sources.select("source", "tokens", F.lit(alpha).alias("alpha"), F.when(some, F.round(w, 9)).otherwise(0.0).alias("weight"),
                          F.when(some, F.round(w * total)).otherwise(0.0).cast("long").alias("quota"))


def mix_plan(docs: DataFrame, entropy: float | None = None, repeats: float | None = None,
             budget: float | None = None, blocks: int = BLOCKS, seed: int = 1, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(source, block, pass, position, weight, alpha): the blocks drawn, in order of ``position`` within a source.

    Whole passes come first, with every block, also those without a token;
    a last pass in part takes blocks in its permuted order while the tokens
    before a block are under the quota, so a source overshoots by less than
    one block.  A null source is a source.  Rows
    with a null id share a block.
    """
    rows = docs.select(F.col(source_col).alias("source"), block_of(F.col(id_col), blocks, seed).alias("block"),
                       token_count(F.col(text_col)).alias("n"))
    cells = written(rows.groupBy("source", "block").agg(F.sum("n").alias("n")), "mix-cells")
    sources = cells.groupBy("source").agg(F.sum("n").alias("tokens"))
    plan = weights(sources, entropy, repeats, budget)
    passes = F.when(F.col("tokens") > 0, F.ceil(F.col("quota") / F.col("tokens"))).otherwise(F.lit(1)).cast("int")
    cells = cells.join(plan.withColumnRenamed("source", "dfx_s"), F.col("source").eqNullSafe(F.col("dfx_s"))).drop("dfx_s")
    cells = cells.filter(passes > 0).select("*", F.explode(F.sequence(F.lit(1), passes)).alias("pass"))
    order = hash32(F.lit(str(seed)), F.coalesce(F.col("source"), F.lit("")), F.col("pass").cast("string"),
                   F.col("block").cast("string"))
    cells = cells.withColumn("order", order)
    w = Window.partitionBy("source", "pass").orderBy("order", "block")       # ``blocks`` rows at most
    cells = cells.withColumn("before", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
    cells = cells.withColumn("position", (F.col("pass") - 1) * F.lit(blocks) + F.row_number().over(w) - 1)
    left = F.col("quota") - (F.col("pass") - 1) * F.col("tokens")
    return cells.filter((F.col("tokens") <= left) | (F.col("before") < left)).select(
        "source", "block", "pass", "position", "weight", "alpha")


def block_of(id_: Column, blocks: int, seed: int) -> Column:
    return F.pmod(hash32(F.lit(f"b{seed}"), F.coalesce(id_.cast("string"), F.lit(""))), F.lit(blocks)).cast("int")


def mix(docs: DataFrame, entropy: float | None = None, repeats: float | None = None, budget: float | None = None,
        blocks: int = BLOCKS, seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` drawn, once per pass that draws their block; further columns: dfx_pass, dfx_position.

    Empty and null texts have no tokens: they go with their block, and a
    source of nothing else is taken once.  An empty table gives no row.
    """
    plan = mix_plan(docs, entropy, repeats, budget, blocks, seed, id_col, text_col, source_col).select(
        F.col("source").alias("dfx_source"), F.col("block").alias("dfx_pblock"),
        F.struct(F.col("pass").alias("p"), F.col("position").alias("q")).alias("dfx_draw"))
    rows = docs.withColumn("dfx_block", block_of(F.col(id_col), blocks, seed))
    # all passes of a block travel as one short list, so rows are copied after the join and not before
    plan = plan.groupBy("dfx_source", "dfx_pblock").agg(F.sort_array(F.collect_list("dfx_draw")).alias("dfx_draws"))
    plan = written(plan, "mix-plan")
    if plan.count() <= BROADCAST_CELLS:
        plan = F.broadcast(plan)
    out = rows.join(plan, F.col(source_col).eqNullSafe(F.col("dfx_source")) & (F.col("dfx_block") == F.col("dfx_pblock")))
    return out.withColumn("dfx_draw", F.explode("dfx_draws")).select(
        *docs.columns, F.col("dfx_draw.p").alias("dfx_pass"), F.col("dfx_draw.q").alias("dfx_position"))
