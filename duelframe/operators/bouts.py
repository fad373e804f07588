"""The combined bout table in one lazy plan (the reference's joining flow).

bouts --location_join--> + venue elevation
      --pair_join------> + exact scorecard (order-insensitive names, same date)
      --best_match_join> + closest scorecard of the same / next day for the rest
      --update_from----> scorecard columns filled for the fuzzy matches
      --lookup x2------> + each side's home elevation
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.functions.keys import normalize_name, pair_key
from duelframe.operators.joins import (
    best_match_join, dedupe_first, location_join, lookup, pair_join, update_from,
)
from duelframe.operators.project import winner_loser


def combine_bouts(bouts: DataFrame, cards: DataFrame, locations: DataFrame | None = None,
                  homes: DataFrame | None = None, *, bout_id: str = "bout_id",
                  red: str = "R_name", blue: str = "B_name", outcome: str = "Winner",
                  date: str = "date", location: str = "location", card_id: str = "card_id",
                  card_winner: str = "winner", card_loser: str = "loser",
                  card_date: str = "date", max_days: int = 1) -> DataFrame:
    """Bouts with their scorecard (exact, else best match) and elevations.

    ``cards`` columns come back prefixed ``sc_``; ``sc_match`` says how the
    scorecard was found ('exact', 'fuzzy' or NULL).  ``locations`` has
    (location, location_elevation); ``homes`` has (name, elevation).
    """
    out = bouts
    if locations is not None:
        out = location_join(out, locations, location, "location", dedupe="first",
                            dim_order=["location_elevation"])
    # one scorecard per (pair key, date): duplicates would fan the bouts out
    keyed = cards.withColumn("_ck", pair_key(normalize_name(card_winner),
                                             normalize_name(card_loser)))
    cards1 = dedupe_first(keyed, ["_ck", card_date], [card_id]).drop("_ck")
    exact = pair_join(out, cards1, (red, blue), (card_winner, card_loser), date, card_date)
    exact = exact.drop("_pair_key").withColumn(
        "sc_match", F.when(F.col("sc_" + card_id).isNotNull(), F.lit("exact")))
    # read twice below (fuzzy input and update target): written once instead of
    # re-running the location join, the key normalisation and the pair join
    from duelframe.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(bouts.sparkSession)
    exact = exact.checkpoint(eager=True)
    # fuzzy pass for bouts without an exact scorecard (raw names, as recorded)
    todo = winner_loser(exact.filter(F.col("sc_" + card_id).isNull()).select(
        bout_id, date, red, blue, outcome), red, blue, outcome)
    todo = todo.filter(F.col("winner_name").isNotNull())      # a draw has no winner to look for
    card_cols = [c for c in cards.columns if c != card_id]
    sc = cards.toDF(*["sc_" + c for c in cards.columns])
    best = best_match_join(todo, sc, bout_id, "sc_" + card_id, date, "sc_" + card_date,
                           ("winner_name", "loser_name"), ("sc_" + card_winner, "sc_" + card_loser),
                           max_days=max_days, right_cols=["sc_" + c for c in [card_id, *card_cols]])
    patch = best.filter(F.col("match_sc_" + card_id).isNotNull()).select(
        bout_id, *[F.col("match_sc_" + c).alias("sc_" + c) for c in [card_id, *card_cols]],
        F.lit("fuzzy").alias("sc_match"))
    out = update_from(exact, patch, bout_id, ["sc_" + c for c in [card_id, *card_cols]]
                      + ["sc_match"])
    if homes is not None:
        h = homes.select(normalize_name("name").alias("_hn"), F.col("elevation").alias("_he"))
        out = out.withColumn("_rn", normalize_name(red)).withColumn("_bn", normalize_name(blue))
        out = lookup(out, h, "_rn", "_hn", "_he", f"{red[:2]}home_elevation")
        out = lookup(out, h, "_bn", "_hn", "_he", f"{blue[:2]}home_elevation")
        out = out.drop("_rn", "_bn")
    return out
