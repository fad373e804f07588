"""The combined bout flow on a hand-made table."""

import datetime as dt

from duelframe.operators.bouts import combine_bouts

D = dt.date


def test_combine_bouts(spark):
    bouts = spark.createDataFrame([
        (1, D(2020, 1, 1), "José Aldo", "Conor McGregor", "Blue", "Las Vegas, Nevada, USA"),
        (2, D(2020, 1, 1), "Anna Smith", "Bea Jones", "Red", "Las Vegas, Nevada, USA"),
        (3, D(2020, 2, 1), "Carl Lee", "Dan Ray", "Red", "Sao Paulo, Brazil"),
        (4, D(2020, 3, 1), "Eve Fox", "Gil Ho", "Red", "Nowhere"),
    ], "bout_id int, date date, R_name string, B_name string, Winner string, location string")
    cards = spark.createDataFrame([
        (10, D(2020, 1, 1), "Conor McGregor", "Jose Aldo", "ko"),      # exact, names swapped
        (11, D(2020, 1, 1), "Anne Smith", "Bea Jones", "decision"),     # fuzzy, same day
        (12, D(2020, 2, 2), "Carl Lea", "Dan Ray", "submission"),       # fuzzy, next day
        (13, D(2020, 1, 1), "Zed Zed", "Yan Yan", "tko"),
    ], "card_id int, date date, winner string, loser string, method string")
    locs = spark.createDataFrame([("Las Vegas, USA", 610.0), ("Sao Paulo, Brazil", 760.0)],
                                 "location string, location_elevation double")
    homes = spark.createDataFrame([("jose aldo", 100.0), ("Carl Lee", 5.0)],
                                  "name string, elevation double")
    out = {r.bout_id: r for r in combine_bouts(bouts, cards, locs, homes).collect()}
    assert len(out) == 4
    assert (out[1].sc_card_id, out[1].sc_match, out[1].sc_method) == (10, "exact", "ko")
    assert (out[2].sc_card_id, out[2].sc_match) == (11, "fuzzy")
    assert (out[3].sc_card_id, out[3].sc_match, out[3].sc_date) == (12, "fuzzy", D(2020, 2, 2))
    assert out[4].sc_card_id is None and out[4].sc_match is None
    assert out[1].location_elevation == 610.0 and out[3].location_elevation == 760.0
    assert out[4].location_elevation is None
    assert out[1].R_home_elevation == 100.0 and out[3].R_home_elevation == 5.0
    assert out[2].B_home_elevation is None


def test_combine_bouts_without_dimensions(spark):
    bouts = spark.createDataFrame([(1, D(2020, 1, 1), "A B", "C D", "Red", "x")],
                                  "bout_id int, date date, R_name string, B_name string, "
                                  "Winner string, location string")
    cards = spark.createDataFrame([(5, D(2020, 1, 1), "c d", "a b", "ko")],
                                  "card_id int, date date, winner string, loser string, method string")
    r = combine_bouts(bouts, cards).collect()
    assert len(r) == 1 and r[0].sc_card_id == 5 and r[0].sc_match == "exact"
    assert "R_home_elevation" not in r[0].asDict() and "location_elevation" not in r[0].asDict()
