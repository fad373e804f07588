"""Deobfuscation without limits of length, and spelt runs of several words."""

import pytest

from conftest import SF_ORACLE
from duelframe.llm import toxicity


@pytest.fixture(scope="module")
def restorer(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    return toxicity.Restorer(toxicity.language_model(toxicity.trigram_counts(docs)))


def test_spelt_runs_are_cut_into_words(restorer):
    assert restorer.spelt("a s t u p i d person") == ["a", "stupid"]
    assert restorer.spelt("s t u p i d i d i o t") == ["stupid", "idiot"]
    assert restorer.spelt("s.t.u.p.i.d.i.d.i.o.t") == ["stupid", "idiot"]
    assert restorer.spelt("s t u u u u p 1 1 d") == ["stupid"]
    assert restorer.restored("a s t u p i d person") == "a stupid person"


def test_spelt_runs_of_any_length(restorer):
    run = " ".join("whatastupidpersonthisisandthatistheendofitall")
    assert len(run) > 80 and "stupid" in restorer.spelt(run) and "person" in restorer.spelt(run)
    assert "stupid" in restorer.restored(run).split()
    long = " ".join("stupid" * 500)
    assert restorer.spelt(long) == ["stupid"] * 500


def test_tokens_of_any_length(restorer):
    assert restorer.token("idi" + "o" * 50 + "t") == "idiot"
    assert restorer.token("i" + "." * 60 + "d1ot") == "idiot"
    assert restorer.token("s" + "*" * 50 + "tup1d") == "stupid"
