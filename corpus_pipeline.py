"""A training corpus from ``documents``: score, dedup, mix, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage
before it kept; all but the last return the columns of ``documents``.  They
need a ``doc_id``, a ``text`` and (mixing) a ``source``; further columns may
have any name and are carried along.  Null texts count as empty, null ids and
sources are values of their own, texts of any length are taken whole, and an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm import exact_dedup, mixing, near_dedup, toxicity
from duelframe.llm.common import table, written
from duelframe.llm.queries import packed

MIX_REPEATS = 1.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go (3).

    Empty texts stay.  Without labels of both kinds nothing can be learned
    and every document stays.
    """
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.filter(F.col("dfx_score") < 0.5).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per normalised text stays, the one with the largest id (7).

    Null and empty texts are one text; of rows equal in id and text one stays.
    """
    return exact_dedup.keep_exact(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group linked at similarity 0.8 on five-word shingles stays (6), the one with the smallest id.

    Texts without a word are linked with nothing and stay, but for rows equal in id and text.
    """
    return near_dedup.keep_distinct(docs, width=5, percent=80).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and small sources again up to 1.5 times by temperature weights (2).

    A null source is a source; sources without a word are taken once.
    """
    return mixing.mix(docs, repeats=MIX_REPEATS).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens in padded sequences (10); an empty text is its end token."""
    return packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: two stages score by fitted models and sketches, which SQL cannot express; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
