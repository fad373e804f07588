"""Every document word against every conversation word, by brute force."""

from conftest import SF_SMALL
import __spark_entry__ as E


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_document_words_meet_conversation_words(spark, tmp_path):
    for name, rows in (("documents", 3), ("conversations", 12)):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    from duelframe.plans.names import words

    x, y = ({r.w for r in words(spark.read.parquet(str(tmp_path / f"{name}.parquet")), "w").collect() if r.w is not None}
            for name in ("documents", "conversations"))
    got = {}
    for r in E.queries()["name_matches_docs"](spark, str(tmp_path)).collect():
        got[r.x, r["rank"]] = (r.score, r.y)
    want = {(a, k): best for a in x for k, best in enumerate(sorted((edits(a, b), b) for b in y)[:7], 1)}
    assert len(x) > 100 and len(y) > 30 and got == want
