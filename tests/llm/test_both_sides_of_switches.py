"""Joins that broadcast below a size give the same rows by shuffle; the mixing SQL states the rule of the code."""

import duckdb
import pytest

from test_operators import AWKWARD, docs_of
from duelframe.llm import exact_dedup, mixing, near_dedup
from duelframe.llm.queries import OP2_SQL, op2_source_mixing


@pytest.mark.parametrize("module, name, work", [
    (exact_dedup, "BROADCAST_KEYS", exact_dedup.keep_exact),
    (exact_dedup, "BROADCAST_KEYS", near_dedup.keep_distinct),
    (near_dedup, "BROADCAST_IDS", near_dedup.near_dedup),
    (mixing, "BROADCAST_CELLS", lambda d: mixing.mix(d, repeats=2.0)),
])
def test_same_rows_without_broadcast(spark, monkeypatch, module, name, work):
    texts = [f"one two three four five six seven eight nine ten {i % 3} eleven twelve" for i in range(14)]
    docs = docs_of(spark, [(20 + i, t, f"s{i % 2}") for i, t in enumerate(texts)] + AWKWARD[:6])
    rows = lambda: sorted(map(str, work(docs).collect()))
    want = rows()
    monkeypatch.setattr(module, name, 0)
    assert rows() == want and len(want) > 0


def test_mixing_sql_takes_blocks_without_a_token(spark, tmp_path):
    rows = [(i, None if i % 4 == 0 else "" if i % 4 == 1 else "a b c", f"s{i % 7 // 3}") for i in range(300)] + [(1000 + i, " ", "blank") for i in range(5)]
    docs_of(spark, rows).drop("kept", "score", "component_id").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in op2_source_mixing(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == sorted(con.execute(OP2_SQL).fetchall())
    assert len({r[0] for r in got}) == 305
