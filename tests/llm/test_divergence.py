"""Source divergence against plain Python over dicts."""

import collections
import re

import pyarrow as pa
import pytest

from test_operators import AWKWARD, LOWER
from duelframe.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, value long, rank int, part string, term string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, g, s, 1, 2, "p", "t") for i, t, g, s in rows], DOCS)


def plain_python(rows, min_docs, top):
    langs = collections.defaultdict(lambda: collections.defaultdict(collections.Counter))
    docs = collections.defaultdict(collections.Counter)
    for _, text, lang, source in rows:
        found = TERM.findall((text or "").translate(LOWER))
        langs[lang or ""][source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        whole = collections.Counter()
        for c in sources.values():
            whole.update(c)

        def values(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}
        q, p = values(whole), {s: values(c) for s, c in sources.items()}
        for s, c in sources.items():
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(found, 1) if part == "pair" or k <= top]
    return sorted(out)


def some_rows(n, sources, langs=("en", "fr")):
    words = ["the", "The", "of", "ünï", "İx", "a1b", "e-f", "zz"]
    rows = []
    for i in range(n):
        text = " ".join(words[(i * k + k * k) % (2 + i % 7)] for k in range(i % 23))
        rows.append((i, text if i % 5 else "one hot text, the same", langs[i % len(langs)], f"s{i % sources}"))
    return rows


@pytest.mark.parametrize("blocks", [(256, 2048), (3, 2)])
def test_equal_to_plain_python(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "SOURCES", blocks[0])
    monkeypatch.setattr(divergence, "TERMS", blocks[1])
    monkeypatch.setattr(divergence, "SLOT", 2)
    rows = some_rows(300, 11) + [(1000, None, None, None), (1001, "", "en", "empty"), (1001, "", "en", "empty"), (1002, "rare", "de", None)]
    got = sorted(tuple(r) for r in divergence.audit(docs_of(spark, rows).repartition(7), min_docs=4, top=3).collect())
    assert got == plain_python(rows, 4, 3)


def test_awkward_rows(spark):
    rows = [(i, t, "en", s) for i, t, s in AWKWARD]
    for least in (1, 1000):
        got = sorted(tuple(r) for r in divergence.audit(docs_of(spark, rows), min_docs=least).collect())
        assert got == plain_python(rows, least, 50)
    assert divergence.audit(docs_of(spark, rows).limit(0)).count() == 0


def test_terms_of_texts():
    texts = ["A bC\x00d", "", "É-é_Z9z", "  ", "日本 go"]
    names, code, text = divergence.terms_of(pa.array(texts))
    names = names.to_pylist()
    assert [(int(t), names[c]) for c, t in zip(code, text)] == [(k, w) for k, x in enumerate(texts) for w in TERM.findall(x.translate(LOWER))]


def test_counts_beyond_32_bits_are_exact(spark):
    df = spark.createDataFrame([(10**15 + 7, 10**16 + 1, 10**6)], "n long, total long, kept long")
    want = 1 + 10**9 * (10**15 + 12) // (10**16 + 1 + 5 * 10**6)
    assert df.select(divergence._p("n", "total", "kept")).first()[0] == want
