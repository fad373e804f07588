"""The ten operators against brute force, round trips and held-out accuracy, and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import os
import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from duelframe.llm import (ann_forest, components, exact_dedup, html_extract, mixing, near_dedup, packing, quality,
                           shingles, token_files, tokens, toxicity, warc_archive)
from duelframe.llm.queries import QUERIES, tokenizer_path
from duelframe.session import scratch_path

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, component_id string"


def docs_of(spark, rows):
    """Documents with further columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "en", s, None, "k", "s", "c") for i, t, s in rows], DOCS)


AWKWARD = [
    (1, "One two three four five six", "a"), (2, "one TWO three four five six", "a"), (2, "one TWO three four five six", "a"),
    (3, None, None), (4, "", "b"), (5, " \t\n ", "b"), (6, "short", "b"), (None, "short", None), (7, "Ünï ünï", "a"),
    (8, "x" * 3_000_000, "a"), (9, "word " * 60_000, "c"), (10, "one two three four five seven", "a"),
]


def word_sets(rows, width):
    out = []
    for _, text, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.append({tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    return out


def brute_components(rows, width, percent):
    sets, head = word_sets(rows, width), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = head[i], head[j]
                head = [min(a, b) if h in (a, b) else h for h in head]
    ids = [r[0] for r in rows]
    least = {h: min((ids[k] for k in range(len(rows)) if head[k] == h and ids[k] is not None), default=None) for h in head}
    return [least[h] for h in head], [len(s) for s in sets]


# --- exact dedup -----------------------------------------------------------

def test_exact_dedup_awkward_rows(spark):
    got = exact_dedup.exact_dedup(docs_of(spark, AWKWARD).repartition(5)).collect()
    groups = collections.defaultdict(list)
    for i, t, _ in AWKWARD:
        groups[(t or "").translate(LOWER)].append(i)
    assert len(got) == len(AWKWARD)
    for t, ids in groups.items():
        mine = [r for r in got if r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()]
        assert sorted(str(r.doc_id) for r in mine) == sorted(map(str, ids))
        assert {r.group_size for r in mine} == {len(ids)} and sum(r.kept for r in mine) == 1
        assert {r.keep_id for r in mine} == {max((i for i in ids if i is not None), default=None)}


def test_exact_dedup_merges_many_runs(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FAN_IN", 2)                # 13 runs: four binomial rounds
    rows = docs_of(spark, [(i, "copy" if i % 3 == 0 else f"text {i % 7}", "a") for i in range(90)]).repartition(13)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(rows).collect()}
    assert got[0] == (87, 30) and len(got) == 90


def test_keep_exact_keeps_one_row_and_all_columns(spark):
    rows = docs_of(spark, AWKWARD)
    kept = exact_dedup.keep_exact(rows)
    assert kept.columns == rows.columns
    assert kept.count() == len({(t or "").translate(LOWER) for _, t, _ in AWKWARD})


# --- near dedup ------------------------------------------------------------

def test_near_dedup_awkward_rows(spark):
    got = near_dedup.near_dedup(docs_of(spark, AWKWARD).repartition(3), width=4).collect()
    heads, sizes = brute_components(AWKWARD, 4, 80)
    mine = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got)
    # null, empty and word-less texts are their own component
    want = sorted((str(i), n, str(i if n == 0 else h)) for (i, _, _), n, h in zip(AWKWARD, sizes, heads))
    assert mine == want
    assert sum(r.kept for r in got if r.n_shingles) == len({h for h, n in zip(heads, sizes) if n})


def test_near_dedup_group_around_a_hub(spark):
    """Copies that differ from one text each in their own way, and two that are linked with each other only."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]

    def edited(seed_words, places, tag):
        w = list(seed_words)
        for p in places:
            w[p] = f"{tag}x{p}"
        return " ".join(w)

    rows = [(0, " ".join(base), "a")]
    for i in range(1, 40):
        rows.append((i, edited(base, rng.choice(150, 2 + i % 6, replace=False), f"e{i}"), "a"))
    far = rng.choice(150, 9, replace=False)
    rows += [(100, edited(base, far, "far"), "a"), (101, edited(base, [*far, 75], "far"), "a")]
    heads, sizes = brute_components(rows, 5, 80)
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in near_dedup.near_dedup(docs_of(spark, rows)).collect()}
    assert got == {i: (h, n) for (i, _, _), h, n in zip(rows, heads, sizes)}


def test_sketch_fills_and_estimates():
    a, b = np.arange(1, 1001, dtype=np.uint64), np.arange(101, 1101, dtype=np.uint64)
    tiny = np.array([7], np.uint64)
    h = shingles.mix(np.concatenate([a, b, tiny]))
    grid = near_dedup.sketch(h, np.array([0, 1000, 2000, 2001, 2001]), 512)
    assert (grid[:3] != near_dedup.FULL).all() and (grid[3] == near_dedup.FULL).all()
    assert abs((grid[0] == grid[1]).mean() - 900 / 1100) < 0.08


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = ["Aa bb  cc", "", "dd", "x" * 500, "e f " * 200, "ü é"]
    column = pa.array(texts)
    data, offsets = shingles.arrow_bytes(column)
    whole = shingles.words(data, offsets)
    monkeypatch.setattr(shingles, "BLOCK", 64)
    cut = shingles.words(data, offsets)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert whole[1].tolist() == [len(t.split()) for t in texts]


def test_components_of_chains_and_later_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (200, 201)], "u long, v long")
    first = components.connected_components(links)
    assert {r.id: r.lab for r in first.collect()} == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 200, 201: 200}
    more = spark.createDataFrame([(101, 300), (60, 201), (5, 5)], "u long, v long")
    both = {r.id: r.lab for r in components.connected_components(more, first).collect()}
    assert both[300] == 100 and both[200] == both[201] == both[60] == 0 and both[101] == 100


# --- tokens, packing, token files ------------------------------------------

ODD = ["", "  ", "Word. WORD, word.", "é, É. é.,", "a<|endoftext|>b", "<|ENDOFTEXT|>.", "H̱, x́. ́a", "don't. I'll, 's.",
       "x\u0085y", "İ. ß, ǅ.", "क़. a", "日本語. 中文,", "😀. a😀,", "ﬁ, Å. Å,", "3.14, 5.", None]


def test_word_encoder_equals_the_tokenizer():
    code = tokens.WordEncoder(tokenizer_path())
    for _ in range(2):                                            # the second time from the cache
        ids, bounds = code.encode(pa.array(ODD, pa.string()), 2)
        want = [e.ids + [2] for e in code.tokenizer.encode_batch([t or "" for t in ODD], add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want


def test_packing_covers_every_id_once(spark):
    rows = [(i, f"some words of document {i} " * (1 + 37 * i % 90), "a") for i in range(120)] + AWKWARD[:8]
    rows.append((500, "long text here " * 4000, "a"))
    out = packing.pack(docs_of(spark, rows).repartition(7), tokenizer_path(), 1, 256, open_windows=4).collect()
    code = tokens.WordEncoder(tokenizer_path())
    ids, bounds = code.encode(pa.array([t for _, t, _ in rows]), 1)
    want = collections.Counter((i, ids[a:b].tobytes()) for (i, _, _), a, b in zip(rows, bounds, bounds[1:]))
    per_seq, whole = collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        assert len(r.ids) == 4 * r.length and 0 < r.length <= 256
        per_seq[r.sequence_id].append((r.offset, r.length))
        whole[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
    for spans in per_seq.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 256
    for (doc, n), parts in whole.items():
        copies = sum(c for (i, b), c in want.items() if i == doc and len(b) == 4 * n)
        assert sum(len(p) for _, p in parts) == 4 * n * copies
        if copies == 1:
            assert want[doc, b"".join(p for _, p in sorted(parts))] == 1
    used = sum(r.length for r in out)
    assert used == len(ids) and used / (256 * len(per_seq)) > 0.95


def test_token_files_round_trip(spark):
    folder = scratch_path(spark, "test-tokens")
    rows = [r for r in AWKWARD if r[0] is not None and r[0] != 2] + [(20 + i, f"text number {i}", "a") for i in range(50)]
    index = token_files.write_token_files(docs_of(spark, rows), folder, tokenizer_path(), 2, length=64, batch_rows=4)
    code, at = tokens.WordEncoder(tokenizer_path()), 0
    got = {r.doc_id: r for r in token_files.read_documents(spark, folder, index).collect()}
    for i, t, _ in sorted(rows):
        ids, _ = code.encode(pa.array([t], pa.string()), 2)
        assert (got[i].start, got[i].n_tokens, bytes(got[i].ids)) == (at, len(ids), ids.astype("<u4").tobytes())
        at += len(ids)
    names = [r.dfx_file for r in index.select("dfx_file").distinct().collect()]
    real = 0
    for name in names:
        file = token_files.TokenFile(folder, name)
        n = sum(len(file.reader.get_batch(b)) for b in range(file.reader.num_record_batches))
        for r in range(n):
            ids, mask = file.row(r)
            assert len(ids) == len(mask) == 64 and (r == n - 1 or mask.all())
            real += int(mask.sum())
        file.close()
    assert real == at


# --- classifiers -----------------------------------------------------------

@pytest.mark.parametrize("name,label,mod,held,least", [("op3_toxicity", "toxic", 5, 0, 0.95), ("op4_quality_classifier", "quality", 3, 1, 0.97)])
def test_held_out_accuracy(spark, name, label, mod, held, least):
    out = QUERIES[name][0](spark, SF_ORACLE).toPandas()
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").toPandas()
    assert len(out) == 1000 and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % mod == held for i in out.doc_id]).all()
    m = out.merge(labels, on="doc_id")
    m = m[m.held_out]
    right = (m.predicted == m[label]).mean()
    assert right >= least and right > max(m[label].mean(), 1 - m[label].mean())


def test_classifiers_on_awkward_rows_and_without_labels(spark):
    rows = docs_of(spark, AWKWARD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality(rows, none).collect()} == {0.5}
    assert {r.dfx_score for r in toxicity.toxicity(rows, none).collect()} == {0.5}
    some = spark.createDataFrame([(1, 0, 1), (10, 1, 0), (10, 1, 0), (6, None, None), (9, 0, 1), (9, 1, 0)],
                                 "doc_id long, quality int, toxic int")
    assert quality.quality(rows, some).count() == toxicity.toxicity(rows, some).count() == len(AWKWARD)


def test_deobfuscation(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = toxicity.language_model(toxicity.trigram_counts(docs))
    for odd, plain in [("idi0t", "idiot"), ("m0r0n", "moron"), ("idiooooot", "idiot"), ("i.d.i.o.t", "idiot"), ("tr@sh", "trash"),
                       ("path3tic", "pathetic")]:
        assert toxicity.Restorer(model).token(odd) == plain
    assert toxicity.Restorer(model).spelt("you i d i o t here") == ["idiot"]
    assert toxicity.Restorer(model).token("the,") == "the" and toxicity.Restorer(model).token("1.25") == ""


# --- html, warc ------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body>
<header class=top><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a><li><a href='/b'>News</a></ul></nav>
<div class="cookie-notice">We use cookies on this site &amp; others</div><div id=ad-1><p>Buy now, buy more and more things</p></div>
<article><h1>Title &eacute;&nbsp;here</h1><p class="x">First  <b>bold</b>
text&#33;<br>next line<p>Second &lt;b&gt; paragraph, with a <a href=/c>link</a>.</p><div class="sidebar"><p>Related stories you may like</p></div>
<section class="comments"><p>I think this is wrong in every way</p></section></article>
<form><label>Your name</label><input></form><aside><p>More from us</p></aside><footer>&copy; us</footer><!-- <p>x</p> --></body></html>"""


def test_html_main_text():
    tree = html_extract.train_tree(*html_extract.labelled_blocks())
    assert html_extract.main_text(PAGE, tree) == (
        "Title é here\nFirst bold text! next line\nSecond <b> paragraph, with a link.")
    for page in (None, "", "   ", "<", "<p", "<script>", "a < b", "<p class='x>unclosed", "</div></div>", "<!--", "&#xZZ; &bogus;"):
        assert isinstance(html_extract.main_text(page, tree), str)
    x, y = html_extract.labelled_blocks()
    assert (html_extract.apply_tree(tree, x) == y).mean() >= 0.99


def test_html_query_keeps_article_lines(spark):
    out = QUERIES["op1_html_extraction"][0](spark, SF_SMALL).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    assert len(out) == len(pages)
    for r in out:
        assert r.n_chars == len(r.text) and "track(" not in r.text and "©" not in r.text
        first = re.search(r"<p><b>([^<&]*)<br>", pages[r.page_id])
        if first:
            assert " ".join(first.group(1).split()) in r.text


def test_html_extract_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "y"), (2, None, None, "y")],
                                 "page_id long, url string, html string, text string")
    got = html_extract.extract(rows).collect()
    assert len(got) == 3 and [r.dfx_main for r in got if r.page_id == 2] == ["", ""] and {r.text for r in got} == {"x", "y"}


def test_warc_round_trip(spark):
    big, odd = "<p>" + "ä" * 600, "x\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a/\r\nX: y", big), (2, "u", big), (5, "u", big), (3, None, None), (4, "u", ""), (6, "u", odd), (7, "u", odd)]
    folder = scratch_path(spark, "test-warc")
    warc_archive.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    got = {r.page_id: r for r in warc_archive.read_records(spark, folder).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        raw = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert (got[i].record_type, got[i].refers_to) == (("revisit", 5) if i in (1, 2) else ("response", None))
    assert warc_archive.read_payloads(spark, folder).count() == 3
    for r in warc_archive.reconstruct(spark, folder).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head).group(1))
        assert block[length:] == b"\r\n\r\n" and (b"revisit" in head) == (not block[:length].endswith(bytes(r.payload) or b"~"))or not r.payload


# --- neighbours, mixing ----------------------------------------------------

def test_forest_recall_and_scores(spark):
    out = QUERIES["op8_nearest_neighbours"][0](spark, SF_ORACLE).collect()
    rows = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(float)
    norm, got, hit = np.sqrt((x * x).sum(1)), collections.defaultdict(list), 0
    for r in sorted(out, key=lambda r: r["rank"]):
        got[r.query_id].append((r.vec_id, r.score))
    for k in np.flatnonzero(ids % 50 == 0):
        s = x @ x[k] / (norm * norm[k])
        s[k] = -9
        hit += len({i for i, _ in got[ids[k]]} & set(ids[np.lexsort((ids, -s))[:5]]))
        assert all(abs(v - s[ids == i][0]) < 1e-12 for i, v in got[ids[k]])
    assert hit >= 0.9 * 5 * len(got) and len(got) == (ids % 50 == 0).sum()


def test_forest_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]), (1, [2.0, 0.0]), (50, [1.0, 1.0]), (100, [-1.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann_forest.nearest(v, F.col("id") % 50 == 0, k=3).orderBy("query_id", "rank").collect()
    mine = collections.defaultdict(list)
    for r in got:
        mine[r.query_id].append(r.vec_id)
    assert mine == {0: [1, 2, 50], 50: [0, 1, 2], 100: [3, 50, 0]}
    assert ann_forest.nearest(v.limit(0), F.col("id") % 50 == 0).count() == 0


def test_mixing_weights(spark):
    rows = spark.createDataFrame([("a", 8000), ("b", 1000), ("c", 500), ("d", 0)], "source string, tokens long")
    got = {r.source: r for r in mixing.weights(rows, None, 2.0, None).collect()}
    assert got["a"].quota == 8000 and got["c"].quota == 1000 and got["d"].quota == 0         # the smallest twice
    assert abs(sum(r.weight for r in got.values()) - 1) < 1e-8
    even = mixing.weights(rows, 0.9, None, 9500.0).collect()
    p = np.array([r.weight for r in even if r.weight])
    assert abs(-(p * np.log(p)).sum() - 0.9 * np.log(3)) < 1e-6 and abs(sum(r.quota for r in even) - 9500) <= 3


def test_mix_keeps_every_document(spark):
    rows = [(i, "w " * (1 + i % 9), "big" if i % 4 else f"s{i % 3}") for i in range(400)] + AWKWARD
    docs = docs_of(spark, rows)
    out = mixing.mix(docs, repeats=2.0)
    assert out.columns[:len(docs.columns)] == docs.columns
    once = out.filter("dfx_pass = 1").select("doc_id", "text").collect()
    assert collections.Counter(map(tuple, once)) == collections.Counter((i, t) for i, t, _ in rows)
    assert 0 < out.filter("dfx_pass > 1").count() <= len(rows)
    assert mixing.mix(docs.limit(0), repeats=2.0).count() == 0


# --- pipeline, entry -------------------------------------------------------

def test_empty_tables(spark):
    docs = docs_of(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_path(spark, "test-empty")
    warc_archive.write_archive(pages, folder)
    index = token_files.write_token_files(docs, scratch_path(spark, "test-empty-tokens"), tokenizer_path(), 2)
    for out in (exact_dedup.exact_dedup(docs), near_dedup.near_dedup(docs), quality.quality(docs, labels), toxicity.toxicity(docs, labels),
                html_extract.extract(pages), packing.pack(docs, tokenizer_path()), warc_archive.read_records(spark, folder),
                token_files.read_documents(spark, folder, index)):
        assert out.count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    clean = P.drop_toxic(spark, docs, SF_ORACLE)
    gone = {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in clean.select("doc_id").collect()}
    assert clean.columns == docs.columns and sum(labels.get(i) == 1 for i in gone) > 20
    assert sum(labels.get(i) == 0 for i in gone) <= 3                # of 348
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    exact = P.drop_exact_copies(spark, docs, SF_ORACLE)
    best = {}
    for i, t, _ in rows:
        best[t.translate(LOWER)] = max(i, best.get(t.translate(LOWER), -1))
    assert {r.doc_id for r in exact.collect()} == set(best.values()) and exact.columns == docs.columns
    near = P.drop_near_copies(spark, docs, SF_ORACLE)
    sets, inverted = word_sets(rows, 5), collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            inverted[x].append(k)
    both = collections.Counter((a, b) for ks in inverted.values() for n, b in enumerate(ks) for a in ks[:n])
    head = list(range(len(rows)))

    def root(k):
        while head[k] != k:
            k = head[k]
        return k

    for (a, b), n in both.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)), key=lambda k: rows[k][0])
            head[b] = a
    assert {r.doc_id for r in near.collect()} == {rows[k][0] for k in range(len(rows)) if root(k) == k} and near.columns == docs.columns


def test_pipeline_runs_and_entry_registers(spark):
    import __spark_entry__ as E

    out = E.queries()["pipeline"](spark, SF_SMALL)
    assert out.count() > 0
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in E.queries()}
    assert os.path.exists(tokenizer_path())
