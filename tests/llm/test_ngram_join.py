"""The n-gram join against brute force over sets."""

import numpy as np
import pytest

from test_operators import AWKWARD, brute_components, docs_of, word_sets
from duelframe.llm import ngram_join, shingles


def check(spark, rows, width=3, percent=90, parts=4):
    got = ngram_join.join(docs_of(spark, rows).repartition(parts), width=width, percent=percent).collect()
    heads, sizes = brute_components(rows, width, percent)
    want = sorted((str(i), n, str(i if n == 0 else h)) for (i, _, _), h, n in zip(rows, heads, sizes))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want


def test_awkward_rows(spark):
    check(spark, AWKWARD)
    check(spark, AWKWARD, width=1, percent=80)
    assert ngram_join.join(docs_of(spark, [])).count() == 0


def family(rng, name, size, n, most):
    base = [f"{name}{k}" for k in range(size)]
    rows = []
    for i in range(n):
        w = list(base)
        for p in rng.choice(size, rng.integers(0, most + 1), replace=False):
            w[p] = f"{name}x{rng.integers(0, 9)}" if rng.random() < 0.7 else ""
        w = w[:size - rng.integers(0, 5)] + [f"{name}more{k}" for k in range(rng.integers(0, 4))]
        rows.append(" ".join(w))
    return rows


@pytest.mark.parametrize("percent", [90, 80])
def test_families_of_edits(spark, percent):
    """Copies that differ from one text each in their own way: most fail against the hub, some are linked with each other only."""
    rng = np.random.default_rng(percent)
    texts = [t for k, size in enumerate((12, 30, 45, 60, 150, 150, 400)) for t in family(rng, f"f{k}w", size, 45, 2 + size // 20)]
    passage = " ".join(f"shared{k}" for k in range(60))
    texts += [f"{passage} " + " ".join(f"own{i}w{k}" for k in range(30)) for i in range(30)] + [passage, "f0w1 f0w2", "", None]
    rng.shuffle(texts)
    check(spark, [(i, t, "a") for i, t in enumerate(texts)], percent=percent)


def test_links_across_failed_rows_only(spark):
    """Rows at the bound, and a chain that no row is the hub of."""
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in range(i):
            w[3 * k] = f"e{k}"
        rows.append((i, " ".join(w), "a"))
    check(spark, rows)


@pytest.mark.parametrize("percent", [90, 80])
def test_block_keys_meet_for_every_pair_within_the_bound(percent):
    rng = np.random.default_rng(5)
    for n in [1, 2, 5, 8, 9, 10, 11, 13, 26, 27, 28, 60, 100, 127, 300, 1500]:
        for _ in range(40):
            x = shingles.mix(rng.integers(0, 1 << 60, n).astype(np.uint64))
            most = n * (100 - percent) // percent
            gone = int(rng.integers(0, most + 1))
            more = int(rng.integers(0, most + 1))
            y = np.concatenate([x[gone:], shingles.mix(rng.integers(0, 1 << 60, more).astype(np.uint64))])
            both = len(np.intersect1d(x, y))
            if not both or 100 * both < percent * (len(x) + len(y) - both):
                continue
            h = np.concatenate([np.sort(x), np.sort(y)])
            keys, bounds = ngram_join.block_keys(h, np.array([0, len(x), len(x) + len(y)]), percent)
            if gone or more:
                assert np.intersect1d(keys[:bounds[1]], keys[bounds[1]:]).size


def test_query_sets_and_repeats(spark):
    rows = [(i, f"a b c d e f g h i j k l {'X' if i % 2 else 'x'}", "a") for i in range(20)] + [(3, "other words here", "a")]
    check(spark, rows)
    assert {len(s) for s in word_sets(rows, 3)} == {11, 1}
