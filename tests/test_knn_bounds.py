"""k-NN by bounded matrix products against brute force."""

import numpy as np
import pandas as pd

from duelframe.operators import models as ML


def brute(q, t, tid, k):
    d = np.zeros((len(q), len(t)))
    for i in range(q.shape[1]):
        d += (q[:, i][:, None] - t[:, i][None, :]) ** 2
    d = np.sqrt(d)
    return [[(tid[j], row[j]) for j in np.lexsort((tid, row))[:k]] for row in d]


def test_nearest_equals_brute_force_where_single_precision_cannot_tell(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(ML, "KNN_STRIP", 7)
    monkeypatch.setattr(ML, "KNN_CHUNK", 11)
    base = rng.normal(size=(60, 5))
    close = 1000 + rng.normal(size=(60, 5)) * 1e-9                      # equal in single precision
    for t in (base, close, np.repeat(base[:6], 10, axis=0), np.zeros((60, 5)), base * 1e160, base * 1e-150, base * 1e30):
        q, tid = t[::3] * (1 + 1e-12), rng.permutation(60)
        got = ML._nearest(np.arange(len(q)), q, tid, t, tid % 2, 4)
        assert isinstance(got, pd.DataFrame)
        got = [list(zip(g["_tid"], g["_d"])) for _, g in got.sort_values(["_qid", "_d", "_tid"]).groupby("_qid")]
        assert got == brute(q, t, tid, 4)
