"""Classification metrics over labels ⋈ documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.operators import metrics as M
from duelframe.plans.registry import register, table

_YY = """(SELECT l.quality AS y, CAST(d.n_chars > 500 AS INTEGER) AS yhat
          FROM labels l JOIN documents d USING (doc_id))"""


def scored(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(F.col("quality").alias("y"),
                                          (F.col("n_chars") > 500).cast("int").alias("yhat"))


@register("confusion_matrix", f"""
WITH c AS (SELECT DISTINCT y AS c FROM {_YY} UNION SELECT DISTINCT yhat FROM {_YY}),
t AS (SELECT y, yhat, count(*) AS n FROM {_YY} GROUP BY ALL)
SELECT a.c AS y, b.c AS yhat, coalesce(t.n, 0) AS n
FROM c a JOIN c b ON true LEFT JOIN t ON t.y = a.c AND t.yhat = b.c
""")
def q_confusion(spark, sf_dir):
    """Confusion matrix, missing cells 0."""
    return M.confusion_matrix(scored(spark, sf_dir), "y", "yhat")


@register("accuracy", f"SELECT round(avg(CAST(y = yhat AS DOUBLE)), 6) AS accuracy FROM {_YY}")
def q_accuracy(spark, sf_dir):
    """A17."""
    return M.accuracy(scored(spark, sf_dir), "y", "yhat").select(
        F.round("accuracy", 6).alias("accuracy"))


@register("f1_per_class", f"""
WITH t AS (SELECT y AS cls, count(*) AS n_true, count(*) FILTER (WHERE y = yhat) AS tp
           FROM {_YY} GROUP BY y),
p AS (SELECT yhat AS cls, count(*) AS n_pred FROM {_YY} GROUP BY yhat)
SELECT cls, round(coalesce(2.0 * coalesce(tp, 0) / nullif(coalesce(n_true, 0) + coalesce(n_pred, 0), 0), 0), 6) AS f1
FROM t FULL JOIN p USING (cls)
""")
def q_f1_per_class(spark, sf_dir):
    """F1 per class (0 when undefined)."""
    f = M.f1_per_class(scored(spark, sf_dir), "y", "yhat")
    return f.select("cls", F.round("f1", 6).alias("f1"))


@register("binary_metrics", f"""
WITH c AS (SELECT count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp,
                  count(*) FILTER (WHERE y <> 1 AND yhat = 1) AS fp,
                  count(*) FILTER (WHERE y = 1 AND yhat <> 1) AS fn,
                  count(*) FILTER (WHERE y <> 1 AND yhat <> 1) AS tn FROM {_YY}),
m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM c)
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
       round(p, 6) AS precision, round(r, 6) AS recall,
       round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1
FROM m
""")
def q_binary_metrics(spark, sf_dir):
    """Precision, recall, F (binary)."""
    b = M.binary_metrics(scored(spark, sf_dir), "y", "yhat")
    return b.select("tp", "fp", "fn", "tn",
                    *[F.round(c, 6).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])
