"""Feature preparation M1-M7, M17, M22-M24 with scikit-learn-equal semantics.

Category lists (one-hot) are collected only after a bounded, checked
distinct count; label codes are computed as a distributed rank of the
distinct values and joined back, so no category list passes the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.operators.joins import broadcast_if_small
from duelframe.operators.ordering import global_row_number, key_row_number

MAX_ONE_HOT_VALUES = 1000


def label_encode(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """M1: alphabetical codes from 0 (scikit LabelEncoder); NULL stays NULL."""
    out = df
    for c in cols:
        vals = df.select(F.col(c).alias("_v")).where(F.col("_v").isNotNull()).distinct()
        codes = global_row_number(vals, ["_v"], "_code")
        codes = codes.select("_v", (F.col("_code") - 1).cast("int").alias("_code"))
        out = out.join(broadcast_if_small(codes), out[c] == codes["_v"], "left")
        out = out.withColumn(c + suffix, F.col("_code")).drop("_v", "_code")
    return out


def _category_values(df: DataFrame, col: str, limit: int) -> list:
    vals = (df.select(F.col(col)).where(F.col(col).isNotNull()).distinct()
              .limit(limit + 1).collect())
    if len(vals) > limit:
        raise ValueError(f"{col} has more than {limit} categories; use one_hot_vector")
    return sorted(r[0] for r in vals)


def one_hot(df: DataFrame, cols: list[str], nulls: str = "zero",
            limit: int = MAX_ONE_HOT_VALUES) -> DataFrame:
    """M2: one 0/1 column ``col_value`` per value, the source column dropped.

    ``nulls='zero'``: a NULL row is all zero (get_dummies); ``'category'``:
    NULL is first filled with '0' and gets its own column (Q10).
    """
    out = df
    for c in cols:
        src = out
        if nulls == "category":
            src = src.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("0")))
        elif nulls != "zero":
            raise ValueError("nulls must be 'zero' or 'category'")
        values = _category_values(src, c, limit)
        out = src.withColumns({f"{c}_{v}": F.when(F.col(c) == F.lit(v), 1).otherwise(0)
                               for v in values}).drop(c)
    return out


def category_codes(df: DataFrame, col: str, nulls: str = "zero") -> DataFrame:
    """(value, code, rows): the distinct values of a column in ascending order, codes from 0.

    A distributed rank: no value passes the driver, so any number of values
    will do.  ``nulls='category'`` counts NULL as the value '0'.
    """
    values = df.select(F.col(col).alias("value"))
    if nulls == "category":
        values = values.select(F.coalesce(F.col("value").cast("string"), F.lit("0")).alias("value"))
    counts = values.where(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("rows"))
    codes = global_row_number(counts, ["value"], "_code")
    return codes.select("value", (F.col("_code") - 1).cast("int").alias("code"), "rows")


def one_hot_vector(df: DataFrame, cols: list[str], nulls: str = "zero", output: str = "one_hot") -> DataFrame:
    """M2 for any number of values: one sparse vector column for ``cols``, which are dropped.

    Place ``code`` (see ``category_codes``), after the values of the columns
    before it, is 1; a NULL row has no 1 (``'zero'``) or that of the value '0'
    (``'category'``).  The codes travel by a join (broadcast if small), the
    vectors are made in the JVM.
    """
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler

    if nulls not in ("zero", "category"):
        raise ValueError("nulls must be 'zero' or 'category'")
    out, parts = df, []
    for i, c in enumerate(cols):
        codes = category_codes(df, c, nulls).select(F.col("value").alias("_v"), F.col("code").alias(f"_code{i}")).checkpoint(eager=True)
        n = codes.count()
        key = F.col(c) if nulls == "zero" else F.coalesce(F.col(c).cast("string"), F.lit("0"))
        out = out.join(broadcast_if_small(codes), key == F.col("_v"), "left").drop("_v", c)
        out = out.withColumn(f"_code{i}", F.coalesce(f"_code{i}", F.lit(n)).cast("double"))
        # fitted on the number of values alone; place n, which is dropped, stands for NULL
        size = df.sparkSession.createDataFrame([(float(n),)], [f"_code{i}"])
        encoder = OneHotEncoder(inputCols=[f"_code{i}"], outputCols=[f"_hot{i}"], dropLast=True).fit(size)
        out = encoder.transform(out).drop(f"_code{i}")
        parts.append(f"_hot{i}")
    return VectorAssembler(inputCols=parts, outputCol=output).transform(out).drop(*parts)


def sparse_entries(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, place, value): the entries other than 0 of a vector column, one row each."""
    fields = F.from_json(F.to_json(F.struct(F.col(vector).alias("v"))), "v struct<type:int,indices:array<int>,values:array<double>>")["v"]
    places = F.when(fields["type"] == 0, fields["indices"]).when(          # MLlib turns short vectors into dense ones
        F.size(fields["values"]) > 0, F.sequence(F.lit(0), F.size(fields["values"]) - 1))
    z = df.select(id_col, F.explode(F.arrays_zip(places.alias("i"), fields["values"].alias("x"))).alias("e"))
    return z.select(id_col, F.col("e.i").alias("place"), F.col("e.x").alias("value")).filter("value <> 0")


def encode_auto(df: DataFrame, skip: list[str] | None = None, vector: str | None = None) -> DataFrame:
    """M3: per categorical column: any NULL -> one-hot (null row zero), else codes.

    With ``vector`` the one-hot columns become one sparse vector of that name
    (any number of values).
    """
    from duelframe.operators.aggs import null_profile
    from duelframe.operators.project import columns_by_type

    skip = set(skip or [])
    cats = [c for c in columns_by_type(df)[1] if c not in skip and
            df.schema[c].dataType.typeName() == "string"]
    if not cats:
        return df
    prof = {r["column"]: r["nulls"] for r in null_profile(df, cats).collect()}
    with_nulls = [c for c in cats if prof[c] > 0]
    out = label_encode(df, [c for c in cats if prof[c] == 0])
    if vector:
        return one_hot_vector(out, with_nulls, "zero", vector) if with_nulls else out
    return one_hot(out, with_nulls, "zero")


def standardize(df: DataFrame, cols: list[str], fit_on: Column | None = None,
                suffix: str = "") -> DataFrame:
    """M4: (x - mean) / population std, fitted on ``fit_on`` rows; std 0 -> 1."""
    fit = df.filter(fit_on) if fit_on is not None else df
    row = fit.agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)],
                  *[F.stddev_pop(c).alias(f"_s{i}") for i, c in enumerate(cols)]).first()
    exprs = {}
    for i, c in enumerate(cols):
        m, s = row[f"_m{i}"], row[f"_s{i}"]
        s = 1.0 if (s is None or s == 0) else s
        exprs[c + suffix] = (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(exprs)


def minmax(df: DataFrame, cols: list[str], fit_on: Column | None = None,
           suffix: str = "") -> DataFrame:
    """M5: (x - min) / (max - min) fitted on ``fit_on`` rows; constant -> 0."""
    fit = df.filter(fit_on) if fit_on is not None else df
    row = fit.agg(*[F.min(c).alias(f"_lo{i}") for i, c in enumerate(cols)],
                  *[F.max(c).alias(f"_hi{i}") for i, c in enumerate(cols)]).first()
    exprs = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"_lo{i}"], row[f"_hi{i}"]
        rng = (hi - lo) if (hi is not None and lo is not None and hi != lo) else 1.0
        exprs[c + suffix] = (F.col(c) - F.lit(lo)) / F.lit(rng)
    return df.withColumns(exprs)


def split_key(id_col, seed: int) -> Column:
    """First 8 hex digits of md5('id:seed') - the same in Spark and DuckDB."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.substring(F.md5(F.concat_ws(":", c.cast("string"), F.lit(str(seed)))), 1, 8)


def split_threshold(frac: float) -> str:
    return format(int(round(frac * 16 ** 8)), "08x")


def split(df: DataFrame, id_col: str, frac: float = 0.8, seed: int = 1,
          name: str = "is_train") -> DataFrame:
    """M6: repeatable train/test flag: hash(id, seed) below ``frac``."""
    return df.withColumn(name, split_key(id_col, seed) < F.lit(split_threshold(frac)))


def split_stratified(df: DataFrame, id_col: str, label: str, frac: float = 0.75,
                     seed: int = 1, name: str = "is_train") -> DataFrame:
    """M7: per label, the first floor(frac·n + 0.5) rows in hash order are train.

    Row numbers come from the hot-key-safe numbering (a label holding most
    rows is spread over many tasks).
    """
    keyed = df.withColumn("_h", split_key(id_col, seed))
    numbered = key_row_number(keyed, label, ["_h", id_col], "_rn", "_n")
    keep = F.floor(F.col("_n") * frac + 0.5)
    return numbered.withColumn(name, F.col("_rn") <= keep).drop("_h", "_rn", "_n")


def select_correlated(df: DataFrame, label: str, exclude: list[str] | None = None) -> list[str]:
    """Names of the half of the numeric features most correlated with ``label``.

    The correlation table has one row per column (bounded by the schema).
    """
    from duelframe.operators.aggs import label_correlation
    from duelframe.operators.ordering import top_half

    corr = label_correlation(df, label)
    return sorted(r["feature"] for r in top_half(corr, exclude=exclude).collect())


def feature_set(df: DataFrame, kind: str, label: str | None = None,
                keep: list[str] | None = None) -> DataFrame:
    """M22: 'all', 'no_avg' (drop columns starting with avg_) or 'correlated'."""
    keep = keep or []
    if kind == "all":
        return df
    if kind == "no_avg":
        return df.select(*[c for c in df.columns if not c.startswith("avg_")])
    if kind == "correlated":
        feats = select_correlated(df, label)
        return df.select(*keep, *feats, label)
    raise ValueError(kind)


def clean_competitors(df: DataFrame, group: str, impute_cols: list[str],
                      fill_values: dict[str, str], required: list[str],
                      replacements: list[tuple[Column, str, object]]) -> DataFrame:
    """Impute group means (W6), fill categories (F19), drop rows missing
    required values (P9), conditional overwrites (P13) - one plan."""
    from duelframe.operators.project import replace_where
    from duelframe.operators.windows import impute_group_mean

    out = impute_group_mean(df, group, impute_cols)
    out = out.fillna(fill_values)
    for c in required:
        out = out.filter(F.col(c).isNotNull())
    for cond, col, value in replacements:
        out = replace_where(out, cond, col, value)
    return out


def prepare_careers(df: DataFrame, drop: list[str], skip: list[str], vector: str | None = None) -> DataFrame:
    """Drop columns, encode categoricals by the null rule (``vector`` as in ``encode_auto``), fill NULL with 0."""
    out = encode_auto(df.drop(*drop), skip, vector)
    return out.fillna(0)
