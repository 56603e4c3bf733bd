"""Model fitting and evaluation.

Linear models are fitted from grouped sufficient statistics (closed-form
ordinary least squares with one or two features), so a fit is one aggregate,
k fits (folds, bootstrap replicates, learning-curve sizes) are one grouped
aggregate, and everything stays exact and SQL-checkable.  Trees use MLlib.

Splits come from a deterministic hash of the row key, so they are stable under
re-partitioning and recomputation after an executor loss (``randomSplit`` is
not).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmarket.operators.common import attach, join_small, one_row
from lotmarket.session import ensure_checkpoint_dir
from lotmarket.sources.files import materialize


# --------------------------------------------------------------------------- splits

def hash_bucket(cols: Sequence[str], buckets: int = 100, seed: int = 42) -> Column:
    """0..buckets-1 from the first 32 bits of md5(seed-key-key...): portable, and independent between seeds."""
    h = F.md5(F.concat_ws("-", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % buckets).cast("bigint")


def xx_bucket(cols: Sequence[str], buckets: int = 100, seed: int = 42) -> Column:
    """xxhash64 bucket for keys of any type."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(buckets))


def split_label(bucket: Column, bounds: Sequence[tuple[str, int]]) -> Column:
    """M1: name the split by bucket ranges, e.g. [("train", 80), ("test", 100)]."""
    out = None
    for name, hi in bounds:
        out = F.when(bucket < hi, F.lit(name)) if out is None else out.when(bucket < hi, F.lit(name))
    return out


# --------------------------------------------------------------------------- closed-form OLS

def ols_sums(xs: Sequence[str], y: str, weight: Column | None = None) -> list[Column]:
    """Aggregates of the sufficient statistics for OLS on ``xs`` (1 or 2 features)."""
    w = weight if weight is not None else F.lit(1.0)
    out = [F.sum(w).alias("n"), F.sum(w * F.col(y)).alias("sy"), F.sum(w * F.col(y) * F.col(y)).alias("syy")]
    for i, x in enumerate(xs, 1):
        out += [F.sum(w * F.col(x)).alias(f"s{i}"), F.sum(w * F.col(x) * F.col(y)).alias(f"s{i}y"),
                F.sum(w * F.col(x) * F.col(x)).alias(f"s{i}{i}")]
    if len(xs) == 2:
        out.append(F.sum(w * F.col(xs[0]) * F.col(xs[1])).alias("s12"))
    return out


def ols_coefficients(k: int) -> list[Column]:
    """Intercept ``b0`` and slopes ``b1..bk`` from the sums of :func:`ols_sums`."""
    n, sy = F.col("n"), F.col("sy")
    if k == 1:
        cxx = F.col("s11") - F.col("s1") * F.col("s1") / n
        cxy = F.col("s1y") - F.col("s1") * sy / n
        b1 = F.try_divide(cxy, cxx)
        return [(sy / n - b1 * F.col("s1") / n).alias("b0"), b1.alias("b1")]
    c11 = F.col("s11") - F.col("s1") * F.col("s1") / n
    c22 = F.col("s22") - F.col("s2") * F.col("s2") / n
    c12 = F.col("s12") - F.col("s1") * F.col("s2") / n
    c1y = F.col("s1y") - F.col("s1") * sy / n
    c2y = F.col("s2y") - F.col("s2") * sy / n
    det = c11 * c22 - c12 * c12
    b1 = F.try_divide(c22 * c1y - c12 * c2y, det)
    b2 = F.try_divide(c11 * c2y - c12 * c1y, det)
    b0 = sy / n - b1 * F.col("s1") / n - b2 * F.col("s2") / n
    return [b0.alias("b0"), b1.alias("b1"), b2.alias("b2")]


def ols_fit(df: DataFrame, y: str, xs: Sequence[str], group: Sequence[str] = (),
            weight: Column | None = None) -> DataFrame:
    """M2: one row of coefficients per group (``b0``, ``b1`` [, ``b2``]) and ``n``."""
    g = df.groupBy(*group) if group else df
    sums = g.agg(*ols_sums(xs, y, weight))
    return sums.select(*group, "n", *ols_coefficients(len(xs)))


def predict_linear(df: DataFrame, coef: DataFrame, xs: Sequence[str], name: str = "prediction",
                   on: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Apply coefficients (one row, or one row per ``on`` key) to the rows;
    ``keep`` carries further coefficient-table columns along."""
    c = coef.select(*on, *keep, *[F.col(f"b{i}").alias(f"_b{i}") for i in range(len(xs) + 1)])
    # one coefficient row -> scalar subquery; one row per key -> equi-join on the key
    j = df.join(c, list(on), "inner") if on else attach(df, c)
    p = F.col("_b0")
    for i, x in enumerate(xs, 1):
        p = p + F.col(f"_b{i}") * F.col(x)
    return j.withColumn(name, p).drop(*[f"_b{i}" for i in range(len(xs) + 1)])


# --------------------------------------------------------------------------- metrics

def regression_metrics(df: DataFrame, y: str, p: str, group: Sequence[str] = ()) -> DataFrame:
    """M5: MAE, RMSE, R^2 (1 - SSE/SST), MAPE (%) over rows with y != 0, and
    accuracy = max(0, (1 - MAE / median(y)) * 100)."""
    from lotmarket.operators.stats import group_quantiles, reread
    e = F.col(y) - F.col(p)
    ks = list(group)
    df = reread(df.select(*ks, y, p))
    g = df.groupBy(*ks) if ks else df
    m = g.agg(F.count("*").cast("bigint").alias("n"), F.avg(F.abs(e)).alias("mae"),
              F.sqrt(F.avg(e * e)).alias("rmse"),
              (1 - F.sum(e * e) / (F.var_pop(y) * F.count(y))).alias("r2"),
              (F.avg(F.when(F.col(y) != 0, F.abs(e / F.col(y))) * 100)).alias("mape"))
    med = group_quantiles(df, ks or None, y, {"_med_y": 0.5})
    m = m.join(med, ks, "left") if ks else attach(m, med)
    return m.withColumn("accuracy", F.greatest(F.lit(0.0), (1 - F.col("mae") / F.col("_med_y")) * 100)).drop("_med_y")


def r2_by_fit(df: DataFrame, y: str, p: str, group: Sequence[str]) -> DataFrame:
    e = F.col(y) - F.col(p)
    return df.groupBy(*group).agg((1 - F.sum(e * e) / (F.var_pop(y) * F.count(y))).alias("r2"),
                                  F.count("*").cast("bigint").alias("n_eval"))


# --------------------------------------------------------------------------- resampling

def r2_from_sums(k: int) -> Column:
    """R^2 of coefficients ``b0..bk`` on the rows whose sums (:func:`ols_sums`) stand beside them: no pass over rows."""
    b = [F.col(f"b{i}") for i in range(k + 1)]
    sse = F.col("syy") - 2 * b[0] * F.col("sy") + b[0] * b[0] * F.col("n")
    for i in range(1, k + 1):
        sse = sse - 2 * b[i] * F.col(f"s{i}y") + 2 * b[0] * b[i] * F.col(f"s{i}") + b[i] * b[i] * F.col(f"s{i}{i}")
    if k == 2:
        sse = sse + 2 * b[1] * b[2] * F.col("s12")
    return 1 - F.try_divide(sse, F.col("syy") - F.col("sy") * F.col("sy") / F.col("n"))


def kfold_linear_r2(df: DataFrame, y: str, xs: Sequence[str], fold: str, k: int) -> DataFrame:
    """M9: k-fold CV of a linear fit in one pass over the rows.  Training sums of fold f = total sums minus the sums
    of fold f; R^2 on fold f follows from its sums and that fit's coefficients."""
    per = materialize(df.groupBy(fold).agg(*ols_sums(xs, y)), "fold-sums")  # a row for each fold
    stat_cols = [c for c in per.columns if c != fold]
    tot = per.agg(*[F.sum(c).alias(f"_t_{c}") for c in stat_cols])
    train = attach(per, tot).select(fold, *[(F.col(f"_t_{c}") - F.col(c)).alias(c) for c in stat_cols])
    coef = train.select(fold, *ols_coefficients(len(xs)))
    return per.join(coef, fold).select(fold, r2_from_sums(len(xs)).alias("r2"), F.col("n").cast("bigint").alias("n_eval"))


def cv_summary(scores: DataFrame, holdout: DataFrame | None = None) -> DataFrame:
    """Mean and population std of the fold scores; a std under 0.02 is very good.

    ``holdout`` (one row, ``r2``) adds the check against learning by heart: its R^2 within 0.05 of the folds' mean."""
    s = scores.agg(F.avg("r2").alias("mean_r2"), F.stddev_pop("r2").alias("std_r2"),
                   F.count("*").cast("bigint").alias("folds"))
    s = s.withColumn("verdict", F.when(F.col("std_r2") < 0.02, "very good").otherwise("needs work"))
    if holdout is None:
        return s
    s = attach(s, holdout.select(F.col("r2").alias("holdout_r2")))
    return s.withColumn("overfit", F.when(F.abs(F.col("holdout_r2") - F.col("mean_r2")) < 0.05, "safe").otherwise("overfit"))


def learning_curve(df: DataFrame, y: str, xs: Sequence[str], fold: str, k: int, size_bucket: str,
                   sizes: Sequence[int]) -> DataFrame:
    """For each training size s (percent of buckets) and fold f: fit on rows
    of other folds with ``size_bucket < s``, score train and validation R^2, all from one pass over the rows.

    The (size, validation fold) grid is a literal array of parameters; a row
    takes part in the fits whose size it lies under and whose fold it is not
    (``explode`` of the matching grid entries, fan-out <= sizes * k), so no
    join with the grid is needed.  Sums are pre-aggregated per
    (fold, size_bucket) first (at most k*100 rows)."""
    grid = F.array(*[F.struct(F.lit(int(s)).cast("bigint").alias("size"), F.lit(f).cast("bigint").alias("_vf"))
                     for s in sizes for f in range(k)])

    def fits_of(bucket, fo):
        return F.explode(F.filter(grid, lambda g: (bucket < g["size"]) & (fo != g["_vf"])))

    per = df.groupBy(fold, size_bucket).agg(*ols_sums(xs, y))
    stat_cols = [c for c in per.columns if c not in (fold, size_bucket)]
    j = per.select("*", fits_of(F.col(size_bucket), F.col(fold)).alias("_g")) \
        .select("*", F.col("_g.size").alias("size"), F.col("_g._vf").alias("_vf")).drop("_g")
    train = j.groupBy("size", "_vf").agg(*[F.sum(c).alias(c) for c in stat_cols])
    fits = train.select("*", *ols_coefficients(len(xs))).select(
        "size", "_vf", F.col("n").alias("n_train"), *[f"b{i}" for i in range(len(xs) + 1)], r2_from_sums(len(xs)).alias("train_r2"))
    # validation: the sums of the fold that was left out
    held = per.groupBy(F.col(fold).cast("bigint").alias("_vf")).agg(*[F.sum(c).alias(c) for c in stat_cols])
    out = fits.join(held, "_vf").withColumn("val_r2", r2_from_sums(len(xs)))
    agg = out.groupBy("size").agg(F.avg("train_r2").alias("train_r2"), F.avg("val_r2").alias("val_r2"),
                                  F.avg("n_train").alias("mean_train_rows"))
    gap = F.col("train_r2") - F.col("val_r2")
    # the verdict is the last size's
    return agg.withColumn("gap", gap).withColumn(
        "verdict", F.when(F.col("size") < max(sizes), F.lit(None)).when(gap > 0.1, "overfit")
        .when(F.col("val_r2") < 0.5, "underfit").otherwise("good"))


# Poisson(1) cumulative probabilities P(X <= k), k = 0..7.
POISSON1_CDF = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
                0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999897508033253]
#: A weight is drawn from 16 bits of a sha256, which holds draws for sixteen replicates.
DRAW_BITS = 16
DRAWS_PER_HASH = 256 // DRAW_BITS
#: Draws below the k-th bound have weight k at most.
POISSON1_BOUNDS = [int(p * (1 << DRAW_BITS)) for p in POISSON1_CDF]


def replicate_draws(name: Column, reps: int, seed: int) -> Column:
    """A binary value with 16 random bits for each replicate: sha256 of seed, block of sixteen replicates and the row's
    name."""
    blocks = -(-reps // DRAWS_PER_HASH)
    return F.concat(*[F.unhex(F.sha2(F.concat(F.lit(f"{seed}-{b}-"), name), 256)) for b in range(blocks)])


def bootstrap_sums(train: DataFrame, key: Sequence[str], y: str, xs: Sequence[str], reps: int, seed: int) -> DataFrame:
    """The sums of :func:`ols_sums` for each replicate ``rep`` (1..reps) of a Poisson bootstrap.

    No row is copied: a batch's rows times their weights for all replicates are one matrix product, added up in the
    task, so a task sends one row a replicate, whatever the number of its rows.  Rows with a NULL take no part.
    """
    names = ["n", "sy", "syy"]
    for i in range(1, len(xs) + 1):
        names += [f"s{i}", f"s{i}y", f"s{i}{i}"]
    if len(xs) == 2:
        names.append("s12")
    rows = train.na.drop(subset=[y, *xs]).select(F.concat_ws("-", *[F.col(c).cast("string") for c in key]).alias("name"), F.col(y).cast("double").alias("y"),
                                                 *[F.col(x).cast("double").alias(f"x{i}") for i, x in enumerate(xs, 1)])
    rows = rows.withColumn("draws", replicate_draws(F.col("name"), reps, seed)).drop("name")
    width, k = -(-reps // DRAWS_PER_HASH) * DRAWS_PER_HASH, len(xs)

    def task_sums(batches):
        total = np.zeros((reps, len(names)))
        for batch in batches:
            if not batch.num_rows:
                continue
            draws = np.frombuffer(b"".join(batch.column("draws").to_pylist()), dtype=">u2").reshape(-1, width)[:, :reps]
            weights = np.searchsorted(POISSON1_BOUNDS, draws, side="right").astype(float)
            yv = batch.column("y").to_numpy()
            x = [batch.column(f"x{i}").to_numpy() for i in range(1, k + 1)]
            stats = [np.ones_like(yv), yv, yv * yv]
            for v in x:
                stats += [v, v * yv, v * v]
            if k == 2:
                stats.append(x[0] * x[1])
            total += weights.T @ np.stack(stats, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(range(1, reps + 1), pa.int32()), *[pa.array(c) for c in total.T]], names=["rep", *names])

    parts = rows.mapInArrow(task_sums, "rep int, " + ", ".join(f"{c} double" for c in names))
    return parts.groupBy("rep").agg(*[F.sum(c).alias(c) for c in names])


def bootstrap_intervals(train: DataFrame, test: DataFrame, key: Sequence[str], y: str, xs: Sequence[str],
                        reps: int = 100, seed: int = 7, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Poisson bootstrap of a linear fit.  Each training row has a weight per replicate, drawn from a sha256 of
    (seed, replicate, key); the sums of all replicates are gathered without copies of rows (:func:`bootstrap_sums`).
    The ``reps`` coefficient rows (bounded by the parameter) reach every test row as one array-valued scalar subquery,
    and the row's ``lo``/``hi`` quantiles (linear interpolation, as ``percentile``) are read from its sorted
    predictions: no join, no shuffle of the test rows."""
    coef = bootstrap_sums(train, key, y, xs, reps, seed).select("rep", *ols_coefficients(len(xs)))
    fits = one_row(coef.agg(F.collect_list(F.struct(*[F.col(f"b{i}") for i in range(len(xs) + 1)])).alias("c")))
    # the scalar lands in a column first: subqueries may not sit inside transform()
    t = test.select(*key, y, *xs, fits["c"].alias("_fits"))

    def pred(c):
        p = c["b0"]
        for i, x in enumerate(xs, 1):
            p = p + c[f"b{i}"] * F.col(x)
        return p

    # a column of its own: read several times below, worked out once
    t = t.select(*key, y, F.sort_array(F.transform(F.col("_fits"), pred)).alias("_preds"))
    preds = F.col("_preds")

    def quantile(q):
        pos = (F.size(preds) - 1) * F.lit(q)
        base = F.floor(pos).cast("int")
        a = F.element_at(preds, base + 1)
        b = F.element_at(preds, F.least(base + 2, F.size(preds)))
        return a + (pos - base) * (b - a)

    per_row = t.select(*key, y, quantile(lo).alias("lower"), quantile(hi).alias("upper"))
    return per_row.withColumn("covered", F.col(y).between(F.col("lower"), F.col("upper"))) \
        .withColumn("width", F.col("upper") - F.col("lower"))


# --------------------------------------------------------------------------- attribution

def linear_attribution(df: DataFrame, coef: DataFrame, xs: Sequence[str], group: str | None = None) -> DataFrame:
    """Exact per-row contributions ``b_j * (x_j - mean_j)`` for every row,
    summarised as mean |contribution| per feature (and mean contribution per group)."""
    means = df.agg(*[F.avg(x).alias(f"_m_{x}") for x in xs])
    c = coef.select(*[F.col(f"b{i}").alias(f"_b_{x}") for i, x in enumerate(xs, 1)])
    j = attach(attach(df, means), c)
    keep = [group] if group else []
    contrib = j.select(*keep, *[(F.col(f"_b_{x}") * (F.col(x) - F.col(f"_m_{x}"))).alias(x) for x in xs])
    long = contrib.withColumn("_id", F.lit(0)).unpivot(["_id", *keep], list(xs), "feature", "contribution")
    g = ["feature", *keep]
    return long.groupBy(*g).agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"),
                                F.avg("contribution").alias("mean_contribution"))


def marginal_effect(df: DataFrame, coef: DataFrame, xs: Sequence[str]) -> DataFrame:
    """% change of the (log-scale) target per unit of each feature:
    ``(exp(slope of contribution on x) - 1) * 100``; 0 when x is constant."""
    c = coef.select(*[F.col(f"b{i}").alias(f"_b_{x}") for i, x in enumerate(xs, 1)])
    j = attach(df, c)
    parts = []
    for x in xs:
        contrib = F.col(f"_b_{x}") * F.col(x)
        parts.append(F.when(F.var_pop(x) == 0, F.lit(0.0))
                     .otherwise((F.exp(F.regr_slope(contrib, F.col(x))) - 1) * 100).alias(x))
    row = j.agg(*parts).withColumn("_id", F.lit(0))
    return row.unpivot("_id", list(xs), "feature", "effect_pct").drop("_id")


# --------------------------------------------------------------------------- encoders

def label_encode(df: DataFrame, c: str, name: str, missing: str = "UNKNOWN") -> DataFrame:
    """M8: alphabetical codes 0..k-1 of the distinct values (NULL -> ``missing``),
    computed on the distinct values with scalable dense ids, joined back without dealing the rows out by a hot value."""
    from lotmarket.operators.warehouse import dense_ids
    v = df.withColumn(c, F.coalesce(F.col(c), F.lit(missing)))
    codes = dense_ids(v.select(c).distinct(), [c], "_code").withColumn(name, F.col("_code") - 1).drop("_code")
    return join_small(v, codes, [c])


def median_encoding(train: DataFrame, key: str, y: str, name: str) -> DataFrame:
    """M7: per key value, ``log(1 + median(y))`` of the training rows."""
    from lotmarket.operators.stats import group_quantiles
    return group_quantiles(train, key, y, {"_m": 0.5}).select(key, F.log1p("_m").alias(name))


def encode(df: DataFrame, encoding: DataFrame, key: str, name: str) -> DataFrame:
    """Rows with their key's encoding less the mean of all encodings; 0 for a key without one."""
    j = attach(join_small(df, encoding, [key]), encoding.agg(F.avg(name).alias("_mean")))
    return j.withColumn(name, F.coalesce(F.col(name) - F.col("_mean"), F.lit(0.0))).drop("_mean")


# --------------------------------------------------------------------------- trees

def tree_fit(train: DataFrame, y: str, xs: Sequence[str], kind: str = "rf", **params):
    """M3/M4: a forest (``forest.fit_forest``, which takes the library's parameter names) or the library's boosted trees.
    Returns (model, assembler)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from lotmarket.operators.forest import fit_forest
    va = VectorAssembler(inputCols=list(xs), outputCol="features", handleInvalid="keep")
    if kind == "rf":
        return fit_forest(train, y, xs, **params), va
    ensure_checkpoint_dir(train.sparkSession)
    est = GBTRegressor(labelCol=y, featuresCol="features", checkpointInterval=10, **params)
    return est.fit(va.transform(train)), va


def importance_table(model, xs: Sequence[str], spark) -> DataFrame:
    """M6: feature importances as a table, sorted by importance."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(x, float(v)) for x, v in zip(xs, imp)], "feature string, importance double")
