"""Model queries: price ~ area + land on the stand-in sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmarket.functions import core as fx
from lotmarket.operators import boost
from lotmarket.operators import market as mk
from lotmarket.operators import ml
from lotmarket.operators.common import attach
from lotmarket.plans.binding import sales, with_sales
from lotmarket.plans.catalog import register
from lotmarket.plans.common import finish
from lotmarket.sources.files import materialize

XS = ["x1", "x2"]
SEED = 42
KEY = ["l_orderkey", "l_linenumber"]
SIZE_SEED, FOLD5_SEED, FOLD3_SEED = 7, 11, 13


def bucket_sql(seed: int, buckets: int) -> str:
    """DuckDB twin of :func:`lotmarket.operators.ml.hash_bucket` on ``KEY``."""
    h = f"md5(concat_ws('-', '{seed}', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)))"
    digits = " + ".join(f"(instr('0123456789abcdef', substring({h}, {i + 1}, 1)) - 1) * {16 ** (7 - i)}" for i in range(8))
    return f"CAST(({digits}) % {buckets} AS BIGINT)"




def base(spark, d):
    s = sales(spark, d)
    return s.select("l_orderkey", "l_linenumber", "borough_name", "neighborhood", "building_type",
                    F.col("sale_price").alias("y"), F.log1p("sale_price").alias("ly"),
                    F.col("gross_sqft").alias("x1"), F.col("land_sqft").alias("x2"),
                    F.col("total_units").cast("double").alias("x3"), F.col("age_days").cast("double").alias("x4"),
                    ml.hash_bucket(KEY, 100, SEED).alias("bucket"), ml.hash_bucket(KEY, 100, SIZE_SEED).alias("bucket2"),
                    ml.hash_bucket(KEY, 5, FOLD5_SEED).alias("fold5"), ml.hash_bucket(KEY, 3, FOLD3_SEED).alias("fold3"))


BASE_SQL = f"""base AS (SELECT l_orderkey, l_linenumber, borough_name, neighborhood, building_type, sale_price AS y,
  ln(1 + sale_price) AS ly, gross_sqft AS x1, land_sqft AS x2, {bucket_sql(SEED, 100)} AS bucket, {bucket_sql(SIZE_SEED, 100)} AS bucket2,
  {bucket_sql(FOLD5_SEED, 5)} AS fold5, {bucket_sql(FOLD3_SEED, 3)} AS fold3 FROM sales),
tr AS (SELECT * FROM base WHERE bucket < 80), te AS (SELECT * FROM base WHERE bucket >= 80)"""


def coef_sql(name: str, src: str, y: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return f"""{name} AS (SELECT {g}n, b1, b2, sy / n - b1 * s1 / n - b2 * s2 / n AS b0 FROM (
  SELECT *, (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS b1, (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS b2
  FROM (SELECT *, s11 - s1 * s1 / n AS c11, s22 - s2 * s2 / n AS c22, s12 - s1 * s2 / n AS c12,
               s1y - s1 * sy / n AS c1y, s2y - s2 * sy / n AS c2y FROM (
    SELECT {g}CAST(count(*) AS DOUBLE) AS n, sum({y}) AS sy, sum(x1) AS s1, sum(x2) AS s2, sum(x1 * x1) AS s11,
           sum(x2 * x2) AS s22, sum(x1 * x2) AS s12, sum(x1 * {y}) AS s1y, sum(x2 * {y}) AS s2y FROM {src}{gb}))))"""


ML_SQL = BASE_SQL + ",\n" + coef_sql("coef", "tr", "y") + """,
pred AS (SELECT te.*, coef.b0 + coef.b1 * te.x1 + coef.b2 * te.x2 AS p FROM te, coef)"""


def split(spark, d):
    b = base(spark, d)
    return b.where(F.col("bucket") < 80), b.where(F.col("bucket") >= 80)


def fit(spark, d, y="y"):
    tr, _ = split(spark, d)
    return ml.ols_fit(tr, y, XS)


def predictions(spark, d):
    tr, te = split(spark, d)
    return ml.predict_linear(te, ml.ols_fit(tr, "y", XS), XS, "p")


@register("hash_split", with_sales(f"""
SELECT CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n,
       CAST(NULL AS VARCHAR) AS split3, CAST(NULL AS BIGINT) AS n3 FROM base GROUP BY 1
UNION ALL
SELECT NULL, NULL, CASE WHEN b3 < 7225 THEN 'train' WHEN b3 < 8500 THEN 'valid' ELSE 'test' END, count(*)
FROM (SELECT {bucket_sql(SEED, 10000)} AS b3 FROM sales) GROUP BY 3""",
                                   BASE_SQL))
def hash_split(spark, d):
    b = base(spark, d)
    two = b.groupBy(ml.split_label(F.col("bucket"), [("train", 80), ("test", 100)]).alias("split")) \
        .agg(F.count("*").alias("n")).select("split", "n", F.lit(None).cast("string").alias("split3"),
                                             F.lit(None).cast("bigint").alias("n3"))
    b3 = ml.hash_bucket(KEY, 10000, SEED)
    three = sales(spark, d).groupBy(ml.split_label(b3, [("train", 7225), ("valid", 8500), ("test", 10000)])
                                    .alias("split3")).agg(F.count("*").alias("n3")) \
        .select(F.lit(None).cast("string").alias("split"), F.lit(None).cast("bigint").alias("n"), "split3", "n3")
    return finish(two.unionByName(three))


@register("lr_fit", with_sales("SELECT CAST(n AS BIGINT) AS n, round(b0, 4) AS b0, round(b1, 4) AS b1, "
                               "round(b2, 4) AS b2 FROM coef", ML_SQL))
def lr_fit(spark, d):
    return finish(fit(spark, d).withColumn("n", F.col("n").cast("bigint")))


@register("model_tables", with_sales("SELECT 'price' AS model, CAST(any_value(coef.n) AS BIGINT) AS n_train, count(*) AS n_scored, "
                                     "round(avg(p), 4) AS mean_prediction, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse FROM pred, coef", ML_SQL))
def model_tables(spark, d):
    """A fit is stored as a table of coefficients, read back, and scores rows as the fit itself would."""
    tr, te = split(spark, d)
    stored = materialize(ml.ols_fit(tr, "y", XS).withColumn("model", F.lit("price")), "model-table")
    e = F.col("y") - F.col("p")
    scored = ml.predict_linear(te, stored, XS, "p").agg(F.count("*").alias("n_scored"), F.avg("p").alias("mean_prediction"), F.sqrt(F.avg(e * e)).alias("rmse"))
    return finish(attach(scored, stored.select("model", F.col("n").cast("bigint").alias("n_train"))))


METRICS_SQL = """SELECT count(*) AS n, round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 4) AS r2,
       round(avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100, 4) AS mape,
       round(greatest(0.0, (1 - avg(abs(y - p)) / median(y)) * 100), 4) AS accuracy"""


@register("regression_metrics", with_sales(METRICS_SQL + " FROM pred", ML_SQL))
def regression_metrics(spark, d):
    return finish(ml.regression_metrics(predictions(spark, d), "y", "p"))


@register("error_by_region", with_sales("""
SELECT borough_name, round(avg((p - y) / y * 100), 4) AS mean_error, round(stddev_samp((p - y) / y * 100), 4) AS std_error, count(*) AS n
FROM pred GROUP BY 1""", ML_SQL))
def error_by_region(spark, d):
    p = predictions(spark, d)
    e = F.try_divide(F.col("p") - F.col("y"), F.col("y")) * 100  # percent of the price
    return finish(p.groupBy("borough_name").agg(F.avg(e).alias("mean_error"), F.stddev_samp(e).alias("std_error"),
                                                F.count("*").alias("n")))


# Price tiers of the stand-in scale (right-closed; above the last edge -> no tier).
TIER_EDGES = [0, 20000, 40000, 60000, 80000, 100000]
TIER_LABELS = ["<20K", "20-40K", "40-60K", "60-80K", "80-100K"]


@register("error_by_tier", with_sales("""
SELECT tier, count(*) AS n, round(avg(abs(p - y) / y) * 100, 4) AS mean_abs_pct, round(avg((p - y) / y) * 100, 4) AS bias,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 4) AS r2
FROM (SELECT *, CASE WHEN y > 0 AND y <= 20000 THEN '<20K' WHEN y > 20000 AND y <= 40000 THEN '20-40K'
                     WHEN y > 40000 AND y <= 60000 THEN '40-60K' WHEN y > 60000 AND y <= 80000 THEN '60-80K'
                     WHEN y > 80000 AND y <= 100000 THEN '80-100K' END AS tier FROM pred)
WHERE tier IS NOT NULL GROUP BY tier""", ML_SQL))
def error_by_tier(spark, d):
    p = predictions(spark, d).withColumn("tier", fx.bin_right_closed("y", TIER_EDGES, TIER_LABELS)) \
        .where(F.col("tier").isNotNull())
    e = F.col("y") - F.col("p")
    out = p.groupBy("tier").agg(F.count("*").alias("n"), (F.avg(F.abs(e) / F.col("y")) * 100).alias("mean_abs_pct"),
                                (F.avg((F.col("p") - F.col("y")) / F.col("y")) * 100).alias("bias"),
                                (1 - F.sum(e * e) / (F.var_pop("y") * F.count("y"))).alias("r2"))
    return finish(out)


@register("linear_attribution", with_sales("""
SELECT feature, borough_name, round(avg(abs(c)), 4) AS mean_abs_contribution, round(avg(c), 4) AS mean_contribution
FROM (SELECT borough_name, 'x1' AS feature, coef.b1 * (x1 - m.m1) AS c FROM base, coef,
             (SELECT avg(x1) AS m1, avg(x2) AS m2 FROM base) m
      UNION ALL
      SELECT borough_name, 'x2', coef.b2 * (x2 - m.m2) FROM base, coef, (SELECT avg(x1) AS m1, avg(x2) AS m2 FROM base) m)
GROUP BY 1, 2""", ML_SQL))
def linear_attribution(spark, d):
    b = base(spark, d)
    return finish(ml.linear_attribution(b, fit(spark, d), XS, group="borough_name"))


@register("marginal_effect", with_sales("""
SELECT 'x1' AS feature, round((exp(regr_slope(lc.b1 * x1, x1)) - 1) * 100, 4) AS effect_pct FROM base, lc
UNION ALL
SELECT 'x2', round((exp(regr_slope(lc.b2 * x2, x2)) - 1) * 100, 4) FROM base, lc""",
                                        BASE_SQL + ",\n" + coef_sql("lc", "tr", "ly")))
def marginal_effect(spark, d):
    return finish(ml.marginal_effect(base(spark, d), fit(spark, d, "ly"), XS))


@register("label_encode", with_sales("""
SELECT v.category, c.code, count(*) AS n FROM
  (SELECT coalesce(CASE WHEN tax = 0 THEN NULL ELSE building_category END, 'UNKNOWN') AS category FROM sales) v
  JOIN (SELECT category, dense_rank() OVER (ORDER BY category) - 1 AS code FROM (
        SELECT DISTINCT coalesce(CASE WHEN tax = 0 THEN NULL ELSE building_category END, 'UNKNOWN') AS category FROM sales)) c
  USING (category) GROUP BY 1, 2"""))
def label_encode(spark, d):
    s = sales(spark, d).select(F.when(F.col("tax") == 0, None).otherwise(F.col("building_category")).alias("category"))
    enc = ml.label_encode(s, "category", "code")
    return finish(enc.groupBy("category", "code").agg(F.count("*").alias("n")))


KFOLD_SQL = BASE_SQL + """,
fb AS (SELECT *, fold5 AS fold FROM base),
per AS (SELECT fold, CAST(count(*) AS DOUBLE) AS n, sum(y) AS sy, sum(x1) AS s1, sum(x2) AS s2, sum(x1 * x1) AS s11,
               sum(x2 * x2) AS s22, sum(x1 * x2) AS s12, sum(x1 * y) AS s1y, sum(x2 * y) AS s2y FROM fb GROUP BY fold),
trs AS (SELECT p.fold, t.n - p.n AS n, t.sy - p.sy AS sy, t.s1 - p.s1 AS s1, t.s2 - p.s2 AS s2, t.s11 - p.s11 AS s11,
               t.s22 - p.s22 AS s22, t.s12 - p.s12 AS s12, t.s1y - p.s1y AS s1y, t.s2y - p.s2y AS s2y
        FROM per p, (SELECT sum(n) AS n, sum(sy) AS sy, sum(s1) AS s1, sum(s2) AS s2, sum(s11) AS s11, sum(s22) AS s22,
                            sum(s12) AS s12, sum(s1y) AS s1y, sum(s2y) AS s2y FROM per) t),
kc AS (SELECT fold, b1, b2, sy / n - b1 * s1 / n - b2 * s2 / n AS b0 FROM (
  SELECT *, (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS b1, (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS b2
  FROM (SELECT *, s11 - s1 * s1 / n AS c11, s22 - s2 * s2 / n AS c22, s12 - s1 * s2 / n AS c12,
               s1y - s1 * sy / n AS c1y, s2y - s2 * sy / n AS c2y FROM trs))),
kr AS (SELECT fold, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS r2, count(*) AS n_eval
       FROM (SELECT fb.*, kc.b0 + kc.b1 * fb.x1 + kc.b2 * fb.x2 AS p FROM fb JOIN kc USING (fold)) GROUP BY fold)"""


def _kfold(spark, d):
    b = base(spark, d).withColumnRenamed("fold5", "fold")
    return ml.kfold_linear_r2(b, "y", XS, "fold", 5)


@register("kfold_r2", with_sales("SELECT fold, round(r2, 4) AS r2, n_eval FROM kr", KFOLD_SQL))
def kfold_r2(spark, d):
    return finish(_kfold(spark, d))


@register("kfold_summary", with_sales("""
SELECT round(avg(r2), 4) AS mean_r2, round(stddev_pop(r2), 4) AS std_r2, count(*) AS folds,
       CASE WHEN stddev_pop(r2) < 0.02 THEN 'very good' ELSE 'needs work' END AS verdict,
       round(any_value(hold), 4) AS holdout_r2,
       CASE WHEN abs(any_value(hold) - avg(r2)) < 0.05 THEN 'safe' ELSE 'overfit' END AS overfit
FROM kr, (SELECT 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS hold FROM pred) h""",
                                         ML_SQL + KFOLD_SQL[len(BASE_SQL):]))
def kfold_summary(spark, d):
    p = predictions(spark, d).withColumn("_all", F.lit(0))
    return finish(ml.cv_summary(_kfold(spark, d), ml.r2_by_fit(p, "y", "p", ["_all"]).select("r2")))


# Six sizes from a tenth to all of the training rows, in percent.
SIZES = [10, 28, 46, 64, 82, 100]


def _lc_sql() -> str:
    sizes = ", ".join(f"({s})" for s in SIZES)
    return BASE_SQL + f""",
fb AS (SELECT *, fold3 AS fold FROM base),
pairs AS (SELECT s.size, f.vf FROM (VALUES {sizes}) s(size), (SELECT DISTINCT fold AS vf FROM fb) f),
trs AS (SELECT p.size, p.vf, CAST(count(*) AS DOUBLE) AS n, sum(y) AS sy, sum(x1) AS s1, sum(x2) AS s2, sum(x1 * x1) AS s11,
               sum(x2 * x2) AS s22, sum(x1 * x2) AS s12, sum(x1 * y) AS s1y, sum(x2 * y) AS s2y
        FROM fb JOIN pairs p ON fb.bucket2 < p.size AND fb.fold <> p.vf GROUP BY 1, 2),
lc AS (SELECT size, vf, b1, b2, sy / n - b1 * s1 / n - b2 * s2 / n AS b0 FROM (
  SELECT *, (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS b1, (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS b2
  FROM (SELECT *, s11 - s1 * s1 / n AS c11, s22 - s2 * s2 / n AS c22, s12 - s1 * s2 / n AS c12,
               s1y - s1 * sy / n AS c1y, s2y - s2 * sy / n AS c2y FROM trs))),
vr AS (SELECT size, fold, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS val_r2 FROM (
        SELECT fb.*, lc.size, lc.b0 + lc.b1 * fb.x1 + lc.b2 * fb.x2 AS p FROM fb JOIN lc ON fb.fold = lc.vf) GROUP BY 1, 2),
tr2 AS (SELECT size, vf AS fold, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS train_r2, count(*) AS n_train FROM (
        SELECT fb.*, lc.size, lc.vf, lc.b0 + lc.b1 * fb.x1 + lc.b2 * fb.x2 AS p FROM fb
        JOIN lc ON fb.bucket2 < lc.size AND fb.fold <> lc.vf) GROUP BY 1, 2)"""


@register("learning_curve", with_sales("""
SELECT CAST(size AS BIGINT) AS size, round(train_r2, 4) AS train_r2, round(val_r2, 4) AS val_r2,
       round(mean_train_rows, 4) AS mean_train_rows, round(train_r2 - val_r2, 4) AS gap,
       CASE WHEN size < 100 THEN NULL WHEN train_r2 - val_r2 > 0.1 THEN 'overfit' WHEN val_r2 < 0.5 THEN 'underfit' ELSE 'good' END AS verdict
FROM (SELECT size, avg(train_r2) AS train_r2, avg(val_r2) AS val_r2, avg(n_train) AS mean_train_rows
      FROM tr2 JOIN vr USING (size, fold) GROUP BY size)""", _lc_sql()))
def learning_curve(spark, d):
    b = base(spark, d).withColumnRenamed("fold3", "fold")
    return finish(ml.learning_curve(b, "y", XS, "fold", 3, "bucket2", SIZES))


REPS, BOOT_SEED = 100, 7


def _boot_sql() -> str:
    """DuckDB twin of :func:`lotmarket.operators.ml.bootstrap_intervals`: every training row meets every replicate."""
    h = f"sha256(concat_ws('-', '{BOOT_SEED}', CAST(rep // {ml.DRAWS_PER_HASH} AS VARCHAR), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)))"
    digits = " + ".join(f"(instr('0123456789abcdef', substring(h, CAST(4 * (rep % {ml.DRAWS_PER_HASH}) + {i + 1} AS BIGINT), 1)) - 1) * {16 ** (3 - i)}" for i in range(4))
    weight = " + ".join(f"CASE WHEN u >= {x} THEN 1 ELSE 0 END" for x in ml.POISSON1_BOUNDS)
    sums = "sum(w) AS n, sum(w * y) AS sy, sum(w * x1) AS s1, sum(w * x2) AS s2, sum(w * x1 * x1) AS s11, sum(w * x2 * x2) AS s22, " \
           "sum(w * x1 * x2) AS s12, sum(w * x1 * y) AS s1y, sum(w * x2 * y) AS s2y"
    return BASE_SQL + f""",
draws AS (SELECT rep, y, x1, x2, {digits} AS u FROM (SELECT tr.*, rep, {h} AS h FROM tr, range({REPS}) r(rep))),
bs AS (SELECT rep, {sums} FROM (SELECT *, {weight} AS w FROM draws) GROUP BY rep),
bc AS (SELECT rep, b1, b2, sy / n - b1 * s1 / n - b2 * s2 / n AS b0 FROM (
  SELECT *, (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS b1, (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS b2
  FROM (SELECT *, s11 - s1 * s1 / n AS c11, s22 - s2 * s2 / n AS c22, s12 - s1 * s2 / n AS c12,
               s1y - s1 * sy / n AS c1y, s2y - s2 * sy / n AS c2y FROM bs))),
iv AS (SELECT any_value(l_orderkey) AS l_orderkey, any_value(l_linenumber) AS l_linenumber, any_value(te.y) AS y,
              quantile_cont(bc.b0 + bc.b1 * te.x1 + bc.b2 * te.x2, 0.05) AS lower, quantile_cont(bc.b0 + bc.b1 * te.x1 + bc.b2 * te.x2, 0.95) AS upper
       FROM (SELECT *, row_number() OVER () AS id FROM te) te, bc GROUP BY id)"""


def _bootstrap(spark, d):
    tr, te = split(spark, d)
    return ml.bootstrap_intervals(tr, te, KEY, "y", XS, reps=REPS, seed=BOOT_SEED)


# Prices to the cent: the two engines add the sums up in different orders.
@register("bootstrap_interval", with_sales("""
SELECT l_orderkey, l_linenumber, round(y, 2) AS y, round(lower, 2) AS lower, round(upper, 2) AS upper,
       y BETWEEN lower AND upper AS covered, round(upper - lower, 2) AS width FROM iv""", _boot_sql()))
def bootstrap_interval(spark, d):
    return finish(_bootstrap(spark, d), 2)


@register("bootstrap_summary", with_sales("""
SELECT round(avg(CASE WHEN y BETWEEN lower AND upper THEN 1.0 ELSE 0.0 END) * 100, 4) AS coverage_pct,
       round(avg(upper - lower), 4) AS mean_width, count(*) AS n FROM iv""", _boot_sql()))
def bootstrap_summary(spark, d):
    """Coverage and mean width of the 90 % intervals."""
    return finish(_bootstrap(spark, d).agg((F.avg(F.col("covered").cast("double")) * 100).alias("coverage_pct"),
                                           F.avg("width").alias("mean_width"), F.count("*").cast("bigint").alias("n")))


# Forest of 150 trees of depth 14 (seed 42) and boosted trees
# (500 rounds, depth 7, step .05, row subsample .8) on the log price.
RF_PARAMS = {"numTrees": 150, "maxDepth": 14, "seed": 42}
GBT_PARAMS = {"rounds": 500, "depth": 7, "step": 0.05, "subsample": 0.8, "seed": 42}
TREE_XS = ["x1", "x2", "x3", "x4"]
ROWS_PER_TASK = 200_000


def tree_frame(spark, d):
    """The model columns, written once (the star join isn't replayed for each round) in partitions of a useful size."""
    t = base(spark, d).select("y", "ly", "bucket", *TREE_XS)
    rows = spark.read.parquet(f"{d}/lineitem.parquet").count()
    return materialize(t.repartition(max(2, -(-rows // ROWS_PER_TASK))), "tree-rows")


@register("rf_fit")
def rf_fit(spark, d, **params):
    """Rows-only: forest feature importances (M3 + M6)."""
    t = tree_frame(spark, d)
    model, _ = ml.tree_fit(t.where(F.col("bucket") < 80), "y", TREE_XS, "rf", **(RF_PARAMS | params))
    return finish(ml.importance_table(model, TREE_XS, spark))


def boosted(spark, d, **params):
    """The fitted trees, and the written model rows."""
    t = tree_frame(spark, d)
    return boost.fit_boosted(t.where(F.col("bucket") < 80), "ly", TREE_XS, **(GBT_PARAMS | params)), t


@register("gbt_fit")
def gbt_fit(spark, d, **params):
    """Rows-only: boosted trees on log price, all rounds; test metrics on the price scale (M4 + M5)."""
    model, t = boosted(spark, d, **params)
    te = boost.predict_boosted(t.where(F.col("bucket") >= 80).select("y", *TREE_XS), model, TREE_XS)
    te = materialize(te.select("y", F.expm1("prediction").alias("p")), "tree-predictions")
    return finish(ml.regression_metrics(te, "y", "p"))


@register("gbt_importance")
def gbt_importance(spark, d, **params):
    """Rows-only: each feature's share of the gain of all splits (M6)."""
    model, t = boosted(spark, d, **params)
    return finish(boost.importance_rows(model, TREE_XS, t))


VAL_SQL = BASE_SQL + """,
me AS (SELECT avg(ln(1 + m)) AS mean_ne FROM (SELECT median(y) AS m FROM tr GROUP BY neighborhood)),
mt AS (SELECT avg(ln(1 + m)) AS mean_te FROM (SELECT median(y) AS m FROM tr GROUP BY building_type)),
ne AS (SELECT neighborhood, ln(1 + median(y)) AS ne FROM tr GROUP BY 1),
te_ AS (SELECT building_type, ln(1 + median(y)) AS te FROM tr GROUP BY 1),
enc AS (SELECT tr.l_orderkey, tr.ly, tr.x1, ne.ne - me.mean_ne + te_.te - mt.mean_te AS x2
        FROM tr JOIN ne USING (neighborhood) JOIN te_ USING (building_type), me, mt),
req AS (SELECT borough_name, neighborhood, building_type, count(*) AS n_requests, avg(x1) AS x1 FROM te GROUP BY 1, 2, 3),
""" + coef_sql("vc", "enc", "ly") + """,
bm AS (SELECT borough_name, median(y) AS med FROM tr GROUP BY 1)"""


@register("batch_valuation", with_sales("""
SELECT borough_name, neighborhood, building_type, n_requests, round(x1, 4) AS area, round(v, 4) AS value, round(v * 0.85, 4) AS low,
       round(v * 1.15, 4) AS high, round((v - med) / med * 100, 4) AS vs_region_median_pct, round(CASE WHEN x1 > 0 THEN v / x1 END, 4) AS per_area
FROM (SELECT req.*, bm.med, exp(vc.b0 + vc.b1 * req.x1 + vc.b2 * (coalesce(ne.ne - me.mean_ne, 0.0) + coalesce(te_.te - mt.mean_te, 0.0))) - 1 AS v
      FROM req JOIN bm USING (borough_name) LEFT JOIN ne USING (neighborhood) LEFT JOIN te_ USING (building_type), vc, me, mt)""", VAL_SQL))
def batch_valuation(spark, d):
    """Requests are the combinations in the held-out rows, each with its own area; neighbourhood and type enter by
    the log of their training median, less the mean of these (0 where a value was never seen)."""
    tr, te = split(spark, d)
    ne = ml.median_encoding(tr, "neighborhood", "y", "ne")
    kind = ml.median_encoding(tr, "building_type", "y", "te")
    train = ml.encode(ml.encode(tr.drop("x2"), ne, "neighborhood", "ne"), kind, "building_type", "te")
    coef = ml.ols_fit(train.withColumn("x2", F.col("ne") + F.col("te")), "ly", XS)
    reqs = te.groupBy("borough_name", "neighborhood", "building_type").agg(F.count("*").alias("n_requests"), F.avg("x1").alias("x1"))
    reqs = ml.encode(ml.encode(reqs, ne, "neighborhood", "ne"), kind, "building_type", "te").withColumn("x2", F.col("ne") + F.col("te"))
    p = ml.predict_linear(reqs, coef, XS, "lp").withColumn("value", F.expm1("lp"))
    out = p.join(mk.median_by(tr, "borough_name", "y", "med"), "borough_name").select(
        "borough_name", "neighborhood", "building_type", "n_requests", F.col("x1").alias("area"), "value",
        (F.col("value") * 0.85).alias("low"), (F.col("value") * 1.15).alias("high"),
        (F.try_divide(F.col("value") - F.col("med"), F.col("med")) * 100).alias("vs_region_median_pct"),
        fx.guarded_ratio("value", "x1").alias("per_area"))
    return finish(out)


@register("residual_histogram", with_sales("""
SELECT bin, count(*) AS n, round(lo + bin * (hi - lo) / 60, 4) AS bin_start, round(lo + (bin + 1) * (hi - lo) / 60, 4) AS bin_end,
       round(any_value(mr), 4) AS mean_residual
FROM (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((r - lo) / ((hi - lo) / 60)), 59) END AS BIGINT) AS bin, lo, hi, mr
      FROM (SELECT y - p AS r FROM pred) x, (SELECT min(y - p) AS lo, max(y - p) AS hi, avg(y - p) AS mr FROM pred) b)
GROUP BY bin, lo, hi""", ML_SQL))
def residual_histogram(spark, d):
    p = predictions(spark, d).withColumn("r", F.col("y") - F.col("p"))
    h = mk.histogram(p, "r", 60)
    return finish(attach(h, p.agg(F.avg("r").alias("mean_residual"))))
