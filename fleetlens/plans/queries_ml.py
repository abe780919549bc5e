"""Registered queries: folds, average precision, PCA selection, model comparison, LDA, resampling."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from fleetlens.ml.data import labelled_vectors, standardize, with_vector
from fleetlens.ml.folds import stratified_folds
from fleetlens.ml.metrics import average_precision, ranking_metrics, weighted_prf
from fleetlens.ml.models import compare_models, fit_lda, grid_search, lda_scores, pca_select
from fleetlens.ml.sketch import WIDTH, dot, polynomial_sketch
from fleetlens.plans import oracle as O
from fleetlens.plans.registry import register
from fleetlens.sources.tables import load

_FOLDS_SQL = """SELECT id, y, cast((row_number() OVER (PARTITION BY y ORDER BY (id * 7919 + 0) % 10007, id) - 1) % 5 AS integer) AS fold
FROM (SELECT vec_id AS id, cast(label = 0 AS integer) AS y FROM embeddings)"""


@register("stratified_folds", _FOLDS_SQL)
def q_stratified_folds(spark, sf_dir):
    """Stratified 5-fold assignment of the labelled vectors (target: label = 0)."""
    return stratified_folds(labelled_vectors(spark, sf_dir).select("id", "y"))


# stand-in score for AP: a fixed linear read-out of the embedding (first coordinate), ties kept
_AP_SQL = """WITH s AS (SELECT cast(label = 0 AS integer) AS y, round(embedding[1], 2) AS score FROM embeddings),
d AS (SELECT score, sum(y) AS pos, count(*) AS cnt FROM s GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS ctp, sum(cnt) OVER (ORDER BY score DESC) AS ctc,
  sum(pos) OVER () AS npos FROM d)
SELECT round_even(sum(pos / npos * ctp / ctc) * 10000, 0) / 10000 + 0.0e0 AS average_precision FROM c"""


@register("average_precision", _AP_SQL)
def q_average_precision(spark, sf_dir):
    """Step-wise average precision of a score (first embedding coordinate, 2 dp) for label = 0."""
    v = labelled_vectors(spark, sf_dir)
    scored = v.select("y", F.round(F.col("x")[0], 2).alias("score"))
    return average_precision(scored)


@register("pca_selection")
def q_pca_selection(spark, sf_dir):
    """PCA on standardised embeddings: first-component loadings, kept dims and explained variance."""
    return pca_select(labelled_vectors(spark, sf_dir))


def _prepared(spark, sf_dir):
    v = labelled_vectors(spark, sf_dir)
    return stratified_folds(with_vector(standardize(v)))


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    """5-fold comparison of balanced RF, boosted trees (plain / positive-weighted), cubic SVM with
    Platt scaling, balanced logistic regression and LDA: weighted F1/precision/recall, ROC-AUC, AP."""
    return compare_models(_prepared(spark, sf_dir), folds=5)


@register("lda_model")
def q_lda_model(spark, sf_dir):
    """Linear discriminant fitted on folds 1-4, scored on fold 0 (id, y, score, prediction)."""
    d = _prepared(spark, sf_dir)
    coef, b = fit_lda(d.where(F.col("fold") != 0))
    s = lda_scores(d.where(F.col("fold") == 0), coef, b)
    return s.select("id", "y", "score", (F.col("score") >= 0.5).cast("int").alias("prediction"))


@register("grid_search")
def q_grid_search(spark, sf_dir):
    """Grid search over boosted trees, resampling inside the folds, weighted F1: all 216 settings of ``models.GRID``."""
    return grid_search(_prepared(spark, sf_dir))


# ---- parts of the evaluation and of the models that SQL can express
_FIXED = "SELECT cast(label = 0 AS integer) AS y, round(embedding[1], 2) AS score, cast(embedding[1] > 0.05 AS integer) AS prediction FROM embeddings"


@register("weighted_metrics", f"""WITH s AS ({_FIXED}),
c AS (SELECT k AS cls, count(*) FILTER (y = k AND prediction = k) AS tp, count(*) FILTER (y = k) AS act, count(*) FILTER (prediction = k) AS pred, count(*) AS n
  FROM s, (VALUES (0), (1)) v(k) GROUP BY k),
m AS (SELECT act / n AS w, CASE WHEN pred > 0 THEN tp / pred ELSE 0 END AS p, CASE WHEN act > 0 THEN tp / act ELSE 0 END AS r FROM c)
SELECT {O.q4('sum(w * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END)')} AS f1, {O.q4('sum(w * p)')} AS "weightedPrecision", {O.q4('sum(w * r)')} AS "weightedRecall" FROM m""")
def q_weighted_metrics(spark, sf_dir):
    """Weighted F1, precision and recall of a fixed prediction (first embedding value above 0.05)."""
    v = labelled_vectors(spark, sf_dir)
    return weighted_prf(v.select("y", (F.col("x")[0] > 0.05).cast("int").alias("prediction")))


@register("roc_auc", f"""WITH s AS ({_FIXED}), n AS (SELECT count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q FROM s),
d AS (SELECT score, count(*) FILTER (y = 1) AS a, count(*) FILTER (y = 0) AS b FROM s GROUP BY score),
c AS (SELECT *, sum(b) OVER (ORDER BY score) - b AS below FROM d)
SELECT {O.q4('sum(a * (below + b / 2.0e0)) / any_value(p * q)')} AS roc_auc FROM c, n""")
def q_roc_auc(spark, sf_dir):
    """ROC-AUC of a fixed score (first embedding value, 2 places), ties counted half."""
    v = labelled_vectors(spark, sf_dir)
    return ranking_metrics(v.select("y", F.round(F.col("x")[0], 2).alias("score"))).select("roc_auc")


_DIMS = "v AS (SELECT vec_id AS id, cast(label = 0 AS integer) AS y, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS d FROM embeddings)"


@register("class_means", f"WITH {_DIMS} SELECT y, cast(d AS integer) AS dim, count(*) AS n, {O.q4('avg(v)')} AS mean FROM v GROUP BY y, d")
def q_class_means(spark, sf_dir):
    """Class means of every input of the discriminant."""
    x = labelled_vectors(spark, sf_dir).select("y", F.posexplode("x").alias("dim", "v"))
    return x.groupBy("y", "dim").agg(F.count("*").alias("n"), F.avg("v").alias("mean"))


@register("standardize", f"""WITH {_DIMS}, s AS (SELECT d, avg(v) AS mu, stddev_pop(v) AS sd FROM v GROUP BY d)
SELECT id, cast(d AS integer) AS dim, {O.q4('(v - mu) / CASE WHEN sd > 1e-12 THEN sd ELSE 1 END')} AS z FROM v JOIN s USING (d)""")
def q_standardize(spark, sf_dir):
    """Every labelled vector standardised per dimension (population std), long form."""
    return standardize(labelled_vectors(spark, sf_dir)).select("id", F.posexplode("z").alias("dim", "z"))


@register("feature_correlation", f"""WITH {_DIMS} SELECT cast(a.d AS integer) AS dim_a, cast(b.d AS integer) AS dim_b, {O.q4('corr(a.v, b.v)')} AS corr
FROM v a JOIN v b ON a.id = b.id AND a.d < b.d GROUP BY a.d, b.d""")
def q_feature_correlation(spark, sf_dir):
    """Pearson correlation of every pair of inputs (what PCA on standardised data decomposes)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Correlation
    v = labelled_vectors(spark, sf_dir).select(array_to_vector("x").alias("features"))
    m = Correlation.corr(v, "features").first()[0].toArray()  # width x width, whatever the rows
    rows = [(i, j, float(m[i, j])) for i in range(len(m)) for j in range(i + 1, len(m))]
    return spark.createDataFrame(rows, "dim_a int, dim_b int, corr double")


# ---- the cubic kernel of every vector with the first vector of its label, and its sketch
@register("cubic_sketch", f"""WITH r AS (SELECT label, min(vec_id) AS ref_id FROM embeddings WHERE embedding IS NOT NULL GROUP BY label)
SELECT a.vec_id, r.ref_id, {O.q4("(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) + 1) ** 3")} AS kernel, TRUE AS within
FROM embeddings a JOIN r ON a.label = r.label JOIN embeddings b ON b.vec_id = r.ref_id WHERE a.embedding IS NOT NULL""")
def q_cubic_sketch(spark, sf_dir):
    """(x . y + 1)^3 of every vector x and the first vector y of its label; ``within``: the dot product of their
    sketches is at most three standard errors away, 3 sqrt(29 / 4096) of (|x|^2 + 1)^1.5 (|y|^2 + 1)^1.5."""
    e = load(spark, sf_dir, "embeddings").where("embedding IS NOT NULL")
    e = e.select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    n = e.select(F.max(F.size("x"))).first()[0] or 0
    ref = e.groupBy("label").agg(F.min_by(F.struct("vec_id", "x"), "vec_id").alias("r"))
    ref = ref.select("label", F.col("r.vec_id").alias("ref_id"), F.col("r.x").alias("y"), polynomial_sketch("r.x", n).alias("sy"))
    d = e.join(ref, "label").withColumn("sx", polynomial_sketch("x", n))  # sketches are wider than vectors: made after the shuffle
    kernel = F.pow(dot("x", "y") + 1.0, 3.0)
    reach = 3 * math.sqrt(29 / WIDTH) * F.pow((dot("x", "x") + 1.0) * (dot("y", "y") + 1.0), 1.5)
    return d.select("vec_id", "ref_id", kernel.alias("kernel"), (F.abs(dot("sx", "sy") - kernel) <= reach).alias("within"))
