"""Registered queries: the model-scored path of each ML family, one-batch runs, neighbours and resampling.

Trained model files are not part of the data, so these keys use a fixed logistic read-out of the
standardised inputs: everything from z-score to outputs can then be computed in SQL as well.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.ml.data import labelled_vectors, standardize
from fleetlens.ml import forest
from fleetlens.ml.folds import stratified_folds
from fleetlens.ml.neighbours import exact_knn
from fleetlens.ml.resample import A, B, C, M, adasyn, smote
from fleetlens.operators.features import CMB_MODEL_INPUTS, ESP_MODEL_INPUTS
from fleetlens.operators.scoring import linear_probability
from fleetlens.operators.signal import ECS_FEATURES
from fleetlens.plans import oracle as O
from fleetlens.plans import queries_da, queries_sinks  # noqa: F401  (their oracles are reused)
from fleetlens.plans.batch import FAMILIES, run_batch
from fleetlens.plans.families import cmb_job, ecs_job, esprsp_job
from fleetlens.plans.queries_core import imp_sql
from fleetlens.plans.queries_features import _HEX, _P, CMB_CURVE, CMB_FEAT_CTES, ESP_CURVE, ESP_FEAT_CTES
from fleetlens.plans.queries_signal import _DATE, _ECS_BASE, _ECS_SCORED, _z
from fleetlens.plans.registry import ORACLE, QUERIES, register
from fleetlens.sources.family import Telemetry

INTERCEPT = -0.3


def coefficients(inputs) -> list[float]:
    """Fixed weights of the read-out, between -0.5 and 0.5."""
    return [((i * 37) % 11 - 5) / 10.0 for i in range(len(inputs))]


def _read_out(inputs) -> str:
    line = " + ".join(f"{w}e0 * coalesce({c}, 0)" for c, w in zip(inputs, coefficients(inputs)))
    return f"1.0e0 / (1.0e0 + exp(-({INTERCEPT}e0 + {line})))"


def _scored_sql(ctes: str, frm: str, keys: str, inputs, where: str) -> str:
    """``ctes`` plus CTE ``modelled``: rows of ``frm`` with probability p from standardised inputs."""
    z = ", ".join(_z(c) for c in inputs)
    return (f"{ctes},\nstd AS (SELECT {keys}, {z} FROM {frm} WHERE {where} WINDOW s AS (PARTITION BY CompanyID, batch_start)),\n"
            f"modelled AS (SELECT {keys}, {_read_out(inputs)} AS p FROM std)")


_IDS = "CompanyID, VehicleID, TripEventID, TripEventGuid, DriverID, CreatedDate"
_ECS_MODEL = _scored_sql(_ECS_BASE, "feats", _IDS, ECS_FEATURES, "TRUE") + _ECS_SCORED.replace(
    "SELECT *, cast((n * 37) % 101 AS double) / 100.0 AS p FROM feats", "SELECT * FROM modelled")


@register("ecs_model_scores", _ECS_MODEL + imp_sql("ecs_scored", "score / 100", created=_DATE))
def q_ecs_model_scores(spark, sf_dir):
    """Curve-speed importance from standardised inputs and a fixed logistic model."""
    return ecs_job(Telemetry.derive(spark, sf_dir), linear_probability(ECS_FEATURES, coefficients(ECS_FEATURES), INTERCEPT))[0]


def _family_sql(ctes, curve: str, required: str, inputs, frm: str) -> str:
    scored = curve.replace(f"SELECT *, {_P} AS p, {_HEX} AS code FROM feat WHERE {required} IS NOT NULL",
                           f"SELECT *, {_HEX} AS code FROM modelled")
    base = _scored_sql(O.with_ctes(*ctes).rstrip("\n"), "feat", _IDS, inputs, f"{required} IS NOT NULL")
    return base + ",\n" + scored + "\n" + imp_sql(frm, "score / 100")


@register("cmb_model_scores", _family_sql(CMB_FEAT_CTES, CMB_CURVE, "AbsDiffBrakingForcestd", CMB_MODEL_INPUTS, "cmbs"))
def q_cmb_model_scores(spark, sf_dir):
    """Collision importance from standardised inputs and a fixed logistic model."""
    return cmb_job(Telemetry.derive(spark, sf_dir), linear_probability(CMB_MODEL_INPUTS, coefficients(CMB_MODEL_INPUTS), INTERCEPT))[0]


@register("esprsp_model_scores", _family_sql(ESP_FEAT_CTES, ESP_CURVE, "DeltaSpeedBeforeZeromax", ESP_MODEL_INPUTS, "esps"))
def q_esprsp_model_scores(spark, sf_dir):
    """Stability-brake importance from standardised inputs and a fixed logistic model."""
    return esprsp_job(Telemetry.derive(spark, sf_dir), linear_probability(ESP_MODEL_INPUTS, coefficients(ESP_MODEL_INPUTS), INTERCEPT))[0]


# ---- one batch: the second week of the data, every family
_BEGIN = "(SELECT date_trunc('day', min(CreatedDate)) + INTERVAL 7 DAY FROM trip_event)"
_BATCH = O.with_ctes(O.TRIP_EVENT) + " UNION ALL ".join(
    f"SELECT '{name}' AS family, q.CompanyID, q.VehicleID, q.TripEventID, q.TripEventGuid, q.importancescore "
    f"FROM ({ORACLE[key]}) q JOIN trip_event t ON q.CompanyID = t.CompanyID AND q.TripEventID = t.TripEventID "
    f"WHERE t.CreatedDate >= {_BEGIN} AND t.CreatedDate < {_BEGIN} + INTERVAL 7 DAY"
    for name, key in zip(FAMILIES, ("overspeed_scores", "nonsevere_scores", "da_scores", "ecs_scores", "cmb_curve", "esprsp_curve")))


@register("batch_run_scores", _BATCH)
def q_batch_run_scores(spark, sf_dir):
    """All families scored for one half-open CreatedDate batch (the second week of the data)."""
    t = Telemetry.derive(spark, sf_dir)
    begin = t.trips.agg(F.date_trunc("day", F.min("CreatedDate")) + F.expr("INTERVAL 7 DAYS")).first()[0]
    import datetime as dt
    parts = run_batch(t, begin, begin + dt.timedelta(days=7))
    out = None
    for name, (imp, _) in parts.items():
        p = imp.select(F.lit(name).alias("family"), "CompanyID", "VehicleID", "TripEventID", "TripEventGuid", "importancescore")
        out = p if out is None else out.unionByName(p)
    return out


# ---- neighbours and resampling on the training folds (fold <> 0) of the labelled vectors
_TRAIN = """WITH v AS (SELECT vec_id AS id, cast(label = 0 AS integer) AS y, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
st AS (SELECT d, avg(v) AS mu, stddev_pop(v) AS sd FROM v GROUP BY d),
z AS (SELECT id, y, list((v - mu) / CASE WHEN sd > 1e-12 THEN sd ELSE 1 END ORDER BY d) AS x FROM v JOIN st USING (d) GROUP BY id, y),
f AS (SELECT id, (row_number() OVER (PARTITION BY y ORDER BY (id * 7919 + 0) % 10007, id) - 1) % 5 AS fold FROM z),
tr AS (SELECT z.* FROM z JOIN f USING (id) WHERE fold <> 0),
mi AS (SELECT * FROM tr WHERE y = 1),
nn AS (SELECT * FROM (SELECT a.id, b.id AS nn_id, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) AS rank
  FROM mi a JOIN mi b ON a.id <> b.id) WHERE rank <= 5),
want AS (SELECT greatest(count(*) FILTER (y = 0) - count(*) FILTER (y = 1), 0) AS g, count(*) FILTER (y = 1) AS n FROM tr)"""


def _train(spark, sf_dir):
    d = stratified_folds(standardize(labelled_vectors(spark, sf_dir)))
    return d.where(F.col("fold") != 0).select("id", "y", F.col("z").alias("x"))


@register("knn_neighbours", _TRAIN + " SELECT id, nn_id, rank FROM nn")
def q_knn_neighbours(spark, sf_dir):
    """The five nearest minority neighbours of every minority vector of the training folds."""
    mi = _train(spark, sf_dir).where(F.col("y") == 1)
    return exact_knn(mi, mi, 5).select("id", "nn_id", "rank")


def _draw(j: str, seed: int) -> str:
    return f"(((per.id * {A} + {j} * {B} + {seed * C}) % {M})::DOUBLE / {float(M)})"


def _synthetic_sql(per: str, seed: int) -> str:
    return (f"{_TRAIN}, {per}, found AS (SELECT id, max(rank) AS k FROM nn GROUP BY id),\n"
            f"dr AS (SELECT per.id, j, cast(floor({_draw('j', seed)} * k) AS bigint) + 1 AS rank, {_draw('j', seed + 1)} AS gap\n"
            f"  FROM (SELECT id, unnest(range(n_syn)) AS j FROM per WHERE n_syn > 0) per JOIN found USING (id))\n"
            "SELECT dr.id AS src_id, nn.nn_id, dr.j, " + O.q4("gap") + " AS gap, " + O.q4("a.x[1] + gap * (b.x[1] - a.x[1])") + " AS x_first, "
            + O.q4("list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] + gap * (b.x[i] - a.x[i])))") + " AS x_sum\n"
            "FROM dr JOIN nn ON dr.id = nn.id AND dr.rank = nn.rank JOIN mi a ON a.id = dr.id JOIN mi b ON b.id = nn.nn_id")


def _summary(syn):
    total = F.aggregate("x", F.lit(0.0), lambda s, v: s + v)
    return syn.select("src_id", "nn_id", F.col("j").cast("long").alias("j"), "gap", F.col("x")[0].alias("x_first"), total.alias("x_sum"))


@register("smote", _synthetic_sql(f"""per AS (SELECT id, cast(g // n + CASE WHEN row_number() OVER (ORDER BY (id * {A} + {5 * C}) % {M}, id)
  <= g % n THEN 1 ELSE 0 END AS bigint) AS n_syn FROM mi, want)""", 3))
def q_smote(spark, sf_dir):
    """SMOTE rows for the training folds: source, neighbour, draw, and the new vector's first value and sum."""
    return _summary(smote(_train(spark, sf_dir)))


@register("adasyn", _synthetic_sql("""al AS (SELECT * FROM (SELECT a.id, b.y, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) AS r
  FROM mi a JOIN tr b ON a.id <> b.id) WHERE r <= 5),
hard AS (SELECT id, count(*) FILTER (y = 0) AS h FROM al GROUP BY id),
per AS (SELECT id, cast(round(h * g::DOUBLE / greatest((SELECT sum(h) FROM hard), 1)::DOUBLE) AS bigint) AS n_syn FROM hard, want)""", 5))
def q_adasyn(spark, sf_dir):
    """ADASYN rows for the training folds: source, neighbour, draw, and the new vector's first value and sum."""
    return _summary(adasyn(_train(spark, sf_dir)))


# ---- a forest grown on the training folds and kept as a table, and the scores that it gives to every vector
def _level_sql(level: int) -> str:
    """Counts, the best cut of each node, and the nodes that rows reach after this level."""
    return f""",
h{level} AS (SELECT t, node, d, bin, sum(w * y) AS a, sum(w * (1 - y)) AS b FROM at{level} JOIN wt USING (id, t) JOIN bn USING (id)
  WHERE node >= {2 ** level} AND (d * (2 * (t // {forest.SLICES}) + 1) + t) % {forest.SLICES} = 0 GROUP BY t, node, d, bin),
c{level} AS (SELECT t, node, d, bin, sum(a) OVER r AS al, sum(b) OVER r AS bl, sum(a) OVER (PARTITION BY t, node, d) AS tot_a,
  sum(b) OVER (PARTITION BY t, node, d) AS tot_b FROM h{level} WINDOW r AS (PARTITION BY t, node, d ORDER BY bin)),
m{level} AS (SELECT t, node, d, bin, al::DOUBLE * n0 AS p, bl::DOUBLE * n1 AS q, (tot_a - al)::DOUBLE * n0 AS r, (tot_b - bl)::DOUBLE * n1 AS s
  FROM c{level}, cls WHERE al + bl >= {forest.MIN_ROWS} AND tot_a + tot_b - al - bl >= {forest.MIN_ROWS} AND tot_a > 0 AND tot_b > 0),
s{level} AS (SELECT t, node, d, bin AS cut FROM m{level}
  QUALIFY row_number() OVER (PARTITION BY t, node ORDER BY (p * p + q * q) / (p + q) + (r * r + s * s) / (r + s) DESC, d, bin) = 1),
at{level + 1} AS (SELECT id, t, CASE WHEN s.d IS NULL THEN a.node WHEN bn.bin <= s.cut THEN 2 * a.node ELSE 2 * a.node + 1 END AS node
  FROM at{level} a LEFT JOIN s{level} s USING (t, node) LEFT JOIN bn USING (id, d))"""


_FOREST = f"""WITH v AS (SELECT vec_id AS id, cast(label = 0 AS integer) AS y, embedding FROM embeddings),
f AS (SELECT id, y, (row_number() OVER (PARTITION BY y ORDER BY (id * 7919 + 0) % 10007, id) - 1) % 5 AS fold FROM v),
lv AS (SELECT id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS d FROM v),
rg AS (SELECT d, min(x) AS lo, max(x) AS hi FROM lv JOIN f USING (id) WHERE fold <> 0 GROUP BY d),
bn AS (SELECT id, d, CASE WHEN hi > lo THEN least(greatest(floor((x - lo) * {forest.BINS} / (hi - lo)), 0), {forest.BINS - 1}) ELSE 0 END::BIGINT AS bin
  FROM lv JOIN rg USING (d)),
cls AS (SELECT (count(*) FILTER (y = 0))::DOUBLE AS n0, (count(*) FILTER (y = 1))::DOUBLE AS n1 FROM f WHERE fold <> 0),
at0 AS (SELECT id, t, 1 AS node FROM f, range({forest.TREES}) r(t)),
hs AS (SELECT id, t, y, (id * {forest.A} + t * {forest.B}) % {forest.M} AS h FROM f, range({forest.TREES}) r(t) WHERE fold <> 0),
wt AS (SELECT id, t, y, CASE WHEN h < 7360 THEN 1 WHEN h < 9200 THEN 2 ELSE 3 END AS w FROM hs WHERE h >= 3680)""" + "".join(
    _level_sql(level) for level in range(forest.DEPTH)) + f""",
lf AS (SELECT t, node, sum(w * y) AS a, sum(w * (1 - y)) AS b FROM at{forest.DEPTH} JOIN wt USING (id, t) GROUP BY t, node),
leaf AS (SELECT t, node, (a + b)::BIGINT AS n, floor(a::DOUBLE * n0 / (a::DOUBLE * n0 + b::DOUBLE * n1) * {forest.MICRO} + 0.5e0)::BIGINT AS micros FROM lf, cls)
"""
_CUTS = " UNION ALL ".join(f"SELECT t, node, d, cut FROM s{level}" for level in range(forest.DEPTH))


def _forest(spark, sf_dir):
    rows = stratified_folds(labelled_vectors(spark, sf_dir))
    return rows, forest.fit_forest(rows.where(F.col("fold") != 0))


@register("forest_model", _FOREST + f"""SELECT t::INTEGER AS tree, node::INTEGER AS node, d::INTEGER AS dim, cut::INTEGER AS cut,
  {O.q4("lo")} AS lo, {O.q4("hi")} AS hi, NULL::BIGINT AS rows, NULL::BIGINT AS micros FROM ({_CUTS}) JOIN rg USING (d)
  UNION ALL SELECT t, node, NULL, NULL, NULL, NULL, n, micros FROM leaf""")
def q_forest_model(spark, sf_dir):
    """The balanced random forest of the training folds: one row per cut and leaf."""
    return _forest(spark, sf_dir)[1]


@register("forest_model_scores", _FOREST + f"""SELECT id, any_value(fold)::INTEGER AS fold, any_value(y)::INTEGER AS y,
  {O.q4(f"sum(coalesce(micros, 0))::DOUBLE / {float(forest.TREES * forest.MICRO)}e0")} AS probability
  FROM at{forest.DEPTH} JOIN f USING (id) LEFT JOIN leaf USING (t, node) GROUP BY id""")
def q_forest_model_scores(spark, sf_dir):
    """Probability of the trained forest for every vector; fold 0 was held out."""
    rows, model = _forest(spark, sf_dir)
    return rows.select("id", "fold", "y", forest.forest_probability(model, "x").alias("probability"))
