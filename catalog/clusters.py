"""Clustering: exact measures on the labelled embeddings, models on the customer table."""

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from catalog.base import W, query, r, rounded, wide
from shopsight.cluster import metrics as M
from shopsight.cluster.density import dbscan, k_distances, suggest_eps
from shopsight.cluster.kmeans import assign_to_centres, fit_many
from shopsight.cluster.models import (
    Mixture,
    best_k,
    fit_gmm,
    fit_kmeans,
    fit_mixtures,
    gap_statistic,
    gmm_labels,
    hierarchical,
    linkage_table,
    sweep_gmm,
    sweep_kmeans,
)
from shopsight.cluster.prepare import CLUSTER_FEATURES, LOG_FEATURES, fit_cluster_prep, scaled_names
from shopsight.cluster.segments import anova_f, business_labels, chi_square, score_customers
from shopsight.operators.aggregates import cluster_summary, customer_behaviour
from shopsight.plans.segmentation import load_segmentation, save_segmentation, segment_customers
from shopsight.session import scratch_uri
from shopsight.sources import bindings

_SCALED = scaled_names(CLUSTER_FEATURES, LOG_FEATURES)


def _customers(spark, sf):
    return customer_behaviour(wide(spark, sf)).persist()


def _vectors(spark, sf):
    customers = _customers(spark, sf)
    prepared = fit_cluster_prep(customers).transform(customers)
    return prepared.select(F.col("customer_unique_id").alias("id"), "features").persist()


def _embeddings(spark, sf):
    return bindings.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.col("label").alias("cluster"),
    )


@query(
    "e7_cluster_preparation",
    W
    + ", p AS (SELECT customer_unique_id, recency, ln(1 + frequency) AS frequency_log, ln(1 + monetary) AS monetary_log, "
    + "avg_review_score, avg_delivery_days, coalesce(late_delivery_rate, (SELECT quantile_cont(late_delivery_rate, 0.5) FROM cust)) "
    + "AS late_delivery_rate FROM cust), x AS (SELECT customer_unique_id, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}_z" for c in [n[:-2] for n in _SCALED])
    + " FROM p) SELECT customer_unique_id, "
    + r(*_SCALED)
    + " FROM x",
)
def preparation(spark, sf):
    customers = _customers(spark, sf)
    return rounded(fit_cluster_prep(customers).transform(customers).select("customer_unique_id", *_SCALED))


@query("m1_kmeans")
def kmeans(spark, sf):
    vectors = _vectors(spark, sf)
    return fit_kmeans(vectors, 4).transform(vectors).groupBy("prediction").agg(F.count("*").alias("n"))


@query("m1_kmeans_assignment", W + " SELECT count(*) AS customers, 4 AS clusters, 0 AS misplaced FROM cust")
def kmeans_assignment(spark, sf):
    """Every customer is in the cluster of the nearest fitted centre, and no cluster is empty."""
    vectors = _vectors(spark, sf)
    model = fit_kmeans(vectors, 4)
    both = assign_to_centres(model.transform(vectors), [[float(v) for v in c] for c in model.clusterCenters()])
    return both.agg(
        F.count("*").alias("customers"),
        F.count_distinct("prediction").cast("int").alias("clusters"),
        F.count_if(F.col("prediction") != F.col("cluster")).cast("int").alias("misplaced"),
    )


_CENTRES = [[-1.0] * 6, [0.0] * 6, [1.0] * 6]
_DIST = " + ".join(f"pow(z.{n} - ({{c}}), 2)" for n in _SCALED)


@query(
    "m1_nearest_centre",
    W
    + ", p AS (SELECT customer_unique_id, recency, ln(1 + frequency) AS frequency_log, ln(1 + monetary) AS monetary_log, "
    + "avg_review_score, avg_delivery_days, late_delivery_rate FROM cust), z AS (SELECT customer_unique_id, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}_z" for c in [n[:-2] for n in _SCALED])
    + " FROM p), d AS (SELECT customer_unique_id, "
    + ", ".join(f"sqrt({_DIST.format(c=c[0])}) AS d{i}" for i, c in enumerate(_CENTRES))
    + """ FROM z) SELECT customer_unique_id AS id, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster,
    round(least(d0, d1, d2), 4) AS distance FROM d""",
)
def nearest_centre(spark, sf):
    return rounded(assign_to_centres(_vectors(spark, sf), _CENTRES).select("id", "cluster", "distance"))


@query("m2_kmeans_sweep")
def sweep(spark, sf):
    return rounded(sweep_kmeans(_vectors(spark, sf), "id"))


@query("m2_sweep_fixed_points", W + " SELECT k, (SELECT count(*) FROM cust) AS customers, 0 AS empty, 0 AS moved, true AS cost_agrees FROM (SELECT unnest(range(2, 11))::INT AS k)")
def sweep_fixed_points(spark, sf):
    """For each k of the sweep: no cluster is empty, every centre is the mean of its customers, and the cost is that of the assignment."""
    vectors = _vectors(spark, sf)
    x = vector_to_array("features")
    rows = []
    for k, model in fit_many(vectors, range(2, 11)).items():
        found = assign_to_centres(vectors, model.centres.tolist())
        dims = model.centres.shape[1]
        means = found.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.col("distance") * F.col("distance")).alias("cost"), F.array(*[F.avg(x[i]) for i in range(dims)]).alias("mean")).collect()
        away = sum(float(np.abs(np.array(m["mean"]) - model.centres[m["cluster"]]).max()) > 1e-3 for m in means)
        cost = sum(m["cost"] for m in means)
        rows.append((k, sum(m["n"] for m in means), k - len(means), int(away), abs(cost - model.cost) <= 1e-6 * cost))
    return spark.createDataFrame(rows, "k int, customers long, empty int, moved int, cost_agrees boolean")


@query(
    "w5_best_k",
    """WITH e AS (SELECT k, vec_id AS id, embedding::DOUBLE[] AS x, CASE k WHEN 2 THEN label % 2 WHEN 3 THEN label ELSE vec_id % 4 END AS label
      FROM embeddings, (SELECT unnest([2, 3, 4]) AS k)),
    pair AS (SELECT a.k, a.id, a.label, b.label AS other, sum(pow(list_distance(a.x, b.x), 2)) AS s, count(*) AS c
      FROM e a JOIN e b ON a.k = b.k GROUP BY a.k, a.id, a.label, b.label),
    sil AS (SELECT k, id, max(CASE WHEN other = label THEN s / (c - 1) END) AS a, min(CASE WHEN other <> label THEN s / c END) AS b
      FROM pair GROUP BY k, id)
    SELECT arg_max(k, s) AS k FROM (SELECT k, avg((b - a) / greatest(a, b)) AS s FROM sil GROUP BY k)""",
)
def pick_k(spark, sf):
    """The argmax over a sweep: three labellings of the embeddings."""
    base = _embeddings(spark, sf)
    rows = []
    for k, label in ((2, F.col("cluster") % 2), (3, F.col("cluster")), (4, F.pmod(F.col("id"), F.lit(4)))):
        rows.append((k, M.squared_silhouette(base.withColumn("cluster", label.cast("int")))))
    found = best_k(spark.createDataFrame(rows, "k int, silhouette double"))
    return spark.createDataFrame([(found,)], "k int")


_E = "WITH e AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS x FROM embeddings)"
_KD = """, kd AS (SELECT id, d FROM (SELECT a.id, list_distance(a.x, b.x) AS d, row_number() OVER (PARTITION BY a.id
  ORDER BY list_distance(a.x, b.x)) AS k FROM e a, e b) WHERE k = 5)"""


@query("m3_k_distance", _E + _KD + " SELECT id, round(d, 4) AS k_distance FROM kd")
def k_distance(spark, sf):
    return rounded(k_distances(_embeddings(spark, sf), "id", 5))


@query(
    "m3_suggested_eps",
    _E + _KD
    + """ SELECT round(quantile_cont(d, 0.9), 4) AS p90, round(quantile_cont(d, 0.95), 4) AS p95,
      round(quantile_cont(d, 0.99), 4) AS p99 FROM kd""",
)
def eps(spark, sf):
    found = suggest_eps(k_distances(_embeddings(spark, sf), "id", 5))
    return rounded(spark.createDataFrame([tuple(found.values())], "p90 double, p95 double, p99 double"))


@query(
    "m4_dbscan",
    "WITH RECURSIVE " + _E[5:] + _KD
    + """, eps AS (SELECT quantile_cont(d, 0.5) AS eps FROM kd),
    near AS (SELECT a.id AS a, b.id AS b FROM e a, e b, eps WHERE list_distance(a.x, b.x) <= eps),
    core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 5),
    links AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    reach AS (SELECT id, id AS root FROM core UNION SELECT l.b, q.root FROM reach q JOIN links l ON q.id = l.a WHERE q.root < l.b),
    comp AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
    member AS (SELECT id, root FROM comp UNION ALL SELECT near.a, min(root) FROM near JOIN comp ON near.b = comp.id
      WHERE near.a NOT IN (SELECT id FROM core) GROUP BY near.a),
    numbers AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS n FROM (SELECT DISTINCT root FROM member))
    SELECT e.id, CAST(coalesce(n, -1) AS INT) AS cluster FROM e LEFT JOIN member ON e.id = member.id LEFT JOIN numbers USING (root)""",
)
def density(spark, sf):
    vectors = _embeddings(spark, sf).persist()
    eps = suggest_eps(k_distances(vectors, "id", 5), [0.5])[0.5]
    return dbscan(vectors, "id", eps, 5)


@query("m4_dbscan_customers")
def density_customers(spark, sf):
    vectors = _vectors(spark, sf)
    eps = suggest_eps(k_distances(vectors, "id", 5))[0.95]
    return dbscan(vectors, "id", eps, 10).groupBy("cluster").agg(F.count("*").alias("n"))


@query("m5_hierarchical")
def ward(spark, sf):
    return hierarchical(_vectors(spark, sf), "id", 4).groupBy("cluster", "method", "micro_clusters").agg(F.count("*").alias("n"))


@query("m5_hierarchical_rows", W + " SELECT count(*) AS customers, 4 AS clusters FROM cust")
def ward_rows(spark, sf):
    """Every customer has one of the clusters asked for."""
    labelled = hierarchical(_vectors(spark, sf), "id", 4)
    return labelled.agg(F.count("cluster").alias("customers"), F.count_distinct("cluster").cast("int").alias("clusters"))


@query("m5_linkage")
def linkage(spark, sf):
    return rounded(linkage_table(_embeddings(spark, sf), "id"))


@query("m6_mixture")
def mixture(spark, sf):
    vectors = _vectors(spark, sf)
    out = gmm_labels(fit_gmm(vectors, 3), vectors)
    return rounded(out.groupBy("cluster").agg(F.count("*").alias("n"), F.avg("confidence").alias("confidence")))


@query("m6_mixture_rows", W + " SELECT count(*) AS customers, 3 AS clusters, 0 AS unsure, true AS likelier FROM cust")
def mixture_rows(spark, sf):
    """Every customer has one of three components with at least a third of the posterior; one component explains less."""
    vectors = _vectors(spark, sf)
    models = fit_mixtures(vectors, [1, 3])
    return gmm_labels(models[3], vectors).agg(
        F.count("*").alias("customers"),
        F.count_distinct("cluster").cast("int").alias("clusters"),
        F.count_if(~F.col("confidence").between(1 / 3, 1 + 1e-9)).cast("int").alias("unsure"),
        F.lit(models[3].log_likelihood > models[1].log_likelihood).alias("likelier"),
    )


_GIVEN = [(0.5, -0.5, 1.0), (0.3, 0.5, 2.0), (0.2, 1.5, 0.5)]  # weight, every mean, every variance
_LOGS = [f"ln({w}) - 3 * ln({v}) - ({_DIST.format(c=m)}) / {2 * v}" for w, m, v in _GIVEN]


@query(
    "m6_mixture_posterior",
    W
    + ", p AS (SELECT customer_unique_id, recency, ln(1 + frequency) AS frequency_log, ln(1 + monetary) AS monetary_log, "
    + "avg_review_score, avg_delivery_days, late_delivery_rate FROM cust), z AS (SELECT customer_unique_id, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}_z" for c in [n[:-2] for n in _SCALED])
    + " FROM p), l AS (SELECT customer_unique_id, "
    + ", ".join(f"{log} AS l{i}" for i, log in enumerate(_LOGS))
    + """ FROM z) SELECT customer_unique_id AS id, CASE WHEN l0 >= l1 AND l0 >= l2 THEN 0 WHEN l1 >= l2 THEN 1 ELSE 2 END AS cluster,
    round(1 / (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2)) + exp(l2 - greatest(l0, l1, l2))), 4) AS confidence FROM l""",
)
def mixture_posterior(spark, sf):
    """Labels and probabilities under a stated mixture."""
    dims = len(_SCALED)
    given = Mixture(
        np.array([w for w, _, _ in _GIVEN]), np.array([[m] * dims for _, m, _ in _GIVEN]), np.array([v * np.eye(dims) for _, _, v in _GIVEN])
    )
    return rounded(gmm_labels(given, _vectors(spark, sf)).select("id", "cluster", "confidence"))


@query("m6_mixture_sweep")
def mixture_sweep(spark, sf):
    return rounded(sweep_gmm(_vectors(spark, sf)), 2)


_SILHOUETTE = """, pair AS (SELECT a.id, a.label, b.label AS other, sum({d}) AS s, count(*) AS c
  FROM e a, e b GROUP BY a.id, a.label, b.label),
sil AS (SELECT id, label, max(CASE WHEN other = label THEN s / (c - {own}) END) AS a, min(CASE WHEN other <> label THEN s / c END) AS b
  FROM pair GROUP BY id, label)
"""
_EXACT = _SILHOUETTE.format(d="list_distance(a.x, b.x)", own=1)


@query(
    "m7_silhouette",
    _E + _EXACT + """ SELECT id, label AS cluster, round(a, 4) AS a, round(b, 4) AS b,
      round((b - a) / greatest(a, b), 4) AS silhouette FROM sil""",
)
def silhouette(spark, sf):
    return rounded(M.silhouette_samples(_embeddings(spark, sf), "id"))


@query(
    "m8_squared_silhouette",
    _E + _SILHOUETTE.format(d="pow(list_distance(a.x, b.x), 2)", own=1)
    + " SELECT round(avg((b - a) / greatest(a, b)), 4) AS silhouette FROM sil",
)
def squared_silhouette(spark, sf):
    value = M.squared_silhouette(_embeddings(spark, sf))
    return rounded(spark.createDataFrame([(value,)], "silhouette double"))


_CENTROIDS = """, cell AS (SELECT id, label, unnest(x) AS v, generate_subscripts(x, 1) AS axis FROM e),
mid AS (SELECT label, axis, avg(v) AS m, count(*) AS c FROM cell GROUP BY label, axis),
away AS (SELECT id, cell.label, sqrt(sum(pow(v - m, 2))) AS d FROM cell JOIN mid USING (label, axis) GROUP BY id, cell.label),
spread AS (SELECT label, avg(d) AS s, sum(d * d) AS w, count(*) AS c FROM away GROUP BY label),
gap AS (SELECT a.label AS i, b.label AS j, sqrt(sum(pow(a.m - b.m, 2))) AS d FROM mid a JOIN mid b ON a.axis = b.axis AND a.label <> b.label
  GROUP BY a.label, b.label),
db AS (SELECT avg(worst) AS db FROM (SELECT i, max((p.s + q.s) / d) AS worst FROM gap JOIN spread p ON p.label = i
  JOIN spread q ON q.label = j GROUP BY i)),
whole AS (SELECT axis, avg(v) AS g FROM cell GROUP BY axis),
bt AS (SELECT sum(c * pow(m - g, 2)) AS b FROM mid JOIN whole USING (axis)),
ch AS (SELECT any_value(b) * (sum(c) - count(*)) / (sum(w) * (count(*) - 1)) AS ch FROM spread, bt)
"""


@query("m9_davies_bouldin", _E + _CENTROIDS + " SELECT round(db, 4) AS davies_bouldin FROM db")
def davies_bouldin(spark, sf):
    value = M.davies_bouldin(M.centroid_table(_embeddings(spark, sf)))
    return rounded(spark.createDataFrame([(value,)], "davies_bouldin double"))


@query("m10_calinski_harabasz", _E + _CENTROIDS + " SELECT round(ch, 4) AS calinski_harabasz FROM ch")
def calinski_harabasz(spark, sf):
    value = M.calinski_harabasz(M.centroid_table(_embeddings(spark, sf)))
    return rounded(spark.createDataFrame([(value,)], "calinski_harabasz double"))


_NOISY = "WITH e AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS x FROM embeddings WHERE label <> 0)"


@query(
    "m11_evaluate",
    _NOISY + _EXACT + _CENTROIDS
    + """ SELECT 'classes' AS name, (SELECT count(DISTINCT label) FROM e) AS n_clusters,
      (SELECT count(*) FROM embeddings WHERE label = 0) AS n_noise,
      round((SELECT avg((b - a) / greatest(a, b)) FROM sil), 4) AS silhouette,
      round(db, 4) AS davies_bouldin, round(ch, 4) AS calinski_harabasz, NULL AS error, 'exact' AS measure FROM db, ch""",
)
def evaluate(spark, sf):
    noisy = _embeddings(spark, sf).withColumn("cluster", F.when(F.col("cluster") == 0, -1).otherwise(F.col("cluster")))
    return rounded(M.evaluate_labels(noisy, "classes", "id", silhouette="exact"))


@query(
    "m12_compare_methods",
    _E + _EXACT + _CENTROIDS
    + """ SELECT 'classes' AS name, (SELECT count(DISTINCT label) FROM e) AS n_clusters, 0::BIGINT AS n_noise,
      round((SELECT avg((b - a) / greatest(a, b)) FROM sil), 4) AS silhouette,
      round(db, 4) AS davies_bouldin, round(ch, 4) AS calinski_harabasz, NULL AS error, 'exact' AS measure FROM db, ch
    UNION ALL SELECT 'one', 1, 0, NULL, NULL, NULL, 'Less than 2 clusters', 'exact'
    UNION ALL SELECT 'noise', 0, (SELECT count(*) FROM e), NULL, NULL, NULL, 'Less than 2 clusters', 'exact'""",
)
def compare(spark, sf):
    df = _embeddings(spark, sf).withColumns({"same": F.lit(5), "none": F.lit(-1)}).persist()
    return rounded(M.compare_methods(df, {"classes": "cluster", "one": "same", "noise": "none"}, "id", silhouette="exact"))


_SUMMARY = ["recency", "frequency", "monetary", "avg_review_score"]


@query(
    "m13_business_labels",
    W
    + ", k AS (SELECT *, CAST(total_items % 5 AS INT) AS cluster_id FROM cust), s AS (SELECT cluster_id, "
    + ", ".join(f"round(avg({c}), 2) AS {c}" for c in _SUMMARY)
    + " FROM k GROUP BY cluster_id), n AS (SELECT cluster_id, "
    + ", ".join(
        f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) ELSE {c} END AS {c}"
        for c in _SUMMARY
    )
    + """ FROM s), b AS (SELECT cluster_id, CASE
      WHEN recency < 0.4 AND (monetary > 0.5 OR frequency > 0.5) THEN CASE WHEN avg_review_score > 0.5 THEN 'champions' ELSE 'needs_attention' END
      WHEN recency > 0.6 THEN 'at_risk' WHEN monetary > 0.6 THEN 'big_spenders' ELSE 'potential_loyalists' END AS l FROM n)
    SELECT cluster_id, CASE WHEN row_number() OVER (PARTITION BY l ORDER BY cluster_id) = 1 THEN l ELSE l || '_' || cluster_id END
      AS customer_segment FROM b""",
)
def labels(spark, sf):
    customers = _customers(spark, sf).withColumn("cluster_id", (F.col("total_items") % 5).cast("int"))
    summary = cluster_summary(customers, "cluster_id", _SUMMARY)
    return business_labels(summary, frequency="frequency", monetary="monetary")


@query("m14_segmentation")
def segmentation(spark, sf):
    result = segment_customers(
        _customers(spark, sf), k=4
    )
    return rounded(result.comparison)


@query("a8_segmentation_artifacts")
def artifacts(spark, sf):
    """Save a segmentation, load its fitted stages, score with them: sizes must agree with the saved labels."""
    customers = _customers(spark, sf)
    result = segment_customers(customers)
    uri = scratch_uri(spark, "segments")
    save_segmentation(result, uri)
    scored = score_customers(customers, *load_segmentation(uri)).select("customer_unique_id", "cluster_id")
    saved = spark.read.parquet(f"{uri}/customers").select("customer_unique_id", F.col("cluster_id").alias("saved"), "customer_segment")
    return scored.join(saved, "customer_unique_id").groupBy("customer_segment").agg(
        F.count("*").alias("n"), F.count_if(F.col("saved") == F.col("cluster_id")).alias("agree")
    )


@query("m15_score_customers")
def score(spark, sf):
    customers = _customers(spark, sf)
    train = customers.where(F.col("recency") > 100)
    prep = fit_cluster_prep(train)
    model = fit_kmeans(prep.transform(train).select("features").persist(), 3)
    return score_customers(customers, prep, model).select("customer_unique_id", "cluster_id")


_TESTED = ["recency", "monetary", "avg_review_score"]


@query(
    "m16_anova",
    W
    + ", k AS (SELECT *, total_items % 5 AS g FROM cust) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(CAST(b / (k - 1) / (w / (n - k)) AS DOUBLE), 4) AS f_statistic, k - 1 AS df_between,
        CAST(n - k AS BIGINT) AS df_within FROM (SELECT sum(c * pow(m - (SELECT avg({c}) FROM k), 2)) AS b, sum(v * c) AS w, sum(c) AS n, count(*) AS k
        FROM (SELECT g, avg({c}) AS m, var_pop({c}) AS v, count(*) AS c FROM k GROUP BY g))"""
        for c in _TESTED
    ),
)
def anova(spark, sf):
    customers = _customers(spark, sf).withColumn("cluster_id", (F.col("total_items") % 5).cast("int"))
    return rounded(anova_f(customers, "cluster_id", _TESTED))


@query(
    "m16_chi_square",
    """WITH t AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS n FROM orders GROUP BY ALL),
    x AS (SELECT a, sum(n) AS s FROM t GROUP BY a), y AS (SELECT b, sum(n) AS s FROM t GROUP BY b)
    SELECT 'o_orderpriority' AS feature, round(CAST(sum(pow(coalesce(n, 0) - x.s * y.s / (SELECT sum(n) FROM t), 2)
      / (x.s * y.s / (SELECT sum(n) FROM t))) AS DOUBLE), 4) AS statistic,
      CAST((count(DISTINCT x.a) - 1) * (count(DISTINCT y.b) - 1) AS INT) AS "degreesOfFreedom"
    FROM x CROSS JOIN y LEFT JOIN t ON t.a = x.a AND t.b = y.b""",
)
def chi(spark, sf):
    orders = bindings.table(spark, sf, "orders").withColumn("g", F.ascii("o_orderstatus").cast("double"))
    return rounded(chi_square(orders, "g", "o_orderpriority").drop("pValue"))


@query("m17_gap_statistic")
def gap(spark, sf):
    return rounded(gap_statistic(_vectors(spark, sf), range(2, 11)))
