import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shopsight.cluster import density as density_module, kmeans as kmeans_module, metrics as M, models as models_module
from shopsight.cluster.blocks import distances, every_pair, make_blocks, make_stripes, nearest_distances, product_distances, within
from shopsight.cluster.density import dbscan, distinct_points, k_distances
from shopsight.cluster.kmeans import CentreModel, fit_many, lloyd
from shopsight.cluster.models import Mixture, cut_tree, fit_mixtures, gmm_criteria, gmm_labels, hierarchical, linkage_table, merge_tree, micro_clusters, sweep_gmm
from shopsight.cluster.segments import business_labels

SIZES = [16, 1024]


def cloud(seed=0, n=260):
    """Two dense spots, a thin bridge, scattered points, and one place that holds a third of the rows."""
    rng = np.random.default_rng(seed)
    spots = [rng.normal(0, 0.3, (n // 4, 3)), rng.normal(3, 0.3, (n // 4, 3)), rng.uniform(-3, 6, (n // 6, 3))]
    same = np.tile([[8.0, 8.0, 8.0]], (n // 3, 1))
    return np.vstack([*spots, same])


def vectors(spark, xs, labels=None):
    rows = [(i, [float(v) for v in x], int(labels[i]) if labels is not None else 0) for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "id long, x array<double>, cluster int").withColumn("features", array_to_vector("x")).drop("x").persist()


def gaps(xs):
    return np.sqrt(((xs[:, None, :] - xs[None, :, :]) ** 2).sum(axis=2))


def brute_dbscan(xs, eps, least):
    near = gaps(xs) <= eps
    core = near.sum(axis=1) >= least
    labels, number = np.full(len(xs), -1), 0
    for i in range(len(xs)):
        if not core[i] or labels[i] >= 0:
            continue
        stack = [i]
        labels[i] = number
        while stack:
            p = stack.pop()
            if not core[p]:
                continue
            for q in np.flatnonzero(near[p] & (labels < 0)):
                labels[q] = number
                stack.append(q)
        number += 1
    return labels


def test_blocks_are_bounded_even_where_points_coincide(spark):
    xs = cloud()
    points = vectors(spark, xs).select("id", F.expr("transform(sequence(0, 2), i -> 1.0D)").alias("x"))
    blocks = make_blocks(points, 16)
    assert blocks.rows.agg(F.max("n"), F.sum("n")).first() == (16, len(xs))


@pytest.mark.parametrize("block_rows", SIZES)
def test_k_distance(spark, block_rows):
    xs = cloud()
    got = {r.id: r.k_distance for r in k_distances(vectors(spark, xs), "id", 5, block_rows=block_rows).collect()}
    expected = np.sort(gaps(xs), axis=1)[:, 4]
    assert [got[i] for i in range(len(xs))] == pytest.approx(list(expected))


@pytest.mark.parametrize("block_rows", SIZES)
@pytest.mark.parametrize("eps,least", [(0.35, 5), (0.8, 4), (2.5, 10)])
def test_dbscan(spark, block_rows, eps, least):
    xs = cloud(1)
    got = {r.id: r.cluster for r in dbscan(vectors(spark, xs), "id", eps, least, block_rows=block_rows).collect()}
    assert [got[i] for i in range(len(xs))] == list(brute_dbscan(xs, eps, least))


def test_blocks_are_read_from_files_and_only_near_ones(spark, monkeypatch):
    """Every point is in one block of few points; neighbours and clusters come from a small part of all pairs, and no block is shuffled for a pair."""
    rng = np.random.default_rng(3)
    xs = np.concatenate([rng.normal(size=(400, 2)) + 50 * place for place in range(10)])[rng.permutation(4000)]
    frame = vectors(spark, xs)
    tiles = density_module.write_tiles(distinct_points(density_module.as_points(frame, "id")), 64)
    sizes = tiles.on_groups(lambda t, group: (pd.DataFrame({"id": t.points(i)[2], "block": i, "n": int(t.n[i])}) for i in group), "id long, block long, n long").collect()
    assert sorted(r.id for r in sizes) == list(range(4000)) and max(r.n for r in sizes) <= 64
    tiles.release()
    pairs = spark.sparkContext.accumulator(0)

    def counted(plain):
        return lambda xs_a, n_a, xs_b, n_b, *rest: (pairs.add(int(n_a * n_b)), plain(xs_a, n_a, xs_b, n_b, *rest))[1]

    monkeypatch.setattr(density_module, "nearest_distances", counted(nearest_distances))
    monkeypatch.setattr(density_module, "within", counted(within))
    found = [r.k_distance for r in k_distances(frame, "id", 5, block_rows=64).orderBy("id").collect()]
    assert found == pytest.approx(list(np.sort(gaps(xs), axis=1)[:, 4]))
    assert pairs.value < 4000 * 4000 / 10
    got = [r.cluster for r in dbscan(frame, "id", 0.6, 8, block_rows=64).orderBy("id").collect()]
    assert got == list(brute_dbscan(xs, 0.6, 8))
    assert pairs.value < 4000 * 4000 / 5


def test_nearest_takes_known_distances_into_account():
    rng = np.random.default_rng(6)
    a, b, c = rng.normal(size=(50, 3)), rng.normal(size=(40, 3)), rng.normal(size=(60, 3)) + 0.2
    ones = np.ones(60, np.int64)
    known = nearest_distances(a, 50, b, 40, ones[:40], 4)
    both = nearest_distances(a, 50, c, 60, ones, 4, known)
    assert (both == nearest_distances(a, 50, np.vstack([b, c]), 100, np.ones(100, np.int64), 4)).all()


def test_dbscan_all_noise(spark):
    xs = np.arange(12.0).reshape(-1, 1) * 10
    assert {r.cluster for r in dbscan(vectors(spark, xs), "id", 1.0, 2).collect()} == {-1}


def brute_silhouette(xs, labels):
    d, out = gaps(xs), []
    for i in range(len(xs)):
        own = (labels == labels[i]) & (np.arange(len(xs)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, labels == c].mean() for c in set(labels) - {labels[i]})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.array(out)


@pytest.mark.parametrize("block_rows", SIZES)
def test_silhouette(spark, block_rows):
    xs = cloud(2)
    labels = (xs[:, 0] > 1.5).astype(int) + 2 * (np.arange(len(xs)) == 7)
    got = {r.id: r.silhouette for r in M.silhouette_samples(vectors(spark, xs, labels), "id", block_rows=block_rows).collect()}
    assert [got[i] for i in range(len(xs))] == pytest.approx(list(brute_silhouette(xs, labels)))


def test_one_cluster_has_no_measures(spark):
    df = vectors(spark, cloud(), [0] * 1000)
    row = M.evaluate_labels(df, "one", "id").first()
    assert row.silhouette is None and row.error == "Less than 2 clusters"
    row = M.evaluate_labels(df.withColumn("cluster", F.lit(-1)), "noise", "id").first()
    assert (row.n_clusters, row.n_noise) == (0, df.count())


def brute_tree(xs, clusters, method):
    groups = [[i] for i in range(len(xs))]

    def cost(a, b):
        if method == "ward":
            u, v = xs[a].mean(axis=0), xs[b].mean(axis=0)
            return len(a) * len(b) / (len(a) + len(b)) * ((u - v) ** 2).sum()
        d = gaps(xs)[np.ix_(a, b)]
        return d.max() if method == "complete" else d.mean()

    while len(groups) > clusters:
        pairs = [(cost(a, b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j]
        _, i, j = min(pairs)
        groups[i] += groups.pop(j)
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("method", ["ward", "complete", "average"])
def test_tree(method):
    xs = np.random.default_rng(4).normal(size=(40, 3))
    labels = cut_tree(merge_tree(xs, np.ones(40), method), 40, 5)
    assert {frozenset(np.flatnonzero(labels == c)) for c in set(labels)} == brute_tree(xs, 5, method)


def test_weighted_tree_equals_repeated_points():
    xs = np.random.default_rng(5).normal(size=(12, 2))
    sizes = np.arange(12) % 3 + 1
    whole = np.repeat(xs, sizes, axis=0)
    few = cut_tree(merge_tree(xs, sizes), 12, 4)
    many = cut_tree(merge_tree(whole, np.ones(len(whole))), len(whole), 4)
    assert (np.repeat(few, sizes)[:, None] == np.repeat(few, sizes)).tolist() == (many[:, None] == many).tolist()


def test_hierarchical_above_the_limit_covers_every_row(spark):
    xs = cloud(3)
    out = hierarchical(vectors(spark, xs), "id", 3, m=20)
    assert out.count() == len(xs) and out.select("cluster").distinct().count() == 3


def brute_step(xs, weights, means, covariances):
    """One round of expectation-maximisation in plain numpy: (new parameters, log-likelihood of the old ones)."""
    logs = []
    for w, m, c in zip(weights, means, covariances):
        away = xs - m
        quad = np.einsum("ni,ij,nj->n", away, np.linalg.inv(c), away)
        logs.append(np.log(w) - 0.5 * (quad + np.log(np.linalg.det(2 * np.pi * c))))
    dens = np.exp(np.array(logs).T)
    share = dens / dens.sum(axis=1, keepdims=True)
    mass = share.sum(axis=0)
    new_means = share.T @ xs / mass[:, None]
    spreads = [((xs - m).T * share[:, j]) @ (xs - m) / mass[j] + 1e-6 * np.eye(xs.shape[1]) for j, m in enumerate(new_means)]
    return (mass / len(xs), new_means, np.array(spreads)), np.log(dens.sum(axis=1)).sum(), share


def test_mixture_is_a_fixed_point_of_the_plain_steps(spark):
    rng = np.random.default_rng(6)
    xs = np.vstack([rng.normal([0, 0, 0], [1, 0.5, 2], (200, 3)), rng.normal([6, 5, -4], [0.5, 1, 1], (100, 3)), np.tile([[3.0, -3.0, 3.0]], (30, 1))])
    rows = vectors(spark, xs, np.ones(len(xs))).repartition(5).persist()
    model = fit_mixtures(rows, [3], restarts=2, tol=1e-9)[3]
    (weights, means, spreads), likelihood, share = brute_step(xs, model.weights, model.means, model.covariances)
    assert model.log_likelihood == pytest.approx(likelihood)
    assert model.weights == pytest.approx(weights, abs=1e-4)
    assert model.means == pytest.approx(means, abs=1e-3)
    assert model.covariances == pytest.approx(spreads, abs=1e-3)
    got = {r.id: r for r in gmm_labels(model, rows).collect()}
    assert [got[i].cluster for i in range(len(xs))] == share.argmax(axis=1).tolist()
    assert [got[i].confidence for i in range(len(xs))] == pytest.approx(share.max(axis=1).tolist())


def test_mixtures_of_many_sizes_are_fitted_in_one_sweep(spark):
    found = {r.n: r for r in sweep_gmm(vectors(spark, cloud(7)), range(1, 5), restarts=2).collect()}
    assert sorted(found) == [1, 2, 3, 4] and found[1].log_likelihood < found[3].log_likelihood
    assert found[2].aic == pytest.approx(gmm_criteria(found[2].log_likelihood, 2, 3, len(cloud(7)))[1])


def test_mixture_without_covariances_starts_at_the_nearest_mean():
    start = Mixture(np.array([0.5, 0.5]), np.array([[0.0], [10.0]]), None)
    share, _ = start.shares(np.array([[1.0], [9.0]]))
    assert share.tolist() == [[1, 0], [0, 1]]


def test_criteria():
    bic, aic = gmm_criteria(-100.0, 2, 3, 50)
    assert aic == 200 + 2 * (6 + 12 + 1) and bic == pytest.approx(200 + 19 * np.log(50))


def test_labels_repeat_with_the_cluster_number(spark):
    rows = [(0, 0.0, 9.0, 9.0, 5.0), (1, 0.1, 9.0, 8.0, 4.9), (2, 9.0, 1.0, 1.0, 3.0), (3, 0.2, 8.5, 9.0, 1.0), (4, 5.0, 1.0, 7.0, 3.0)]
    df = spark.createDataFrame(rows, "cluster_id int, recency double, frequency_log double, monetary_log double, avg_review_score double")
    out = {r.cluster_id: r.customer_segment for r in business_labels(df).collect()}
    assert out == {0: "champions", 1: "champions_1", 2: "at_risk", 3: "needs_attention", 4: "big_spenders"}


def test_copies_are_collapsed(spark):
    points = vectors(spark, cloud()).select("id", F.array(F.lit(1.0)).alias("x"))
    assert distinct_points(points).count() == 1


def test_ward_leaves_are_fitted_centres_whatever_the_row_count(spark):
    rng = np.random.default_rng(5)
    middle = np.repeat([[0.0, 0.0], [9.0, 0.0], [0.0, 9.0]], 20, axis=0)
    rows = [(1000 + i, x.tolist()) for i, x in enumerate(middle + rng.normal(0, 0.3, middle.shape))]
    vectors = spark.createDataFrame(rows, "id long, x array<double>").select("id", array_to_vector("x").alias("features")).persist()
    for m in (20, 100):  # fewer and more than the rows
        assert micro_clusters(vectors, "id", m).agg(F.max("micro")).first()[0] < m
        found = hierarchical(vectors, "id", 3, m).collect()
        assert len(found) == 60 and len({(r.cluster, (r.id - 1000) // 20) for r in found}) == 3
        assert {(r.method, 3 <= r.micro_clusters <= min(m, 60)) for r in found} == {("ward", True)}
        tree = linkage_table(vectors, "id", m).collect()
        assert {(r.method, r.micro_clusters) for r in tree} == {("ward", len(tree) + 1)}


def test_shared_passes_equal_plain_lloyd(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.4, (80, 3)) for c in ((0, 0, 0), (4, 0, 1), (0, 5, -2))])
    points = spark.createDataFrame([(row.tolist(),) for row in x], "x array<double>").repartition(4)
    starts = [x[rng.choice(len(x), k, replace=False)] for k in (1, 2, 3, 5)] + [np.concatenate([x[:2], [[99.0, 99.0, 99.0]]])]
    starts.append(starts[2][::-1])  # the same centres in another order: followed once
    for start, model in zip(starts, lloyd(points, starts, tol=0.0)):
        centres = np.array(start, float)
        for _ in range(model.rounds + 1):
            gaps = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
            label = gaps.argmin(axis=1)
            centres = np.stack([x[label == j].mean(axis=0) if (label == j).any() else centres[j] for j in range(len(centres))])
        assert np.allclose(sorted(model.centres.tolist()), sorted(centres.tolist()))
        assert np.isclose(model.cost, gaps.min(axis=1).sum())


def test_one_pass_serves_all_k_and_restarts(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.2, (60, 2)) for c in ((0, 0), (3, 0), (0, 3), (3, 3))])
    vectors = spark.createDataFrame([(i, Vectors.dense(row)) for i, row in enumerate(x.tolist())], ["id", "features"]).persist()
    passes = []
    plain = kmeans_module._pass
    monkeypatch.setattr(kmeans_module, "_pass", lambda points, models: passes.append(len(models)) or plain(points, models))
    best = fit_many(vectors, [2, 4, 1], restarts=4, start_rows=20)
    assert passes[0] == 12 and passes == sorted(passes, reverse=True) and len(passes) > 1
    assert best[4].cost < best[2].cost < best[1].cost and best[4].cost < 60
    best[4].save(f"{tmp_path}/model")
    again = CentreModel.load(f"{tmp_path}/model")
    assert np.array_equal(again.centres, best[4].centres) and again.cost == best[4].cost
    found = again.transform(vectors)
    assert found.columns == ["id", "features", "prediction"] and found.groupBy("prediction").count().collect().__len__() == 4
    with pytest.raises(ValueError):
        fit_many(vectors.limit(0), [2])


def test_a_pass_is_one_stage(spark):
    points = kmeans_module.spread(vectors(spark, cloud()))
    points.count()
    sc = spark.sparkContext
    sc.setJobGroup("one-pass", "one pass")
    kmeans_module._pass(points, [np.zeros((2, 3)), np.ones((3, 3))])
    models_module._mixture_sums(points, [Mixture(np.full(2, 0.5), np.array([[0.0] * 3, [3.0] * 3]), None)])
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("one-pass") for s in tracker.getJobInfo(j).stageIds]
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sum(s is not None and s.numCompletedTasks > 0 for s in stages) == 2
    assert points.rdd.getNumPartitions() == 1
    points.unpersist()


def test_gap_fits_run_at_the_same_time(spark, monkeypatch):
    fit, meet = models_module.fit_many, threading.Barrier(4, timeout=60)

    def waiting(*args):
        meet.wait()
        return fit(*args)

    monkeypatch.setattr(models_module, "fit_many", waiting)
    found = models_module.gap_statistic(vectors(spark, cloud()), [2, 3], samples=3).collect()
    assert [r.k for r in found] == [2, 3] and all(np.isfinite([r.gap, r.deviation]).all() for r in found)


@pytest.mark.parametrize("dims", [1, 6, 64])
@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_neighbours_by_products_equal_those_measured_one_by_one(dims, offset):
    rng = np.random.default_rng(dims)
    a, b = (np.round(rng.normal(size=(n, dims)), 1) + offset for n in (90, 70))
    b[:30] = a[:30]
    gaps, weights = distances(a.ravel(), 90, b.ravel(), 70), rng.integers(1, 4, 70)
    for reach in np.quantile(gaps, [0, 0.01, 0.5, 1], method="nearest"):
        assert (within(a.ravel(), 90, b.ravel(), 70, reach) == (gaps <= reach)).all()
    for k in (1, 5, 300):
        every = np.repeat(gaps, np.minimum(weights, k), axis=1)
        every = np.sort(np.pad(every, ((0, 0), (0, max(0, k - every.shape[1]))), constant_values=np.inf), axis=1)[:, :k]
        assert (nearest_distances(a.ravel(), 90, b.ravel(), 70, weights, k) == every).all()


@pytest.mark.parametrize("dims", [1, 2, 64])
def test_distances_by_product_equal_those_by_coordinates(dims):
    """Far from the origin, with copies and near copies, where a matrix product alone loses small distances."""
    rng = np.random.default_rng(dims)
    a = rng.normal(size=(300, dims)) + 1e4
    b = np.vstack([a[:5], a[5:9] + 1e-7, rng.normal(size=(200, dims)) + 1e4])
    found = product_distances(a, b)
    assert found == pytest.approx(distances(a.ravel(), len(a), b.ravel(), len(b)), rel=1e-6, abs=0)
    assert (np.diag(found)[:5] == 0).all()


def test_silhouette_measures_copies_once_and_every_pair_of_blocks_once(spark, monkeypatch):
    """Distances of a quarter of the ordered pairs are enough here: half of the rows are copies, and both orders share one."""
    xs = np.repeat(cloud(2)[:60], 2, axis=0)
    labels = np.arange(len(xs)) % 3
    sizes = []
    monkeypatch.setattr(M, "product_distances", lambda a, b: sizes.append(len(a) * len(b)) or product_distances(a, b))
    ((names, sums),) = M._label_sums(xs.ravel(), labels, len(xs), xs.ravel(), labels, len(xs), True)
    assert sizes == [60 * 60] and names.tolist() == [0, 1, 2]
    assert sums == pytest.approx(np.stack([gaps(xs)[:, labels == c].sum(axis=1) for c in range(3)], axis=1))
    points = vectors(spark, xs, labels).select("id", F.expr("transform(sequence(0, 1), i -> id + 0.0D)").alias("x"))
    blocks = make_stripes(points, 16)
    pairs = [(r.a, r.b) for r in every_pair(blocks, ["ids"]).select("a", "b").collect()]
    assert len(set(pairs)) == len(pairs) == blocks.number * (blocks.number + 1) // 2 and all(a <= b for a, b in pairs)
    got = {r.id: r.silhouette for r in M.silhouette_samples(vectors(spark, xs, labels), "id", block_rows=16).collect()}
    assert [got[i] for i in range(len(xs))] == pytest.approx(list(brute_silhouette(xs, labels)))


def test_passes_read_stretches_of_vectors(spark):
    """A pass moves few large rows to Python, and totals them as numpy does, whatever the number of centres."""
    x = np.random.default_rng(8).normal(size=(30_000, 3)) + 1e3
    points = kmeans_module.spread(vectors(spark, x))
    assert points.count() <= 8 and points.agg(F.sum(F.size("x"))).first()[0] == x.size
    centres = [x[:4], x[5:905], np.vstack([x[:1], [[9e9] * 3]])]
    for model, sums in zip(centres, kmeans_module._pass(points, centres)):
        gaps = ((x[:, None, :2] - model[None, :, :2]) ** 2).sum(axis=2) + (x[:, None, 2] - model[None, :, 2]) ** 2
        label = gaps.argmin(axis=1)
        assert sums[:, 0].tolist() == np.bincount(label, minlength=len(model)).tolist()
        assert sums[:, 1].sum() == pytest.approx(gaps.min(axis=1).sum())
        assert sums[:, 2:].sum(axis=0) == pytest.approx(x.sum(axis=0))
    points.unpersist()


def test_start_sample_has_the_smallest_hashes_and_copies_do_not_shorten_it(spark):
    few = np.random.default_rng(2).normal(size=(400, 2))
    for x in (few, np.repeat(few[:3], 150, axis=0)):  # few different values may all have large hashes
        frame = vectors(spark, x)
        got = kmeans_module.start_sample(frame, 20)
        plain = frame.select(F.expr("id"), models_module.vector_to_array("features").alias("x")).orderBy(F.xxhash64("x"), "x").limit(20).collect()
        assert got.tolist() == [r.x for r in plain]


def test_micro_clusters_follow_the_nearest_mean_of_shared_passes(spark, monkeypatch):
    """The leaves come from the passes over packed rows, each row is in the nearest one, and their means go into the tree."""
    x = np.random.default_rng(11).normal(size=(900, 3))
    passes, trees = [], []
    plain = kmeans_module._pass
    monkeypatch.setattr(kmeans_module, "_pass", lambda points, models: passes.append(models) or plain(points, models))
    monkeypatch.setattr(models_module, "merge_tree", lambda c, n, method: trees.append((c, n)) or merge_tree(c, n, method))
    assigned, leaves, _ = models_module.ward_tree(vectors(spark, x), "id", 50)
    assert 1 < len(passes) <= models_module.MICRO_ROUNDS + 1 and [len(m) for m in passes[-1]] == [50]
    label = np.array([r.micro for r in assigned.orderBy("id").collect()])
    assert label.tolist() == ((x[:, None] - passes[-1][0][None]) ** 2).sum(axis=2).argmin(axis=1).tolist()
    ((centres, sizes),) = trees
    assert sizes.tolist() == [int((label == j).sum()) for j in leaves]
    assert centres == pytest.approx(np.stack([x[label == j].mean(axis=0) for j in leaves]))
