from collections import deque

import numpy as np
import pytest

from millrace.operators import clustering, components, density, metrics, scaling


def brute_force(points, eps, least):
    """Labels (least core index of the cluster, or -1) and core flags by comparing all points."""
    close = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)) <= eps
    core = close.sum(1) >= least
    label = np.full(len(points), -1)
    for i in range(len(points)):
        if core[i] and label[i] == -1:
            queue = deque([i])
            label[i] = i
            while queue:
                for j in np.where(close[queue.popleft()])[0]:
                    if core[j] and label[j] == -1:
                        label[j] = i
                        queue.append(j)
    for i in np.where(~core)[0]:
        near = [label[j] for j in np.where(close[i])[0] if core[j]]
        label[i] = min(near) if near else -1
    return label, core


def frame(spark, points):
    names = [f"f{i}" for i in range(points.shape[1])]
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "event_id long, " + ", ".join(f"{n} double" for n in names)), names


def clouds(seed):
    draw = np.random.default_rng(seed)
    dense = draw.normal(0, 0.2, (150, 3))
    ring = np.array([2.0, 2.0, 0.0]) + draw.normal(0, 0.4, (80, 3))
    copies = np.repeat([[5.0, 5.0, 5.0]], 40, axis=0)
    return np.vstack([dense, ring, copies, draw.uniform(-4, 8, (60, 3)), [[9.0, 9.0, 9.0]] * 2])


@pytest.mark.parametrize("seed", [1, 2])
def test_density_clusters_match_brute_force(spark, seed):
    points = clouds(seed)
    rows, names = frame(spark, points)
    model = density.DensityClustering(rows, names)
    label, core = brute_force(points, 0.5, 5)
    assert {r["id"]: r["label"] for r in model.labels().collect()} == {i: int(v) for i, v in enumerate(label)}
    assert {r["id"]: r["is_core"] for r in model.core_rows().collect()} == {i: bool(v) for i, v in enumerate(core)}
    assert {r["id"]: r["is_noise"] for r in model.noise_rows().collect()} == {i: bool(v == -1) for i, v in enumerate(label)}


def test_density_with_boxes_too_large_for_direct_comparison(spark):
    """Two dense plates whose distance straddles eps at one corner only."""
    draw = np.random.default_rng(4)
    plate = draw.uniform(0, 0.34, (120, 2))
    points = np.vstack([plate, plate + [0.83, 0.0], [[0.34, 0.0], [0.84, 0.0]]])
    rows, names = frame(spark, points)
    label, _ = brute_force(points, 0.5, 5)
    assert {r["id"]: r["label"] for r in density.DensityClustering(rows, names).labels().collect()} == {i: int(v) for i, v in enumerate(label)}


def test_two_points_are_noise(spark):
    rows, names = frame(spark, np.zeros((2, 2)))
    assert [r["label"] for r in density.DensityClustering(rows, names).labels().collect()] == [-1, -1]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, j) for j in range(200, 260)] + [(300, 300 + 1)]
    found = components.connected_components(spark.createDataFrame(edges, "u long, v long"))
    roots = {r["node"]: r["root"] for r in found.collect()}
    assert {roots[i] for i in range(100, 161)} == {100} and {roots[j] for j in range(200, 260)} == {7}
    assert roots[7] == 7 and roots[301] == 300 and len(roots) == 61 + 61 + 2


def labelled(spark):
    points = clouds(3)
    rows, names = frame(spark, points)
    centres = [[0.0, 0.0, 0.0], [2.0, 2.0, 0.0], [5.0, 5.0, 5.0]]
    placed = clustering.assign(rows, names, centres)
    labels = np.argmin(((points[:, None] - np.array(centres)[None]) ** 2).sum(-1), axis=1)
    return points, labels, placed, names


@pytest.mark.parametrize("block", [4096, 50])
def test_silhouettes(spark, block):
    points, labels, placed, names = labelled(spark)
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))

    def mean(d):
        same = np.array([d[i][labels == labels[i]].sum() / ((labels == labels[i]).sum() - 1) for i in range(len(points))])
        other = np.array([min(d[i][labels == k].mean() for k in set(labels) if k != labels[i]) for i in range(len(points))])
        return ((other - same) / np.maximum(same, other)).mean()

    assert metrics.silhouette(placed, names, block_rows=block).first()[0] == pytest.approx(mean(distance))
    assert metrics.silhouette_squared(placed, names).first()[0] == pytest.approx(mean(distance**2))


def test_single_cluster_has_no_quality(spark):
    rows, names = frame(spark, np.random.default_rng(0).normal(size=(20, 2)))
    placed = clustering.assign(rows, names, [[0.0, 0.0]])
    assert metrics.calinski_harabasz(placed, names).first()["calinski_harabasz"] is None
    assert metrics.davies_bouldin(placed, names).first()["davies_bouldin"] is None
    assert metrics.silhouette(placed, names).first()["silhouette"] is None


def test_kmeans_is_at_a_fixed_point(spark):
    _, _, placed, names = labelled(spark)
    fit = clustering.fit_kmeans(placed, names, 3, tolerance=0.0)
    stepped = clustering.update_centres(clustering.assign(placed, names, fit.centres), names).orderBy("cluster").collect()
    assert np.allclose([[r[n] for n in names] for r in stepped], fit.centres)
    x = np.array([[r[n] for n in names] for r in placed.collect()])
    assert fit.cost == pytest.approx(((x[:, None] - np.array(fit.centres)[None]) ** 2).sum(-1).min(1).sum())


def test_kmeans_depends_on_the_rows_alone(spark):
    rows, names = frame(spark, np.random.default_rng(3).normal(size=(300, 2)))
    fits = [clustering.fit_kmeans(part, names, 4) for part in (rows.coalesce(1), rows.repartition(7))]
    assert np.allclose(fits[0].centres, fits[1].centres) and all(f.converged for f in fits)
    assert not clustering.fit_kmeans(rows, names, 4, rounds=1).converged


def test_kmeans_of_few_or_no_points(spark):
    rows, names = frame(spark, np.array([[1.0, 2.0], [1.0, 2.0], [3.0, 4.0]]))
    assert clustering.fit_kmeans(rows, names, 5).centres == [[1.0, 2.0], [3.0, 4.0]]
    assert clustering.fit_kmeans(rows.where("false"), names, 5).centres == []


def test_keyed_kmeans_equals_one_fit_per_key(spark):
    draw = np.random.default_rng(8)
    data = {k: np.vstack([draw.normal(c, 0.1, (n, 2)) for c in (-1.0, 1.0)]) for k, n in (("hot", 200), ("cold", 10))}
    rows = [(k, [float(v) for v in p]) for k, points in data.items() for p in points]
    points = spark.createDataFrame(rows, "machine_id string, x array<double>")
    fitted = clustering.keyed_kmeans(points, "machine_id", "x", clustering.spread_centres(2, 2))
    for r in fitted.collect():
        half = len(data[r["machine_id"]]) // 2
        for c, part in zip(r["centres"], (data[r["machine_id"]][:half], data[r["machine_id"]][half:])):
            assert list(c["centre"]) == pytest.approx(list(part.mean(0)))


def test_scaler_of_a_constant_feature(spark):
    rows, names = frame(spark, np.array([[1.0, 5.0], [3.0, 5.0]]))
    scaled = scaling.Scaler.fit(rows, names).transform(rows).orderBy("event_id").collect()
    assert [(r["f0"], r["f1"]) for r in scaled] == [(-1.0, 0.0), (1.0, 0.0)]
