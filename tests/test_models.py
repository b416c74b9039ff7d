import numpy as np
import pytest
from pyspark.sql import functions as F

from grainline.operators import forest, reduce


def test_pca_components_uncorrelated_and_centred(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=800)
    rows = [(float(x), float(2 * x + rng.normal() * 0.1), float(rng.normal())) for x in a]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    out = reduce.pca(df, ["a", "b", "c"], 2).toPandas()
    assert list(out.columns) == ["pca_component_1", "pca_component_2"]
    assert abs(out.mean()).max() < 1e-9
    assert abs(np.corrcoef(out.T)[0, 1]) < 1e-9


def test_isolation_forest_finds_planted_points(spark):
    rng = np.random.default_rng(4)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(2000, 2)))]
    pts += [(2000 + i, 8.0 + i, -8.0 - i) for i in range(20)]
    df = spark.createDataFrame(pts, "id int, x double, y double")
    model = forest.fit_isolation_forest(df, ["x", "y"], n_trees=50, contamination=0.01, seed=7)
    out = model.transform(df).toPandas()
    assert out.loc[out.id >= 2000, "is_outlier"].all()
    assert 15 <= out.is_outlier.sum() <= 30


def _brute_knn(X, k):
    n = X.shape[1]
    out = X.copy()
    for j in range(n):
        miss = np.isnan(X[:, j])
        don = np.flatnonzero(~miss)
        for r in np.flatnonzero(miss):
            diff = X[r][None, :] - X[don]
            cnt = (~np.isnan(diff)).sum(1)
            d2 = np.where(cnt > 0, np.nansum(diff ** 2, 1) * n / np.maximum(cnt, 1), np.nan)
            ok = ~np.isnan(d2)
            idx, dd = don[ok], d2[ok]
            keys = []
            for c in reversed(range(n)):
                keys += [np.nan_to_num(X[idx, c]), ~np.isnan(X[idx, c])]
            o = np.lexsort(keys + [dd])[:k]
            out[r, j] = X[idx[o], j].mean()
    return out


def test_knn_exact_against_brute_force_with_rings_and_chunks(spark):
    from grainline.operators.knn import impute_knn
    rng = np.random.default_rng(9)
    X = np.column_stack([rng.integers(0, 300, 600).astype(float), rng.normal(size=600), rng.normal(size=600)])
    X[rng.random(600) < 0.15, 1] = np.nan
    X[rng.random(600) < 0.10, 2] = np.nan
    X[:200, 0] = 7.0                                    # a hot value holding a third of the rows
    rows = [(i, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(X)]
    df = spark.createDataFrame(rows, "rid string, a double, b double, c double".replace("rid string", "rid int"))
    df = df.withColumn("rid", F.col("rid").cast("string"))
    got = impute_knn(df, None, 4, donors_per_cell=40, chunk_rows=30).toPandas()
    got = got.assign(rid=got.rid.astype(int)).sort_values("rid")[["a", "b", "c"]].to_numpy()
    assert np.allclose(got, _brute_knn(X, 4), atol=1e-12)


@pytest.mark.parametrize("shape", ["skewed", "gappy", "clumps"])
def test_knn_tree_against_brute_force(spark, shape):
    """Many leaves over skewed columns, over columns that all have gaps, and over one dense clump."""
    from grainline.operators.knn import impute_knn
    rng = np.random.default_rng(11)
    n = 500
    if shape == "skewed":
        X = np.exp(3 * rng.normal(size=(n, 3)))
        X[rng.random(n) < 0.1, 1] = np.nan
    elif shape == "gappy":
        X = np.round(rng.normal(size=(n, 4)), 2)
        X[rng.random((n, 4)) < 0.35] = np.nan
    else:
        X = np.where(rng.random((n, 1)) < 0.8, 0.001 * rng.normal(size=(n, 3)), 100 * rng.normal(size=(n, 3)))
        X[: n // 3] = [0.0, 0.0, 1.0]                       # one row a third of the table
        X[rng.random(n) < 0.1, 2] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) + (i,) for i, row in enumerate(X)],
                               ", ".join(f"c{i} double" for i in range(X.shape[1])) + ", id bigint")
    got = impute_knn(df, None, 4, columns=[f"c{i}" for i in range(X.shape[1])], donors_per_cell=20, chunk_rows=25)
    got = got.toPandas().sort_values("id")[[f"c{i}" for i in range(X.shape[1])]].to_numpy(float)
    want = _brute_knn(X, 4)
    want = np.where(np.isnan(want), np.nanmean(X, axis=0), want)    # rows without a coordinate to compare
    assert np.allclose(got, want, atol=1e-9)


def test_tree_bounds_hold():
    """A node's bound never exceeds the distance to a point in it; leaves are of even size."""
    from grainline.operators.spacetree import Boxes, grow, leaf_of
    rng = np.random.default_rng(4)
    P = np.exp(2 * rng.normal(size=(2000, 3)))
    P[rng.random(P.shape) < 0.2] = np.nan
    nodes = grow(P, 40).packed()
    leaf = leaf_of(nodes, P)
    sizes = np.bincount(leaf, minlength=40)
    assert sizes.max() <= 4 * 2000 / 40
    low, high = np.full((40, 3), np.inf), np.full((40, 3), -np.inf)
    always, ever = np.zeros((40, 3), bool), np.zeros((40, 3), bool)
    for i in range(40):
        q = P[leaf == i]
        always[i], ever[i] = (~np.isnan(q)).all(0), (~np.isnan(q)).any(0)
        low[i], high[i] = np.nanmin(np.vstack([q, np.full(3, np.inf)]), 0), np.nanmax(np.vstack([q, np.full(3, -np.inf)]), 0)
    boxes = Boxes(nodes, low, high, always, ever, sizes > 0)
    x = P[:60]
    point, at, bound = boxes.near(x, np.full(60, np.inf))
    for p, i, b in zip(point, at, bound):
        diff = x[p] - P[leaf == i]
        shared = (~np.isnan(diff)).sum(1)
        d2 = np.where(shared > 0, np.nansum(diff ** 2, 1) * 3 / np.maximum(shared, 1), np.inf)
        assert b <= d2.min()


def test_scatter_matches_numpy_over_tiles_and_partitions(spark):
    """Large means, columns over several tiles, partitions of unequal size and an empty one."""
    from grainline.functions.gram import scatter
    rng = np.random.default_rng(3)
    X = rng.normal(size=(150, 150)) * np.arange(1, 151) + 1e6
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], ", ".join(f"c{i} double" for i in range(150)))
    n, mean, m = scatter(df.repartition(7))
    assert n == 150 and np.allclose(mean, X.mean(0), rtol=1e-12)
    assert np.allclose(m / 149, np.cov(X.T), rtol=1e-8, atol=1e-6)
    n, mean, m = scatter(df.limit(0))
    assert n == 0 and not m.any()


def test_pca_of_many_columns_and_no_rows(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(300, 2)) @ rng.normal(size=(2, 80))
    df = spark.createDataFrame([tuple(map(float, r)) for r in base], ", ".join(f"c{i} double" for i in range(80)))
    model = reduce.fit_pca(df, None, 2)
    assert abs(sum(model.explained_variance_ratio) - 1) < 1e-9
    assert np.allclose(np.cov(model.transform(df).toPandas().to_numpy().T),
                       np.diag(np.sort(np.linalg.eigvalsh(np.cov(base.T)))[::-1][:2]), atol=1e-6)
    assert reduce.pca(df.limit(0), None, 2).count() == 0
